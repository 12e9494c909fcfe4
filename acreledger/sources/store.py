"""Small files of the ledger's folder: markers and leases, through the file system that its URI names."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _open(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if it is not there."""
    fs, place = _open(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []


def listing(spark: SparkSession, folder: str) -> str:
    """Files of a folder with their sizes and times, as one text; hidden files are left out."""
    fs, place = _open(spark, folder)
    found = fs.listStatus(place) if fs.exists(place) else []
    lines = [(x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in found]
    return json.dumps(sorted(line for line in lines if line[0][0] not in "._"))


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.delete(place, True)


def put(spark: SparkSession, path: str, text: str = "", overwrite: bool = False) -> bool:
    """Writes a small file; False if one is there already and may not be replaced.

    The file system creates it in one step, so of several writers one succeeds.
    """
    fs, place = _open(spark, path)
    try:
        stream = fs.create(place, overwrite)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception) or "already exists" in str(error.java_exception):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def get(spark: SparkSession, path: str) -> tuple[str, float] | None:
    """Text of a small file and when it was last written (seconds), or None."""
    fs, place = _open(spark, path)
    try:
        status = fs.getFileStatus(place)
        stream = fs.open(place)
        data = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        stream.close()
    except Py4JJavaError as error:
        if "FileNotFound" in str(error.java_exception):
            return None
        raise
    return data.decode(), status.getModificationTime() / 1000


class LedgerLocked(RuntimeError):
    """Another writer holds the books; what was to be written is tried again on the next start."""


@dataclass(frozen=True)
class Lease:
    """A writer's right to the books: the highest number holds (a fencing number), until it expires.

    Leases are files ``lease-<number>``; taking one creates the next number, which only one writer can.
    A holder that dies leaves its lease to expire.  A holder that was too slow finds a higher number at its
    next :meth:`check` and must not write.
    """

    spark: SparkSession
    folder: str
    number: int
    owner: str
    seconds: float

    @property
    def path(self) -> str:
        return f"{self.folder}/lease-{self.number:012d}"

    def renew(self) -> None:
        """Starts the lease's time anew; fails if another writer has taken over."""
        self.check()
        put(self.spark, self.path, json.dumps({"owner": self.owner, "seconds": self.seconds}), overwrite=True)

    def check(self) -> None:
        """Raises unless this is the highest lease and its time is not over."""
        found = _newest(self.spark, self.folder)
        if found is None or found[0] != self.number or found[1] != self.owner or found[2] < time.time():
            raise LedgerLocked(f"lease {self.number} has been lost")

    def release(self) -> None:
        """Ends the lease, if it is still held."""
        found = _newest(self.spark, self.folder)
        if found is not None and found[:2] == (self.number, self.owner):
            put(self.spark, self.path, json.dumps({"owner": self.owner, "seconds": 0}), overwrite=True)


def _newest(spark: SparkSession, folder: str) -> tuple[int, str | None, float] | None:
    """Number, owner and end (seconds) of the highest lease.

    A file without text has just been created by a writer; it counts as held for a minute.
    """
    numbers = [int(n.removeprefix("lease-")) for n in names(spark, folder) if n.startswith("lease-")]
    if not numbers:
        return None
    found = get(spark, f"{folder}/lease-{max(numbers):012d}")
    if found is None:
        return max(numbers), None, 0.0
    text, written = found
    held = json.loads(text) if text else {"owner": None, "seconds": 60}
    return max(numbers), held["owner"], written + held["seconds"] if held["seconds"] else 0.0


def take_lease(spark: SparkSession, folder: str, seconds: float = 600) -> Lease:
    """The next lease of a folder, if none is held; :class:`LedgerLocked` otherwise."""
    newest = _newest(spark, folder)
    if newest is not None and newest[2] >= time.time():
        raise LedgerLocked(f"the books are held by lease {newest[0]}")
    lease = Lease(spark, folder, (newest[0] if newest else 0) + 1, uuid.uuid4().hex, seconds)
    if not put(spark, lease.path, json.dumps({"owner": lease.owner, "seconds": seconds})):
        raise LedgerLocked(f"lease {lease.number} was taken by another writer")
    for name in names(spark, folder):
        if name.startswith("lease-") and int(name.removeprefix("lease-")) < lease.number - 10:
            remove(spark, f"{folder}/{name}")
    return lease


@contextmanager
def leased(spark: SparkSession, folder: str, seconds: float = 600) -> Iterator[Lease]:
    """Holds a lease for the time of a block."""
    lease = take_lease(spark, folder, seconds)
    try:
        yield lease
    finally:
        lease.release()
