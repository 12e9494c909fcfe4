"""WARC archives: a writer of monolithic gzip files, their normaliser, and a reader by offset index.

Some crawlers compress a whole archive as one gzip stream, which can only be read from its start.  The
normaliser inflates such a stream once, from front to back, writes every record as a gzip member of its
own and beside it an index of offsets.  Readers then share out the members of one archive among tasks.

Files are written through the file system that the folder's URI names.  A task writes to a name of its
own attempt and moves the file into place when it is complete, so a repeated task leaves one whole file.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, uri: str):
        self.fs, self.path = _place(uri)
        self.attempt = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.attempt, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        if data:
            self.stream.write(data)
            self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        if self.fs.get_file_info(self.path).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.path)
        self.fs.move(self.attempt, self.path)


def record_id(key) -> str:
    return f"<urn:x-page:{'null' if key is None else key}>"


def _header(fields: list[tuple[str, str]]) -> bytes:
    clean = lambda v: v.replace("\r", "%0D").replace("\n", "%0A")
    return ("WARC/1.0\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields) + "\r\n").encode()


def record(key, uri: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One record; a revisit keeps the HTTP header (and so the payload's length) without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(key)), ("WARC-Date", date), ("WARC-Target-URI", uri or "")]
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``_sha1``, ``_first``: the payload's digest, and the row to refer to (null: a response).

    Among equal payloads of at least ``min_bytes`` the row with the largest key is the response; rows that
    tie for it are all responses, and so are rows whose payload has no key at all.  Null is an empty payload.
    Copies are counted before the shuffle; only digests that occur twice are joined back.  Input columns with working
    names (``_sha1``, ``_first``, ``_digest``, ``_k``, ``_n``) give way.
    """
    body = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("_sha1", "_first", "_digest", "_k", "_n")])
    marked = pages.withColumn("_sha1", F.sha1(body))
    long = pages.filter(F.length(body) >= min_bytes).select(F.sha1(body).alias("_digest"), F.col(key).alias("_k"))
    firsts = long.groupBy("_digest").agg(F.max("_k").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    joined = marked.join(firsts, F.col("_sha1") == F.col("_digest"), "left")
    return joined.withColumn("_first", F.when(~F.col(key).eqNullSafe(F.col("_first")), F.col("_first"))).drop("_digest")


def write_monolithic(pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Writes one gzip stream per partition of ``with_revisits`` rows; returns their ``path``, lazily."""
    rows = pages.select(F.col(key).alias("key"), F.col(uri).alias("uri"), F.col(html).cast("binary").alias("body"), F.col("_sha1").alias("sha1"), F.col("_first").alias("first"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for k, u, body, sha1, first in zip(*[c for c in batch.columns], strict=True):
                if out is None:
                    name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
                    out, squeeze = _Output(name), zlib.compressobj(level, zlib.DEFLATED, 31)
                digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
                raw = body.as_py() or b""
                out.write(squeeze.compress(record(k.as_py(), u.as_py(), raw, digest, first.as_py(), first.is_valid, date)))
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["path"])

    return rows.mapInArrow(task, "path string")


class _Inflated:
    """A gzip file (of one member or many) as a stream of plain bytes, inflated once."""

    def __init__(self, stream):
        self.stream, self.unzip, self.buffer, self.begun = stream, zlib.decompressobj(31), bytearray(), False

    def _more(self) -> bool:
        data = self.unzip.unconsumed_tail or self.unzip.unused_data
        if self.unzip.eof:
            data = self.unzip.unused_data.lstrip(b"\0")
            self.unzip, self.begun = zlib.decompressobj(31), False
        if not data:
            data = self.stream.read(CHUNK)
            if not data:
                if self.begun:
                    raise ValueError("the archive ends within a gzip member")
                return False
        self.begun = True
        self.buffer += self.unzip.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the stream.  A header is as long as its URL."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer.strip(b"\r\n"):
                    raise ValueError("the archive ends within a header")
                return None
        data = bytes(self.buffer[: at + len(mark)])
        del self.buffer[: at + len(mark)]
        return data

    def take(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            data = bytes(self.buffer[:count])
            del self.buffer[: len(data)]
            count -= len(data)
            if data:
                yield data


def fields_of(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def normalise_file(path: str, target: str, level: int = 6) -> int:
    """Rewrites an archive with one member per record, and ``target + '.idx'``; returns the number of records.

    Memory is bounded by a chunk however long a record is.  Index lines are JSON: offset, length,
    type, id and target of each record.
    """
    fs, source = _place(path)
    out, index, count = _Output(target), _Output(f"{target}.idx"), 0
    with fs.open_input_stream(source, compression=None) as stream:
        plain = _Inflated(stream)
        while (header := plain.until(b"\r\n\r\n")) is not None:
            fields, start = fields_of(header.lstrip(b"\r\n")), out.size
            squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
            out.write(squeeze.compress(header.lstrip(b"\r\n")))
            for piece in plain.take(int(fields["content-length"])):
                out.write(squeeze.compress(piece))
            for _ in plain.take(4):  # the two line ends after a block
                pass
            out.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
            line = {"offset": start, "length": out.size - start, "type": fields.get("warc-type"), "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri")}
            index.write(json.dumps(line).encode() + b"\n")
            count += 1
    out.close()
    index.close()
    return count


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """``path, records`` of the normalised archives; one task row per archive of ``archives.path``."""

    def task(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path in part["path"]:
                target = f"{folder}/{path.rpartition('/')[2]}"
                yield pd.DataFrame({"path": [target], "records": [normalise_file(path, target, level)]})

    return archives.select("path").mapInPandas(task, "path string, records bigint")


def read_index(archives: DataFrame) -> DataFrame:
    """``path, offset, length, type, id, uri`` from the sidecar indexes of normalised archives."""
    schema = "path string, offset bigint, length bigint, type string, id string, uri string"

    def task(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path in part["path"]:
                fs, name = _place(f"{path}.idx")
                with fs.open_input_stream(name) as stream:
                    lines = [json.loads(x) for x in stream.read().splitlines()]
                yield pd.DataFrame([{"path": path, **x} for x in lines], columns=["path", "offset", "length", "type", "id", "uri"])

    return archives.select("path").mapInPandas(task, schema)


def read_records(index: DataFrame) -> DataFrame:
    """``id, type, uri, digest, refers_to, payload, payload_bytes`` of the indexed records.

    Only the member of each row is read and inflated.  A revisit has a null payload and the length that its
    HTTP header states.
    """
    schema = "id string, type string, uri string, digest string, refers_to string, payload binary, payload_bytes bigint"

    def one(data: bytes) -> dict:
        plain = zlib.decompress(data, 31)
        head, _, rest = plain.partition(b"\r\n\r\n")
        f = fields_of(head + b"\r\n")
        http, _, body = rest[: int(f["content-length"])].partition(b"\r\n\r\n")
        revisit = f["warc-type"] == "revisit"
        size = int(fields_of(http + b"\r\n")["content-length"])
        return {"id": f["warc-record-id"], "type": f["warc-type"], "uri": f.get("warc-target-uri"), "digest": f["warc-payload-digest"].removeprefix("sha1:"), "refers_to": f.get("warc-refers-to"), "payload": None if revisit else body, "payload_bytes": size if revisit else len(body)}

    def task(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, rows in part.groupby("path", sort=False):
                fs, name = _place(path)
                with fs.open_input_file(name) as file:
                    found, held = [], 0
                    for offset, length in zip(rows["offset"], rows["length"], strict=True):
                        found.append(one(file.read_at(int(length), int(offset))))
                        held += found[-1]["payload_bytes"]
                        if held > 8 * CHUNK:
                            yield pd.DataFrame(found)
                            found, held = [], 0
                if found:
                    yield pd.DataFrame(found)

    return index.select("path", "offset", "length").mapInPandas(task, schema)


def roundtrip(spark: SparkSession, pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages written as monolithic archives below ``folder``, normalised, and read back by their index.

    The rows are those of ``read_records``.  Archives are written when this is called; reading is lazy.  The
    monolithic files are removed once all are normalised.
    """
    written = cut_lineage(write_monolithic(with_revisits(pages, key, html, min_bytes), f"{folder}/raw", key, uri, html))
    spread = max(1, written.count())
    done = cut_lineage(normalise(written.repartition(spread), f"{folder}/warc"))
    remove(f"{folder}/raw")
    members = cut_lineage(read_index(done))
    return read_records(members.repartition(spread))


def remove(folder: str) -> None:
    fs, path = _place(folder)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)
