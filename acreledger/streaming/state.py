"""Stateful steps before the sink: tickets seen before (ST5) and files that are still growing (ST2)."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator, Sequence
from fnmatch import fnmatch

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: State of a stream on the executors' disks, in bounded memory whatever the number of keys; Spark's own keeps all of it on the
#: heap.  A stream that goes on from a checkpoint keeps the store that the checkpoint was begun with.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

TICKET = ("ticket_number", "tare_time", "crop_description")


def first_files(loads: DataFrame, keys: Sequence[str] = TICKET, keep: str = "30 days") -> DataFrame:
    """ST5: ``keys, file_time, file`` of keys that no earlier batch had, with the earliest file of this one.

    The state store holds the first arrival of each key, in spans of ``keep``; spans that have passed are freed.  Time
    is that of arrival: a watermark on the rows' own time would drop late tickets that nobody has seen.
    A key that comes again in a later span passes once more; the exact look-up behind knows it.  Rows with a
    null key go, as they can never be entered.  To be written in update mode.
    """
    timed = loads.na.drop("any", subset=list(keys)).withColumn("arrived", F.current_timestamp())
    spans = timed.withWatermark("arrived", "1 day").groupBy(F.window("arrived", keep), *keys)
    first = spans.agg(F.min(F.struct("arrived", "file_time", "file")).alias("first"))
    # a key that an earlier batch had keeps that batch's time
    new = first.where(F.col("first.arrived") == F.current_timestamp())
    return new.select(*keys, "first.file_time", "first.file")


def poll_folder(spark: SparkSession, folder: str, pattern: str, ticks: DataFrame | None = None) -> DataFrame:
    """``path, size, seen``: the files of a folder and their sizes, listed anew in every micro-batch.

    ``ticks`` is a stream that has a row whenever to look; a rate source unless given.  ``folder`` is a URI that
    tasks can list.
    """
    if ticks is None:
        ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()

    def look(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if sum(len(p) for p in parts):
            fs, path = pafs.FileSystem.from_uri(folder)
            found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
            head = folder[: len(folder) - len(path)] if folder.endswith(path) else ""
            rows = [(head + f.path, f.size, time.time()) for f in found if f.is_file and fnmatch(f.base_name, pattern)]
            yield pd.DataFrame(rows, columns=["path", "size", "seen"])

    return ticks.select(F.lit(1).alias("tick")).coalesce(1).mapInPandas(look, "path string, size long, seen double")


def complete_files(polls: DataFrame, quiet_seconds: float = 1, forget_days: float = 30) -> DataFrame:
    """ST2: ``path, size`` of each file once, when it had the same size for ``quiet_seconds`` of polls.

    The state of a path holds its size and since when; a path that grows starts anew.  A timer frees
    paths that have not been listed for ``forget_days``.  An empty file is not complete.
    """
    millis = int(forget_days * 86_400_000)

    def watch(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        size, since, released = state.get if state.exists else (-1, 0.0, False)
        for now, seen in pd.concat(list(parts)).sort_values("seen")[["size", "seen"]].itertuples(index=False):
            if released:
                break
            if now != size or not now:
                size, since = int(now), float(seen)
            elif seen - since >= quiet_seconds:
                released = True
                yield pd.DataFrame({"path": [key[0]], "size": [size]})
        state.update((size, since, released))
        state.setTimeoutDuration(millis)

    return polls.groupBy("path").applyInPandasWithState(
        watch, "path string, size long", "size long, since double, released boolean", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
