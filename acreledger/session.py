"""Session helpers: a sized session, the shared working folder, lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None, app: str = "acreledger", partitions: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the jobs here rely on.

    Adaptive execution coalesces small shuffle partitions, splits skewed ones and
    turns a join into a broadcast only after measuring the small side.  ``partitions``
    is the initial number of shuffle partitions: the bytes of the largest shuffle
    divided by some 128 MB (100 TB: 800,000); Spark's 200 are meant for 25 GB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # a checkpoint goes once nothing refers to it any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **({"spark.sql.shuffle.partitions": partitions} if partitions else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the time of a block; what was set before is set again after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset the checkpoint folder of the context counts, else a folder in
    the warehouse, which executors share as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    sc.setCheckpointDir(folder)
    return folder


def drop_dir(spark: SparkSession, path: str) -> None:
    """Removes a work folder whose result has been read or checkpointed."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/acreledger/{purpose}-{uuid.uuid4().hex}"


#: Shuffle files go as soon as the job that wrote them is over, not when the driver happens to collect its garbage.
#: It counts for frames made while it is set; a frame that runs again makes its shuffles anew.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def cut_lineage(df: DataFrame, free: bool = False) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder (survives lost executors).

    ``free`` removes the shuffle files behind it at once; not for a frame that is used again as well.
    """
    spark = df.sparkSession
    if free:
        with settings(spark, FREED):
            return cut_lineage(df.select("*"))
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
