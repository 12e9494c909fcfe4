"""Streaming daily and weekly totals (ST7) and document tickets (ST6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import ticket_number, ticket_title
from ..session import cut_lineage, drop_dir

# Weeks of the window function start on the epoch's weekday; day 4 is a Monday.
WINDOWS = {"day": ("1 day", None, None), "week": ("7 days", "7 days", "4 days")}


def windowed_totals(events: DataFrame, time: str, value: str, unit: str = "day", delay: str = "2 days") -> DataFrame:
    """ST7: totals per day, or per week labelled by its Sunday; late rows beyond
    ``delay`` are dropped and their state freed.  Empty buckets are filled on read."""
    size, slide, start = WINDOWS[unit]
    window = F.window(time, size) if slide is None else F.window(time, size, slide, start)
    totals = events.withWatermark(time, delay).groupBy(window.alias("w")).agg(
        F.sum(value).alias("total"), F.count(F.lit(1)).alias("rows")
    )
    label = F.to_date("w.start") if unit == "day" else F.date_add(F.to_date("w.start"), 6)
    return totals.select(label.alias("bucket"), "total", "rows")


#: Every so many batches the changes so far become one folder.
COMPACT_EVERY = 50


def start_totals(totals: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keeps the totals under ``path``: each batch adds the buckets that it changed.

    Update mode hands on changed buckets only and frees the state of those that the
    watermark has passed.  A batch writes ``batch=<id>``, so a repeated batch replaces
    its own folder; now and then all buckets are rewritten as one and older folders go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            cut_lineage(read_totals(spark, path)).write.mode("overwrite").parquet(folder)
            for row in spark.read.parquet(path).select("batch").distinct().where(F.col("batch") < batch_id).collect():
                drop_dir(spark, f"{path}/batch={row['batch']}")

    writer = totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals of each bucket as of the newest batch that changed it."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in ("bucket", "batch")]
    newest = rows.groupBy("bucket").agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select("bucket", *[F.col(f"v.{c}") for c in values])


def stream_documents(spark: SparkSession, folder: str, prefix: str, suffix: str = ".pdf") -> DataFrame:
    """ST6: scale ticket documents of a folder as (path, ticket, title).

    Only paths are used; the content column is pruned and never read.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"{prefix}*{suffix}")
        .load(folder)
        .select("path", "modificationTime")
    )
    return document_tickets(files, prefix)


def document_tickets(files: DataFrame, prefix: str) -> DataFrame:
    """ST6: ticket number and note title from each path."""
    name = F.element_at(F.split("path", "/"), -1)
    ticket = ticket_number(name, prefix)
    return files.withColumn("ticket", ticket).withColumn("title", ticket_title("ticket"))
