"""Nearest-in-time lookup (J13) without putting one key's history in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def nearest(
    facts: DataFrame,
    points: DataFrame,
    key: str,
    time: str,
    value: str,
    tie: str,
    bucket: Column | None = None,
) -> DataFrame:
    """For each fact the point of the same key nearest in time.

    ``points`` has columns key, time, value and tie.  Of two equally near points
    the earlier wins, and of several at one time the smallest ``tie`` value.
    Facts keep all columns and gain ``near_time`` and ``near_<value>`` (null when
    the key has no point at all).

    Both sides are first reduced to one row per (key, time), which folds groups of
    copies.  Windows then run per (key, ``bucket``).  Without a given bucket the rows are
    sorted into ranges of (key, time) of even size, and a range is a bucket, so neither
    a key that holds a third of all rows nor a crowded day meets in one task.
    The last and first point of each bucket, one short row per bucket, carry the
    search over bucket borders.
    """
    moments = facts.where(F.col(time).isNotNull() & F.col(key).isNotNull()).select(key, time).distinct()
    best = (
        points.where(F.col(time).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, time)
        .agg(F.min_by(value, tie).alias(value))
        .select(key, time, F.struct(F.col(time).alias("at"), F.col(value).alias("value")).alias("point"))
    )
    point_type = best.schema["point"].dataType
    both = (
        moments.withColumn("point", F.lit(None).cast(point_type))
        .withColumn("asked", F.lit(True))
        .unionByName(best.withColumn("asked", F.lit(False)))
    )
    if bucket is None:
        # the place of a row must not change between uses, hence the checkpoint
        both = cut_lineage(both.repartitionByRange(key, time).withColumn("bucket", F.spark_partition_id()), free=True)
    else:
        both = both.withColumn("bucket", bucket)

    # "the next point" is "the last seen" in descending order: frames that grow from
    # the start of a partition take one step per row, open-ended ones rescan the rest
    past = (Window.unboundedPreceding, -1)
    buckets = Window.partitionBy(key)
    borders = (
        both.groupBy(key, "bucket")
        .agg(F.max("point").alias("last_point"), F.min("point").alias("first_point"))
        .select(
            key,
            "bucket",
            F.last("last_point", ignorenulls=True)
            .over(buckets.orderBy("bucket").rowsBetween(*past))
            .alias("before"),
            F.last("first_point", ignorenulls=True)
            .over(buckets.orderBy(F.desc("bucket")).rowsBetween(*past))
            .alias("after"),
        )
    )

    so_far = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(key, "bucket")
    found = both.select(
        key,
        "bucket",
        time,
        "asked",
        F.last("point", ignorenulls=True).over(inside.orderBy(time).rangeBetween(*so_far)).alias("prev"),
        F.last("point", ignorenulls=True).over(inside.orderBy(F.desc(time)).rangeBetween(*so_far)).alias("next"),
    ).where("asked")
    left, right = F.coalesce("prev", "before"), F.coalesce("next", "after")
    located = (
        found.join(borders, [key, "bucket"])
        .select(key, time, left.alias("l"), right.alias("r"))
        .select(
            key,
            time,
            F.when(F.col("r").isNull(), F.col("l"))
            .when(F.col("l").isNull(), F.col("r"))
            .when(F.col(time) - F.col("l.at") <= F.col("r.at") - F.col(time), F.col("l"))
            .otherwise(F.col("r"))
            .alias("hit"),
        )
        .select(key, time, F.col("hit.at").alias("near_time"), F.col("hit.value").alias(f"near_{value}"))
    )
    return facts.join(located, [key, time], "left")


def nearest_to(points: DataFrame, at: Column, key: str, time: str, value: str, tie: str) -> DataFrame:
    """Nearest point of every key to one given time: a single aggregate."""
    gap = F.abs(F.col(time) - at)
    order = F.struct(gap, F.col(time), F.col(tie))
    return points.where(F.col(time).isNotNull()).groupBy(key).agg(
        F.min_by(time, order).alias("near_time"), F.min_by(value, order).alias(f"near_{value}")
    )
