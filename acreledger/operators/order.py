"""Order of a whole table: running sums over all rows, in even ranges of the order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of one range, which one task sorts.
PER_RANGE = 500_000


def running_total(df: DataFrame, order: Sequence[str], value: Column, name: str, per_range: int = PER_RANGE) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows up to this one and with it.

    ``order`` tells the rows apart (ties are summed in no fixed sequence).  A window without keys would
    sort the table in one task; here the table is cut into ranges of the order, each range is summed
    within itself, and what earlier ranges hold comes from one row per range.  The ranges are
    checkpointed, as their borders are sampled and may differ when a lost part is computed again.
    Nulls of ``value`` add nothing; an empty table stays empty.
    """
    ranges = max(1, -(-df.count() // per_range))
    placed = df.withColumn("_value", F.coalesce(value, F.lit(0))).repartitionByRange(ranges, *order)
    placed = cut_lineage(placed.withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.groupBy("_range").agg(F.sum("_value").alias("_whole"))
    before = whole.select("_range", F.coalesce(F.sum("_whole").over(earlier), F.lit(0)).alias("_before"))
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.join(before, "_range").withColumn(name, F.col("_before") + F.sum("_value").over(upto))
    return summed.select(*df.columns, name)


def row_numbers(df: DataFrame, order: Sequence[str], name: str, per_range: int = PER_RANGE) -> DataFrame:
    """Adds ``name``: the row's number in the order, from 1."""
    return running_total(df, order, F.lit(1), name, per_range)
