"""Pivot, melt and joined-string forms (RS1-RS4, A8, A10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import exact_mean


def pivot_mean(df: DataFrame, index: Sequence[str], column: str, values: Sequence, value: str) -> DataFrame:
    """RS1/RS2: mean of ``value`` per index and column value; missing gives 0.

    The column values are given, so there is no extra pass to find them.
    """
    wide = df.groupBy(*index).pivot(column, list(values)).agg(exact_mean(value))
    return wide.na.fill(0.0, subset=[str(v) for v in values])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    """RS3: columns to rows, duplicates removed."""
    return df.unpivot(list(ids), list(values), variable, value).distinct()


def number_text(column: str | Column) -> Column:
    """Plain decimal text of a number, as short as possible, at least ``.0``.

    Never uses exponent notation, unlike a cast of a double to string, whose digits
    it keeps (up to twelve behind the point).
    """
    c = F.col(column) if isinstance(column, str) else column
    fixed = c.cast("string").cast("decimal(38,12)").cast("string")
    trimmed = F.rtrim(fixed, F.lit("0"))
    return F.when(F.endswith(trimmed, F.lit(".")), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)


def trend_text(df: DataFrame, index: Sequence[str], year: str, years: Sequence[int], value: str) -> DataFrame:
    """RS4: the yearly values of each index row as one space-joined string.

    Built by conditional means over the fixed list of years, so nothing is
    collected per group and missing years show as 0.0.
    """
    cells = [
        F.coalesce(exact_mean(F.when(F.col(year) == y, F.col(value))), F.lit(0.0)) for y in years
    ]
    return df.groupBy(*index).agg(F.concat_ws(" ", *[number_text(c) for c in cells]).alias("Trend"))


def with_total_row(df: DataFrame, label: str, text: str, sums: Sequence[str]) -> DataFrame:
    """``df`` plus one row with the sum of numeric columns; other columns null."""
    total = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    total = total.withColumn(text, F.lit(label))
    return df.unionByName(total, allowMissingColumns=True)


def detail_with_totals(df: DataFrame, key: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """A10: detail rows and one total row per key for all keys at once.

    ``row_kind`` is ``detail`` or ``total``.  Grouping sets give both from one pass over ``df``, whose joins
    would run twice under a union; rows get a number, so equal ones stay apart.
    """
    columns = [c for c in df.columns if c not in sums]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    total = F.grouping("_row") == 1
    values = [F.when(total, F.coalesce(F.sum(c), F.lit(0))).otherwise(F.sum(c)).alias(c) for c in sums]
    kind = F.when(total, F.lit("total")).otherwise(F.lit("detail")).alias("row_kind")
    both = rows.groupingSets([[*columns, "_row"], list(key)], *columns, "_row").agg(*values, kind)
    return both.select(*df.columns, "row_kind")
