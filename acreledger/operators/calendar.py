"""Calendar resampling with empty buckets (W1-W3) and summary statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sums import exact_totals

STEPS = {"day": "1 day", "week": "7 days", "month": "1 month"}


def bucket_label(time: str | Column, unit: str) -> Column:
    """Date naming the bucket: the day, the Sunday ending the week, or the month end."""
    day = F.to_date(F.col(time) if isinstance(time, str) else time)
    if unit == "day":
        return day
    if unit == "week":
        return F.date_add(F.trunc(day, "week"), 6)
    if unit == "month":
        return F.last_day(day)
    raise ValueError(f"unknown unit {unit!r}")


def resample(
    df: DataFrame,
    time: str,
    value: str,
    unit: str = "day",
    how: str = "sum",
    group: list[str] | None = None,
    pair: tuple[str, str] | None = None,
) -> DataFrame:
    """Sum or mean per calendar bucket from the first to the last bucket present.

    Buckets without rows give 0 for a sum and null for a mean.  With ``group`` each
    group has its own calendar.  ``pair`` names the integer columns of a rational that is summed exactly as
    ``value``.  The calendar is built from the aggregated buckets,
    so its size is the number of days, weeks or months, not of rows.
    """
    group = group or []
    label = bucket_label(time, unit)
    agg = F.sum(value) if how == "sum" else F.try_divide(F.sum(value).cast("double"), F.count(value))
    dated, keys = df.where(F.col(time).isNotNull()), [*group, label.alias("bucket")]
    filled = exact_totals(dated, keys, {value: pair}) if pair else dated.groupBy(*keys).agg(agg.alias(value))
    span = filled.groupBy(*group).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    step = F.expr(f"interval {STEPS[unit]}")
    days = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), step) if unit == "month" else F.sequence("lo", "hi", step)
    calendar = span.where(F.col("lo").isNotNull()).select(*group, F.explode(days).alias("bucket"))
    if unit == "month":
        calendar = calendar.withColumn("bucket", F.last_day("bucket"))
    out = calendar.join(filled, [*group, "bucket"], "left")
    return out.withColumn(value, F.coalesce(value, F.lit(0))) if how == "sum" else out


def exact_median(df: DataFrame, value: str, group: list[str] | None = None, buckets: int = 4096, passes: int = 3) -> DataFrame:
    """``group, median`` (double), by narrowing histograms instead of holding the values of a group.

    A pass counts values in equal buckets between a group's least and greatest value and keeps the one or
    two buckets that hold the middle ranks; the next pass divides these.  What is left is counted by value
    and ranked.  Counts combine before each shuffle, so neither a large group nor a value that fills half
    of it comes to one task; three passes of 4096 buckets part 7*10^10 values, whatever outliers there are.
    """
    # without a group all rows share an empty text, made from the value so that joins on it stay joins on a key
    parts = [F.col(g) for g in group or []] or [F.substring(F.col(value).cast("string"), 1, 0)]
    names = [f"_g{i}" for i in range(len(parts))]
    rows = df.where(F.col(value).isNotNull()).select(*[p.alias(n) for p, n in zip(parts, names)], F.col(value).alias("_v"))
    rows = rows.withColumns({"_base": F.lit(0).cast("bigint"), "_path": F.lit("")})
    keys = [*names, "_path"]

    def same(a: str, b: str, on: list[str]) -> Column:
        hit = F.lit(True)
        for name in on:
            hit = hit & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
        return hit

    sizes = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    for _ in range(passes):
        span = rows.groupBy(*keys).agg(F.min("_v").cast("double").alias("_lo"), F.max("_v").cast("double").alias("_hi"))
        within = rows.alias("r").join(span.alias("s"), same("r", "s", keys)).select("r.*", "_lo", "_hi")
        share = (F.col("_v").cast("double") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        bucket = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(share * buckets), F.lit(buckets - 1))).otherwise(F.lit(0))
        placed = within.withColumn("_b", bucket.cast("int")).drop("_lo", "_hi")
        counts = placed.groupBy(*keys, "_base", "_b").agg(F.count(F.lit(1)).alias("_c"))
        before = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
        started = counts.withColumn("_start", F.col("_base") + F.coalesce(before, F.lit(0)))
        middle = started.alias("c").join(sizes.alias("n"), same("c", "n", names)).select("c.*", "_n")
        middle = middle.where((F.col("_start") <= high) & (F.col("_start") + F.col("_c") > low)).drop("_c", "_n", "_base")
        kept = placed.alias("r").join(middle.alias("m"), same("r", "m", [*keys, "_b"]))
        path = F.concat(F.col("r._path"), F.col("r._b").cast("string"), F.lit("."))
        rows = kept.select(*[F.col(f"r.{n}") for n in names], "r._v", F.col("m._start").alias("_base"), path.alias("_path"))
    counts = rows.groupBy(*keys, "_base", "_v").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1))
    started = counts.withColumn("_start", F.col("_base") + F.coalesce(before, F.lit(0)))
    ranked = started.alias("c").join(sizes.alias("n"), same("c", "n", names)).select("c.*", "_n")
    holds = lambda rank: (F.col("_start") <= rank) & (F.col("_start") + F.col("_c") > rank)
    ends = [F.max(F.when(holds(rank), F.col("_v").cast("double"))) for rank in (low, high)]
    medians = ranked.groupBy(*names).agg((ends[0] / 2 + ends[1] / 2).alias("median"))
    return medians.withColumnsRenamed(dict(zip(names, group))) if group else medians.drop(*names)


def summary_statistics(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Count, mean, min, max, median and sum of a column; nothing is held per group."""
    group = group or []
    sums = df.groupBy(*group).agg(
        F.count(value).alias("count"),
        F.try_divide(F.sum(value).cast("double"), F.count(value)).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.sum(value).alias("sum"),
    )
    medians = exact_median(df, value, group).withColumnsRenamed({g: f"_{g}" for g in group})
    if not group:
        # one row each, put together; an empty table has no median
        both = sums.unionByName(medians, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in ("count", "mean", "min", "max", "median", "sum")])
    hit = F.lit(True)
    for g in group:
        hit = hit & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return sums.join(medians, hit, "left").drop(*[f"_{g}" for g in group])
