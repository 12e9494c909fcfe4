"""Depreciation schedules in closed form: one narrow explode per asset (G1, RS5, S9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import ratio

HALF_YEAR_STRAIGHT = "MO S/L"
DECLINING = "HY 200DB"
STOP_AT = 0.5


def _step(basis: Column, term: Column, method: Column) -> Column:
    """Amount per row of the methods that take the same amount every time."""
    per_year = ratio(basis, term, 2).cast("double")
    return F.when(method == HALF_YEAR_STRAIGHT, F.try_divide(basis, term * 2)).otherwise(per_year)


def _row_bound(basis: Column, term: Column, step: Column, method: Column) -> Column:
    """Upper bound of the number of regular rows; null when they would never end."""
    kept = F.lit(1.0) - F.try_divide(F.lit(2.0), term)
    by_rate = (
        F.when(term == F.floor(term), term)
        .when(kept > 0, F.log(basis / F.lit(STOP_AT)) / -F.log(kept) + 3.0)
        .otherwise(F.lit(3.0))
    )
    declining = F.when(term > 0, by_rate)
    same = F.when(step > 0, basis / step + 1.0)
    return F.ceil(F.when(method == DECLINING, declining).otherwise(same)).cast("int")


def _left_before(basis: Column, term: Column, step: Column, method: Column, k: Column) -> Column:
    """What is left to write off before regular row ``k`` (from 1)."""
    after_first = basis * (F.lit(1.0) - F.try_divide(F.lit(1.0), term))
    kept = F.lit(1.0) - F.try_divide(F.lit(2.0), term)
    declining = F.when(k == 1, basis).otherwise(after_first * F.pow(kept, (k - 2).cast("double")))
    return F.when(method == DECLINING, declining).otherwise(basis - step * (k - 1))


def _row_date(first_year: Column, k: Column, method: Column) -> Column:
    """Date of regular row ``k`` (from 1): December 31 first, then chained months.

    Chained half years from December 31 fall on June 30 and December 30 (T8).
    """
    december, later = F.lit(12), F.floor(k / 2).cast("int")
    half = (
        F.when(k == 1, F.make_date(first_year, december, F.lit(31)))
        .when(k % 2 == 0, F.make_date(first_year + later, F.lit(6), F.lit(30)))
        .otherwise(F.make_date(first_year + later, december, F.lit(30)))
    )
    return F.when(method == HALF_YEAR_STRAIGHT, half).otherwise(
        F.make_date(first_year + k - 1, december, F.lit(31))
    )


def depreciation_rows(assets: DataFrame) -> DataFrame:
    """G1: schedule rows of every asset; narrow, no shuffle.

    Input columns Cost, Sec_179, Method, Years and Date_in_Service.  A Section 179
    row comes first if there is any, then regular rows while more than 0.50 is
    left.  ``MO S/L`` takes basis/(2 term) each half year; ``HY 200DB`` takes half
    the double rate first, then the double rate of what is left, and the rest in
    the last year of the term; any other method takes basis/term to the cent per
    year.  ``amt`` is negative.

    The rows of an asset are bounded by its term.  An asset whose step is zero or
    negative would never end: it gets no regular rows and ``endless = true`` on its
    Section 179 row, or on a single row with null amount and date.
    """
    cost, sec = F.col("Cost").cast("double"), F.col("Sec_179").cast("double")
    terms = assets.withColumns(
        {
            "_sec": sec,
            "_basis": cost - sec,
            "_term": F.col("Years").cast("double"),
            "_method": F.coalesce("Method", F.lit("")),
            "_year": F.year("Date_in_Service"),
        }
    )
    basis, term, method, year = F.col("_basis"), F.col("_term"), F.col("_method"), F.col("_year")
    terms = terms.withColumn("_step", _step(basis, term, method))
    step = F.col("_step")
    terms = terms.withColumn("_bound", F.when(basis > STOP_AT, _row_bound(basis, term, step, method)))
    terms = terms.withColumn("endless", F.coalesce((basis > STOP_AT) & F.col("_bound").isNull(), F.lit(False)))
    k = F.col("row_number")
    before = _left_before(basis, term, step, method, k)
    rows = terms.withColumn(
        "row_number", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce("_bound", F.lit(0)), F.lit(0))))
    )
    rows = rows.withColumn("_before", F.when(k > 0, before))
    special = F.coalesce(F.col("_sec") > 0, F.lit(False))
    rows = rows.where(((k == 0) & (special | F.col("endless"))) | (F.col("_before") > STOP_AT))
    declining = (
        F.when(k.cast("double") == term, F.col("_before"))
        .when(k == 1, F.col("_before") / term)
        .otherwise(F.lit(2.0) / term * F.col("_before"))
    )
    amount = F.when(method == DECLINING, declining).otherwise(step)
    first = k == 0
    return rows.select(
        *assets.columns,
        "endless",
        "row_number",
        F.when(first, F.when(special, F.make_date(year, F.lit(12), F.lit(31))))
        .otherwise(_row_date(year, k, method))
        .alias("post_date"),
        F.when(first, F.when(special, -F.col("_sec"))).otherwise(-amount).alias("amt"),
        F.when(first & special, "Section 179").otherwise("Regular Depreciation").alias("description"),
        F.when(first & special, "801").otherwise("800").alias("depreciation_code"),
    )
