"""Summaries, trends and the transaction detail report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import icon_file, label_with_code, sum0
from ..operators.reshape import detail_with_totals, pivot_mean, trend_text
from ..operators.splits import AMOUNTS
from ..operators.sums import TOTAL, exact_totals
from .chart import OTHER_ORDER, SUMMARY_ORDER


def summary(tx: DataFrame, keys: Sequence[str], by_year: bool = False) -> DataFrame:
    """Sums of amount and quantity per key, per posting year on request.

    Rows that carry integer pairs are added up exactly; rows without (a schedule's) add their ``amt``.
    """
    grouping = [F.year("post_date").alias("year")] if by_year else []
    if "value_num" not in tx.columns:
        return tx.groupBy(*grouping, *keys).agg(*[sum0(c).alias(c) for c in ("quantity", "amt") if c in tx.columns])
    plain = F.when(F.col("value_denom").isNull(), F.col("amt"))
    more = {"quantity": F.col("quantity")} if "quantity" in tx.columns else {}
    out = exact_totals(tx, [*grouping, *keys], {"amt": AMOUNTS["amt"]}, {"plain": plain, **more})
    zero, narrow = F.lit(0), "decimal(37,9)"  # sums of wider decimals would give up a digit
    both = F.col("amt").cast(narrow) + F.coalesce("plain", zero).cast(narrow)
    summed = {"amt": both.cast(TOTAL), **{c: F.coalesce(c, zero) for c in more}}
    return out.withColumns(summed).select(*out.columns[: len(grouping) + len(keys)], *more, "amt")


def summary_by_account(tx: DataFrame, by_year: bool = False) -> DataFrame:
    """R13 per account code and name."""
    return summary(tx, ["account_code", "account_name"], by_year).withColumnsRenamed(
        {"account_code": "Code", "account_name": "Account", "amt": "Amount", "quantity": "Quantity"}
    )


def summary_by_ancestor(tx: DataFrame, by_year: bool = False) -> DataFrame:
    """R13 per account type and level ancestor."""
    return summary(tx, ["account_type", "finpack_account"], by_year).withColumnsRenamed(
        {"account_type": "Type", "finpack_account": "Account", "amt": "Amount", "quantity": "Quantity"}
    )


def executive_summary(
    tx: DataFrame,
    include_depreciation: bool = False,
    limit: int | None = None,
    by_year: bool = False,
) -> DataFrame:
    """Sums per type with OIBDA and net income, in fixed order.

    All types are returned; ``limit`` cuts to the first rows of each year, for a last
    step of a printed report only (a trend must be built from uncut rows).

    INCOME and EXPENSE always show; a missing one is null and makes OIBDA null.
    Sums are taken once; the derived rows come from the handful of summed rows.
    """
    years = ["year"] if by_year else []
    sums = summary(tx, ["account_type"], by_year).select(*years, "account_type", "amt")
    fixed = ["INCOME", "EXPENSE"] + (["DEPRECIATION"] if include_depreciation else [])

    def of(kind: str):
        return F.max(F.when(F.col("account_type") == kind, F.col("amt")))

    oibda = F.col("INCOME") + F.col("EXPENSE")
    cells = {**{k: F.col(k) for k in fixed}, "OIBDA": oibda}
    if include_depreciation:
        cells["NET INCOME"] = oibda + F.col("DEPRECIATION")
    amount = dict(sums.dtypes)["amt"]
    named = F.array(
        *[F.struct(F.lit(k).alias("account_type"), v.cast(amount).alias("amt")) for k, v in cells.items()]
    )
    # one entry per account type, a fixed short list
    other = F.filter("types", lambda t: ~F.coalesce(t["account_type"].isin(*cells), F.lit(False)))
    rows = (
        sums.groupBy(*years)
        .agg(*[of(k).alias(k) for k in fixed], F.collect_list(F.struct("account_type", "amt")).alias("types"))
        .select(*years, F.inline(F.concat(named, other)))
    )
    order = F.lit(OTHER_ORDER)
    for kind in cells:
        order = F.when(F.col("account_type") == kind, F.lit(SUMMARY_ORDER[kind])).otherwise(order)
    rows = rows.withColumn("order", order)
    if limit:
        place = F.row_number().over(Window.partitionBy(*years).orderBy("order", "account_type"))
        rows = rows.withColumn("_n", place).where(F.col("_n") <= limit).drop("_n")
    return rows.orderBy(*years, "order", "account_type").select(
        *years, F.col("account_type").alias("Account"), F.col("amt").alias("Amount")
    )


def trend_data(
    report: Callable[..., DataFrame], years: Sequence[int], index: Sequence[str], value: str
) -> DataFrame:
    """R14/U5/RS1: a yearly report pivoted to one column per year, missing 0.

    ``report(years)`` is called once and returns all years with a ``year`` column.
    """
    return pivot_mean(report(list(years)), index, "year", years, value)


def with_trend(
    report: Callable[..., DataFrame], years: Sequence[int], index: Sequence[str], value: str
) -> DataFrame:
    """The last year's report with all yearly values as text in ``Trend``."""
    rows = report(list(years))
    trend = trend_text(rows, index, "year", list(years), value)
    return rows.where(F.col("year") == max(years)).drop("year").join(trend, list(index), "left")


def with_icon(df: DataFrame, column: str = "Account") -> DataFrame:
    """Picture name for each label."""
    return df.withColumn("icon", icon_file(column))


def transaction_details(tx: DataFrame, ordered: bool = False) -> DataFrame:
    """Detail rows and a total row per account, with the display label.

    ``ordered`` sorts the report by account, year, date and source, totals last (O1).

    The total is dated December 31 of the report year, or of each row's year.
    """
    rows = tx.select(
        "account_code",
        label_with_code("account_name", "account_code").alias("display"),
        F.year("post_date").alias("year"),
        F.col("src_code").alias("Src"),
        F.to_date("post_date").alias("Date"),
        F.col("description").alias("Description"),
        F.col("memo").alias("Memo"),
        F.col("amt").alias("Amount"),
    )
    both = detail_with_totals(rows, ["account_code", "year"], ["Amount"])
    is_total = F.col("row_kind") == "total"
    rows = both.withColumns(
        {
            "Src": F.when(is_total, F.lit("Total")).otherwise(F.col("Src")),
            "Date": F.when(is_total, F.make_date("year", F.lit(12), F.lit(31))).otherwise(F.col("Date")),
        }
    )
    return rows.orderBy("account_code", "year", "row_kind", "Date", "Src") if ordered else rows

