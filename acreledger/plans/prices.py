"""Commodity prices: yearly lists, bids, nearest bid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import exact_mean, in_years, matches, rational
from ..operators.asof import nearest, nearest_to


def commodity_prices(ledger, years: int | Sequence[int] | None = None) -> DataFrame:
    """Prices of the year with the commodity's name and metadata."""
    commodities = ledger.commodities.withColumnRenamed("guid", "commodity_guid")
    return ledger.prices.where(in_years("date", years)).join(commodities, "commodity_guid")


def bids(
    ledger, years: int | Sequence[int] | None = None, complete_rows_only: bool = False
) -> DataFrame:
    """Bid prices with the cash value; rows without date, commodity or value drop out.

    ``complete_rows_only`` also drops rows with a null in any metadata column.
    """
    rows = commodity_prices(ledger, years)
    if complete_rows_only:
        rows = rows.na.drop("any")
    return (
        rows.where(matches("type", "bid"))
        .withColumn("cash", rational("value_num", "value_denom"))
        .where(F.col("date").isNotNull() & F.col("cash").isNotNull())
        .select("guid", "commodity_guid", "currency_guid", "date", F.col("fullname").alias("crop"), "cash")
    )


def commodity_bids(
    ledger,
    how: str | None = "mean",
    years: int | Sequence[int] | None = None,
    by_year: bool = False,
    complete_rows_only: bool = False,
) -> DataFrame:
    """Mean or last bid per commodity, name and currency, or every bid."""
    rows = bids(ledger, years, complete_rows_only)
    if how is None:
        return rows.orderBy("date")
    value = {
        "mean": exact_mean("cash"),
        "last": F.max_by("cash", F.struct("date", "guid")),
    }[how]
    keys = ["commodity_guid", "crop", "currency_guid"]
    grouping = [F.year("date").alias("year")] if by_year else []
    return rows.where(F.col("currency_guid").isNotNull() & F.col("crop").isNotNull()).groupBy(
        *grouping, *keys
    ).agg(value.alias("cash"))


def nearest_commodity_bid(ledger, commodity: str, at: str) -> DataFrame:
    """The bid nearest to a time for one commodity, two digits.

    A commodity guid wins over a name; a name matches by its title-case prefix.
    The result has one row, or none when nothing matches.
    """
    rows = bids(ledger)
    by_guid = F.when(F.col("commodity_guid") == commodity, F.lit(0))
    by_name = F.when(matches("crop", commodity.title()), F.lit(1))
    ranked = rows.withColumn("rank", F.coalesce(by_guid, by_name)).where(F.col("rank").isNotNull())
    per_rank = nearest_to(ranked, F.lit(at).cast(ranked.schema["date"].dataType), "rank", "date", "cash", "guid")
    return per_rank.orderBy("rank").limit(1).select("near_time", F.round("near_cash", 2).alias("cash"))


def nearest_bids(ledger, facts: DataFrame, time: str = "date", bucket: Column | None = None) -> DataFrame:
    """Every fact ``(commodity_guid, time)`` with the nearest bid over all years."""
    points = bids(ledger).select("commodity_guid", F.col("date").alias(time), "cash", "guid")
    found = nearest(facts, points, "commodity_guid", time, "cash", "guid", bucket)
    return found.withColumn("near_cash", F.round("near_cash", 2))


def bids_of_commodities(ledger, names: Sequence[str]) -> DataFrame:
    """Bid rows of named commodities."""
    named = ledger.commodities.where(F.col("fullname").isin(*names))
    return ledger.prices.where(F.col("type") == "bid").join(
        named.withColumnRenamed("guid", "commodity_guid"), "commodity_guid"
    )
