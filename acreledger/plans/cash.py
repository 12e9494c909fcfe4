"""Cash views: all, cleaned and farm transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.splits import counter_flows, counter_splits
from ..operators.tree import all_accounts
from .chart import CASH_TYPES, CROPS, FARM_RULES, HARVEST_CODES, Reclass, reclassify
from .invoices import invoice_quantities


def _with_quantity(ledger, tx: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Invoice quantity per (transaction, account) of the posting year, 0 if none.

    With report years the invoice must be posted in the transaction's own year, so
    one pass serves every year; without them all invoices count.
    """
    quantities = invoice_quantities(ledger, list(years) if years else None)
    keys = ["tx_guid", "account_guid"]
    if years:
        tx = tx.withColumn("inv_year", F.year("post_date"))
        keys.append("inv_year")
    else:
        quantities = quantities.groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    joined = tx.join(quantities, keys, "left").drop("inv_year")
    return joined.withColumn("quantity", F.coalesce("quantity", F.lit(0)))


def fetch_transactions(
    ledger,
    types: Sequence[str],
    inverse: bool = True,
    years: Sequence[int] | None = None,
    crops: list[str] | None = None,
    level: int = 4,
    quantity: bool = True,
    paths: bool = True,
) -> DataFrame:
    """Counter splits of some account types with paths and invoice quantities."""
    accounts = all_accounts(ledger, crops or CROPS, level) if paths else None
    tx = counter_splits(ledger, types, inverse, years, accounts=accounts)
    return _with_quantity(ledger, tx, years) if quantity else tx


def all_cash_transactions(ledger, years: Sequence[int] | None = None, **options) -> DataFrame:
    """What stands against the cash, credit, receivable and payable accounts."""
    return fetch_transactions(ledger, CASH_TYPES, True, years, **options)


def _clean(tx: DataFrame) -> DataFrame:
    """R16 masks: no transfers between cash accounts, no payments of bills."""
    return tx.where(
        ~F.col("account_type").isin(*CASH_TYPES) & (F.coalesce("split_action", F.lit("")) != "Payment")
    )


def cleaned_cash_transactions(ledger, years: Sequence[int] | None = None, **options) -> DataFrame:
    """Cash transactions without transfers and payments."""
    return _clean(all_cash_transactions(ledger, years, **options)).drop("qty")


def _farm(tx: DataFrame, rules: list[Reclass], excluded: list[str]) -> DataFrame:
    """Harvest income codes left out first, then the reclassification rules."""
    kept = tx.where(~F.coalesce(F.col("account_code").isin(*excluded), F.lit(False)))
    return reclassify(kept, rules)


def farm_cash_transactions(
    ledger,
    years: Sequence[int] | None = None,
    depreciation: DataFrame | None = None,
    rules: list[Reclass] | None = None,
    excluded: list[str] | None = None,
    **options,
) -> DataFrame:
    """Farm transactions, optionally with the rows of a depreciation schedule."""
    tx = _farm(cleaned_cash_transactions(ledger, years, **options), rules or FARM_RULES, excluded or HARVEST_CODES)
    return tx if depreciation is None else tx.unionByName(depreciation, allowMissingColumns=True)


def farm_flows(
    ledger,
    years: Sequence[int] | None = None,
    rules: list[Reclass] | None = None,
    excluded: list[str] | None = None,
    quantity: bool = False,
    paths: bool = False,
    crops: list[str] | None = None,
    level: int = 4,
) -> DataFrame:
    """R17 in weighted form for totals: one row per split, sums already multiplied.

    ``amt`` (and ``quantity``) carry the number of cash accounts of the
    transaction, so sums equal those over :func:`farm_cash_transactions` while no
    row is repeated.  Quantities and paths are joined only when asked for.  Summaries add up
    the integer pairs, so the decimals of the rows are computed only where they are shown.
    """
    accounts = all_accounts(ledger, crops or CROPS, level) if paths else None
    tx = _clean(counter_flows(ledger, CASH_TYPES, years, accounts))
    tx = _farm(tx, rules or FARM_RULES, excluded or HARVEST_CODES)
    if quantity:
        tx = _with_quantity(ledger, tx, years).withColumn(
            "quantity", F.col("quantity").cast("decimal(28,9)") * F.col("sources").cast("decimal(9,0)")
        )
    return tx
