"""Depreciation as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MONEY, derived_guid, in_years
from ..functions.toml import toml_section
from ..operators.schedule import depreciation_rows
from ..operators.tree import all_accounts
from ..sources.schema import DEPRECIATION_TOML
from .chart import CROPS


def depreciable_assets(ledger, crops: list[str] | None = None, level: int = 4) -> DataFrame:
    """Accounts whose notes carry a Depreciation section, with its terms as columns."""
    accounts = all_accounts(ledger, crops or CROPS, level, with_notes=True)
    return toml_section(
        accounts.where(F.col("account_notes").isNotNull()), "account_notes", "Depreciation", DEPRECIATION_TOML
    )


def depreciation_transactions(
    ledger,
    years: int | list[int] | None = None,
    crops: list[str] | None = None,
    level: int = 4,
    assets: DataFrame | None = None,
) -> DataFrame:
    """Schedule rows in the shape of cash transactions, year by posting date.

    Account columns read 800 Depreciation; the asset becomes the source account.
    Guids derive from the asset and row number.
    """
    assets = depreciable_assets(ledger, crops, level) if assets is None else assets
    described = assets.withColumnsRenamed({"description": "account_desc"})
    rows = depreciation_rows(described).where(in_years("post_date", years))
    now = F.current_timestamp()
    return rows.select(
        derived_guid("guid", F.lit("depreciation")).alias("account_guid"),
        derived_guid("guid", "row_number", F.lit("tx")).alias("tx_guid"),
        F.lit("DEPRECIATION").alias("account_type"),
        "account_desc",
        "parent_guid",
        "commodity_guid",
        F.lit("Depreciation").alias("account_name"),
        F.lit("800").alias("account_code"),
        "depreciation_code",
        F.col("guid").alias("src_guid"),
        F.col("code").alias("src_code"),
        F.lit("DEPRECIATION").alias("src_type"),
        F.col("name").alias("src_name"),
        derived_guid("guid", F.lit("currency")).alias("currency_guid"),
        F.col("row_number").cast("string").alias("tx_num"),
        now.alias("enter_date"),
        "description",
        F.col("post_date").cast("timestamp").alias("post_date"),
        F.lit("DEPR").alias("split_action"),
        derived_guid("guid", "row_number", F.lit("split")).alias("split_guid"),
        F.col("amt").cast(MONEY).alias("amt"),
        now.alias("reconcile_date"),
        F.lit("").alias("reconcile_state"),
        F.col("name").alias("memo"),
        "finpack_account",
        "parent_accounts",
        F.lit(1).cast(MONEY).alias("quantity"),
        "endless",
    )
