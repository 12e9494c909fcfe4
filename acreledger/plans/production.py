"""Acres, yields, leases, harvest progress, machine data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import capped_width, icon_file, matches, ratio, sum0
from ..functions.toml import toml_section
from ..operators.reshape import melt, pivot_mean
from ..operators.tree import all_accounts
from ..sources.schema import vendor_terms_toml
from .chart import CROPS, HARVEST_CODES, RENT_CODES
from .invoices import invoice_lines
from .position import stock_values
from .prices import commodity_bids

RENT_ACTION = "Project"
MISSING = "---"


def _lines_with_crop(ledger, lines: DataFrame, crops: list[str]) -> DataFrame:
    crop = all_accounts(ledger, crops).select(F.col("guid").alias("account_guid"), "crop")
    return lines.join(crop, "account_guid")


def rented_acres(
    ledger,
    year: int | None = None,
    crops: list[str] | None = None,
    rent_codes: Sequence[str] = tuple(RENT_CODES),
    lines: DataFrame | None = None,
) -> DataFrame:
    """Acres, rent and base rent per crop, operation and owner.

    Only Project lines on rent accounts count.  ``lines`` passes in invoice lines
    that a caller already has.
    """
    lines = invoice_lines(ledger, year) if lines is None else lines
    rent = lines.where(F.col("account_code").isin(*rent_codes) & (F.col("quantity_type") == RENT_ACTION))
    keys = ["crop", "operation", "operation_id", "org_name"]
    return (
        _lines_with_crop(ledger, rent, crops or CROPS)
        .na.drop("any", subset=keys)
        .groupBy(*keys)
        .agg(F.round(sum0("quantity"), 2).alias("acres"), F.round(sum0("amt"), 2).alias("amt"))
        .withColumn("base_rent", ratio("amt", "acres", 0))
    )


def planted_acres(rented: DataFrame, include_operation_id: bool = False) -> DataFrame:
    """Acres per crop and operation."""
    keys = ["crop", "operation"] + (["operation_id"] if include_operation_id else [])
    return rented.groupBy(*keys).agg(F.round(sum0("acres"), 2).alias("acres"))


def production(
    ledger,
    year: int | None = None,
    include_operation_id: bool = True,
    crops: list[str] | None = None,
    harvest_codes: Sequence[str] = tuple(HARVEST_CODES),
    rent_codes: Sequence[str] = tuple(RENT_CODES),
    lines: DataFrame | None = None,
) -> DataFrame:
    """Bushels of harvest lines, planted acres and bushels per acre."""
    lines = invoice_lines(ledger, year) if lines is None else lines
    keys = ["crop", "operation"] + (["operation_id"] if include_operation_id else [])
    harvest = lines.where(F.col("account_code").isin(*harvest_codes))
    bushels = (
        _lines_with_crop(ledger, harvest, crops or CROPS)
        .na.drop("any", subset=keys)
        .groupBy(*keys)
        .agg(F.round(sum0("quantity"), 2).alias("total_bushels"))
    )
    acres = planted_acres(rented_acres(ledger, year, crops, rent_codes, lines), include_operation_id)
    return bushels.join(acres, keys, "left").withColumn("bu_per_acre", ratio("total_bushels", "acres", 2))


def lease_terms(lines: DataFrame, crops: list[str]) -> DataFrame:
    """U1/RS3: share per operation and crop with the rent cap, from the owners' notes.

    Notes are reduced to distinct (operation, text) before the text is parsed.
    """
    notes = lines.where(F.col("org_notes").isNotNull()).select("operation_id", "org_notes").distinct()
    parsed = toml_section(notes, "org_notes", "Vendor_Details", vendor_terms_toml(crops))
    return melt(parsed, ["operation_id", "Max"], crops, "crop", "Percentage")


def _fields(
    ledger, lines: DataFrame, crops: list[str], harvest_codes: Sequence[str], rent_codes: Sequence[str]
) -> DataFrame:
    """Rented acres with the field's bushels per acre, both from one aggregate.

    Equal to joining :func:`rented_acres` with :func:`production`: the windows run
    over the summed rows, one per owner of a field.
    """
    is_rent = F.col("account_code").isin(*rent_codes) & (F.col("quantity_type") == RENT_ACTION)
    is_harvest = F.col("account_code").isin(*harvest_codes)
    field = ["crop", "operation", "operation_id"]
    summed = (
        _lines_with_crop(ledger, lines.where(is_rent | is_harvest), crops)
        .na.drop("any", subset=field)
        .groupBy(*field, "org_name")
        .agg(
            F.count(F.when(is_rent, F.lit(1))).alias("rents"),
            F.round(F.sum(F.when(is_rent, F.col("quantity"))), 2).alias("acres"),
            F.round(F.sum(F.when(is_rent, F.col("amt"))), 2).alias("amt"),
            F.sum(F.when(is_harvest, F.col("quantity"))).alias("bushels"),
        )
        .withColumn("acres", F.when(F.col("org_name").isNotNull(), F.col("acres")))
    )
    whole = Window.partitionBy(*field)
    return (
        summed.withColumn("total_bushels", F.round(F.sum("bushels").over(whole), 2))
        .withColumn("bu_per_acre", ratio("total_bushels", F.sum("acres").over(whole), 2))
        .where((F.col("rents") > 0) & F.col("org_name").isNotNull())
        .withColumn("base_rent", ratio("amt", "acres", 0))
        .drop("rents", "bushels")
    )


def flexible_lease(
    ledger,
    year: int | None = None,
    price_year: int | None = None,
    crops: list[str] | None = None,
    harvest_codes: Sequence[str] = tuple(HARVEST_CODES),
    rent_codes: Sequence[str] = tuple(RENT_CODES),
) -> DataFrame:
    """Bonus rent per field from yield, mean price, share and rent cap.

    The bonus is the smaller of the raw and the capped bonus, ignoring nulls.
    Rent and harvest come from one pass over the invoice lines, the lease terms
    from a second one.
    """
    crops = crops or CROPS
    lines = invoice_lines(ledger, year)
    terms = lease_terms(lines, crops)
    price = commodity_bids(ledger, "mean", price_year or year).select("crop", F.col("cash").alias("price"))
    rent = (
        _fields(ledger, lines, crops, harvest_codes, rent_codes)
        .join(price, "crop", "left")
        .join(terms, ["operation_id", "crop"])
    )
    # widths that hold every product in full, so rounding sees true ties
    acres = F.col("acres").cast("decimal(16,4)")
    base = F.col("base_rent").cast("decimal(18,4)")
    cap = F.col("Max").cast("decimal(18,4)")
    revenue = F.round(F.col("bu_per_acre").cast("double") * F.col("price"), 2).cast("decimal(18,2)")
    steps = (
        rent.withColumn("rev_pct", (F.col("Percentage") / 100).cast("decimal(12,8)"))
        .withColumn("revenue", revenue)
        .withColumn("capped_total", F.round(cap * acres, 2))
        .withColumn("capped_bonus", F.round(F.col("capped_total") - base * acres, 2))
        .withColumn("raw_bonus", F.round((F.col("revenue") * acres).cast("decimal(25,6)") * F.col("rev_pct") - base * acres, 2))
        .withColumn("bonus", F.least("raw_bonus", "capped_bonus"))
        .withColumn("adj_rent", ratio(F.col("bonus") + F.col("amt"), acres, 2))
    )
    # The labels of the report
    return steps.select(
        F.col("crop").alias("Crop"),
        F.col("operation").alias("Field"),
        F.col("org_name").alias("Owner"),
        F.col("acres").alias("Acres"),
        F.col("base_rent").alias("Base Rent"),
        F.col("total_bushels").alias("Total Bushels"),
        F.col("bu_per_acre").alias("Bu/Acre"),
        F.round("price", 2).alias("Price"),
        F.col("Max").alias("Rent Cap"),
        F.col("rev_pct").alias("Revenue %"),
        F.col("revenue").alias("Revenue"),
        F.col("capped_total").alias("Capped Total"),
        F.col("capped_bonus").alias("Capped Bonus"),
        F.col("raw_bonus").alias("Raw Bonus"),
        F.col("bonus").alias("Bonus"),
        F.col("adj_rent").alias("Adjusted Rent"),
    )


STAGES = ["Contracted", "Delivered", "Harvested"]


def latest_by_account(ledger) -> DataFrame:
    """A4: last posting date per account description.

    Dates are reduced per account guid before descriptions are joined.
    """
    dates = ledger.transactions.select(F.col("guid").alias("tx_guid"), "post_date")
    per_account = (
        ledger.splits.select("tx_guid", "account_guid")
        .join(dates, "tx_guid")
        .groupBy("account_guid")
        .agg(F.max("post_date").alias("post_date"))
    )
    named = ledger.accounts.select(F.col("guid").alias("account_guid"), F.col("description").alias("account_desc"))
    return (
        per_account.join(named, "account_guid")
        .where(F.col("account_desc").isNotNull())
        .groupBy("account_desc")
        .agg(F.max("post_date").alias("post_date"))
    )


def last_delivery(latest: DataFrame, stage: str = "Delivered") -> DataFrame:
    """A4: the last posting date over all accounts of one stage."""
    return latest.where(matches("account_desc", stage)).agg(F.max("post_date").alias("last_delivery"))


def harvest_progress(
    ledger,
    through: int | None = None,
    index: str = "account_name",
    crops: list[str] | None = None,
    limit: int | None = None,
    width: float = 100.0,
) -> DataFrame:
    """R28/RS2: contracted, delivered and harvested quantity per account name.

    Descriptions read ``<stage> <crop>``; the pivot is given that list.  ``pct`` is
    null when nothing is contracted; ``progress`` is the fraction capped at one.
    """
    crops = crops or CROPS
    stock = stock_values(ledger, ["account_name", "account_desc", "commodity_guid"], through)
    labels = [f"{stage} {crop}" for stage in STAGES for crop in crops]
    named = stock.withColumn(index, F.col("bid_crop")) if index == "crop" else stock
    wide = pivot_mean(named.withColumn("abs_qty", F.abs("qty")), [index], "account_desc", labels, "abs_qty")

    def stage(name: str):
        total = F.lit(0.0)
        for crop in crops:
            total = total + F.col(f"`{name} {crop}`")
        return total.alias(name)

    rows = wide.select(index, *[stage(s) for s in STAGES]).withColumns(
        {
            "Total": F.col("Delivered") + F.col("Harvested"),
            "pct": ratio("Delivered", "Contracted"),
            "icon": icon_file(index),
        }
    )
    capped = F.when(F.col("pct") > 1, F.lit(1.0)).otherwise(F.col("pct"))
    rows = rows.withColumn("progress", capped).withColumn("bar_width", capped_width("pct", width))
    return rows.orderBy(index).limit(limit) if limit else rows


def machine_yield(machine: DataFrame, excluded_farms: Sequence[str] = ()) -> DataFrame:
    """Worked acres, dry yield, mean moisture and last date per farm and crop."""
    kept = machine.where(
        F.coalesce(~F.col("varieties").isin(MISSING), F.lit(True))
        & F.coalesce(~F.col("moisture").isin(MISSING), F.lit(True))
    )
    if excluded_farms:
        kept = kept.where(F.coalesce(~F.col("farms").isin(*excluded_farms), F.lit(True)))
    return kept.groupBy(F.col("farms").alias("Farm"), F.col("crop_type").alias("Crop")).agg(
        F.sum("area_harvested").alias("Harvested"),
        F.sum("total_dry_yield").alias("Dry_Yield"),
        F.avg(F.col("moisture").try_cast("double")).alias("Moisture"),
        F.max("last_harvested").alias("Date"),
    )


def production_vs_machine(machine: DataFrame, grown: DataFrame) -> DataFrame:
    """Machine data against ledger production per farm and crop."""
    ledger_side = grown.groupBy(F.col("operation").alias("Farm"), F.col("crop").alias("Crop")).agg(
        sum0("total_bushels").cast("double").alias("total_bushels"), sum0("acres").cast("double").alias("acres")
    )
    joined = machine.join(ledger_side, ["Farm", "Crop"], "left").na.fill(
        0.0, subset=["Harvested", "Dry_Yield", "Moisture", "total_bushels", "acres"]
    )
    return joined.select(
        "Farm",
        "Crop",
        icon_file("Crop").alias("icon"),
        F.col("Harvested").alias("Acres Worked"),
        "Dry_Yield",
        "Moisture",
        "Date",
        F.col("total_bushels").alias("Bushels"),
        F.col("acres").alias("Total Acres"),
        (F.col("Dry_Yield") - F.col("total_bushels")).alias("New Bushels"),
        ratio("total_bushels", "Harvested").alias("Bu/Acres Worked"),
        ratio("total_bushels", "acres").alias("Bu/Total Acres"),
    )
