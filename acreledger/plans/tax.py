"""Tax and wage extracts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import in_year, numeric_prefix, product, rational, sum0, times
from ..operators.pattern import like_join
from ..operators.tree import all_accounts
from .chart import CROPS, DEPOSIT_CODE, WAGE_PATTERN


def _account_splits(ledger, accounts: DataFrame) -> DataFrame:
    """Splits on chosen accounts (given with ``account_guid``), decimal ``amt``."""
    splits = ledger.splits.select(
        "tx_guid", "account_guid", "memo", rational("value_num", "value_denom").alias("amt")
    )
    return splits.join(accounts, "account_guid")


def _heads(ledger, year: int | None) -> DataFrame:
    return ledger.transactions.where(in_year("post_date", year)).select(
        F.col("guid").alias("tx_guid"), "post_date", "description"
    )


def vendor_1099_lines(ledger, year: int | None = None) -> DataFrame:
    """R19 detail/J4: bill lines of vendors whose notes mention 1099."""
    vendors = ledger.vendors.where(F.col("notes").ilike("%1099%")).select(
        F.col("guid").alias("vendor_guid"),
        F.col("name").alias("vendor_name"),
        F.col("id").alias("vendor_id"),
        "addr_addr1",
        "addr_addr2",
        "addr_addr3",
        "addr_addr4",
        F.col("addr_phone").alias("phone"),
    )
    jobs = ledger.jobs.select(F.col("guid").alias("job_guid"), F.col("owner_guid").alias("vendor_guid"))
    heads = ledger.invoices.where(in_year("date_posted", year)).select(
        F.col("guid").alias("bill"), F.col("owner_guid").alias("job_guid"), F.to_date("date_posted").alias("post_date")
    )
    # heads are cut down to the vendors at hand before the lines are joined
    wanted = heads.join(jobs.join(vendors, "vendor_guid"), "job_guid").drop("job_guid", "vendor_guid")
    lines = ledger.entries.select(
        "bill",
        F.col("b_acct").alias("acct_guid"),
        product("quantity_num", "quantity_denom", "b_price_num", "b_price_denom").alias("amt"),
    )
    names = ledger.accounts.select(F.col("guid").alias("acct_guid"), F.col("name").alias("acct_name"))
    return lines.join(wanted, "bill").drop("bill").join(names, "acct_guid")


def vendor_1099(ledger, year: int, crops: list[str] | None = None, level: int = 4) -> DataFrame:
    """Amount per level ancestor and vendor with address; null addresses drop out."""
    places = all_accounts(ledger, crops or CROPS, level).select(F.col("guid").alias("acct_guid"), "finpack_account")
    keys = ["finpack_account", "vendor_name", "vendor_id", "addr_addr1", "addr_addr2", "addr_addr3"]
    return (
        vendor_1099_lines(ledger, year)
        .join(places, "acct_guid", "left")
        .na.drop("any", subset=keys)
        .groupBy(*keys)
        .agg(F.round(sum0("amt"), 2).alias("amt"))
    )


def deductible_splits(ledger, year: int) -> DataFrame:
    """R20 detail: splits on tax-related expense accounts with the deductible part.

    The attribute side is filtered before the join (F12); the account code is the
    percentage.  Rows with any null drop out.
    """
    related = (
        ledger.slots.where(
            (F.col("name") == "tax-related")
            & ((F.col("slot_type") == 1) | (F.col("string_val") == "true"))
        )
        .select(F.col("obj_guid").alias("account_guid"))
    )
    accounts = (
        ledger.accounts.where(F.col("account_type") == "EXPENSE")
        .select(F.col("guid").alias("account_guid"), F.col("name").alias("Acct"), "code")
        .join(related, "account_guid")
    )
    rows = _account_splits(ledger, accounts).join(_heads(ledger, year), "tx_guid")
    pct = numeric_prefix("code").cast("decimal(20,9)")
    return (
        rows.select(
            "Acct",
            F.to_date("post_date").alias("post_date"),
            F.col("description").alias("Description"),
            F.col("memo").alias("Memo"),
            F.col("amt").alias("Amt"),
            pct.alias("Deduct_Percentage"),
        )
        .na.drop("any")
        .withColumn("Deduct_Total", F.round(times(F.col("Amt"), F.col("Deduct_Percentage")) * F.lit(Decimal("0.01")), 2).cast("decimal(24,2)"))
    )


def deductible_expenses(ledger, year: int) -> DataFrame:
    """Sums per account (the percentage column is summed as well)."""
    return (
        deductible_splits(ledger, year)
        .groupBy("Acct")
        .agg(*[sum0(c).alias(c) for c in ("Amt", "Deduct_Percentage", "Deduct_Total")])
    )


def interest_payments(ledger, year: int, pattern: str = "%Interest%") -> dict[str, DataFrame]:
    """R21/SK4: interest paid, totals per payee and detail, as two named tables."""
    accounts = ledger.accounts.where(
        (F.col("account_type") == "EXPENSE") & F.col("name").ilike(pattern)
    ).select(F.col("guid").alias("account_guid"), "name")
    detail = (
        _account_splits(ledger, accounts)
        .join(_heads(ledger, year), "tx_guid")
        .select("name", "description", F.to_date("post_date").alias("post_date"), "amt")
    )
    totals = (
        detail.where(F.col("description").isNotNull())
        .groupBy("description")
        .agg(F.round(sum0("amt"), 2).alias("amt"))
    )
    return {"Totals": totals, "Detail": detail}


def wage_transactions(ledger, year: int | None = None, code_pattern: str = WAGE_PATTERN) -> DataFrame:
    """Wage splits of transactions whose description is an employee's name pattern."""
    staff = ledger.employees.select(
        F.col("id").alias("emp_id"),
        F.col("addr_name").alias("emp_name"),
        F.col("addr_addr1").alias("emp_addr1"),
        F.col("addr_addr2").alias("emp_addr2"),
    )
    accounts = ledger.accounts.where(F.col("code").ilike(code_pattern)).select(
        F.col("guid").alias("account_guid"), "name", "code"
    )
    paid = _account_splits(ledger, accounts).join(_heads(ledger, year), "tx_guid")
    return like_join(paid, "description", staff, "emp_name").select(
        F.to_date("post_date").alias("post_date"),
        F.month("post_date").alias("month"),
        "name",
        "code",
        "memo",
        "amt",
        "emp_id",
        "emp_name",
        "emp_addr1",
        "emp_addr2",
    )


def wages_monthly(wages: DataFrame) -> DataFrame:
    """Withholding per month and memo."""
    return wages.where(F.col("memo").isNotNull()).groupBy("month", "memo").agg(sum0("amt").alias("amt"))


def wages_totals(wages: DataFrame) -> DataFrame:
    """Totals per account code, employee and memo."""
    keys = ["code", "emp_id", "emp_name", "emp_addr1", "emp_addr2", "memo"]
    return wages.na.drop("any", subset=keys).groupBy(*keys).agg(sum0("amt").alias("amt"))


def labor_deposits(ledger, year: int, code: str = DEPOSIT_CODE) -> DataFrame:
    """Deposits per account name and posting time."""
    accounts = ledger.accounts.where(F.col("code") == code).select(F.col("guid").alias("account_guid"), "name")
    return (
        _account_splits(ledger, accounts)
        .join(_heads(ledger, year), "tx_guid")
        .groupBy("name", "post_date")
        .agg(F.sum("amt").alias("amt"))
        .withColumn("post_date", F.to_date("post_date"))
    )


def wage_reports(ledger, year: int) -> dict[str, DataFrame]:
    """R22/SK4: the four wage tables by sheet name."""
    wages = wage_transactions(ledger, year)
    return {
        "Transactions": wages,
        "Monthly_Withholding": wages_monthly(wages),
        "W2_Wage_Totals": wages_totals(wages),
        "Labor_Deposits": labor_deposits(ledger, year),
    }

