"""Chart-of-accounts rules as data: codes, types and categories used by the reports."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import matches

# Account types, codes and labels the reports are defined by.
CASH_TYPES = ["RECEIVABLE", "PAYABLE", "BANK", "CREDIT", "CASH"]
BALANCE_TYPES = {
    "Assets": ["ASSET"],
    "Cash": ["BANK", "CASH"],
    "Liabilities": ["LIABILITY", "CREDIT", "PAYABLE"],
}
STOCK_TYPES = ["STOCK"]
CROPS = ["Corn", "Soybeans"]
HARVEST_CODES = ["301c", "303b"]
RENT_CODES = ["424b", "424c"]
GRAIN_CODES = "133|134"
CAPITAL_PREFIX = "15"
WAGE_PATTERN = "54%"
DEPOSIT_CODE = "510"
PAID_TOLERANCE = "0.02"
SUMMARY_ORDER = {"INCOME": 10, "EXPENSE": 20, "OIBDA": 30, "DEPRECIATION": 40, "NET INCOME": 50}
OTHER_ORDER = 100
TICKET_CROPS = {"CORN": "Corn", "BEANS": "Soybeans"}


@dataclass(frozen=True)
class Reclass:
    """Accounts whose code starts with ``codes`` get the columns in ``put``."""

    codes: str
    put: dict[str, str] = field(default_factory=dict)


# Inventory sold counts as income, prepaid as expense, 9xx as non-farm.
FARM_RULES = [
    Reclass("133", {"account_name": "Corn", "account_type": "INCOME", "account_code": "301c"}),
    Reclass("134", {"account_name": "Soybeans", "account_type": "INCOME", "account_code": "303b"}),
    Reclass("146|147", {"account_type": "EXPENSE"}),
    Reclass("9", {"account_type": "NF EXPENSE"}),
]


def reclassify(df: DataFrame, rules: list[Reclass], code: str = "account_code") -> DataFrame:
    """The rules in order; a later rule sees the codes an earlier one set."""
    for rule in rules:
        hit = F.coalesce(matches(code, rule.codes), F.lit(False))
        df = df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in rule.put.items()})
    return df
