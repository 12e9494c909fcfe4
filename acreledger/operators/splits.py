"""Split level joins: all transactions, counter splits, account totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import in_years, packed, rational, unpacked
from ..sources.ledger import TRANSACTION_KEYS, Ledger
from .sums import exact_totals


def in_folders(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Rows of the year folders of some years, where the table is kept in such folders."""
    if not years or "post_year" not in df.columns:
        return df
    return df.where(F.col("post_year").isin(*([years] if isinstance(years, int) else sorted(set(years)))))


PATH_COLUMNS = ["finpack_account", "parent_accounts"]


def splits_with_accounts(
    ledger,
    accounts: DataFrame | None = None,
    heads: DataFrame | None = None,
    years: Sequence[int] | None = None,
) -> DataFrame:
    """Splits with the attributes of their account; amounts still as integer pairs.

    ``accounts`` may be the enriched accounts; their path columns then come along in
    the same join, instead of a second shuffle of the splits on the account.
    ``heads`` are the wanted transactions; their columns are joined first, so only
    their splits go on.  ``years`` are theirs, for splits kept in year folders.
    Guids of splits go through the shuffles as bytes, half of what their text takes on disk.
    """
    accounts = ledger.accounts if accounts is None else accounts
    accounts = accounts.select(
        F.col("guid").alias("account_guid"),
        "account_type",
        F.col("description").alias("account_desc"),
        "parent_guid",
        "commodity_guid",
        F.col("name").alias("account_name"),
        F.col("code").alias("account_code"),
        *[c for c in PATH_COLUMNS if c in accounts.columns],
    )
    splits = in_folders(ledger.splits, years).select(
        packed("guid").alias("split_guid"),
        "tx_guid",
        "account_guid",
        "memo",
        F.col("action").alias("split_action"),
        "reconcile_date",
        "reconcile_state",
        "value_num",
        "value_denom",
        "quantity_num",
        "quantity_denom",
    )
    if heads is not None:
        splits = splits.join(heads, "tx_guid")
    return splits.join(accounts, "account_guid").withColumn("split_guid", unpacked("split_guid"))


#: Sums over rows that keep their integer pairs (``pairs=True``), for :func:`~.sums.exact_totals`.
AMOUNTS = {"amt": ("value_num", "value_denom"), "qty": ("quantity_num", "quantity_denom")}


def with_amounts(df: DataFrame, factor: int | Column = 1, pairs: bool = False) -> DataFrame:
    """Decimal ``amt`` and ``qty``; a sign or weight multiplies the integer numerator.

    ``pairs`` keeps the multiplied integer pairs as well, for sums; decimals that nobody selects
    are then never computed.
    """
    factor = factor if isinstance(factor, Column) else F.lit(factor)
    weighted = df.withColumns({num: F.col(num) * factor for num, _ in AMOUNTS.values()})
    rows = weighted.withColumns({name: rational(*pair) for name, pair in AMOUNTS.items()})
    return rows if pairs else rows.drop(*[c for pair in AMOUNTS.values() for c in pair])


def transaction_heads(ledger, years: Sequence[int] | None = None) -> DataFrame:
    """Transactions under their report names, year range pushed to the scan."""
    return in_folders(ledger.transactions, years).where(in_years("post_date", years)).select(
        F.col("guid").alias("tx_guid"),
        "currency_guid",
        F.col("num").alias("tx_num"),
        "enter_date",
        "description",
        "post_date",
    )


def all_transactions(ledger, years: Sequence[int] | None = None, pairs: bool = False) -> DataFrame:
    """Every split with its account and transaction."""
    return with_amounts(splits_with_accounts(ledger, None, transaction_heads(ledger, years), years), 1, pairs)


def counter_splits(
    ledger,
    types: Sequence[str],
    inverse: bool = True,
    years: Sequence[int] | None = None,
    distinct_splits: bool = False,
    accounts: DataFrame | None = None,
    pairs: bool = False,
) -> DataFrame:
    """Splits joined to the *other* accounts of their transaction.

    ``inverse`` lists what stands against accounts of the given types, sign turned;
    otherwise the splits on those accounts are listed against every other account.
    One self join for all accounts replaces a query per account.  The source side
    is reduced to distinct (transaction, account) first.  A split repeats once per
    other account, as in the report this reproduces; ``distinct_splits`` keeps each
    split once, with the smallest source account.

    The wanted years restrict both sides before they meet.  The join on the transaction
    is the last one, so adaptive execution can split a transaction that holds a large
    share of the splits.  Totals that need no source columns should
    use :func:`counter_flows`, which never multiplies rows.
    """
    chosen = F.col("account_type").isin(*types)
    splits = splits_with_accounts(ledger, accounts, transaction_heads(ledger, years), years)
    dated = transaction_heads(ledger, years).select("tx_guid") if years else None
    sources = splits_with_accounts(ledger, None, dated, years).select(
        "tx_guid",
        F.col("account_guid").alias("src_guid"),
        F.col("account_code").alias("src_code"),
        F.col("account_type").alias("src_type"),
        F.col("account_name").alias("src_name"),
    )
    if inverse:
        sources = sources.where(F.col("src_type").isin(*types))
    else:
        splits = splits.where(chosen)
    if distinct_splits:
        pick = F.struct("src_guid", "src_code", "src_type", "src_name")
        # two candidates are enough: one of them differs from the split's own account
        low = sources.groupBy("tx_guid").agg(F.min(pick).alias("a"))
        nxt = (
            sources.join(low, "tx_guid")
            .where(F.col("src_guid") != F.col("a.src_guid"))
            .groupBy("tx_guid")
            .agg(F.min(pick).alias("b"))
        )
        two = low.join(nxt, "tx_guid", "left")
        joined = splits.join(two, "tx_guid")
        other = F.when(F.col("a.src_guid") != F.col("account_guid"), F.col("a")).otherwise(F.col("b"))
        joined = joined.withColumn("_src", other).where(F.col("_src").isNotNull())
        joined = joined.select(*splits.columns, "_src.*")
    else:
        sources = sources.distinct()
        joined = splits.join(sources, "tx_guid").where(F.col("account_guid") != F.col("src_guid"))
    return with_amounts(joined, -1 if inverse else 1, pairs)


def in_parts(ledger, parts: int) -> list[Ledger]:
    """The ledger cut by transactions: each part has all splits and the head of its transactions, and every account.

    What stands against what never crosses a transaction, so the rows of :func:`counter_splits` over a ledger are those
    over its parts.  Splits and transactions without a guid, which meet nothing, are in none.
    """

    def part(n: int) -> Ledger:
        def table(name: str) -> DataFrame:
            rows = ledger.table(name)
            if name not in TRANSACTION_KEYS:
                return rows
            return rows.where(F.pmod(F.xxhash64(TRANSACTION_KEYS[name]), F.lit(parts)) == n)

        return Ledger(table)

    return [part(n) for n in range(parts)]


def source_counts(ledger, types: Sequence[str], years: Sequence[int] | None = None) -> DataFrame:
    """Number of distinct accounts of some types per transaction.

    Distinct is taken on (transaction, account), so a huge transaction is spread
    over many tasks before its short list of accounts is counted.
    """
    chosen = ledger.accounts.where(F.col("account_type").isin(*types)).select(F.col("guid").alias("account_guid"))
    splits = in_folders(ledger.splits, years).select("tx_guid", "account_guid")
    if years:
        splits = splits.join(transaction_heads(ledger, years).select("tx_guid"), "tx_guid", "left_semi")
    return (
        splits.join(chosen, "account_guid", "left_semi")
        .distinct()
        .groupBy("tx_guid")
        .agg(F.count(F.lit(1)).alias("sources"))
    )


def counter_flows(
    ledger, types: Sequence[str], years: Sequence[int] | None = None, accounts: DataFrame | None = None
) -> DataFrame:
    """J2 in weighted form: one row per split of the accounts *outside* ``types``.

    ``sources`` says how often the split appears in the inverse counter-split join.
    ``amt`` and ``qty``, and the integer pairs they come from, are already multiplied by it, so
    their sums equal those over the joined rows, without the fan-out.
    """
    heads = transaction_heads(ledger, years)
    outside = splits_with_accounts(ledger, accounts, heads, years).where(~F.col("account_type").isin(*types))
    return with_amounts(outside.join(source_counts(ledger, types, years), "tx_guid"), -F.col("sources"), pairs=True)


def counter_totals_by_source(ledger, types: Sequence[str], heads: DataFrame) -> DataFrame:
    """J2 inverse summed per source account: ``src_guid, amt, qty, rows``, without the fan-out.

    What stands against an account in a transaction is the transaction's total less the account's own
    splits.  Splits are summed per transaction and account, those sums per transaction, and a source meets one
    row per transaction and pair of denominators: no step has more rows than there are splits.  ``heads`` holds the
    ``tx_guid`` of the wanted transactions.  Sources without a counter split give no row.
    """
    known = ledger.accounts.select(F.col("guid").alias("account_guid"), F.col("account_type").isin(*types).alias("source"))
    splits = ledger.splits.select("tx_guid", "account_guid", *[c for pair in AMOUNTS.values() for c in pair])
    denoms = [denom for _, denom in AMOUNTS.values()]
    nums = [num for num, _ in AMOUNTS.values()]
    own = (
        splits.join(heads.select("tx_guid"), "tx_guid", "left_semi")
        .join(known, "account_guid")
        .groupBy("tx_guid", "account_guid", "source", *denoms)
        .agg(*[F.sum(n).alias(n) for n in nums], F.count(F.lit(1)).alias("rows"))
    )
    totals = own.groupBy("tx_guid", *denoms).agg(*[F.sum(c).alias(c) for c in (*nums, "rows")])
    sources = own.where("source").select("tx_guid", F.col("account_guid").alias("src_guid"))
    against = sources.distinct().join(totals, "tx_guid").select("src_guid", *denoms, *[(-F.col(n)).alias(n) for n in nums], "rows")
    itself = own.where("source").select(F.col("account_guid").alias("src_guid"), *denoms, *nums, (-F.col("rows")).alias("rows"))
    return exact_totals(against.unionByName(itself), ["src_guid"], AMOUNTS, {"rows": F.col("rows")}).where("rows > 0")


def account_totals(ledger, year: int | None = None) -> DataFrame:
    """A1/R13 minimum slice: sum and count of splits per account.

    Splits are summed by account guid before account attributes are joined, so a
    hot account shrinks to one row per map task before anything is shuffled.
    """
    splits = in_folders(ledger.splits, [year] if year else None).select("tx_guid", "account_guid", *AMOUNTS["amt"])
    if year:
        heads = transaction_heads(ledger, [year]).select("tx_guid")
        splits = splits.join(heads, "tx_guid", "left_semi")
    sums = exact_totals(splits, ["account_guid"], {"amt": AMOUNTS["amt"]}, {"splits": F.lit(1)})
    accounts = ledger.accounts.select(
        F.col("guid").alias("account_guid"),
        F.col("code").alias("account_code"),
        F.col("name").alias("account_name"),
        "account_type",
    )
    return sums.join(accounts, "account_guid")
