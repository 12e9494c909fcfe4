"""Account tree: ancestor paths, ancestor at a level, term search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import descriptor
from ..session import cut_lineage


#: Rounds (depth 2**6) after which the walkers are tested for cycles.
ROUNDS_BEFORE_TEST = 6


def endless(pointers: DataFrame) -> DataFrame:
    """Nodes of ``(guid, next)`` whose pointers never end: those on or above a cycle.

    Every doubling covers twice the steps.  A chain has fewer steps than there are
    nodes, so what still points somewhere after more steps than that has no end.
    """
    steps, nodes = 1, pointers.count()
    state = pointers
    while steps <= nodes:
        walking = state.where(F.col("next").isNotNull())
        if walking.isEmpty():
            break
        jump = state.select(F.col("guid").alias("next"), F.col("next").alias("after"))
        moved = walking.join(jump, "next").select("guid", F.col("after").alias("next"))
        state = cut_lineage(state.where(F.col("next").isNull()).unionByName(moved))
        steps *= 2
    return state.where(F.col("next").isNotNull()).select("guid")


def parent_paths(accounts: DataFrame) -> DataFrame:
    """Names from an inner node up to its root: ``(guid, names, closed)``, at any depth.

    Only nodes that are somebody's parent take part, a small part of the accounts.
    Pointers double each round, so depth d takes ceil(log2 d) joins; every round
    is checkpointed, because the plan would otherwise double with it.  Nodes
    without a name are skipped in the path; a parent that does not exist ends it.
    A node on or above a cycle never ends and is returned with ``closed = false``;
    such nodes are found by pointers alone, so no path is drawn out around a cycle.
    """
    parents = accounts.where(F.col("parent_guid").isNotNull()).select(F.col("parent_guid").alias("guid")).distinct()
    nodes = accounts.join(parents, "guid", "left_semi").select("guid", "name", "parent_guid")
    known = nodes.select(F.col("guid").alias("parent_guid"), F.lit(True).alias("known"))
    state = nodes.join(known, "parent_guid", "left").select(
        "guid",
        F.when(F.col("name").isNull(), F.array().cast("array<string>")).otherwise(F.array("name")).alias("names"),
        F.when(F.col("known"), F.col("parent_guid")).alias("next"),
    )
    state = cut_lineage(state)
    cyclic, rounds = None, 0
    while True:
        if rounds == ROUNDS_BEFORE_TEST:
            cyclic = endless(state.select("guid", "next"))
            state = cut_lineage(state.join(cyclic, "guid", "left_anti"))
        walking = state.where(F.col("next").isNotNull())
        if walking.isEmpty():
            break
        rounds += 1
        jump = state.select(
            F.col("guid").alias("next"), F.col("names").alias("more"), F.col("next").alias("after")
        )
        moved = walking.join(jump, "next").select(
            "guid", F.concat("names", "more").alias("names"), F.col("after").alias("next")
        )
        state = cut_lineage(state.where(F.col("next").isNull()).unionByName(moved))
    closed = state.select("guid", "names", F.lit(True).alias("closed"))
    if cyclic is None:
        return closed
    return closed.unionByName(cyclic.select("guid", F.array().cast("array<string>").alias("names"), F.lit(False).alias("closed")))


def with_paths(accounts: DataFrame, level: int = 4) -> DataFrame:
    """Add ``parent_accounts`` (nearest first, ``>`` joined), ``finpack_account``.

    The level counts from the root; accounts nearer to the root than that keep
    their own name.  Accounts in a cycle get a null path and ``path_closed`` false.
    """
    paths = parent_paths(accounts).select(
        F.col("guid").alias("parent_guid"), F.col("names").alias("_names"), F.col("closed").alias("_closed")
    )
    names = F.coalesce("_names", F.array().cast("array<string>"))
    closed = F.coalesce("_closed", F.lit(True))
    path = F.when(closed, F.array_join(names, ">"))
    above = F.when(closed & (F.size(names) >= level), F.element_at(names, -level))
    return accounts.join(paths, "parent_guid", "left").select(
        *[accounts[c] for c in accounts.columns if c != "parent_guid"],
        "parent_guid",
        path.alias("parent_accounts"),
        F.when(F.coalesce(above, F.lit("")) == "", F.col("name")).otherwise(above).alias("finpack_account"),
        closed.alias("path_closed"),
    )


def account_notes(ledger) -> DataFrame:
    """Note text of each account, from the key/value side table."""
    return ledger.slots.where((F.col("name") == "notes") & (F.col("slot_type") == 4)).select(
        F.col("obj_guid").alias("guid"), F.col("string_val").alias("account_notes")
    )


def all_accounts(ledger, crops: list[str], level: int = 4, with_notes: bool = False) -> DataFrame:
    """Accounts with path, level ancestor and crop; built once per ledger.

    The crop of the account's own name wins over that of its ancestors; General
    is the default.  Notes are joined only on request.
    """

    def build() -> DataFrame:
        located = with_paths(ledger.accounts, level)
        from_path = descriptor("parent_accounts", crops, F.lit("General"))
        return located.withColumn("crop", descriptor("name", crops, from_path))

    accounts = ledger.remember(f"all_accounts|{level}|{'|'.join(crops)}", build)
    return accounts.join(account_notes(ledger), "guid", "left") if with_notes else accounts


def accounts_of_type(accounts: DataFrame, types: list[str]) -> DataFrame:
    """Guids of the accounts of some types."""
    return accounts.where(F.col("account_type").isin(*types)).select("guid")


def accounts_matching(accounts: DataFrame, term: str) -> DataFrame:
    """Accounts with a term in their own name or any ancestor's, by commodity.

    One pass and one row per account, also when both places match.
    """
    hit = F.coalesce(F.col("name").rlike(term), F.lit(False)) | F.coalesce(
        F.col("parent_accounts").rlike(term), F.lit(False)
    )
    return accounts.where(hit).select("commodity_guid", "guid").dropDuplicates(["guid"])


def one_account_per_commodity(matched: DataFrame, name: str) -> DataFrame:
    """The account to post to per commodity: smallest guid, with the number found.

    More than one candidate is a bookkeeping question; it shows as ``<name>_found``
    instead of multiplying the loads.
    """
    return (
        matched.where(F.col("commodity_guid").isNotNull())
        .groupBy("commodity_guid")
        .agg(F.min("guid").alias(name), F.count(F.lit(1)).alias(f"{name}_found"))
    )
