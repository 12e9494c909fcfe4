"""The account tree as intervals: what lies below an account is a range of its tour.

A tour walks down into every inner node and up out of it again.  The place of a step is its number, so
an account lies below another when its place is within the other's first and last one.  Leaves take the
place where their parent is entered; they add no steps, so a parent of a million accounts costs two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import PER_RANGE, row_numbers, running_total
from .tree import endless


def _inner(accounts: DataFrame) -> DataFrame:
    """Nodes that are somebody's parent, ``(guid, up)``; ``up`` is null without an existing parent.

    Nodes on or below a cycle are left out: no tour reaches them.
    """
    parents = accounts.where(F.col("parent_guid").isNotNull()).select(F.col("parent_guid").alias("guid")).distinct()
    nodes = accounts.join(parents, "guid", "left_semi").select("guid", "parent_guid")
    known = nodes.select(F.col("guid").alias("parent_guid"), F.lit(True).alias("known"))
    nodes = cut_lineage(
        nodes.join(known, "parent_guid", "left").select("guid", F.when(F.col("known"), F.col("parent_guid")).alias("up"))
    )
    return nodes.join(endless(nodes.withColumnRenamed("up", "next")), "guid", "left_anti")


def _down(guid: str) -> Column:
    return F.concat(F.lit("<"), F.col(guid))


def _up(guid: str) -> Column:
    return F.concat(F.lit(">"), F.col(guid))


def _steps(nodes: DataFrame, per_range: int) -> DataFrame:
    """The tour as a linked list ``(step, next)``; the last step has no next.

    Siblings follow each other by guid.  The next one is found by its number in the order of
    (parent, guid), not by a window per parent.
    """
    numbered = row_numbers(nodes, ["up", "guid"], "number", per_range)
    later = numbered.select((F.col("number") - 1).alias("number"), F.col("up").alias("_up"), F.col("guid").alias("sibling"))
    rows = numbered.join(later, "number", "left").withColumn(
        "sibling", F.when(F.col("up").eqNullSafe(F.col("_up")), F.col("sibling"))
    )
    first = nodes.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("guid")).agg(F.min("guid").alias("child"))
    rows = rows.join(first, "guid", "left")
    into = F.struct(_down("guid").alias("step"), F.coalesce(_down("child"), _up("guid")).alias("next"))
    out = F.struct(_up("guid").alias("step"), F.coalesce(_down("sibling"), _up("up")).alias("next"))
    return rows.select(F.inline(F.array(into, out)))


def tour(accounts: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """First and last place of every inner node: ``(guid, enter, leave)``.

    The places come from ranking the list of steps: each round a step adds the distance of the step it
    points to and points where that one does, so n steps take log2 n joins, each on a key that no two
    rows share, at any depth and width.  Rounds are checkpointed, as the plan would double otherwise.
    """
    state = cut_lineage(
        _steps(_inner(accounts), per_range).withColumn("togo", F.col("next").isNotNull().cast("bigint"))
    )
    steps = state.count()
    reached = 1
    while reached < steps:
        jump = state.select(F.col("step").alias("next"), F.col("next").alias("after"), F.col("togo").alias("more"))
        moved = state.where(F.col("next").isNotNull()).join(jump, "next")
        moved = moved.select("step", F.col("after").alias("next"), (F.col("togo") + F.col("more")).alias("togo"))
        state = cut_lineage(state.where(F.col("next").isNull()).unionByName(moved))
        reached *= 2
    place = F.lit(steps) - F.col("togo")
    entering = F.col("step").startswith("<")
    return state.groupBy(F.substring("step", 2, 1 << 30).alias("guid")).agg(
        F.max(F.when(entering, place)).alias("enter"), F.max(F.when(~entering, place)).alias("leave")
    )


def with_places(accounts: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """``(guid, enter, leave)`` of every account, leaves at the place where their parent is entered.

    Both are null for leaves without an existing parent and for accounts on or below a cycle.
    """
    places = cut_lineage(tour(accounts)) if places is None else places
    above = places.select(F.col("guid").alias("parent_guid"), F.col("enter").alias("_at"))
    rows = accounts.select("guid", "parent_guid").join(places, "guid", "left").join(above, "parent_guid", "left")
    return rows.select("guid", F.coalesce("enter", "_at").alias("enter"), F.coalesce("leave", "_at").alias("leave"))


def _marked_steps(places: DataFrame, entering: Column, leaving: Column) -> DataFrame:
    """Both steps of every inner node, ``(guid, at, first, amount)``."""
    into = F.struct(F.col("enter").alias("at"), F.lit(True).alias("first"), entering.alias("amount"))
    out = F.struct(F.col("leave").alias("at"), F.lit(False).alias("first"), leaving.alias("amount"))
    return places.select("guid", F.inline(F.array(into, out)))


def accounts_below(
    accounts: DataFrame, hit: Column, places: DataFrame | None = None, per_range: int = PER_RANGE
) -> DataFrame:
    """X3 by intervals: the accounts for which ``hit`` holds, and all accounts below such accounts.

    Every hit opens its interval and closes it again; an account is below one where more are open than
    closed.  That is a running sum over the tour, whatever the depth and however many accounts hit.
    Accounts on or below a cycle are found by their own hit only.
    """
    places = cut_lineage(tour(accounts, per_range)) if places is None else places
    rows = accounts.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    opened = F.col("_hit").cast("bigint")
    steps = _marked_steps(places.join(rows.select("guid", "_hit"), "guid"), opened, -opened)
    open_ = running_total(steps, ["at"], F.col("amount"), "open", per_range)
    inside = open_.where(F.col("first") & (F.col("open") > 0)).select(F.col("guid").alias("parent_guid"), F.lit(True).alias("_in"))
    found = rows.join(inside, "parent_guid", "left").where(F.col("_hit") | F.coalesce("_in", F.lit(False)))
    return found.select(*accounts.columns)


def subtree_totals(
    accounts: DataFrame, amounts: DataFrame, value: str, places: DataFrame | None = None, per_range: int = PER_RANGE
) -> DataFrame:
    """A10: sum of ``value`` over each account and all below it: ``(guid, total)``.

    ``amounts`` holds rows ``(guid, value)``, any number per account; ``value`` is a whole number or a
    decimal.  An inner node's own rows and those of its leaves count where it is entered; a subtree is
    the running sum where it is left, less what it was before it was entered.  So an account's rows are added once,
    not once per ancestor.  Accounts without rows have 0; accounts on or below a cycle only their own rows.
    """
    places = cut_lineage(tour(accounts, per_range)) if places is None else places
    own = amounts.groupBy("guid").agg(F.sum(value).alias("own"))
    rows = cut_lineage(accounts.select("guid", "parent_guid").join(own, "guid", "left"))
    is_inner = places.select("guid", F.lit(True).alias("inner"))
    spot = F.when(F.col("inner"), F.col("guid")).otherwise(F.col("parent_guid"))
    at_node = rows.join(is_inner, "guid", "left").groupBy(spot.alias("guid")).agg(F.sum("own").alias("here"))
    steps = _marked_steps(places.join(at_node, "guid", "left"), F.col("here"), F.lit(0))
    summed = running_total(steps, ["at"], F.col("amount"), "upto", per_range)
    first = F.col("first")
    below = summed.groupBy("guid").agg(
        (
            F.max(F.when(~first, F.col("upto")))
            - F.max(F.when(first, F.col("upto")))
            + F.coalesce(F.max(F.when(first, F.col("amount"))), F.lit(0))
        ).alias("below")
    )
    return rows.join(below, "guid", "left").select("guid", F.coalesce("below", "own", F.lit(0)).alias("total"))
