"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, repeated up to ``max_epochs`` times.  A
document's virtual finish time is the number of its source's words up to and with it, divided by the
source's target.  All passes of all documents are range-sorted by finish time and the order is truncated where the
budget is spent, so every source reaches its target at time 1 whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .common import in_ranges, row_mix, word_count

#: Columns of the result beside the input's; input columns with these names are replaced.
RESULT = ("size", "source_size", "target", "taken", "copies")
#: Place of a pass in the common order; row ids tell equal rows apart.
TURN = ("time", "_null", "_src", "epoch", "_mix", "_key", "_rid")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int, budget: int | None) -> DataFrame:
    """``_null, _src, source_size, target`` from the sizes by source.

    Sources in code point order, null last, get the weights in turn.  A target above ``max_epochs``
    times its source is cut to that and the rest shared anew by weight.  That has a closed form:
    with sources in order of size by weight, those before the first that can bear its share are cut.
    The table has one row per source, so its windows are small however many rows there are.
    """
    all_rows, order = W.partitionBy(), W.orderBy("_null", "_src")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.select("*", weight.cast("long").alias("_w"), (F.col("source_size") * max_epochs).alias("_most"))
    total = F.sum("source_size").over(all_rows) if budget is None else F.lit(int(budget)).cast("long")
    by_ratio = W.orderBy((F.col("_most").cast("double") / F.col("_w")), "_null", "_src")
    before = F.coalesce(F.sum("_most").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_w").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    level = weighed.select("*", ((total - before).cast("double") / rest).alias("_level"), F.row_number().over(by_ratio).alias("_rank"))
    bears = F.col("_most").cast("double") >= F.col("_level") * F.col("_w")
    first = F.min(F.when(bears, F.struct("_rank", "_level"))).over(all_rows)
    final = level.select("*", first.alias("_first"))
    capped = F.col("_first").isNull() | (F.col("_rank") < F.col("_first._rank"))
    target = F.when(capped, F.col("_most").cast("double")).otherwise(F.col("_first._level") * F.col("_w"))
    return final.select("_null", "_src", "source_size", target.alias("target"))


def queues(base: DataFrame, count: int, weights: Sequence[int], budget: int | None, max_epochs: int, per_range: int) -> DataFrame:
    """Rows with ``source_size, target`` and ``_upto``, the words of their source up to and with them.

    A source is a stretch of the order by source, hash and row; a task holds a piece of it, equal rows or not, and
    running sums start from the sum of the pieces before.
    """
    ordered = in_ranges(base, count, per_range, "_null", "_src", "_mix", "_key", "_rid")
    pieces = ordered.groupBy("_null", "_src", "_range").agg(F.sum("size").alias("_words"))
    sizes = pieces.groupBy("_null", "_src").agg(F.sum("_words").alias("source_size"))
    earlier = W.partitionBy("_null", "_src").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = pieces.withColumn("_from", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    starts = starts.join(source_targets(sizes, weights, max_epochs, budget), ["_null", "_src"])
    inner = W.partitionBy("_null", "_src", "_range").orderBy("_mix", "_key", "_rid").rowsBetween(W.unboundedPreceding, 0)
    queued = ordered.withColumn("_in", F.sum("size").over(inner)).join(starts, ["_null", "_src", "_range"])
    return cut_lineage(queued.withColumn("_upto", F.col("_from") + F.col("_in")).drop("_from", "_in", "_range"))


def _turn(epoch: int) -> Column:
    """Place of a document's ``epoch``-th pass in the common order."""
    words = (F.col("source_size") * epoch + F.col("_upto")).cast("double")
    time = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    return F.struct(time.alias("time"), "_null", "_src", F.lit(epoch).alias("epoch"), "_mix", "_key", "_rid")


def last_turn(queued: DataFrame, count: int, budget: int, max_epochs: int, per_range: int) -> Column | None:
    """The last pass that the budget covers, as a literal struct; None if it covers none.

    All passes are range-sorted by their place.  Sums by range tell in which one the budget ends; it alone is added up row
    by row.  Only sums and the one place come to the driver.
    """
    turns = queued.select("size", F.explode(F.array(*[_turn(e) for e in range(max_epochs)])).alias("turn")).select("size", "turn.*")
    ranged = in_ranges(turns, count * max_epochs, per_range, *TURN)
    sums = ranged.groupBy("_range").agg(F.sum("size").alias("words"), F.max(F.struct(*TURN)).alias("last"))
    running = sums.withColumn("upto", F.sum("words").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)))
    over = running.filter(F.col("upto") > budget).agg(F.min(F.struct("_range", "upto", "words")).alias("x")).first()["x"]
    end = running.filter(F.col("upto") <= budget).agg(F.max("last").alias("x")).first()["x"]
    if over is not None:
        piece = ranged.filter(F.col("_range") == over["_range"])
        upto = F.sum("size").over(W.partitionBy("_range").orderBy(*TURN).rowsBetween(W.unboundedPreceding, 0))
        fits = piece.withColumn("upto", upto).filter(F.col("upto") <= budget - (over["upto"] - over["words"]))
        end = fits.agg(F.max(F.struct(*TURN)).alias("x")).first()["x"] or end
    if end is None:
        return None
    return F.struct(*[F.lit(end[n]).alias(n) for n in TURN])


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    budget: int | None = None,
    max_epochs: int = 3,
    columns: Sequence[str] | None = None,
    per_range: int = 10_000,
) -> DataFrame:
    """Rows with ``size, source_size, target, taken, copies`` and the input's ``columns`` (all unless given).

    ``size`` is the number of words (null text: 0), ``copies`` says how often the mix takes the row (0
    to ``max_epochs``), ``taken`` is copies times size.  The budget is the number of all words unless
    given.  A null source is a source of its own, after all others.

    The order within a source is a hash of key and text, so reruns agree; equal rows tie and
    share their results in either order.  The input is read once, into a checkpoint of what is wanted of it; all sums run over
    slim rows, in pieces of ``per_range`` rows whatever repeats.

    Rows of no words take part and use nothing up.  Input columns with these names are replaced, all others come back
    whatever their names.  An empty input gives no rows.
    """
    wanted = [c for c in (docs.columns if columns is None else columns) if c.lower() not in RESULT]
    name = F.col(f"`{source}`")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("_doc"),
        word_count(F.col(f"`{text}`")).alias("size"),
        name.isNull().cast("int").alias("_null"),
        F.coalesce(name.cast("string"), F.lit("")).alias("_src"),
        row_mix(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("_mix"),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    base = cut_lineage(base)
    count, words = base.agg(F.count("*"), F.sum("size")).first()
    queued = queues(base.drop("_doc"), count, weights, budget, max_epochs, per_range)
    end = last_turn(queued, count, (words or 0) if budget is None else int(budget), max_epochs, per_range)
    copies = F.lit(0)
    for epoch in range(max_epochs if end is not None else 0):
        copies = copies + F.when(_turn(epoch) <= end, 1).otherwise(0)
    mixed = queued.select("_rid", "source_size", "target", copies.cast("int").alias("copies"))
    mixed = base.select("_rid", "_doc", "size").join(mixed, "_rid")
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return mixed.select(*[F.col(f"_doc.`{c}`") for c in wanted], "size", "source_size", "target", taken, "copies")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, columns as in ``docs``."""
    whole = docs.select(F.struct("*").alias("_doc"), *[F.col(f"`{options.get(c, d)}`").alias(d) for c, d in (("key", "doc_id"), ("text", "text"), ("source", "source"))])
    rest = {k: v for k, v in options.items() if k not in ("key", "text", "source")}
    mixed = mix_sources(whole, columns=["_doc"], **rest).filter("copies > 0").select("_doc", "copies")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")
