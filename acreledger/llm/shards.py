"""Sharding by jump consistent hashing.

A key's shard follows from the key and the number of shards alone: a chain of pseudo-random jumps
``0 = b0 < b1 < b2 ...`` belongs to each key, and with n shards the key lives in the last jump below
n.  Appending a shard extends the chain by at most one jump, so rows move only into the new shard.
There is no ring table and nothing to broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .common import hex_number, in_ranges, row_mix

#: Linear congruential generator modulo 2**48, as in POSIX drand48 (fixed values).
FACTOR, INCREMENT, MASK = 25214903917, 11, (1 << 48) - 1


def _next(x: Column) -> Column:
    """The next 48-bit state; the product is taken by halves, so no long overflows."""
    high, low = F.shiftright(x, 24), x.bitwiseAND(F.lit((1 << 24) - 1))
    carried = F.shiftleft((high * F.lit(FACTOR)).bitwiseAND(F.lit((1 << 24) - 1)), 24)
    return (carried + low * F.lit(FACTOR) + F.lit(INCREMENT)).bitwiseAND(F.lit(MASK))


def jump_shard(key: Column, n_shards: int) -> Column:
    """Struct (shard, grown): the shard of ``key`` among ``n_shards`` and among one more.

    The chain has about ln(n) jumps and, for up to 64 shards, never more than n.  Beyond that it
    is followed for 64 + 16 ln(n) jumps; a longer chain (chance below 1e-30) raises an error
    instead of giving a wrong shard.  A null key is a key like any other.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    seed = hex_number(F.md5(F.coalesce(key.cast("string"), F.lit("null"))))
    rounds = n_shards + 1 if n_shards <= 64 else 64 + int(16 * math.log(n_shards))
    long = lambda value: F.lit(value).cast("long")
    start = F.struct(seed.alias("x"), long(0).alias("j"), long(-1).alias("shard"), long(-1).alias("grown"))

    def step(a: Column, _: Column) -> Column:
        x, j = _next(a["x"]), a["j"]
        jump = F.floor((j + 1) * F.lit(2147483648.0) / (F.shiftright(x, 17) + 1)).cast("long")
        return F.when(j > n_shards, a).otherwise(
            F.struct(
                x.alias("x"),
                jump.alias("j"),
                F.when(j < n_shards, j).otherwise(a["shard"]).alias("shard"),
                j.alias("grown"),
            )
        )

    def finish(a: Column) -> Column:
        done = F.struct(a["shard"].cast("int").alias("shard"), a["grown"].cast("int").alias("grown"))
        return F.when(a["j"] > n_shards, done).otherwise(F.raise_error(F.lit("jump chain too long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, finish)


#: Columns of the result beside the input's; input columns with these names are replaced.
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def assign_shards(
    docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text", columns: Sequence[str] | None = None, per_range: int = 50_000
) -> DataFrame:
    """Rows with ``size, text_crc32, law, shard, slot, grown_shard`` and the input's ``columns`` (all unless given).

    ``size`` is the UTF-8 length plus 8 (null text: 8), ``text_crc32`` the CRC of the UTF-8 bytes
    (null: of none), ``law`` is "key", ``grown_shard`` the shard if there were one more.  ``slot``
    numbers the rows of a shard from 0 without gaps: rows are range-sorted by shard and a hash of key and text, pieces
    of ``per_range`` rows are counted, and each numbers its own rows from the sum of those before it, so no
    task holds a shard, whatever repeats.  Equal rows get adjacent slots in either order.  Null keys share one shard.
    The input is read once.  Input columns with these names are replaced, all others come back whatever their names; an
    empty input gives no rows.
    """
    wanted = [c for c in (docs.columns if columns is None else columns) if c.lower() not in RESULT]
    name = F.col(f"`{key}`")
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("_doc"),
        (F.length(body) + 8).cast("long").alias("size"),
        F.crc32(body).cast("long").alias("text_crc32"),
        jump_shard(name, n_shards).alias("_jump"),
        row_mix(name, F.col(f"`{text}`")).alias("_mix"),
        name.alias("_key"),
        F.monotonically_increasing_id().alias("_rid"),
    )
    base = cut_lineage(base)
    slim = base.select(F.col("_jump.shard").alias("shard"), "_mix", F.col("_key").isNotNull().alias("_named"), "_key", "text_crc32", "_rid")
    order = ["_mix", "_named", "_key", "text_crc32", "_rid"]
    ranged = in_ranges(slim, base.count(), per_range, "shard", *order)
    counts = ranged.groupBy("shard", "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy("shard").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    place = F.row_number().over(W.partitionBy("shard", "_range").orderBy(*order)) - 1
    placed = ranged.withColumn("_row", place).join(offsets, ["shard", "_range"])
    slots = placed.select("_rid", (F.col("_from") + F.col("_row")).cast("long").alias("slot"))
    own = [F.col(f"_doc.`{c}`") for c in wanted]
    return base.join(slots, "_rid").select(*own, "size", "text_crc32", F.lit("key").alias("law"), F.col("_jump.shard").alias("shard"), "slot", F.col("_jump.grown").alias("grown_shard"))
