"""Whole-number vectors for the search operators, and pairs of row blocks and query blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

#: Scores stay below this: sums in doubles and products of primes beyond it are exact whole numbers.
EXACT = 1 << 48
#: A null key comes after all others.
NO_KEY = np.iinfo(np.int64).max
#: Rows of a block, and queries that meet it at once.
BLOCK, PART = 8192, 16384


def usable(vec: Column) -> Column:
    """Neither null itself nor holding a component that is null, infinite or not a number."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & fine, F.lit(False))


def whole_numbers(vec: Column, factor: int) -> Column:
    """``floor(factor * x)`` of each component, taken in doubles."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * float(factor)))


def prepared(df: DataFrame, key: str, vec: str, factor: int, **more: Column) -> tuple[DataFrame, int]:
    """``rid, key, dim, comps`` and columns of one's own for each usable row, and the largest size of a component.

    ``rid`` tells rows apart that are equal in all columns; it is fixed by the checkpoint.  Scores of the
    vectors must stay below 2**48.
    """
    vector = F.col(f"`{vec}`").cast("array<double>")
    own = [column.alias(name) for name, column in more.items()]
    rows = df.where(usable(vector)).select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").cast("long").alias("key"), F.size(vector).alias("dim"), whole_numbers(vector, factor).alias("comps"), *own
    )
    rows = cut_lineage(rows)
    top, bottom, dim = rows.agg(F.max(F.array_max("comps")), F.min(F.array_min("comps")), F.max("dim")).first()
    most = max(abs(top or 0), abs(bottom or 0))
    if (dim or 0) * most * most >= EXACT:
        raise ValueError("components too large: scores would reach 2**48")
    return rows.withColumn("comps", F.col("comps").cast("array<int>")), most


def matrix(table: pa.Table, dim: int, column: str = "comps") -> np.ndarray:
    """The vectors of a table's rows, all of ``dim`` components."""
    return table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)


def keys_of(table: pa.Table, column: str = "key") -> np.ndarray:
    return table[column].combine_chunks().fill_null(NO_KEY).to_numpy(zero_copy_only=False)


def nullable(keys: np.ndarray) -> pa.Array:
    return pa.array(keys, mask=keys == NO_KEY)


def first_k(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, highest first, equal ones in order of place."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")][:k]


def in_blocks(rows: DataFrame, queries: DataFrame, task: Callable[[pa.Table, pa.Table], pa.Table], schema: str, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``task(block of rows, part of the queries)`` for each pair of them with vectors of one length.

    Both have columns ``rid, dim``.  Every row meets every query in exactly one task, and no task holds more
    than about ``block`` rows and ``part`` queries, whatever keys or vectors repeat.
    """
    blocks, parts = max(1, -(-rows.count() // block)), max(1, -(-queries.count() // part))
    number = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    on = ["dim", "block", "part"]
    left = rows.withColumn("block", number(blocks)).withColumn("part", every(parts)).repartition(2 * blocks * parts, *on)
    queries = queries.toDF(*queries.columns)  # columns of its own, as both may come from one table
    right = queries.withColumn("part", number(parts)).withColumn("block", every(blocks)).repartition(2 * blocks * parts, *on)
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(task, schema)


def ranked(found: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    """The ``k`` highest of each group with ``rank`` from 1; ties by smaller key, a null key last."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(key)))
    return found.withColumn("rank", place).where(F.col("rank") <= k)
