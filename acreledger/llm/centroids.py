"""Centroid clustering with progressive search in Walsh-Hadamard space.

The Walsh-Hadamard transform of whole numbers is whole, and squared distances between transforms are ``dim`` times those
between vectors.  Its coefficients, by number of sign changes, go from coarse to fine.  A search adds up squared
differences of coefficients in this order for all centroids; a sum only grows, so a centroid whose sum exceeds the
full distance of another is strictly worse and is left.  Those that remain are finished over all coefficients, and
the least distance, then the least number, wins: results are those of a full search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .vectors import usable, whole_numbers

#: Coefficients after which sums are compared.
STEPS = (2, 4, 8, 16, 32)
#: Vectors that are searched together.
CHUNK = 8192
#: Components below this keep all sums within 64 bits.
LARGEST = 1 << 24


def hadamard(dim: int) -> np.ndarray:
    """The Walsh-Hadamard matrix (``dim`` a power of two), rows by number of sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < dim:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def transform(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Coefficients of each row; exact, as whole numbers below 2**53 in doubles."""
    return (x.astype(np.float64) @ h.T.astype(np.float64)).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of each row, in coefficients, and the terms added up."""
    n, k = len(x), len(centroids)
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    total, begin, terms = np.zeros(n * k, dtype=np.int64), 0, 0
    bound = np.full(n, np.iinfo(np.int64).max)
    for end in [*(s for s in STEPS if s < x.shape[1]), x.shape[1]]:
        total += np.square(x[row, begin:end] - centroids[number, begin:end]).sum(axis=1)
        terms += len(row) * (end - begin)
        if end < x.shape[1]:
            # the full distance of the most promising centroid bounds the others
            order = np.lexsort((number, total, row))
            head = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            rest = np.square(x[row[head], end:] - centroids[number[head], end:]).sum(axis=1)
            bound[row[head]] = np.minimum(bound[row[head]], total[head] + rest)
            left = total <= bound[row]
            row, number, total = row[left], number[left], total[left]
        begin = end
    order = np.lexsort((number, total, row))
    head = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return number[head], total[head], terms


def _coefficients(rows: DataFrame, dim: int) -> DataFrame:
    """``key, coefs``: the transform as bytes of 64-bit numbers."""
    h = hadamard(dim)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
            coefs = transform(x, h).tobytes()
            width = 8 * dim
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([coefs[i : i + width] for i in range(0, len(coefs), width)], pa.binary())], ["key", "coefs"])

    return rows.mapInArrow(task, "key long, coefs binary")


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(len(column), dim)


def _sums(coefs: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of coefficients of each centroid's vectors: a row per task and centroid, added up by Spark."""
    k, dim = centroids.shape

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                x = _unpacked(batch.column(0).slice(at, CHUNK), dim)
                number, _, _ = nearest(x, centroids)
                count += np.bincount(number, minlength=k)
                for c in range(k):
                    total[c] += x[number == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    found = coefs.select("coefs").mapInArrow(task, "cluster long, n long, total array<long>")
    rows = found.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]).collect()
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(dim)]) for r in rows}


def cluster_vectors(
    df: DataFrame, key: str = "vec_id", vec: str = "embedding", factor: int = 1024, dim: int = 64, clusters: int = 8, rounds: int = 10, seed: str = "3:"
) -> tuple[DataFrame, list[list[int]]]:
    """``key, cluster, distance`` per vector, and the final centroids.

    Vectors of exactly ``dim`` components (a power of two), none null or non-finite, take part as ``floor(factor * x)``.
    Centroids start as the vectors whose SHA-256 of ``seed`` and key is smallest (equal keys: by components; a
    null key never), as many as there are up to ``clusters``.  Each round assigns all vectors to the nearest centroid (ties:
    the smaller number) and moves it to the floor of their mean; a centroid without vectors stays.  Distances are squared.
    Only centroids, ``clusters`` times ``dim`` numbers, pass through the driver.  Equal rows are rows of
    their own; other input columns do not matter; an empty input gives no rows.
    """
    vector = F.col(f"`{vec}`").cast("array<double>")
    rows = df.where(usable(vector) & (F.size(vector) == dim)).select(F.col(f"`{key}`").cast("long").alias("key"), whole_numbers(vector, factor).alias("comps"))
    first = rows.where("key IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256))
    centroids = [list(r["comps"]) for r in first.orderBy("h", "comps").limit(clusters).collect()]
    if not centroids:
        # keys are all null, or there are no rows: the smallest vectors begin
        centroids = [list(r["comps"]) for r in rows.orderBy("comps").limit(clusters).collect()]
    too_large = rows.where(F.exists("comps", lambda x: (x >= LARGEST) | (x <= -LARGEST)))
    if not too_large.isEmpty():
        raise ValueError(f"components of {LARGEST} or more")
    h = hadamard(dim)
    coefs = cut_lineage(_coefficients(rows, dim))
    shape = (len(centroids), dim)
    for _ in range(rounds if centroids else 0):
        for number, (n, sums) in _sums(coefs, transform(np.array(centroids, dtype=np.int64), h)).items():
            # back from coefficients: the matrix times its transpose is dim
            centroids[number] = [sum(int(s) * f for s, f in zip(h[:, i].tolist(), sums, strict=True)) // dim // n for i in range(dim)]
    final = transform(np.array(centroids, dtype=np.int64).reshape(shape), h)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                number, distance, _ = nearest(_unpacked(part.column(1), dim), final)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number.astype(np.int32)), pa.array(distance // dim)], ["key", "cluster", "distance"])

    return coefs.mapInArrow(task, "key long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the sums of distances over its cluster and over all, and the centroid's hash.

    The table of clusters has a row per centroid, so it is broadcast.
    """
    assigned = cut_lineage(assigned)
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    listed = [(i, sums.get(i, 0), sum(sums.values()), d) for i, d in enumerate(digest)]
    clusters = assigned.sparkSession.createDataFrame(listed, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster")
