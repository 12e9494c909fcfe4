"""Hard negatives by exact scores from residue number systems.

Scores are inner products of whole-number vectors.  Components are reduced modulo several small primes to residues around
zero, so small that a product of two residue matrices in float32 has no rounding; float32 products are the fastest that
hardware has.  The residues of a score modulo all primes give the signed score by Chinese remaindering, exact
as long as the primes' product exceeds twice the largest possible score: the number of primes follows from the
data's largest component.
"""

from __future__ import annotations

from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .vectors import BLOCK, PART, first_k, in_blocks, keys_of, matrix, nullable, prepared, ranked

#: Whole numbers up to this are exact in float32.
FLOAT32 = 1 << 24
#: Components that are multiplied at once, and anchors whose scores are in memory together.
STRIPE, CHUNK = 64, 256


def primes_for(most: int, dim: int) -> list[int]:
    """The largest primes whose residue products over a stripe are exact, as many as scores need."""
    top = 2 * int((FLOAT32 / max(1, min(dim, STRIPE))) ** 0.5) + 1
    found, p = [], top - 1 + top % 2
    while prod(found) <= 2 * dim * most * most:
        p -= 2
        if all(p % d for d in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
    return found


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues from -(p-1)/2 to (p-1)/2."""
    half = (p - 1) // 2
    return ((x.astype(np.int64) + half) % p - half).astype(np.float32)


def residue_products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> list[np.ndarray]:
    """``a @ b.T`` modulo each prime, in stripes of components, from 0 to p-1."""
    products = []
    for x, y, p in zip(a, b, primes, strict=True):
        total = np.zeros((len(x), len(y)), dtype=np.int64)
        for at in range(0, x.shape[1], STRIPE):
            total += (x[:, at : at + STRIPE] @ y[:, at : at + STRIPE].T).astype(np.int64)
        products.append(total % p)
    return products


def signed(remainders: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The numbers of least size with these remainders, digit by digit in the mixed radix of the primes."""
    value, radix = remainders[0].copy(), primes[0]
    for r, p in zip(remainders[1:], primes[1:], strict=True):
        value += radix * ((r - value) % p * pow(radix, -1, p) % p)
        radix *= p
    return np.where(value > radix // 2, value - radix, value)


class Scores:
    """Exact scores of anchors against the rows of a block."""

    def __init__(self, rows: np.ndarray, most: int):
        self.primes = primes_for(most, rows.shape[1]) or [3]
        self.rows = [residues(rows, p) for p in self.primes]

    def of(self, anchors: np.ndarray) -> np.ndarray:
        return signed(residue_products([residues(anchors, p) for p in self.primes], self.rows, self.primes), self.primes)


def _scored(rows: pa.Table, anchors: pa.Table, most: int):
    """Anchors' places in their table with the block's labels, keys, row ids, and their scores, by smallest key first."""
    dim = anchors["dim"][0].as_py()
    keys, rids = keys_of(rows), rows["rid"].to_numpy()
    order = np.lexsort((rids, keys))
    table, asked = matrix(rows, dim)[order], matrix(anchors, dim)
    scores = Scores(table, most)
    labels = rows["label"].to_numpy()[order]
    for at in range(0, len(asked), CHUNK):
        for i, row in enumerate(scores.of(asked[at : at + CHUNK])):
            yield at + i, row, labels, keys[order], rids[order]


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vec: str = "embedding",
    label: Column | None = None,
    factor: int = 256,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are the ``positives`` other rows of its label with the highest score (inner product of
    ``floor(factor * x)``).  For each of them, the negatives are the ``negatives`` rows of other labels with the highest
    score from ``window[0]`` to ``window[1]`` per cent of the positive's.  Ties go to the smaller key, a null key is last.
    Rows with a null label, a null vector, or a null or non-finite component take no part; vectors of different lengths
    have no score.  Equal rows are rows of their own, so a copy of the anchor can be its positive.  A positive without
    negatives gives no row.  Other input columns do not matter.  An empty input gives no rows.
    """
    label = F.col("label") if label is None else label
    rows, most = prepared(df, key, vec, factor, label=label.cast("long"), asks=F.coalesce(is_anchor, F.lit(False)))
    rows = rows.where("label IS NOT NULL AND dim > 0")
    anchors, rows = rows.where("asks").drop("asks"), rows.drop("asks")
    low, high = window

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            own, mine = right["rid"].to_numpy(), right["label"].to_numpy()
            for i, scores, labels, keys, rids in _scored(left, right, most):
                fit = np.flatnonzero((labels == mine[i]) & (rids != own[i]))
                best = fit[first_k(scores[fit], positives)]
                found.append((np.full(len(best), own[i]), keys[best], scores[best], rids[best]))
        arid, keys, scores, rids = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4))
        return pa.table([pa.array(arid), nullable(keys), pa.array(scores), pa.array(rids)], names=["anchor", "positive_id", "positive_score", "positive"])

    pairs = in_blocks(rows, anchors, nearest, "anchor long, positive_id long, positive_score long, positive long", block, part)
    chosen = cut_lineage(ranked(pairs, ["anchor"], "positive_score", "positive_id", positives).drop("rank"))
    scores = chosen.groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("wanted"))
    asking = anchors.join(scores, F.col("rid") == F.col("anchor")).drop("anchor")

    def below(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            own, mine, wanted = right["rid"].to_numpy(), right["label"].to_numpy(), right["wanted"].to_pylist()
            for i, scores, labels, keys, _ in _scored(left, right, most):
                other = np.flatnonzero(labels != mine[i])
                ranged = 100 * scores[other]
                for score in wanted[i]:
                    fit = other[(ranged >= low * score) & (ranged <= high * score)]
                    best = fit[first_k(scores[fit], negatives)]
                    found.append((np.full(len(best), own[i]), np.full(len(best), score), keys[best], scores[best]))
        arid, wanted, keys, scores = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4))
        return pa.table([pa.array(arid), pa.array(wanted), nullable(keys), pa.array(scores)], names=["a", "s", "negative_id", "negative_score"])

    found = in_blocks(rows, asking, below, "a long, s long, negative_id long, negative_score long", block, part)
    best = ranked(found, ["a", "s"], "negative_score", "negative_id", negatives)
    named = chosen.join(anchors.select(F.col("rid").alias("anchor"), F.col("key").alias("anchor_id")), "anchor")
    joined = named.join(best, (F.col("anchor") == F.col("a")) & (F.col("positive_score") == F.col("s")))
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
