"""Search, hard negatives and clustering of vectors against plain loops over all pairs."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreledger.llm.centroids import cluster_vectors, hadamard, nearest, transform, with_inertia
from acreledger.llm.negatives import Scores, hard_negatives, primes_for, residues, signed
from acreledger.llm.topk import ImpactIndex, top_k
from acreledger.llm.vectors import first_k

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHES = "rid key dim comps asks block part rank score anchor a s wanted h cluster n total coefs other".split()


def rows(count=300, dim=8, seed=1):
    """Vectors on a coarse grid (many ties), copies of one vector and of whole rows, and rows that take no part."""
    rng = np.random.default_rng(seed)
    made = [(i, (rng.integers(-6, 7, dim) / 16).tolist(), int(i % 4)) for i in range(count)]
    made += [(1000 + i, made[0][1], 0) for i in range(60)]
    made += [made[50], made[50], made[100], made[100], (None, made[3][1], 1), (None, made[3][1], 2), (1400, made[7][1], None)]
    made += [(2000, None, 1), (2050, [0.5] * (dim - 1) + [None], 1), (2100, [0.5] * (dim - 1) + [float("nan")], 1), (2150, [float("inf")] * dim, 1)]
    return made + [(2200, [0.25] * (dim + 1), 1), (2201, [0.25] * (dim + 1), 2), (2202, [0.125] * (dim + 1), 1), (2300, [], 1), (2350, [], 1)]


def usable(made, factor):
    fine = [r for r in made if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    return [(k, [math.floor(factor * float(np.float32(x))) for x in v], label) for k, v, label in fine]


def last(key):
    return (key is None, key or 0)


def plain_top(made, step, k=5):
    fine, out = usable(made, 256), []
    for i, (key, v, _) in enumerate(fine):
        if key is not None and key % step == 0:
            found = [(-sum(x * y for x, y in zip(v, w, strict=True)), last(other), other) for j, (other, w, _) in enumerate(fine) if j != i and len(w) == len(v)]
            out += [(key, rank, other, -score) for rank, (score, _, other) in enumerate(sorted(found, key=lambda t: t[:2])[:k], 1)]
    return sorted(out, key=str)


def frame(spark, made, schema=SCHEMA, clashes=False):
    df = spark.createDataFrame(made, schema)
    for name in CLASHES if clashes else ():
        df = df.withColumn(name, F.lit("own"))
    return df


@pytest.mark.parametrize("sizes", [(8192, 16384), (50, 3)])
def test_top_k_equals_all_pairs(spark, sizes):
    made = rows()
    found = top_k(frame(spark, made, clashes=True), F.expr("vec_id % 50 = 0"), block=sizes[0], part=sizes[1])
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_top(made, 50)


def test_index_stops_on_proof_and_is_exact():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32))
    data = np.floor(64 * (centres[rng.integers(0, 40, 4000)] + 0.15 * rng.normal(size=(4000, 32)))).astype(np.int32)
    index, total = ImpactIndex(data), 0
    for q in range(60):
        places, scores, used = index.search(data[q], 5, q)
        exact = data.astype(np.int64) @ data[q].astype(np.int64)
        exact[q] = exact.min() - 1
        assert places.tolist() == np.lexsort((np.arange(4000), -exact))[:5].tolist()
        assert scores.tolist() == exact[places].tolist()
        total += used
    assert total < 0.95 * 60 * data.size  # some postings are never looked at


def test_equal_scores_and_few_rows(spark):
    same = [(i, [0.5, -0.25], 0) for i in range(0, 200, 10)]
    found = {(r["query_id"], r["rank"]): r["vec_id"] for r in top_k(frame(spark, same), F.expr("vec_id % 50 = 0")).collect()}
    assert [found[(50, k)] for k in range(1, 6)] == [0, 10, 20, 30, 40]
    assert top_k(frame(spark, same[:1]), F.expr("vec_id % 50 = 0")).count() == 0
    few = top_k(frame(spark, same[:3]), F.expr("vec_id % 50 = 0"))
    assert [tuple(r)[:3] for r in few.orderBy("rank").collect()] == [(0, 1, 10), (0, 2, 20)]
    assert first_k(np.array([1, 3, 3, 2]), 3).tolist() == [1, 2, 3]


def plain_negatives(made):
    fine, out = [r for r in usable(made, 256) if r[2] is not None and r[1]], []
    fine = [(k, v, (label + 1) % 10 if k is not None and k % 7 == 0 else label) for k, v, label in fine]
    for i, (key, v, label) in enumerate(fine):
        if key is None or key % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), last(other), other, l) for j, (other, w, l) in enumerate(fine) if j != i and len(w) == len(v)]
        scored.sort(key=lambda t: t[:2])
        for p in [t for t in scored if t[3] == label][:5]:
            fit = [t for t in scored if t[3] != label and 30 * -p[0] <= 100 * -t[0] <= 90 * -p[0]]
            out += [(key, p[2], rank, t[2], -p[0], -t[0]) for rank, t in enumerate(fit[:10], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(8192, 16384), (50, 2)])
def test_hard_negatives_equal_all_pairs(spark, sizes):
    made = rows(seed=2)
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    found = hard_negatives(frame(spark, made, clashes=True), F.expr("vec_id % 100 = 0"), label=label, block=sizes[0], part=sizes[1])
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_negatives(made)


@pytest.mark.parametrize("dim, most", [(1, 3), (64, 200), (100, 1 << 18), (300, 1 << 19)])
def test_residues_give_exact_signed_scores(dim, most):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-most, most + 1, (30, dim)), rng.integers(-most, most + 1, (40, dim))
    a[0], b[0], b[1] = most, most, -most
    primes = primes_for(most, dim)
    assert all((p // 2) ** 2 * min(dim, 64) < 1 << 24 for p in primes) and math.prod(primes) > 2 * dim * most**2
    assert (Scores(b, most).of(a) == a @ b.T).all()
    numbers = np.array([0, 1, -1, 12345, -12345])
    assert signed([numbers % 1021, numbers % 1019], [1021, 1019]).tolist() == numbers.tolist()
    assert np.abs(residues(np.arange(-2000, 2000), 1021)).max() == 510


def plain_clusters(made, dim, clusters=8, rounds=10):
    fine = [(k, v) for k, v, _ in usable(made, 1024) if len(v) == dim]
    seeds = sorted((hashlib.sha256(f"3:{k}".encode()).hexdigest(), v) for k, v in fine if k is not None)
    centroids = [v for _, v in seeds[:clusters]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in fine]

    for _ in range(rounds):
        placed = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(fine, placed, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    placed = assign()
    inertia = [sum(d for d, c in placed if c == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((k, c, d, inertia[c], sum(inertia), digest[c]) for (k, _), (d, c) in zip(fine, placed, strict=True)), key=str)


@pytest.mark.parametrize("count", [300, 5])
def test_clusters_equal_full_search(spark, count):
    made = rows(count=101 if count < 10 else count, seed=5)
    made = made[:count] if count < 10 else made
    assigned, centroids = cluster_vectors(frame(spark, made, clashes=True), dim=8)
    found = with_inertia(assigned, centroids).select("key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_clusters(made, 8)


def test_progressive_search_leaves_worse_centroids():
    rng = np.random.default_rng(9)
    h = hadamard(64)
    assert (h @ h.T == 64 * np.eye(64)).all() and (np.diff(h, axis=1) != 0).sum(axis=1).tolist() == list(range(64))
    x = np.cumsum(rng.integers(-9, 10, (500, 64)), axis=1)
    c = np.vstack([x[:6], x[0] + 1, x[0]])
    number, distance, terms = nearest(transform(x, h), transform(c, h))
    full = ((x[:, None] - c) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == 64 * full.min(axis=1)).all()
    assert number[0] == 0 and terms < 0.5 * 500 * 8 * 64


def test_empty_tables_and_large_components(spark):
    nothing = frame(spark, [])
    assert top_k(nothing, F.expr("vec_id % 50 = 0")).count() == 0
    assert hard_negatives(nothing, F.expr("vec_id % 100 = 0")).count() == 0
    assigned, centroids = cluster_vectors(nothing)
    assert with_inertia(assigned, centroids).count() == 0
    unlabelled = frame(spark, [(100, [1.0], None), (None, [1.0], 1), (200, None, None)])
    assert hard_negatives(unlabelled, F.expr("vec_id % 100 = 0")).count() == 0
    unnamed = frame(spark, [(None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)])
    assigned, centroids = cluster_vectors(unnamed, dim=2)
    assert with_inertia(assigned, centroids).count() == 2
    huge = frame(spark, [(100, [1e30, 1.0], 1)])
    for call in (lambda: top_k(huge, F.lit(True)), lambda: hard_negatives(huge, F.lit(True)), lambda: cluster_vectors(huge, dim=2)):
        with pytest.raises(ValueError, match="components"):
            call()
