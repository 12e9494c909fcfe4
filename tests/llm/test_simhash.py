import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from acreledger.llm.components import components
from acreledger.llm.simhash import GrayTree, _placed, distinct_documents, hex_digits, near_duplicates, near_links, ranks_of, spanning_links

from .helpers import ROWS, awkward, empty, words


def fingerprint(text):
    w = [bytes(x).lower() for x in words(text)]
    parts = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] * bool(w)
    counts = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts)) if parts else 0


def groups(fps, most):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("most", [0, 2, 5])
def test_tree_connects_what_brute_force_connects(most):
    rng = random.Random(most)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(25)}
    fps = np.array(sorted(fps), dtype=np.uint64)
    fps = fps[np.argsort(ranks_of(fps))]
    label = np.arange(len(fps))
    nodes, roots = spanning_links(fps, fps, most)
    label[nodes] = roots
    assert label.tolist() == groups([int(x) for x in fps], most)


@pytest.mark.parametrize("most", [0, 2, 4])
def test_roots_of_shards_lose_no_pair(most):
    rng = np.random.default_rng(most)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1)
    fps = np.unique(np.concatenate([fps, *(fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps), dtype=np.uint64)) for _ in range(2))]))
    fps = fps[np.argsort(ranks_of(fps))]
    cuts = np.arange(0, len(fps), 100)
    low, high = np.bitwise_and.reduceat(fps, cuts), np.bitwise_or.reduceat(fps, cuts)
    found = {(int(q), int(k)) for qs, ks in GrayTree(low, high).leaves(fps, most) for q, k in zip(qs, ks)}
    near = np.bitwise_count((fps[:, None] ^ low) & ~(low ^ high)) <= most
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near))))


@pytest.mark.parametrize("per_shard", [1, 7, 20, 1000])
def test_links_across_shards(spark, per_shard):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(12)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    found = components(near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), per_shard=per_shard))
    star = {r["node"]: r["component"] for r in found.collect()}
    want = groups(fps, 2)
    got = [star.get(x, x) for x in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_awkward_rows_match_brute_force(spark):
    rows = near_duplicates(awkward(spark, clashes=True)).select("doc_id", hex_digits("fp"), "component_id").collect()
    fps = [fingerprint(r[1]) for r in ROWS]
    group = groups(fps, 2)
    least = {g: min((r[0] for r, h in zip(ROWS, group) if h == g and r[0] is not None), default=None) for g in group}
    want = [(r[0], f"{f:016x}", least[g]) for r, f, g in zip(ROWS, fps, group)]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert near_duplicates(empty(spark)).count() == 0


def test_shards_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    fps = [(rng.getrandbits(64) - (1 << 63),) for _ in range(5000)]
    classes = spark.createDataFrame(fps, "fp long").distinct()
    sizes = []
    for parts in (2, 31):
        placed = _placed(classes.repartition(parts), 500, 5000)
        sizes.append(sorted((r["shard"], r["count"]) for r in placed.groupBy("shard").count().collect()))
    assert [len(x) for x in sizes] == [10, 10] and all(400 < n < 600 for x in sizes for _, n in x)


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(3)
    base = [rng.choice("lorem ipsum dolor sit amet consectetur elit sed do eiusmod tempor".split()) + str(rng.randrange(90)) for _ in range(4000)]
    texts = [" ".join(base), " ".join(base[:2000] + ["changed"] + base[2001:]), " ".join(rng.choice("abc") + str(rng.randrange(10**6)) for _ in range(400))]
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(4, texts[0]), (4, texts[0]), (4, texts[2] + " more"), (None, texts[1])]
    group = groups([fingerprint(t) for _, t in rows], 2)
    first = {}
    for (k, t), g in zip(rows, group):
        first[g] = min(first.get(g, (True, 0, "")), (k is None, k or 0, t))
    want = sorted((None if none else k, t) for none, k, t in first.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("own")).withColumn("mark", F.lit(1)).withColumn("fp", F.lit(2))
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns and sorted(tuple(r)[:2] for r in kept.collect()) == want and len(want) < 4
    assert {tuple(r)[2:] for r in kept.collect()} == {("own", 1, 2)}
    kept = [tuple(r)[:2] for r in distinct_documents(awkward(spark)).collect()]
    # null, empty and blank texts are one group; copies under several keys another
    assert sorted(map(str, kept)) == sorted(map(str, [r[:2] for r in ROWS if r[0] in (1, 3, 6, 7, 8, 9) or (r[0] is None and r[1])]))
    assert distinct_documents(empty(spark)).count() == 0
