from collections import Counter, defaultdict

import pytest

from acreledger.llm.mixing import mix_sources, mixed_documents
from acreledger.llm.shards import assign_shards, jump_shard

from .helpers import ROWS, awkward, empty, words


def test_targets_are_met_and_nothing_is_lost(spark):
    rows = [(i, "w " * (1 + i % 17), "en", "abc"[i % 3] if i % 5 else "big") for i in range(3000)]
    mixed = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), per_range=50).collect()
    total = sum(len(words(r[1])) for r in rows)
    by = defaultdict(int)
    for r in mixed:
        by[r["source"]] += r["taken"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    assert len(mixed) == len(rows) and total - 17 < sum(by.values()) <= total
    targets = {r["source"]: r["target"] for r in mixed}
    assert sum(targets.values()) == pytest.approx(total)
    assert all(abs(by[s] - t) <= 2 * 17 for s, t in targets.items())


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(1, "a " * 10, "en", "a"), (2, "a " * 100, "en", "b"), (3, "a " * 1000, "en", "c")]
    mixed = {r["source"]: r["target"] for r in mix_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert mixed == {"a": 30.0, "b": 300.0, "c": 780.0}


def test_mix_of_awkward_rows(spark):
    mixed = mix_sources(awkward(spark, clashes=True)).collect()
    assert Counter(map(str, [(r["doc_id"], r["size"]) for r in mixed])) == Counter(map(str, [(r[0], len(words(r[1]))) for r in ROWS]))
    again = mix_sources(awkward(spark).repartition(5)).collect()
    key = lambda x: sorted(map(str, [(r["doc_id"], r["size"], r["taken"], r["target"]) for r in x]))
    assert key(mixed) == key(again)
    docs = awkward(spark, clashes=True)
    rows = mixed_documents(docs)
    assert rows.columns == docs.columns and set(r["copies"] for r in rows.collect()) == {"own"}
    assert mix_sources(empty(spark)).count() == 0 and mixed_documents(empty(spark)).count() == 0
    blank = awkward(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert [r["taken"] for r in mix_sources(blank).collect()] == [0, 0]


def plain_mix(rows, weights=(1, 2, 3), epochs=3):
    """Taken words by (doc_id, text) of all sources, pass by pass in the order of finish times."""
    import hashlib

    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    listed = sorted((s is None, s or "", int(md5(("" if k is None else str(k)) + ":" + ("" if t is None else md5(t)))[:12], 16), "" if k is None else str(k), len(words(t))) for k, t, _, s in rows)
    sizes = defaultdict(int)
    for r in listed:
        sizes[r[:2]] += r[4]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes))}
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    while open_:  # those whose share is too much for them are cut, one after the other
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        s = min(open_, key=lambda s: (epochs * sizes[s] / weight[s], s))
        if epochs * sizes[s] >= share * weight[s]:
            target.update({s: share * weight[s] for s in open_})
            break
        target[s] = float(epochs * sizes[s])
        open_.remove(s)
    upto, turns = defaultdict(int), []
    for i, r in enumerate(listed):
        upto[r[:2]] += r[4]
        turns += [((sizes[r[:2]] * e + upto[r[:2]]) / target[r[:2]] if target[r[:2]] else 0.0, *r[:2], e, *r[2:4], i) for e in range(epochs)]
    taken, used = defaultdict(int), 0
    for t in sorted(turns):
        used += listed[t[-1]][4]
        if used > total:
            break
        taken[t[-1]] += 1
    return Counter((r[3], r[4], r[4] * taken[i]) for i, r in enumerate(listed))


@pytest.mark.parametrize("per_range", [3, 40, 10_000])
def test_mix_equals_plain_queueing(spark, per_range):
    rows = [*ROWS[:-2], *((i, f"w{i} " * (i % 23), "en", "abcd"[i % 7 % 4]) for i in range(100, 400))]
    rows += [(500, "the same row", "en", "a")] * 150  # one key and text, a third of all rows
    docs = awkward(spark, rows, clashes=True)
    for name in ("_n", "_from", "_rid", "_src", "_doc", "_null", "epoch", "time"):
        docs = docs.selectExpr("*", f"'own' AS `{name}`")
    found = mix_sources(docs.repartition(7), per_range=per_range)
    assert {r["_from"] for r in found.select("_from").collect()} == {"own"}
    assert Counter(("" if r["doc_id"] is None else str(r["doc_id"]), r["size"], r["taken"]) for r in found.collect()) == plain_mix(rows)
    again = mixed_documents(docs, per_range=per_range)
    assert again.columns == docs.columns
    assert again.count() == sum(r["copies"] for r in found.collect())


def chain(spark, n):
    from pyspark.sql import functions as F

    rows = spark.range(4000).select("id", jump_shard(F.col("id"), n).alias("x"))
    return {r["id"]: (r["x"]["shard"], r["x"]["grown"]) for r in rows.collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for n in (1, 7, 24, 90):
        now, later = chain(spark, n), chain(spark, n + 1)
        assert all(0 <= s < n and g in (s, n) for s, g in now.values())
        assert {k: g for k, (_, g) in now.items()} == {k: s for k, (s, _) in later.items()}
        moved = sum(s != g for s, g in now.values())
        assert abs(moved - 4000 / (n + 1)) < 5 * (4000 / (n + 1)) ** 0.5
        sizes = Counter(s for s, _ in now.values())
        assert len(sizes) == n and max(sizes.values()) < 4000 / n + 6 * (4000 / n) ** 0.5


def test_slots_have_no_gaps(spark):
    import zlib

    rows = [*ROWS, *[(1, "a row like others", "en", "a")] * 40]
    docs = awkward(spark, rows, clashes=True)
    for name in ("_s", "_doc", "_rid", "_range", "_mix", "_key"):
        docs = docs.selectExpr("*", f"'own' AS `{name}`")
    placed = assign_shards(docs.repartition(5), 3, per_range=4)
    assert {r["_s"] for r in placed.select("_s").collect()} == {"own"} and set(docs.columns) <= set(placed.columns)
    placed = placed.collect()
    assert Counter(map(str, [(r["doc_id"], r["size"], r["text_crc32"]) for r in placed])) == Counter(
        map(str, [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows])
    )
    by = defaultdict(list)
    for r in placed:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    shard = defaultdict(set)
    for r in placed:
        shard[r["doc_id"]].add((r["shard"], r["grown_shard"]))
    assert all(len(x) == 1 for x in shard.values())
    assert assign_shards(empty(spark), 3).count() == 0
