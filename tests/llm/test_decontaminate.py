import re

from acreledger.llm.decontaminate import contamination, find_phrases

from .helpers import ROWS, awkward, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
ITEMS = [
    (10, "cat sat on the mat and looked at the moon for a long while before it"),
    (11, "Größe FÜR"),
    (12, "word word word"),
    (13, None),
    (14, ""),
    (15, "and looked at the moon for a long while before it slept again today"),
    (None, "nothing in particular"),
    (16, "?!"),
]


def brute(rows, items, size=13):
    split = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for k, t in items:
        w = split(t)
        for i in range(max(1, len(w) - size + 1)):
            if w:
                windows.setdefault(tuple(w[i : i + size]), set()).add("" if k is None else str(k))
    out = []
    for k, t in rows:
        w = split(t)
        hit, names = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        out.append((k, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(docs, items, **options):
    found = contamination(docs, items, **options).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted((tuple(r) for r in found), key=str)


def test_matches_brute_force_in_one_block_and_in_many(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute([r[:2] for r in ROWS], ITEMS)
    assert result(awkward(spark, clashes=True), items) == want
    assert result(awkward(spark), items, block_bytes=40) == want


def test_spans_are_bytes_of_the_text(spark):
    items = spark.createDataFrame([(1, "für öffentliche straßen")], "item_id long, text string")
    rows = [(1, "Größe für, Öffentliche für öffentliche! Straßen")]
    found = find_phrases(spark.createDataFrame(rows, "doc_id long, text string"), items).first()
    cut = [rows[0][1].encode()[s["begin"] : s["end"]].decode() for s in found["byte_spans"]]
    assert cut == ["für öffentliche! Straßen"]


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(empty(spark), items) == []
    none = result(awkward(spark), items.limit(0))
    assert len(none) == len(ROWS) and not any(r[2] or r[3] or r[4] for r in none)
