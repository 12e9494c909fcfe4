import hashlib
import random

import numpy as np
import pytest

from acreledger.llm import repeats
from acreledger.llm.suffixes import suffix_array

from .helpers import ROWS, awkward, empty


def brute(rows, length):
    none = 1 << 63
    low = {}
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            low[w] = min(low.get(w, none), none if k is None else k)
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if low[b[i : i + length]] < (none if k is None else k):
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((k, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, folder, length):
    found = repeats.remove_repeats(df, f"file://{folder}", length=length)
    return sorted((tuple(r) for r in found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("length", [20, 50])
def test_matches_brute_force(spark, tmp_path, monkeypatch, length):
    rng = random.Random(length)
    vocabulary = ["aa", "b", "ccc", "the", "é", "zz"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 70)))) for i in range(120)]
    rows += [(500, "a" * 3000), (501, "a" * 200), (502, "a" * 51), (503, "a" * 49), (504, None), (None, "a" * 60), (500, "q" * 60), (501, "q" * 60)]
    monkeypatch.setattr(repeats, "STRETCH", 700)  # several stretches a block
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), tmp_path, length) == brute(rows, length)


def test_awkward_and_empty_rows(spark, tmp_path):
    assert result(awkward(spark), tmp_path, 50) == brute([r[:2] for r in ROWS], 50)
    assert result(empty(spark), tmp_path, 50) == []


@pytest.mark.parametrize("parts", [1, 2, 5, 13])
@pytest.mark.parametrize("texts", [["short text"] * 8, [None] * 5, ["", "x" * 49, None, " "], ["x" * 49, "y" * 50, "y" * 50, "z"], []])
def test_blocks_without_passages(spark, tmp_path, texts, parts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert result(docs, tmp_path, 50) == brute(rows, 50)


def test_text_that_is_kept(spark, tmp_path):
    passage = "".join(chr(97 + i % 26) + str(i) for i in range(40))
    rows = [(1, "start " + passage), (2, passage + " end"), (3, "x" + passage)]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}", with_text=True)
    assert {r["doc_id"]: bytes(r["kept"]).decode() for r in found.collect()} == {1: rows[0][1], 2: " end", 3: "x"}


def shard_of(rows, length):
    """Distinct segments of the texts with their smallest row, their anchors' places and the smallest row of each passage."""
    data, bounds = np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum([0] + [len(r) for r in rows])
    first, count, _, place = repeats.segments(data, bounds, length)
    low, anchors, passages = {}, {}, {}
    for f, n, p in zip(first.tolist(), count.tolist(), place.tolist()):
        row, t = int(np.searchsorted(bounds, f, side="right")) - 1, data[f : f + n + length - 1].tobytes()
        low[t], anchors[t] = min(low.get(t, row), row), p - f
    for t, row in low.items():
        for i in range(len(t) - length + 1):
            passages[t[i : i + length]] = min(passages.get(t[i : i + length], row), row)
    want = [passages[t[i : i + length]] for t in low for i in range(len(t) - length + 1)]
    return list(low), np.array(list(low.values())), np.array(list(anchors.values())), want


@pytest.mark.parametrize("parts", [1, 2, 3, 4, 40])
@pytest.mark.parametrize("length", [17, 18, 21, 50])
def test_minima_of_a_shard(monkeypatch, length, parts):
    rng = random.Random(length + parts)
    words = [b"aa", b"b", b"ccc", b"the ", b"zz"]
    rows = [b"".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows += [rows[7][9:] + rows[3], rows[3], b"a" * 200, b"x" + b"a" * 120, b"ab" * 60]
    for stretch in (1 << 20, 300):
        monkeypatch.setattr(repeats, "STRETCH", stretch)
        monkeypatch.setattr(repeats, "PARTS", parts)
        texts, low, place, want = shard_of(rows, length)
        assert repeats.passage_minima(texts, low, place, length).tolist() == want


def test_only_passages_that_may_repeat_are_sorted(monkeypatch):
    rng = random.Random(2)
    letters = lambda n: bytes(rng.choice(b"abcdefghij") for _ in range(n))
    common, passage = letters(16), letters(90)
    rows = [letters(40) + common + letters(40) for _ in range(300)] + [letters(30) + passage, passage + letters(30)]
    sorted_bytes = []
    monkeypatch.setattr(repeats, "suffix_array", lambda data: sorted_bytes.append(len(data)) or suffix_array(data))
    texts, low, place, want = shard_of(rows, 50)
    assert repeats.passage_minima(texts, low, place, 50).tolist() == want
    assert sum(map(len, texts)) > 40_000
    assert sum(sorted_bytes) < 2_000  # a shared piece of 16 bytes is no passage yet
