"""Token attribution against a plain walk over tokens and characters."""

import random

import pytest
import tiktoken

from acreledger.llm.spans import field_tokens, span_tokens
from acreledger.llm.tokens import PATTERN, load_ranks, section_tokens

from .helpers import awkward, empty

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(VOCABULARY)


def owners(text, labels, rule, ranks):
    """Label of each token; ``labels`` has one per byte."""
    encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    at, found, crossing = 0, [], 0
    for piece in encoding.decode_tokens_bytes(encoding.encode_ordinary(text)):
        own = labels[at : at + len(piece)]
        at += len(piece)
        crossing += len(set(own)) > 1
        runs = {}
        for label in own:
            runs[label] = runs.get(label, 0) + 1
        found.append(own[0] if rule == "first" else own[-1] if rule == "last" else max(runs, key=runs.get))
    return found, crossing


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_lines_against_a_walk(spark, ranks, rule):
    docs = awkward(spark, clashes=False)
    for boundary in (b"\n", b"e", b". "):
        for r in section_tokens(docs, ranks, rule=rule, boundary=boundary).collect():
            raw, labels, section = (r["text"] or "").encode(), [], 0
            if len(raw) > 30_000:
                continue
            pieces = raw.split(boundary)
            for i, piece in enumerate(pieces):
                labels += [i] * (len(piece) + (len(boundary) if i < len(pieces) - 1 else 0))
            own, crossing = owners(r["text"] or "", labels, rule, ranks)
            n = (labels[-1] + 1) if labels else 0
            assert r["section_tokens"] == [own.count(i) for i in range(n)] and r["n_crossing"] == crossing


TEXTS = ["größer als 日本語 text, and more\nwords", "", None, "é🙂🙂 emoji 🙂", "plain words in a row " * 5, "   \n\n  x"]


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_spans_against_a_walk(spark, ranks, rule):
    rng, rows = random.Random(rule), []
    for i in range(60):
        text = TEXTS[i % len(TEXTS)]
        cuts = sorted(rng.sample(range(len(text or "") + 1), min(6, len(text or "") + 1)))
        spans = [(f"s{a}", a, b) for a, b in zip(cuts[::2], cuts[1::2])]
        rng.shuffle(spans)
        rows.append((i, text, spans, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<name: string, begin: int, end: int>>, n_tokens long")
    got = span_tokens(docs, ranks, "spans", rule=rule).collect()
    assert len(got) == len(rows)
    for r in got:
        text, spans = r["text"] or "", r["spans"]
        marks = [next((k for k, s in enumerate(spans) if s["begin"] <= c < s["end"]), f"gap{sum(s['end'] <= c for s in spans)}") for c in range(len(text))]
        labels = [m for c, m in zip(text, marks) for _ in c.encode()]
        own, crossing = owners(text, labels, rule, ranks)
        assert r["span_tokens"] == [own.count(k) for k in range(len(spans))]
        assert r["n_tokens"] == len(own) == sum(r["span_tokens"]) + r["n_outside"]
        if all(a["end"] != b["begin"] for a in spans for b in spans):
            assert r["n_crossing"] == crossing


def test_awkward_spans(spark, ranks):
    kind = "doc_id long, text string, spans array<struct<begin: long, end: long>>"
    rows = [(1, "one two", [(0, 99), (None, 3), (3, 1), (5, 5), None]), (2, "one two", None), (3, None, [(0, 4)]), (4, "one two", [(-5, 3), (3, 7)])]
    got = {r["doc_id"]: r for r in span_tokens(spark.createDataFrame(rows, kind), ranks, "spans").collect()}
    assert got[1]["span_tokens"] == [2, 0, 0, 0, 0] and got[1]["n_outside"] == 0
    assert got[2]["span_tokens"] == [] and got[2]["n_outside"] == 2
    assert got[3]["span_tokens"] == [0] and got[3]["n_tokens"] == 0
    assert got[4]["span_tokens"] == [1, 1]
    with pytest.raises(Exception, match="spans overlap"):
        span_tokens(spark.createDataFrame([(1, "one two", [(0, 4), (3, 7)])], kind), ranks, "spans").collect()
    assert span_tokens(spark.createDataFrame([], kind), ranks, "spans").count() == 0


def test_fields_are_encoded_as_one_text(spark, ranks):
    docs = spark.createDataFrame([(1, "A title", "Body, größer.", 7), (2, None, "Body", 7), (3, "", None, 7)], "doc_id long, title string, text string, spans int")
    encoding = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in field_tokens(docs, ranks, ["title", "text"]).collect():
        whole = f"{r['title'] or ''}\n\n{r['text'] or ''}"
        assert r["n_tokens"] == len(encoding.encode_ordinary(whole)) == sum(r["span_tokens"]) + r["n_outside"]
        assert r["spans"] == 7 and len(r["span_tokens"]) == 2
        assert (r["span_tokens"][1] > 0) == bool(r["text"])
    assert field_tokens(empty(spark), ranks, ["text"]).count() == 0


def test_a_very_long_text(spark, ranks):
    docs = spark.range(1).selectExpr("id AS doc_id", "repeat('Wörter und Zahlen 123, ', 400000) AS text").selectExpr(
        "*", "array(named_struct('begin', 0, 'end', 11), named_struct('begin', 11, 'end', char_length(text))) AS spans")
    r = span_tokens(docs, ranks, "spans").select("n_tokens", "span_tokens", "n_outside").first()
    assert r["n_outside"] == 0 and sum(r["span_tokens"]) == r["n_tokens"] > 1_000_000
