import base64
import gzip
import hashlib
import zlib

import numpy as np
import pytest

from acreledger.llm.tokens import attribute, load_ranks, section_tokens
from acreledger.llm.warc import normalise, normalise_file, read_index, read_records, record, remove, roundtrip

from .helpers import ROWS, awkward, empty

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://a/3\r\nX: y", None),
    (4, "http://a/4", ""),
    (5, "http://a/ü", "<p>größer</p>"),
    (None, "http://a/n", "<p>größer</p>"),
    (6, "http://a/6", "z" * 3_000_000),
    (7, "http://a/7", "twice"),
    (7, "http://a/7", "twice"),
    (-8, "http://a/8", "WARC/1.0\r\n\r\nContent-Length: 5\r\n\r\n"),
]


def test_round_trip_of_awkward_pages(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS type", "2 AS id").repartition(3)
    got = roundtrip(spark, pages, f"file://{tmp_path}").collect()
    largest = {}
    for k, _, h in PAGES:
        largest[h or ""] = max(largest.get(h or "", -100), -100 if k is None else k)
    want = []
    for k, _, h in PAGES:
        raw = (h or "").encode()
        first = largest[h or ""]
        to = None if k == first or list(x[2] or "" for x in PAGES).count(h or "") == 1 else f"<urn:x-page:{first}>"
        want.append((f"<urn:x-page:{'null' if k is None else k}>", "revisit" if to else "response", base64.b32encode(hashlib.sha1(raw).digest()).decode(), to, None if to else raw, len(raw)))
    assert sorted(map(str, [(r["id"], r["type"], r["digest"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]), r["payload_bytes"]) for r in got])) == sorted(map(str, want))
    assert not (tmp_path / "raw").exists()
    remove(f"file://{tmp_path}/warc")
    assert not (tmp_path / "warc").exists()


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert roundtrip(spark, pages, f"file://{tmp_path}").count() == 0


def test_normaliser_takes_one_stream_or_many_members(spark, tmp_path):
    records = [record(k, "u", b"x" * (k * 70_000), "D", None, False, "2024-01-01T00:00:00Z") for k in range(5)]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "many.warc.gz").write_bytes(gzip.compress(records[0] + records[1]) + gzip.compress(b"".join(records[2:])))
    archives = spark.createDataFrame([(f"file://{tmp_path}/{n}.warc.gz",) for n in ("one", "many")], "path string")
    done = normalise(archives, f"file://{tmp_path}/out")
    assert [r["records"] for r in done.collect()] == [5, 5]
    index = read_index(done)
    for r in index.collect():
        raw = open(r["path"].removeprefix("file://"), "rb").read()[r["offset"] : r["offset"] + r["length"]]
        assert zlib.decompress(raw, 31) in records  # a member is a record, and the whole of it
    assert sorted(r["payload_bytes"] for r in read_records(index).collect()) == sorted([0, 70_000, 140_000, 210_000, 280_000] * 2)


def test_damaged_archives_are_errors(tmp_path):
    whole = record(1, "u", b"x" * 100, "D", None, False, "d")
    for name, raw in {"body": whole[:-50], "header": whole + b"WARC/1.0\r\nWARC-Type: x"}.items():
        (tmp_path / name).write_bytes(gzip.compress(raw))
        with pytest.raises(ValueError):
            normalise_file(f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}.out")


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_rules_for_tokens_across_a_boundary():
    ends, sections = np.array([2, 6, 9]), np.array([3, 4, 9])
    assert attribute(ends, sections, "first")[0].tolist() == [2, 0, 1]
    assert attribute(ends, sections, "last")[0].tolist() == [1, 0, 2]
    tokens, crossing = attribute(ends, sections, "most")
    assert tokens.tolist() == [1, 0, 2] and crossing == 1  # bytes 2-6: one, one and two


@pytest.mark.parametrize("boundary", [b"\n", b". ", b"e"])
def test_counts_match_whole_texts(spark, boundary):
    import tiktoken

    from acreledger.llm.tokens import PATTERN

    ranks = load_ranks(VOCABULARY)
    encoding = tiktoken.Encoding("v", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = awkward(spark, clashes=True)
    for rule in ("first", "most"):
        for r in section_tokens(docs, ranks, rule=rule, boundary=boundary).collect():
            raw = (r["text"] or "").encode()
            assert r["n_tokens"] == sum(r["section_tokens"]) == len(encoding.encode_ordinary(raw.decode()))
            pieces = raw.split(boundary)
            assert r["n_sections"] == len(r["section_tokens"]) == len(pieces) - (not pieces[-1]) if raw else not r["section_tokens"]
    one = spark.createDataFrame([(1, "go. on")], "doc_id long, text string")
    first = section_tokens(one, ranks, rule="first", boundary=b". ").first()
    assert first["section_tokens"] == [3, 0] and first["n_crossing"] == 1  # " on" begins before the cut
    assert section_tokens(one, ranks, rule="most", boundary=b". ").first()["section_tokens"] == [2, 1]
    assert section_tokens(empty(spark), ranks).count() == 0
    assert len(ROWS) == docs.count()
