"""Working names that clash, long texts, cut archives: all operators."""

import time
import zlib

import pytest
from pyspark.sql import functions as F

from acreledger.llm import warc
from acreledger.llm.decontaminate import contamination
from acreledger.llm.mixing import mix_sources
from acreledger.llm.quality import judge, measure
from acreledger.llm.repeats import remove_repeats
from acreledger.llm.secrets import candidates, scan_secrets
from acreledger.llm.shards import assign_shards
from acreledger.llm.simhash import distinct_documents, near_duplicates
from acreledger.llm.tokens import load_ranks, section_tokens
from acreledger.llm.toxicity import judge_toxicity

from .helpers import ROWS, awkward, words

NAMES = "_n _from _s _name _first _key _k _doc _rid _words _lines _strict _stratum _level _body _found _one _digest _sha1 own_3 v probability prediction rawPrediction label mark text_ key".split()
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (6, 1, 0), (8, 0, 1)], "doc_id long, toxic int, quality int")


OPERATORS = {
    "toxicity": lambda s, d, f: judge_toxicity(d, labels(s)),
    "mixing": lambda s, d, f: mix_sources(d),
    "repeats": lambda s, d, f: remove_repeats(d, f),
    "secrets": lambda s, d, f: scan_secrets(d),
    "quality": lambda s, d, f: judge(measure(d), labels(s)),
    "shards": lambda s, d, f: assign_shards(d, 5),
    "tokens": lambda s, d, f: section_tokens(d, load_ranks(VOCABULARY)),
    "decontamination": lambda s, d, f: contamination(d, s.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")),
    "simhash": lambda s, d, f: near_duplicates(d),
    "near_copies": lambda s, d, f: distinct_documents(d),
    "warc": lambda s, d, f: warc.roundtrip(s, d.withColumnsRenamed({"doc_id": "page_id", "text": "html", "source": "url"}), f),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_working_names_may_clash(spark, tmp_path, name):
    docs = awkward(spark, [*ROWS, (50, 'token = "abcdef0123456789abcd" and 4111111111111111', "en", "a")])
    docs = docs.select("*", *[F.lit("own").alias(n) for n in NAMES])
    found = OPERATORS[name](spark, docs, f"file://{tmp_path}").collect()
    assert found
    kept = set(NAMES) & set(found[0].asDict())
    assert all(r[n] == "own" for r in found for n in kept)
    if name in ("mixing", "quality", "shards", "tokens", "decontamination", "near_copies", "secrets", "toxicity"):
        assert kept == set(NAMES), set(NAMES) - kept


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"near_copies"}))
def test_a_text_of_many_megabytes(spark, tmp_path, name):
    long = " ".join(f"word{i % 9973} is{i}" for i in range(400_000))  # some 6 MB
    docs = spark.createDataFrame([(1, long, "en", "a"), (2, "a short text that is not very long at all", "en", "b")], "doc_id long, text string, lang string, source string")
    found = OPERATORS[name](spark, docs, f"file://{tmp_path}").collect()
    assert len(found) >= 2
    if name == "mixing":
        assert {r["doc_id"]: r["size"] for r in found} == {1: len(words(long)), 2: 10}
    if name == "shards":
        assert {r["doc_id"]: r["size"] for r in found}[1] == len(long) + 8


def test_places_of_candidates_grow_with_the_text(spark):
    numbers = " ".join(str(10_000_000 + i) for i in range(32_000))
    text = "é " + numbers + ' password = "s3cret" end'
    docs = spark.createDataFrame([(1, text, "en", "a")], "doc_id long, text string, lang string, source string")
    candidates(docs.limit(1).withColumn("text", F.lit("a 12 b"))).collect()
    started = time.time()
    found = candidates(docs).collect()
    assert time.time() - started < 15
    assert len(found) == 32_001 and all(text[r["start"] - 1 :].startswith(r["finding"]) for r in found)
    for r in (found[0], found[77], found[-2], found[-1]):
        at = r["start"] - 1
        assert r["before"] == text[max(0, at - 40) : at] and r["after"] == text[at + len(r["finding"]) :][:40]
    assert found[-1]["finding"] == "s3cret"


def test_cut_archives_and_long_headers(tmp_path):
    one = warc.record(1, "http://x/" + "y" * (3 << 20), b"body", "A" * 32, None, False, "2024-01-01T00:00:00Z")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = squeeze.compress(one) + squeeze.flush()
    for name, part, error in (("whole", data, None), ("no trailer", data[:-8], "gzip member"), ("half", data[: len(data) // 2], "ends within")):
        path = f"{tmp_path}/{name.replace(' ', '_')}.warc.gz"
        with open(path, "wb") as f:
            f.write(part)
        target = f"file://{tmp_path}/out/{name.replace(' ', '_')}.warc.gz"
        if error is None:
            assert warc.normalise_file(f"file://{path}", target) == 1
        else:
            with pytest.raises(ValueError, match=error):
                warc.normalise_file(f"file://{path}", target)
