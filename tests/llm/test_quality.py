import math

import pytest
from pyspark.sql import functions as F

from acreledger.llm.quality import LEVELS, binomial_tail, certified_levels, judge, measure

from .helpers import ROWS, awkward, empty

WHITE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = [w for w in text.translate({ord(c): " " for c in WHITE}).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n


def test_measures_match_brute_force(spark):
    rows = [*ROWS, (20, "a b c d e f g h " * 3 + "x y z", "en", "a"), (21, "# & <a> | b\n# & <a> | b\n\n \n$1", "en", "a"), (22, "a\r\nb\vc\fd\xa0e\x1cf", "en", "a")]
    found = measure(awkward(spark, rows, clashes=True)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((r[0], *brute(r[1]))) for r in rows)
    assert measure(empty(spark)).count() == 0


@pytest.mark.parametrize("n, risk", [(50, 0.1), (700, 0.01), (20000, 0.05)])
def test_tail_is_the_exact_binomial(spark, n, risk):
    ks = [k for k in (0, 1, 3, int(n * risk / 2), int(n * risk) - 1) if 0 <= k < n * risk]
    rows = spark.createDataFrame([(k, n) for k in ks], "k long, n long").select("k", binomial_tail(F.col("k"), F.col("n"), risk).alias("p"))
    for k, p in rows.collect():
        term = lambda j: math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(risk) + (n - j) * math.log1p(-risk))
        assert p == pytest.approx(sum(map(term, range(k + 1))), rel=1e-8)


def test_levels_stop_at_the_first_failure(spark):
    never = len(LEVELS) + 1
    rows = [("a", never)] * 2000 + [("a", 5)] * 60 + [("b", never)] * 30
    levels = {r[0]: r[1] for r in certified_levels(spark.createDataFrame(rows, "_stratum string, _strict int"), "_stratum", 2, 0.01, 0.05).collect()}
    assert levels == {"a": 4, "b": 0}  # 60 of 2060 are too many; 30 prove nothing


def test_few_good_documents_are_rejected(spark):
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    good = [(i, " ".join(word() for _ in range(40)), "en", "s") for i in range(1500)]
    bad = [(5000 + i, " ".join(word() + "###" for _ in range(40)), "en", "s") for i in range(100)]
    labels = spark.createDataFrame([(r[0], 1) for r in good[:1200]] + [(r[0], 0) for r in bad[:50]] + [(None, 1), (3, None)], "doc_id long, quality int")
    judged = judge(measure(awkward(spark, good + bad)), labels).collect()
    assert all(r["kept"] for r in judged if r["doc_id"] < 5000) and not any(r["kept"] for r in judged if r["doc_id"] >= 5000)
    none = judge(measure(awkward(spark, good[:3] + ROWS)), labels.limit(0)).collect()
    assert all(r["kept"] is not r["base_failed"] and r["level"] == 0 for r in none) and len(none) == 3 + len(ROWS)
    assert judge(measure(empty(spark)), labels).count() == 0
