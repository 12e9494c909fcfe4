"""Quality rules with risk-controlled thresholds.

Rules measure a text; a document goes if a measure passes its cutoff.  How strict the cutoffs of a
stratum (a language) may be is learned from a labelled holdout: levels from loose to strict tighten all
cutoffs together, and a level is certified when an exact binomial test shows that it rejects at most a
share ``risk`` of good documents.  Levels are nested, so they are tested in order and testing stops at
the first failure (a fixed sequence needs no correction); strata share the error budget ``delta``
(Bonferroni).  With probability 1 - delta no stratum rejects more than ``risk`` of its good documents.
A stratum with too few labels to certify anything rejects nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WHITE, aside

SYMBOLS = "#*$%&|<>"
#: Cutoffs from loose to strict: symbols per word character, repeated lines per line with a word, repeated words per word.
LEVELS = (
    (0.30, 0.95, 0.95),
    (0.25, 0.90, 0.90),
    (0.20, 0.80, 0.80),
    (0.15, 0.70, 0.70),
    (0.12, 0.60, 0.60),
    (0.10, 0.50, 0.50),
    (0.08, 0.45, 0.40),
    (0.06, 0.40, 0.30),
    (0.05, 0.35, 0.25),
    (0.04, 0.30, 0.20),
)
WINDOW = 8
#: The table of levels is broadcast up to so many strata.
MOST_BROADCAST = 10_000


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once: lambda variables are never inlined."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def _repeated(words: Column) -> Column:
    """Words that lie in a window of eight that occurs twice or more.

    Windows are compared by 64-bit hashes.  Only a text with a repeated hash is sorted: equal hashes
    become neighbours, their places are put in order, and the windows' union is measured.
    """
    hashes = F.when(
        F.size(words) >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))

    def union(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ordered, lambda s: _let(places(s), lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), add, lambda a: a["n"])))

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        at = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        return F.array_sort(F.filter(at, lambda i: i.isNotNull()))

    def add(a: Column, i: Column) -> Column:
        return F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(union(h)))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows with ``n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed``.

    Null texts measure as empty ones.  Input columns with these names are replaced, all others come back whatever
    their names.  Everything is computed
    inside the row, so nothing is shuffled and a long text costs its own length only.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed"]
    docs, own = aside(docs, text)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split(body, "\n", -1), lambda x: _without(x, WHITE) != "")
    by_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).cast("long").alias("r")))
    by_lines = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    found = docs.select("*", by_words.alias("_words"), by_lines.alias("_lines"))
    measured = found.select(
        *[column for name, column in own.items() if name.lower() not in names],
        F.col("_words.n").alias("n_words"),
        F.length(_without(body, WHITE)).cast("long").alias("word_chars"),
        (F.length(body) - F.length(_without(body, SYMBOLS))).cast("long").alias("n_symbols"),
        F.col("_lines.d").alias("n_dup_lines"),
        F.col("_lines.n").alias("n_lines"),
        F.col("_words.r").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def strictness() -> Column:
    """Number of the loosest level that rejects the row; levels run from 1, one more than all: never."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    measures = (ratio("n_symbols", "word_chars"), ratio("n_dup_lines", "n_lines"), ratio("n_repeat_words", "n_words"))
    found = F.lit(len(LEVELS) + 1)
    for level in range(len(LEVELS), 0, -1):
        passed = F.lit(False)
        for value, cutoff in zip(measures, LEVELS[level - 1], strict=True):
            passed = passed | (value > cutoff)
        found = F.when(passed, level).otherwise(found)
    return found


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(X <= k) for X of n trials with chance ``risk``, exact up to rounding.

    The largest term comes from logarithms; smaller ones follow by their ratio.  Where k is at or above the
    mean the tail is never small, and 1 is returned.
    """
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    log_ways = F.aggregate(steps, F.lit(0.0), lambda a, j: a + F.log((n - k + j).cast("double") / j))
    top = F.exp(log_ways + k * F.log(F.lit(risk)) + (n - k) * F.log(F.lit(1 - risk)))
    odds = F.lit((1 - risk) / risk)

    def add(a: Column, j: Column) -> Column:
        i = k - j + 1
        term = a["term"] * i / (n - i + 1) * odds
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    series = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), add, lambda a: a["sum"])
    return F.when(k >= n * F.lit(risk), F.lit(1.0)).otherwise(top * series)


def certified_levels(holdout: DataFrame, stratum: str, strata: int, risk: float, delta: float) -> DataFrame:
    """``stratum, level``: the strictest certified level of each stratum (0: none).

    ``holdout`` has one row per good document, with its stratum and ``_strict``.  It is reduced to counts
    by stratum and level before anything is compared.
    """
    counts = holdout.groupBy(stratum, "_strict").agg(F.count("*").alias("n"))
    levels = counts.groupBy(stratum).agg(F.sum("n").alias("good"), F.map_from_entries(F.collect_list(F.struct("_strict", "n"))).alias("by"))
    each = levels.select(stratum, "good", "by", F.explode(F.sequence(F.lit(1), F.lit(len(LEVELS)))).alias("level"))
    hits = each.select(
        stratum, "good", "level",
        F.aggregate(F.sequence(F.lit(1), F.col("level")), F.lit(0).cast("long"), lambda a, s: a + F.coalesce(F.try_element_at("by", s), F.lit(0))).alias("rejected"),
    )
    tail = hits.withColumn("tail", binomial_tail(F.col("rejected"), F.col("good"), risk))
    failed = F.min(F.when(F.col("tail") > delta / strata, F.col("level"))).over(W.partitionBy(stratum))
    return tail.select(stratum, (F.coalesce(failed, F.lit(len(LEVELS) + 1)) - 1).alias("level")).distinct()


def judge(
    measured: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    stratum: str = "lang",
    risk: float = 0.01,
    delta: float = 0.05,
) -> DataFrame:
    """Rows of ``measure`` with ``level`` and ``kept``.

    The rows are read twice, so they should come from a written table or a checkpoint.  ``labels`` has the
    key and ``quality`` (1 good, 0 bad; null: no label).  Good documents that pass the
    base rules form the holdout; a key labelled both ways counts as bad, repeated labels count once,
    repeated documents each.  ``kept`` is false if the base rules failed or the level of the row's stratum
    rejects it.  A null stratum is a stratum, as is one without labels (which rejects nothing).  Without
    documents there are no rows, without labels only the base rules act.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{stratum}`").cast("string")), F.lit(""))
    measured, own = aside(measured, key, stratum, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed")
    rated = measured.select("*", strictness().alias("_strict"), name.alias("_stratum"))
    good = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.min("quality").alias("_q"))
    passed = rated.filter(~F.col("base_failed")).select(F.col(key).alias("_key"), "_stratum", "_strict")
    holdout = passed.join(good.filter("_q = 1"), F.col("_key") == F.col("_id"), "left_semi")
    strata = max(1, holdout.select("_stratum").distinct().count())
    levels = certified_levels(holdout, "_stratum", strata, risk, delta).withColumnRenamed("_stratum", "_name")
    if strata <= MOST_BROADCAST:
        levels = F.broadcast(levels)
    leveled = rated.join(levels.withColumnRenamed("level", "_level"), F.col("_stratum") == F.col("_name"), "left")
    level = F.coalesce(F.col("_level"), F.lit(0)).cast("int")
    kept = ~F.col("base_failed") & (F.col("_strict") > level)
    kept_columns = [column for name, column in own.items() if name.lower() not in ("level", "kept")]
    return leveled.select(*kept_columns, level.alias("level"), kept.alias("kept"))
