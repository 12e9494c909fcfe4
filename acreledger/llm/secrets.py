"""Secret scan with a random forest that removes false positives.

Candidates are values that are assigned to or quoted after a credential's name or stand in an address, of any
length and characters, and runs of token characters that hold a digit or an inner capital.  Each is described by its length, the
transitions between kinds of characters, the share of its letters that words of the table cover, how usual its pairs of
letters are in those words, its path and the words around it.  A random forest, trained from labelled findings, tells secrets from card numbers,
addresses, hashes in prose and the like.  Everything is column expressions and Spark ML.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .common import aside

#: What stands before a value: a name of a credential with its sign, a name before a quote, or scheme and user of an address.
_NAME = r"(?<![\w.\-])[\w.\-]*?(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key|credential|auth)[\w\-]*+[\"']?\s*+"
_SIGN = r"(?:=>|:=|==?|:)\s*+(?:(?i:bearer|basic)\s++)?"
_QUOTED = r"(?:\"[^\"\n]++(?=\")|'[^'\n]++(?='))"
_ADDRESS = r"://[^\s/:@]*+:"
#: A candidate with what stands before it; a run of token characters is read once.
CANDIDATE = rf"{_NAME}(?:{_SIGN})?{_QUOTED}|{_NAME}{_SIGN}[\"']?\S++|{_ADDRESS}\S+(?=@)|(?<![A-Za-z0-9_+/=\-])(?=[A-Za-z0-9_+/=\-]*?(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9_+/=\-]++"
BEFORE = rf"^(?:{_NAME}(?:{_SIGN}[\"']?|[\"'])|{_ADDRESS})(?=.)"
CONTEXT = 40
#: Words beside a value that name it a credential, and those that mark a sample (fixed values).
NAMES = r"(?i)(token|secret|passwd|password|api[_-]?key|access[_-]?key|credential|auth)"
SAMPLES = r"(?i)(example|sample|dummy|test|placeholder|changeme|xxxx)"
#: What stands directly before a value that is given to a credential's name: the evidence of the weak labels.
ASSIGNED = rf"(?:{_NAME}(?:{_SIGN}[\"']?|[\"'])|{_ADDRESS})$"
#: A word of the table: letters with no letter, digit or underscore beside them.
TABLE_WORD = r"(?<![\p{L}\p{N}_])\p{L}{3,20}(?![\p{L}\p{N}_])"
FEATURES = ["f_length", "f_digits", "f_upper", "f_hex", "f_other", "f_switch", "f_pairs", "f_kinds", "f_cover", "f_bigrams", "f_named", "f_assigned", "f_quoted", "f_sample_path", "f_depth", "f_word_before", "f_word_after"]
#: Features that see what weak labels go by; a forest that learns from these labels does without them.
SEEN = ("f_named", "f_assigned", "f_quoted")


def _running(sizes: Column) -> Column:
    """Running sums of an array of numbers, by doubling steps: n log n, however long a text is."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(sizes) + 1)).cast("int"))
    add = lambda a, k: F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    return F.aggregate(steps, sizes, add)


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: the columns of ``docs`` but the text, with ``finding, start, before, after, path``.

    ``start`` counts code points from 1.  The text is taken apart at its candidates; places are running sums of the
    pieces' lengths and contexts are joined from the pieces nearby, so the work grows with the text, not with its
    square.  Null and empty texts have no candidates.  Input columns with the names of results are replaced, all others
    come back whatever their names.
    """
    new = ("finding", "start", "before", "after", "path")
    slim, own = aside(docs, text, path)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = slim.select("*", body.alias("_body"), F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("_found")).filter(F.size("_found") > 0)
    rows = rows.withColumn("_pieces", F.split("_body", CANDIDATE, -1))
    # pieces and candidates in turn; of each the ends that a context can take from it
    turn = F.transform(F.sequence(F.lit(0), 2 * F.size("_found")), lambda k: F.when(k % 2 == 0, F.get("_pieces", (k / 2).cast("int"))).otherwise(F.get("_found", ((k - 1) / 2).cast("int"))))
    rows = rows.withColumn("_turn", turn).drop("_pieces", "_body")
    rows = rows.withColumns({
        "_upto": _running(F.transform("_turn", F.length)),
        "_tails": F.transform("_turn", lambda x: F.right(x, F.lit(CONTEXT))),
        "_heads": F.transform("_turn", lambda x: F.left(x, F.lit(CONTEXT))),
    }).drop("_turn")
    near = CONTEXT + 1  # so many neighbours hold a context, as no candidate is empty

    def one(m: Column, i: Column) -> Column:
        value = F.regexp_replace(m, BEFORE, "")
        head = F.left(m, F.length(m) - F.length(value))
        first = F.greatest(2 * i + 2 - near, F.lit(1))
        left = F.concat(F.array_join(F.slice("_tails", first, 2 * i + 2 - first), ""), F.right(head, F.lit(CONTEXT)))
        right = F.array_join(F.slice("_heads", 2 * i + 3, near), "")
        start = F.get("_upto", 2 * i) + F.length(head) + 1
        return F.struct(value.alias("finding"), start.cast("int").alias("start"), F.right(left, F.lit(CONTEXT)).alias("before"), F.left(right, F.lit(CONTEXT)).alias("after"))

    rows = rows.withColumn("_one", F.explode(F.transform("_found", one)))
    kept = [column for name, column in own.items() if name.lower() not in new and name != text]
    source = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")).alias("path")
    return rows.select(*kept, *[F.col(f"_one.{c}").alias(c) for c in new[:4]], source)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def table_words(docs: DataFrame, text: str = "text", least: int = 3) -> DataFrame:
    """``word, docs``: the dictionary, lower-cased words of 3 to 20 letters that at least ``least`` rows hold.

    Each row gives a word once, and rows are counted in each task before words are shuffled.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text}`")), F.lit(TABLE_WORD), F.lit(0)))
    return docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least)


def _neighbours(x: Column, one) -> Column:
    """``one`` of each two characters that follow one another, in time linear in the length."""
    letters, n = F.split(x, ""), F.greatest(F.length(x) - 1, F.lit(0))
    return F.zip_with(F.slice(letters, F.lit(1), n), F.slice(letters, F.lit(2), n), one)


def _pair_number(a: Column, b: Column) -> Column:
    """0 to 675 for two letters a to z, else null."""
    inside = a.between("a", "z") & b.between("a", "z")
    return F.when(inside, (F.ascii(a) - 97) * 26 + F.ascii(b) - 97)


def pair_scores(words: DataFrame) -> list[float]:
    """For each pair of letters a to z the logarithm of the second's share among those that follow the first in the dictionary.

    Words weigh as many as the rows that hold them, each pair one more.  676 numbers, whatever the table.
    """
    pairs = words.select("docs", F.explode(_neighbours(F.col("word"), _pair_number)).alias("pair")).filter("pair IS NOT NULL")
    counts = {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.sum("docs").alias("n")).collect()}
    after = [sum(counts.get(26 * a + b, 0) + 1 for b in range(26)) for a in range(26)]
    return [math.log((counts.get(k, 0) + 1) / after[k // 26]) for k in range(676)]


def describe(found: DataFrame, words: DataFrame, scores: list[float] | None = None) -> DataFrame:
    """Candidates with the features of the forest; ``words`` is the dictionary, ``scores`` those of its pairs.

    Columns of candidates wait in a struct meanwhile, so they may have any names; those named as features are replaced.
    """
    packed = found.select(F.struct("*").alias("_found"), "finding", "before", "after", "path", F.monotonically_increasing_id().alias("_row"))
    packed = cut_lineage(packed)
    pieces = F.transform(F.regexp_extract_all("finding", F.lit(r"\p{Lu}?\p{Ll}+|\p{Lu}+"), F.lit(0)), F.lower)
    pieces = packed.select("_row", F.explode(F.filter(pieces, lambda p: F.length(p).between(3, 20))).alias("word"))
    known = pieces.join(words.select("word"), "word").groupBy("_row").agg(F.sum(F.length("word")).alias("_known"))
    rows = packed.join(known, "_row", "left")
    x, after = F.col("finding"), F.col("after")
    before = F.col("before")
    lead = F.regexp_replace("before", ASSIGNED, "")
    length = F.length(x).cast("double")
    kind = F.translate(x, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/=-", "a" * 26 + "A" * 26 + "0" * 10 + "." * 5)
    letters = F.greatest(_count(x, r"\p{L}"), F.lit(1.0))
    table = F.lit(scores if scores is not None else pair_scores(words))
    usual = F.filter(_neighbours(F.lower(x), lambda a, b: F.get(table, _pair_number(a, b))), lambda s: s.isNotNull())
    rows = rows.withColumn("_usual", usual)
    features = {
        "f_length": length,
        "f_digits": _count(x, "[0-9]") / length,
        "f_upper": _count(x, "[A-Z]") / length,
        "f_hex": _count(x, "[0-9a-f]") / length,
        "f_other": _count(x, r"[^A-Za-z0-9]") / length,
        "f_switch": F.regexp_count(kind, F.lit(r"a(?=[A0.])|A(?=[a0.])|0(?=[aA.])|\.(?=[aA0])")) / length,
        "f_pairs": F.size(F.array_distinct(_neighbours(x, lambda a, b: F.concat(a, b)))) / length,
        "f_kinds": (x.rlike("[a-z]").cast("int") + x.rlike("[A-Z]").cast("int") + x.rlike("[0-9]").cast("int")).cast("double"),
        "f_cover": F.coalesce("_known", F.lit(0)) / letters,
        "f_bigrams": F.when(F.size("_usual") > 0, F.aggregate("_usual", F.lit(0.0), lambda a, s: a + s) / F.size("_usual")).otherwise(math.log(1 / 26)),
        "f_named": before.rlike(NAMES).cast("double"),
        "f_assigned": before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        "f_quoted": (before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).cast("double"),
        "f_sample_path": (F.col("path").rlike(SAMPLES) | lead.rlike(SAMPLES)).cast("double"),
        "f_depth": _count(F.col("path"), "[/.]"),
        "f_word_before": F.length(F.regexp_extract(lead, r"([\p{L}]+)[^\p{L}]*$", 1)).cast("double"),
        "f_word_after": F.length(F.regexp_extract(after, r"^[^\p{L}]*([\p{L}]+)", 1)).cast("double"),
    }
    own = [F.col(f"_found.`{c}`") for c in found.columns if c.lower() not in FEATURES]
    return rows.select(*own, *[features[name].alias(name) for name in FEATURES])


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings with features and ``label`` by what stands before them: 1 if they are given to a credential's name, else 0.

    The label does not look at the value and a forest that learns from it does not look at the name (``SEEN``), so it
    learns the form and neighbourhood of secrets, not the rule.  Values marked as samples have no label.
    """
    named = F.col("before").rlike(ASSIGNED)
    return found.withColumn("label", named.cast("double")).filter("f_sample_path = 0").select(*FEATURES, "finding", "before", "start", "label")


def train_forest(labelled: DataFrame, most_rows: int = 20_000, trees: int = 20, depth: int = 6, features: Sequence[str] = FEATURES) -> RandomForestClassificationModel | None:
    """A forest on ``features`` of described findings with ``label``; None if they are not of both kinds.

    More than ``most_rows`` findings are thinned to about that many by a hash, each kind by itself, so rare
    secrets are not lost among numbers.
    """
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (counts.get(0.0) and counts.get(1.0)):
        return None
    share = F.lit(1.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, min(1.0, most_rows / 2 / n)).otherwise(share)
    mark = F.pmod(F.xxhash64("finding", "before", "start"), F.lit(1 << 20))
    chosen = labelled.select(*FEATURES, "label", "finding", "before", "start").filter(mark < share * (1 << 20))
    sample = VectorAssembler(inputCols=list(features), outputCol="v").transform(chosen)
    return RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=trees, maxDepth=depth, seed=7).fit(sample.select("v", "label"))


def apply_forest(found: DataFrame, forest: RandomForestClassificationModel, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Described findings with ``p_secret`` and ``secret``; other columns come back whatever their names."""
    own = [F.col(f"_found.`{c}`") for c in found.columns if c.lower() not in ("p_secret", "secret")]
    packed = found.select(F.struct("*").alias("_found"), *features)
    scored = forest.transform(VectorAssembler(inputCols=list(features), outputCol="v").transform(packed))
    p = F.round(vector_to_array("probability")[1], 6)
    return scored.select(*own, p.alias("p_secret"), (p >= threshold).alias("secret"))


def held_out_counts(found: DataFrame, folds: int = 5) -> DataFrame:
    """``label, secret, n`` of the described findings in one of ``folds`` parts, judged by a forest of the others with weak labels.

    Parts are picked by a hash of the value, so a value that repeats is on one side only.
    """
    unseen = [f for f in FEATURES if f not in SEEN]
    known = weak_labels(found)
    held = F.pmod(F.xxhash64(F.lit(3), "finding"), F.lit(folds)) == 0
    forest = train_forest(known.filter(~held), features=unseen)
    if forest is None:
        raise ValueError("the findings are not of both kinds")
    return apply_forest(known.filter(held), forest, unseen).groupBy("label", "secret").agg(F.count("*").alias("n"))


def scan_secrets(docs: DataFrame, text: str = "text", path: str = "source", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Findings of ``docs`` with ``p_secret`` and ``secret``.

    ``labelled`` holds described findings with a ``label`` of 0 or 1, and the forest sees all features; without it
    ``weak_labels`` of the documents' own findings are taken and the forest does without ``SEEN``.  If they are not of
    both kinds, ``p_secret`` is null and every candidate is kept as a secret, as nothing is known to remove.  Candidates
    and described findings are checkpointed, as they are read several times.  The dictionary is counted over all texts.
    Input columns named as results or features (``finding``, ``f_length``, ``secret`` and so on) are replaced, all others come back
    whatever their names.  Without documents there are no rows.
    """
    words = cut_lineage(table_words(docs, text))
    found = cut_lineage(describe(candidates(docs, text, path), words))
    features = [f for f in FEATURES if labelled is not None or f not in SEEN]
    forest = train_forest(weak_labels(found) if labelled is None else labelled, features=features)
    if forest is not None:
        return apply_forest(found, forest, features, threshold)
    own = [F.col(f"`{c}`") for c in found.columns if c.lower() not in ("p_secret", "secret")]
    return found.select(*own, F.lit(None).cast("double").alias("p_secret"), F.lit(True).alias("secret"))
