"""Toxicity by a classifier chain.

Categories are predicted one after another by logistic regressions over word and prefix counts; each later
model also sees the earlier categories' probabilities.  In training these are out-of-fold predictions, made by
models that have not seen the row, as they will be when the chain is used; otherwise later models would
trust the earlier ones too much.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .buffers import slices, text_buffer

TOKEN = re.compile(r"\w+")
#: Partitions of the training sample.
PARTS = 6
#: Prefixes of words, marked as such, of these lengths are features beside whole words.
PREFIXES = (4, 5, 6, 7, 8)
#: English insults that name the first category of the query (fixed values).
INSULTS = "clown disgusting idiot loser moron pathetic scum stupid trash worthless".split()


def feature_counts(text: str, wanted: dict[str, int] | None = None) -> Counter:
    """How often each feature occurs; with ``wanted`` only those, by their number."""
    found: Counter = Counter()
    for word, n in Counter(TOKEN.findall(text.lower())).items():
        names = [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]
        for name in names:
            if wanted is None:
                found[name] += n
            elif (k := wanted.get(name)) is not None:
                found[k] += n
    return found


def _dense(text: str | None, wanted: dict[str, int]) -> np.ndarray:
    row = np.zeros(len(wanted))
    for k, n in feature_counts(text or "", wanted).items():
        row[k] = np.log1p(n)
    return row


def choose_features(sample: DataFrame, categories: Sequence[str], most: int, least_rows: int = 5) -> list[str]:
    """The ``most`` features whose occurrence separates some category best, by a two-sample z score.

    Documents with a feature are counted in each task before anything is shuffled.
    """
    schema = "feature string, n bigint, " + ", ".join(f"p{k} bigint" for k in range(len(categories)))

    names = ["feature", "n", *(f"p{k}" for k in range(len(categories)))]
    digits = [1 << (32 * k) for k in range(len(categories) + 1)]  # a document's counts in one number

    def count(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(k, *((v // d) % (1 << 32) for d in digits)) for k, v in total.items()], columns=names)

        for part in parts:
            marks = part[list(categories)].to_numpy(dtype=np.int64).tolist()
            for text, mark in zip(part["text"], marks, strict=True):
                one = digits[0] + sum(d * m for d, m in zip(digits[1:], mark, strict=True))
                for name in feature_counts(text or ""):
                    total[name] += one
            if len(total) > 300_000:
                yield rows()
                total.clear()
        if total:
            yield rows()

    sums = sample.select("text", *categories).mapInPandas(count, schema).groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"p{k}").alias(f"p{k}") for k in range(len(categories))])
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    score = F.lit(0.0)
    for k, c in enumerate(categories):
        yes, no = totals[c] or 0, totals["n"] - (totals[c] or 0)
        if yes and no:
            rate = F.col("n") / totals["n"]
            gap = F.abs(F.col(f"p{k}") / yes - (F.col("n") - F.col(f"p{k}")) / no)
            score = F.greatest(score, gap / F.sqrt(rate * (1 - rate) * (1 / yes + 1 / no) + 1e-12))
    best = sums.filter(F.col("n") >= least_rows).orderBy(score.desc(), "feature").limit(most).select("feature")
    return [r["feature"] for r in best.collect()]


@dataclass
class Chain:
    """Feature numbers, and per category in order (weights of features, then of earlier probabilities; intercept)."""

    categories: list[str]
    features: dict[str, int]
    models: list[tuple[np.ndarray, float]]

    def probabilities(self, text: str | None) -> list[float]:
        row = _dense(text, self.features)
        for weights, bias in self.models:
            row = np.append(row, _sigmoid(float(row @ weights) + bias))
        return row[len(self.features) :].tolist()


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: DataFrame, label: str, width: int, **options) -> tuple[np.ndarray, float]:
    """A linear model; where only one class (or none) is there, its smoothed share for every row."""
    n, yes = rows.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if not yes or yes == n:
        share = (yes + 0.5) / (n + 1)
        return np.zeros(width), float(np.log(share / (1 - share)))
    model = LogisticRegression(featuresCol="v", labelCol=label, standardization=True, **options).fit(rows)
    return np.array(model.coefficients.toArray()), float(model.intercept)


def train_chain(
    labelled: DataFrame,
    categories: Sequence[str],
    key: str = "doc_id",
    most_rows: int = 10_000,
    most_features: int = 800,
    folds: int = 3,
    penalty: float = 0.003,
    steps: int = 100,
) -> Chain:
    """Fits the chain on rows with ``key``, ``text`` and a 0/1 column per category.

    More than ``most_rows`` rows are thinned to about that many by a hash of the key; that is the documented
    bound of the training sample, and rows are whole.  A fit ends at the solver's tolerance; ``steps`` bounds those that have none.  Rows with a null category are left out.  Folds
    follow the same hash, so copies of a key share one.
    """
    rows = labelled.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).cast("double").alias(c) for c in categories])
    rows = rows.dropna(subset=list(categories))
    count = rows.count()
    mark = F.xxhash64(F.lit(7), F.col("key"))
    if count > most_rows:
        rows = rows.filter(F.pmod(mark, F.lit(1 << 20)) < int((1 << 20) * most_rows / count))
    # the sample is bounded, so a fixed number of partitions holds it; each step of a fit is a job over them
    folded = rows.withColumn("fold", F.pmod(F.shiftright(mark, 24), F.lit(folds)).cast("int"))
    sample = cut_lineage(folded.repartition(PARTS))
    features = {name: k for k, name in enumerate(choose_features(sample, categories, most_features))}
    width = len(features)

    def vectors(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 200):
                some = part.iloc[at : at + 200]
                yield some.drop(columns=["text"]).assign(x=[_dense(t, features).tolist() for t in some["text"]])

    kinds = "fold int, " + ", ".join(f"`{c}` double" for c in categories)
    train = cut_lineage(sample.select("text", "fold", *categories).mapInPandas(vectors, f"{kinds}, x array<double>"))
    models = []
    for k, category in enumerate(categories):
        rows = train.select("*", array_to_vector("x").alias("v")) if width + k else None
        options = {"regParam": penalty, "maxIter": steps}
        fit = lambda part, k=k, category=category, options=options: _fit(part, category, width + k, **options)
        if rows is None:
            models.append(_fit(train, category, 0))
            break
        models.append(fit(rows))
        if k + 1 == len(categories):
            break
        parts = [fit(rows.filter(F.col("fold") != f)) for f in range(folds)]
        weights, biases = np.array([w for w, _ in parts]), np.array([b for _, b in parts])

        def extend(batches: Iterable[pd.DataFrame], weights=weights, biases=biases) -> Iterator[pd.DataFrame]:
            for part in batches:
                x = np.stack(part["x"].to_numpy()) if len(part) else np.zeros((0, weights.shape[1]))
                fold = part["fold"].to_numpy()
                p = _sigmoid((x * weights[fold]).sum(axis=1) + biases[fold])
                yield part.assign(x=list(np.column_stack([x, p])))

        train = cut_lineage(train.mapInPandas(extend, f"{kinds}, x array<double>"))
    while len(models) < len(categories):
        models.append((np.zeros(width + len(models)), 0.0))
    return Chain(list(categories), features, models)


def apply_chain(docs: DataFrame, chain: Chain, text: str = "text", digits: int = 6) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category, rounded.

    Null and empty texts have no features and get the models' base rates.  Input columns with these names are
    replaced.  The chain is broadcast; its size is bounded by its number of features.
    """
    names = [f"p_{c}" for c in chain.categories]
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names}])
    place = source.columns.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), *(f"`{n}` double" for n in names)])
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                data, bounds = text_buffer(part.column(place))
                raw = data.tobytes()
                found = np.array([sent.value.probabilities(raw[a:b].decode()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]).round(digits)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(found[:, k]) for k in range(len(names))]], [*part.schema.names, *names])

    return source.mapInArrow(task, schema)


def labelled_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", most_rows: int = 10_000) -> DataFrame:
    """Documents with a toxic label, thinned to about ``most_rows``, with the query's three categories.

    ``insult``: toxic, with an English insult; ``other``: toxic without one; ``toxic``: the label.  Labels of
    one key that disagree count as toxic.  At most about ``most_rows`` label rows are broadcast, so texts of unlabelled
    documents are only scanned.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.max("toxic").alias("toxic"))
    count = known.count()
    if count > most_rows:
        known = known.filter(F.pmod(F.xxhash64(F.lit(11), "_id"), F.lit(1 << 20)) < int((1 << 20) * most_rows / count))
    rows = docs.select(key, "text").join(F.broadcast(known), F.col(key) == F.col("_id")).drop("_id")
    rude = F.lower("text").rlike(r"\b(" + "|".join(INSULTS) + r")\b")
    rude = F.coalesce(rude, F.lit(False))
    toxic = F.col("toxic") > 0
    return rows.select(key, "text", (toxic & rude).cast("int").alias("insult"), (toxic & ~rude).cast("int").alias("other"), toxic.cast("int").alias("toxic"))


CATEGORIES = ("insult", "other", "toxic")


def judge_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = 0.5, most_rows: int = 10_000) -> DataFrame:
    """``docs`` with ``p_insult, p_other, p_toxic, toxic``, by a chain trained on the labelled ones.

    A document is toxic if the last probability is at least ``threshold``.  Without labels nothing is toxic.
    """
    chain = train_chain(labelled_documents(docs, labels, key, most_rows), CATEGORIES, key, most_rows)
    found = apply_chain(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "toxic"]), chain)
    return found.withColumn("toxic", F.col("p_toxic") >= threshold) if chain.features else found.withColumn("toxic", F.lit(False))
