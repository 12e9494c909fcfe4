"""A training corpus from raw documents, in five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and the next stage reads it.  Documents that the toxicity chain rejects go, then all but one of each
group of near copies, then documents contaminated by the benchmark; the rest is mixed to the target
weights of its sources, where a document may be repeated, and put into shards.

Every stage takes nulls in any column (a null text has no words: it is not toxic and not contaminated, null and empty texts are
copies of one another, and a null source is a source), repeated rows, ties, texts of any length and empty tables (no rows
in, none out).  All but the last return the columns of their input, whatever further columns it has; the last replaces
columns named as its results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreledger.llm.common import read
from acreledger.llm.decontaminate import contamination
from acreledger.llm.mixing import mixed_documents
from acreledger.llm.shards import assign_shards
from acreledger.llm.simhash import distinct_documents
from acreledger.llm.toxicity import judge_toxicity
from acreledger.llm.warc import remove
from acreledger.session import new_work_dir


def _judged(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], good: Column) -> DataFrame:
    """Rows of ``docs`` that the operator finds ``good``; further columns wait under other names meanwhile."""
    names = [c if c in ("doc_id", "text") else f"own_{i}" for i, c in enumerate(docs.columns)]
    return operator(docs.toDF(*names)).filter(good).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic; it is trained on the labelled ones among them."""
    return _judged(docs, lambda d: judge_toxicity(d, read(spark, sf_dir, "labels")), ~F.col("toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints link: three words a shingle, two bits apart at most."""
    return distinct_documents(docs, shingle=3, most=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    return _judged(docs, lambda d: contamination(d, read(spark, sf_dir, "benchmark")), ~F.col("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and place in it."""
    return assign_shards(docs, 24)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]

#: Trained models and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last is returned, read from what the one before it wrote."""
    docs, folder = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        written, folder = folder, new_work_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if written:
            remove(written)
    return STAGES[-1][1](spark, docs, sf_dir)
