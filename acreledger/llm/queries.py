"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreledger.session import cut_lineage, new_work_dir

from .common import read


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from .toxicity import judge_toxicity

    docs = read(spark, folder, "documents").select("doc_id", "text")
    return judge_toxicity(docs, read(spark, folder, "labels")).drop("text")


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import mix_sources

    mixed = mix_sources(read(spark, folder, "documents").select("doc_id", "text", "source"), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    from .repeats import remove_repeats
    from .warc import remove

    work = new_work_dir(spark, "repeats")
    found = remove_repeats(read(spark, folder, "documents"), work)
    result = cut_lineage(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    remove(work)
    return result


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from .secrets import scan_secrets

    found = scan_secrets(read(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "start", F.length("finding").alias("length"), F.sha2("finding", 256).alias("finding_sha256"), "p_secret", "secret")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import judge, measure

    columns = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "base_failed"]
    measured = cut_lineage(measure(read(spark, folder, "documents").select("doc_id", "text", "lang")).select(*columns))
    judged = judge(measured, read(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "level")


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    from .shards import assign_shards

    placed = assign_shards(read(spark, folder, "documents").select("doc_id", "text"), 24, columns=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from .decontaminate import contamination

    found = contamination(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from .simhash import hex_digits, near_duplicates

    groups = near_duplicates(read(spark, folder, "documents"))
    return groups.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    from .warc import remove, roundtrip

    work = new_work_dir(spark, "warc")
    records = roundtrip(spark, read(spark, folder, "pages"), work)
    number = lambda name: F.expr(f"try_cast(regexp_extract({name}, 'x-page:(-?[0-9]+)', 1) AS bigint)")
    result = cut_lineage(
        records.select(
            number("id").alias("page_id"),
            "payload_bytes",
            F.col("digest").alias("payload_digest"),
            F.col("type").alias("record_type"),
            number("refers_to").alias("refers_to"),
        )
    )
    remove(work)
    return result


def op8_tokens(spark: SparkSession, folder: str, vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    from .tokens import load_ranks, section_tokens

    counted = section_tokens(read(spark, folder, "documents").select("doc_id", "text"), load_ranks(vocabulary))
    return counted.select("doc_id", "n_tokens", "n_sections", "section_tokens", "n_crossing")


def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    from .topk import top_k

    return top_k(read(spark, folder, "embeddings").select("vec_id", "embedding"), F.expr("vec_id % 50 = 0"))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from .negatives import hard_negatives

    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(read(spark, folder, "embeddings"), F.expr("vec_id % 100 = 0"), label=label)


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    from .centroids import cluster_vectors, with_inertia

    assigned, centroids = cluster_vectors(read(spark, folder, "embeddings").select("vec_id", "embedding"))
    return with_inertia(assigned, centroids).withColumnRenamed("key", "vec_id")


_ALL = (
    op1_toxicity,
    op2_mixing,
    op3_warc,
    op4_repeats,
    op5_secrets,
    op6_quality,
    op7_shards,
    op8_tokens,
    op9_decontamination,
    op10_simhash,
    op11_topk,
    op12_negatives,
    op13_centroids,
)
REGISTRY = {f.__name__: f for f in _ALL}
