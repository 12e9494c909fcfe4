"""Small column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

#: Separators of words: the six ASCII white-space characters (fixed values).
WHITE = " \t\n\x0b\x0c\r"
#: A word, as Java and DuckDB write it.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_number(digits: Column, count: int = 12) -> Column:
    """The first hexadecimal digits as a long (at most 15 of them)."""
    return F.conv(F.substring(digits, 1, count), 16, 10).cast("long")


def row_mix(key: Column, text: Column) -> Column:
    """48 pseudo-random bits of a row: equal for equal rows, else as good as unrelated."""
    parts = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))
    return hex_number(F.md5(parts))


def in_ranges(df: DataFrame, count: int, per_range: int, *order: str) -> DataFrame:
    """``df`` range-sorted into pieces of about ``per_range`` rows, numbered by ``_range``; fixed by a checkpoint."""
    ranged = df.repartitionByRange(max(1, -(-count // per_range)), *order)
    return cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))


def aside(df: DataFrame, *needed: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with all columns but the ``needed`` ones under names that no operator uses, and how to select them back."""
    names = [c if c in needed else f"own_{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), {c: F.col(f"`{n}`").alias(c) for n, c in zip(names, df.columns, strict=True)}


def replace_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with computed columns; input columns of these names (in any case) give way."""
    names = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    return df.select(*kept, *[column.alias(name) for name, column in columns.items()])
