"""The :class:`Ledger` holder and its readers and writers (SC1-SC3, SC8, SK1-SK3, SK5)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import FREED, settings
from .schema import LEDGER_TABLES


class Ledger:
    """Named DataFrames of one book set; a table is built on first use.

    ``source`` is a mapping of DataFrames or a function ``name -> DataFrame``.
    A second book set (for example personal books) is simply a second ``Ledger``.
    """

    def __init__(self, source: Mapping[str, DataFrame] | Callable[[str], DataFrame]):
        self._source = source
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            source = self._source
            self._built[name] = source(name) if callable(source) else source[name]
        return self._built[name]

    def remember(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Keep a derived DataFrame (the enriched accounts) for later reports.

        It may be a checkpoint, so changed books need a new ``Ledger`` or :meth:`forget`.
        """
        if name not in self._built:
            self._built[name] = make()
        return self._built[name]

    def forget(self) -> None:
        """Drops what was built, so that tables are opened and derived again."""
        self._built.clear()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self.table(name)
        except KeyError:
            raise AttributeError(f"ledger has no table {name!r}") from None


def load_ledger(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> Ledger:
    """Ledger over ``path/<table>`` with declared schemas; columns prune at the scan."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(LEDGER_TABLES[name]).options(**options).format(fmt).load(f"{path}/{name}")

    return Ledger(read)


def by_text(spark: SparkSession, ledger: Ledger, text: str, tables: list[str], **values) -> DataFrame:
    """SC3/SC4: a query as text over tables of the ledger; values are parameters, never text.

    Tables are named in braces (``{splits}``) and resolved to the ledger's DataFrames, so nothing is registered and
    several ledgers can be queried side by side.  Values are named markers (``:year``); Spark binds them as
    literals after the text is parsed, so what they hold cannot become part of the query.
    """
    return spark.sql(text, args=values, **{name: ledger.table(name) for name in tables})


def rows_with(df: DataFrame, column: str, value) -> DataFrame:
    """SC4: rows whose ``column`` equals a value; the caller names the column, which must be one of the table's."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; there are {', '.join(df.columns)}")
    return df.where(df[f"`{column}`"].eqNullSafe(F.lit(value)))


def declared(df: DataFrame, schema: str, zone: str | None = None) -> DataFrame:
    """Columns of a table cast to their declared types; what does not fit becomes null.

    Databases without a time type keep times as text: bad text is null, and text in
    local time of ``zone`` is moved to the session's UTC.  Columns that are missing are
    null, others are left out.
    """

    def one(name: str, kind: str):
        if name not in df.columns:
            return F.lit(None).cast(kind).alias(name)
        c = F.col(name)
        if kind == "timestamp" and dict(df.dtypes)[name] == "string":
            stamp = F.try_to_timestamp(F.trim(c))
            return (F.to_utc_timestamp(stamp, zone) if zone else stamp).alias(name)
        return c.try_cast(kind).alias(name)

    return df.select(*[one(*part.strip().split(" ")) for part in schema.split(",")])


def guid_ranges(column: str, parts: int) -> list[str]:
    """Predicates that cut a hex guid column into ``parts`` (a power of 16) ranges.

    Lets a JDBC read of splits or transactions run as many parallel range queries
    instead of one connection.  The first predicate also takes nulls and the last
    has no upper bound, so every row falls in exactly one range.
    """
    width = max(1, len(f"{parts - 1:x}"))
    if parts < 2 or 16**width != parts:
        raise ValueError("parts must be a power of 16")
    edges = [f"{i:0{width}x}" for i in range(parts)]
    first = f"({column} < '{edges[1]}' or {column} is null)"
    middle = [f"({column} >= '{lo}' and {column} < '{hi}')" for lo, hi in zip(edges[1:-1], edges[2:])]
    return [first, *middle, f"{column} >= '{edges[-1]}'"]


def load_ledger_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    parallel: Mapping[str, int] | None = None,
    names: Mapping[str, str] | None = None,
    zone: str | None = None,
) -> Ledger:
    """Ledger read straight from a database; large tables read in guid ranges.

    Every table gets its declared types, see :func:`declared`.
    """
    parallel = {"splits": 256, "transactions": 256, "entries": 256, **(parallel or {})}
    names = {"locks": "gnclock", **(names or {})}

    def read(name: str) -> DataFrame:
        table, parts = names.get(name, name), parallel.get(name, 1)
        if parts > 1:
            ranges = guid_ranges("guid", parts)
            rows = spark.read.jdbc(url, table, predicates=ranges, properties=dict(properties or {}))
        else:
            rows = spark.read.jdbc(url, table, properties=dict(properties or {}))
        return declared(rows, LEDGER_TABLES[name], zone)

    return Ledger(read)


def write_ledger(ledger: Ledger, path: str, tables: list[str] | None = None) -> None:
    """Write tables as Parquet; transactions and splits are partitioned by posting year.

    Reports that name their years read only those folders of both tables.  The files are packed by zstd, as guids
    take half the place in it that they take in Spark's default.
    """
    years = ledger.table("transactions").select(
        F.col("guid").alias("tx_guid"), F.year("post_date").alias("post_year")
    )
    for name in tables or list(LEDGER_TABLES):
        df = ledger.table(name)
        folders = []
        if name == "splits":
            df, folders = df.join(years.dropDuplicates(["tx_guid"]), "tx_guid", "left").select(*df.columns, "post_year"), ["post_year"]
        elif name == "transactions":
            df, folders = df.withColumn("post_year", F.year("post_date")), ["post_year"]
        with settings(df.sparkSession, FREED):
            df.select("*").write.mode("overwrite").option("compression", "zstd").partitionBy(*folders).parquet(f"{path}/{name}")


# Tables joined on the transaction and the column that holds its guid.
TRANSACTION_KEYS = {"splits": "tx_guid", "transactions": "guid"}


def write_bucketed(ledger: Ledger, path: str, buckets: int, prefix: str = "ledger") -> None:
    """Splits and transactions as tables bucketed by the transaction guid.

    Equal bucket counts let the counter-split joins and the counts per transaction
    run without shuffling the splits again.  The other tables are plain Parquet.
    """
    for name, key in TRANSACTION_KEYS.items():
        (
            ledger.table(name)
            .repartition(buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .option("path", f"{path}/{name}")
            .saveAsTable(f"{prefix}_{name}")
        )
    write_ledger(ledger, path, [n for n in LEDGER_TABLES if n not in TRANSACTION_KEYS])


def load_bucketed(spark: SparkSession, path: str, prefix: str = "ledger") -> Ledger:
    """Ledger whose splits and transactions come from :func:`write_bucketed`."""
    plain = load_ledger(spark, path)
    return Ledger(lambda n: spark.table(f"{prefix}_{n}") if n in TRANSACTION_KEYS else plain.table(n))


def normalise_post_date(transactions: DataFrame) -> DataFrame:
    """SK5: posting time as canonical text; text that is no timestamp becomes null."""
    stamp = F.try_to_timestamp(F.col("post_date").cast("string"))
    return transactions.withColumn("post_date", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))


def write_csv(df: DataFrame, path: str) -> None:
    """SK1/SK2: CSV with a header line, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_sheets(sheets: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """SK4: one directory per named table of a report."""
    for name, df in sheets.items():
        writer = df.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{path}/{name}")


def write_partitioned(df: DataFrame, path: str, column: str, fmt: str = "parquet") -> None:
    """SK4: a single write split by the values of ``column`` (one sheet per crop)."""
    df.write.mode("overwrite").partitionBy(column).format(fmt).save(path)


def discount_table(spark: SparkSession, discounts: Mapping[str, float]) -> DataFrame:
    """SC8: configured discounts as a small table ``(category, pct)``."""
    rows = [
        spark.range(1).select(F.lit(k).alias("category"), F.lit(float(v)).alias("pct"))
        for k, v in discounts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def is_locked(locks: DataFrame) -> bool:
    """SC10: any row in the lock table means another writer holds the books."""
    return not locks.limit(1).isEmpty()
