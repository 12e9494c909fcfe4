"""TOML sections inside note columns to typed columns."""

from __future__ import annotations

import tomllib
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType, _parse_datatype_string


def _typed(value, dtype):
    if value is None or isinstance(dtype, TimestampType):
        # wall time as written: the zone of an offset date-time is dropped
        return value.replace(tzinfo=None) if isinstance(value, datetime) else None
    if isinstance(dtype, StringType):
        return str(value)
    if dtype.simpleString() == "boolean":
        return value if isinstance(value, bool) else None
    return float(value) if isinstance(value, int | float) else None


def toml_section(df: DataFrame, column: str, section: str, schema: str) -> DataFrame:
    """Rows whose text mentions ``section``, with the section's keys as columns.

    The schema is declared, not taken from the first hit.  Text that is no valid
    TOML, or lacks the section or a key, gives nulls.  This is the one place that
    runs Python: an Arrow batched UDF, after the JVM filter on the section name.
    Callers pass distinct texts where the same note repeats over many rows.
    """
    struct: StructType = _parse_datatype_string(schema)
    fields = [(f.name, f.dataType) for f in struct.fields]

    @F.pandas_udf(struct)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            try:
                found = tomllib.loads(text).get(section)
            except tomllib.TOMLDecodeError:
                found = None
            found = found if isinstance(found, dict) else {}
            rows.append([_typed(found.get(name), dtype) for name, dtype in fields])
        out = pd.DataFrame(rows, columns=[name for name, _ in fields], dtype=object)
        for name, dtype in fields:
            if isinstance(dtype, TimestampType):
                out[name] = pd.to_datetime(out[name])
        return out

    hits = df.where(F.col(column).contains(section))
    return hits.withColumn("_toml", parse(F.col(column))).select(
        *df.columns, *[F.col("_toml").getField(name).alias(name) for name, _ in fields]
    )
