"""Notes: base query, lookup by ticket, counters over time (R33, SC4, S8, S20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import epoch_ms_local
from ..functions.text import ticket_title
from ..operators.calendar import resample


def note_rows(notes: DataFrame, where: Column | None = None, zone: str = "UTC") -> DataFrame:
    """SC4: notes with local times, limited by any condition on the result columns."""
    rows = notes.select(
        F.col("id").alias("note_id"),
        "parent_id",
        "title",
        "body",
        "source",
        "source_application",
        epoch_ms_local("user_updated_time", zone).alias("updated_date"),
        epoch_ms_local("user_created_time", zone).alias("created_date"),
    )
    return rows if where is None else rows.where(where)


def ticket_notes(notes: DataFrame, tickets: DataFrame) -> DataFrame:
    """Note id per ticket number, joined on the exact title."""
    wanted = tickets.select("num").distinct().withColumn("title", ticket_title("num"))
    return wanted.join(notes.select("title", F.col("id").alias("note_id")), "title").select("num", "note_id")


def counter(
    notes: DataFrame,
    title_pattern: str,
    unit: str = "day",
    how: str = "sum",
    body_type: str = "bigint",
    zone: str = "UTC",
    where: Column | None = None,
) -> DataFrame:
    """Numbers kept as note text, per calendar bucket; text that is no number is null."""
    picked = F.col("title").ilike(title_pattern)
    rows = note_rows(notes, picked if where is None else picked & where, zone)
    typed = rows.select("created_date", F.col("body").try_cast(body_type).alias("body"))
    return resample(typed, "created_date", "body", unit, how)
