"""Exact sums of rationals: whole numerators are added per denominator and divided once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import column, quotient, whole_sum
from ..session import cut_lineage

TOTAL = "decimal(38,9)"


def exact_totals(
    df: DataFrame | Sequence[DataFrame],
    keys: Sequence[str | Column],
    amounts: Mapping[str, tuple[str | Column, str]],
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums per key of rationals, given as name -> (numerator, denominator column), and plain ``sums``.

    Numerators are longs and are added as longs per key and denominator; a book has a handful of
    denominators, so what is divided is a few rows per key, whatever was summed.  Quotients carry eighteen digits and
    the result is rounded to nine once, at the end: exact for all denominators that divide 10**9, correctly
    rounded for others.  A zero denominator adds nothing, a group without values gives 0 (T5).

    Several frames count as their union.  They are summed one after the other, and the shuffles of one are gone before
    the next, so the disk holds those of one frame and the whole sums of the others.
    """
    sums = dict(sums or {})
    denoms = sorted({denom for _, denom in amounts.values()})

    def whole_sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, *denoms).agg(
            *[whole_sum(num).alias(f"_{name}") for name, (num, _) in amounts.items()],
            *[F.sum(value).alias(name) for name, value in sums.items()],
        )

    if isinstance(df, DataFrame):
        parts = whole_sums(df)
    else:
        added = reduce(DataFrame.unionByName, [cut_lineage(whole_sums(rows), free=True) for rows in df])
        kinds, same = dict(added.dtypes), added.columns[: len(keys) + len(denoms)]
        parts = added.groupBy(*same).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in added.columns if c not in same])
    totals = [
        F.round(F.coalesce(F.sum(quotient(column(f"_{name}"), denom)), F.lit(0)), 9).cast(TOTAL).alias(name)
        for name, (_, denom) in amounts.items()
    ]
    return parts.groupBy(*parts.columns[: len(keys)]).agg(*totals, *[F.sum(name).alias(name) for name in sums])
