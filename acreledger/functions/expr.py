"""Column expressions shared by the reports (S*, F*, P*); all stay in JVM codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# nine digits behind the point: exact for every denominator that divides 10**9
MONEY = "decimal(28,9)"
WHOLE = "decimal(20,0)"
# eighteen digits: products of two such amounts, and sums of quotients before their one rounding
FINE = "decimal(38,18)"
RATIO = "decimal(29,9)"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed(text: str | Column) -> Column:
    """Text as bytes, for the way through a shuffle: 32 lower-case hex digits (a guid) as 16 bytes.

    Any text is kept as it is, null too: shorter ones by their bytes, others by their bytes and one more.
    """
    c = column(text)
    digits, data = F.unhex(c), c.cast("binary")
    guid = (F.octet_length(c) == 32) & (F.lower(F.hex(digits)) == c)
    return F.when(guid, digits).when(F.octet_length(c) < 16, data).otherwise(F.concat(data, F.lit(bytearray(1))))


def unpacked(data: str | Column) -> Column:
    """The text that :func:`packed` had."""
    c = column(data)
    size = F.octet_length(c)
    text = F.when(size < 16, c).otherwise(F.substring(c, F.lit(1), size - 1)).cast("string")
    return F.when(size == 16, F.lower(F.hex(c))).otherwise(text)


def _shares(denom: Column, digits: int) -> Column:
    """1/denom for powers of ten up to ``digits``, else null: a product is several times cheaper than a division."""
    share = F.when(denom == 100, F.lit(Decimal(1).scaleb(-2)).cast(f"decimal({digits + 1},{digits})"))
    for k in (0, 1, *range(3, digits + 1)):
        share = share.when(denom == 10**k, F.lit(Decimal(1).scaleb(-k)).cast(f"decimal({digits + 1},{digits})"))
    return share


def rational(num: str | Column, denom: str | Column) -> Column:
    """numerator/denominator of one row as a decimal; zero denominator gives null.

    Exact for denominators that divide 10**9; others round half up at the ninth digit.  Powers of
    ten are a product, only what is left is divided.  Sums over many rows take :func:`whole_sum` and
    :func:`quotient` (operators.sums), which divide once per group.
    """
    n, d = column(num).cast(WHOLE), column(denom)
    return F.coalesce((n * _shares(d, 9)).cast(MONEY), F.try_divide(n, d.cast(WHOLE)).cast(MONEY))


def is_positive(num: str | Column, denom: str | Column) -> Column:
    """Whether numerator/denominator is above zero, from the signs alone; null for a zero denominator."""
    n, d = column(num), column(denom)
    return F.when(d != 0, (n > 0) == (d > 0)) & (n != 0)


def product(num: str | Column, denom: str | Column, num2: str | Column, denom2: str | Column) -> Column:
    """Product of two rationals with eighteen digits, so two exact amounts have an exact product.

    The numerators are multiplied as whole numbers; a zero denominator gives null.
    """
    n = (column(num).cast(WHOLE) * column(num2).cast(WHOLE)).cast("decimal(38,0)")
    d, e = column(denom), column(denom2)
    quick = F.when((d == 100) & (e == 100), (n * F.lit(Decimal("0.0001"))).cast(FINE))
    return F.coalesce(quick, quotient(n, (d.cast(WHOLE) * e.cast(WHOLE)).cast("decimal(38,0)")))


def whole_sum(c: str | Column) -> Column:
    """Exact sum of whole numbers (long) as a decimal.

    Two sums of longs, of the parts above and below 24 bits, take no decimal arithmetic per row and hold more
    rows than any table has; an overflow of the upper part would raise, never wrap.
    """
    c = column(c)
    low = (1 << 24) - 1
    high = F.sum(F.shiftright(c, 24)).cast("decimal(28,0)") * F.lit(Decimal(1 << 24))
    return (high + F.sum(c.bitwiseAND(F.lit(low)))).cast("decimal(38,0)")


def quotient(total: Column, denom: str | Column) -> Column:
    """A whole number over a denominator with eighteen digits, zero denominator null.

    The whole part and the rest are divided apart, as one division of wide decimals keeps six digits only.
    """
    d = F.nullif(column(denom).cast("decimal(38,0)"), F.lit(Decimal(0)).cast("decimal(38,0)"))
    rest = total % d
    whole = F.try_divide(total - rest, d).cast("decimal(19,0)")
    # a rest is smaller than its denominator; widths are such that neither step gives up digits
    small = F.try_divide(rest.cast(WHOLE), d.cast(WHOLE)).cast("decimal(19,18)")
    return (whole.cast("decimal(37,18)") + small).cast(FINE)


def times(a: Column, b: Column) -> Column:
    """Product of two decimals of nine digits with eighteen; plain products of wide decimals keep six."""
    whole = [(x.cast("decimal(38,9)") * F.lit(Decimal(10**9))).cast("decimal(38,0)") for x in (a, b)]
    return quotient((whole[0] * whole[1]).cast("decimal(38,0)"), F.lit(Decimal(10**18)))


def in_year(column: str | Column, year: int | None, through: bool = False) -> Column:
    """equal to (or up to and including) a year as a range on the raw column.

    A range, unlike ``year(c) = y``, reaches the Parquet scan as pushed filters.
    ``None`` or 0 passes every row, nulls included.
    """
    c = F.col(column) if isinstance(column, str) else column
    if not year:
        return F.lit(True)
    below = c < F.to_date(F.lit(f"{year + 1}-01-01"))
    return below if through else (c >= F.to_date(F.lit(f"{year}-01-01"))) & below


def in_years(column: str | Column, years: int | Sequence[int] | None) -> Column:
    """F1/F2 for one or several report years in one pass, as a range.

    Years with gaps between them add an exact year test to the covering range.
    """
    if not years or isinstance(years, int):
        return in_year(column, years)
    c = F.col(column) if isinstance(column, str) else column
    lo, hi = min(years), max(years)
    span = (c >= F.to_date(F.lit(f"{lo}-01-01"))) & (c < F.to_date(F.lit(f"{hi + 1}-01-01")))
    return span if len(set(years)) == hi - lo + 1 else span & F.year(c).isin(*sorted(set(years)))


def matches(column: str | Column, pattern: str) -> Column:
    """regular expression anchored at the start only."""
    c = F.col(column) if isinstance(column, str) else column
    return c.rlike(f"^(?:{pattern})")


def descriptor(column: str | Column, names: Iterable[str], initial: Column | None = None) -> Column:
    """The last of ``names`` found in the text, else ``initial``."""
    c = F.col(column) if isinstance(column, str) else column
    start = F.lit(None).cast("string") if initial is None else initial
    return reduce(lambda value, name: F.when(c.rlike(name), F.lit(name)).otherwise(value), names, start)


def sum0(column: str | Column) -> Column:
    """Sum where a group without values gives 0 (T5)."""
    return F.coalesce(F.sum(column), F.lit(0))


def exact_mean(column: str | Column) -> Column:
    """Mean of an exact column: exact sum, then one double division."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def ratio(a: str | Column, b: str | Column, digits: int | None = None) -> Column:
    """``a / b`` with null for a zero divisor, optionally rounded half up.

    A rounded ratio is taken on decimals wide enough that ties are seen exactly.
    """
    x = F.col(a) if isinstance(a, str) else a
    y = F.col(b) if isinstance(b, str) else b
    if digits is None:
        return F.try_divide(x, y)
    return F.round(F.try_divide(x.cast(RATIO), y.cast(RATIO)), digits)


def numeric_prefix(column: str | Column) -> Column:
    """Leading number of a text as double, 0 for text without one, null for null."""
    c = F.col(column) if isinstance(column, str) else column
    head = F.regexp_extract(c, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.when(c.isNotNull(), F.coalesce(head.try_cast("double"), F.lit(0.0)))


def derived_guid(*parts: str | Column) -> Column:
    """Guid derived from a natural key, the same on every retry."""
    return F.md5(F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]))


def label_with_code(name: str, code: str) -> Column:
    """P10: ``name (code)``."""
    return F.concat(F.col(name), F.lit(" ("), F.col(code), F.lit(")"))


def icon_file(column: str | Column) -> Column:
    """File name of the picture for a label."""
    return F.concat(F.lower(column), F.lit(".png"))


def capped_width(fraction: str | Column, width: float = 100.0) -> Column:
    """Bar width for a fraction capped at one, two digits half to even."""
    c = F.col(fraction) if isinstance(fraction, str) else fraction
    return F.bround(F.lit(width) * F.when(c > 1, F.lit(1.0)).otherwise(c), 2)


def year_end(column: str | Column) -> Column:
    """December 31 of a date's year."""
    return F.make_date(F.year(column), F.lit(12), F.lit(31))


def epoch_ms_local(column: str | Column, zone: str) -> Column:
    """Epoch milliseconds to local wall time; fractions of a second are cut."""
    c = F.col(column) if isinstance(column, str) else column
    return F.from_utc_timestamp(F.timestamp_seconds(F.floor(c / 1000)), zone)
