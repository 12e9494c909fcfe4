"""Token counts of fields and of spans that the caller names, by the places of whole-text tokens.

The places of tokens are bytes, as a token of byte-level BPE may end within a character; spans
are given in characters, as Spark's string functions and annotation files count them, and are moved to the bytes where
those characters begin.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buffers import slices, text_buffer
from .tokens import RULES, _encoding, attribute

RESULT = ("n_tokens", "span_tokens", "n_outside", "n_crossing")


def character_starts(raw: bytes) -> np.ndarray:
    """Byte at which each character begins, and the text's length."""
    data = np.frombuffer(raw, dtype=np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def count_spans(ends: np.ndarray, begin: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, int, int]:
    """Tokens per span, tokens in none, tokens across a border; spans are byte ranges, in any order, apart.

    What lies between spans counts as a section of its own, so each token belongs to one span or to none.
    Empty spans have no token.  Spans that overlap are an error: a token would have two owners.
    """
    counts = np.zeros(len(begin), dtype=np.int64)
    real = np.flatnonzero(stop > begin)
    order = real[np.argsort(begin[real], kind="stable")]
    if np.any(stop[order[:-1]] > begin[order[1:]]):
        raise ValueError("spans overlap")
    if not len(ends):
        return counts, 0, 0
    borders = np.unique(np.concatenate([begin[order], stop[order], ends[-1:]]))
    borders = borders[borders > 0]
    tokens, crossing = attribute(ends, borders, rule)
    # a span is one section, the one that ends where the span does
    counts[order] = tokens[np.searchsorted(borders, stop[order])]
    return counts, len(ends) - int(counts.sum()), crossing


def span_tokens(docs: DataFrame, ranks: dict[bytes, int], spans: str, text: str = "text", rule: str = "most") -> DataFrame:
    """``docs`` with ``n_tokens, span_tokens, n_outside, n_crossing``.

    ``spans`` is a column of ``array<struct<begin, end>>``: character places from 0, end excluded, further
    fields allowed.  ``span_tokens`` has one count per span in the given order, and ``n_tokens`` is their sum plus
    ``n_outside``.  Each document is encoded once, whole.  A token across a border goes by ``rule`` (see
    :func:`~.tokens.attribute`).  Places outside the text are moved to its ends; a span that is null or has a
    null place, or that ends before it begins, has no token; null spans or text count as empty; spans that
    overlap are an error.  Input columns with the result's names are replaced.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT])
    place, where = source.columns.index(text), len(source.columns)
    bounds = [F.col(f"`{spans}`").getField(name).cast("array<bigint>") for name in ("begin", "end")]
    names = [f"_{side}_{'_'.join(source.columns)}" for side in ("begin", "end")]  # longer than any column's name
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema),
         "n_tokens bigint, span_tokens array<bigint>, n_outside bigint, n_crossing bigint"]
    )
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    name = sent._jbroadcast.id()

    def count(raw: bytes, begin: list | None, end: list | None) -> tuple[int, list[int], int, int]:
        encoding, sizes = _encoding(name, sent.value)
        begin, end = begin or [], end or []
        ends = np.cumsum(sizes[encoding.encode_to_numpy(raw.decode(), allowed_special=set(), disallowed_special=())]) if raw else np.zeros(0, np.int64)
        starts = character_starts(raw)
        pairs = [(0, 0) if a is None or b is None else (a, max(a, b)) for a, b in zip(begin, end, strict=True)]
        at = starts[np.clip(np.array(pairs, dtype=np.int64).reshape(-1, 2), 0, len(starts) - 1)]
        counts, outside, crossing = count_spans(ends, at[:, 0], at[:, 1], rule)
        return len(ends), counts.tolist(), outside, crossing

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                data, cuts = text_buffer(part.column(place))
                raw = data.tobytes()
                sides = zip(part.column(where).to_pylist(), part.column(where + 1).to_pylist(), strict=True)
                found = [count(raw[a:b], *pair) for a, b, pair in zip(cuts[:-1], cuts[1:], sides, strict=True)]
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
                new = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:where], *new], [*part.schema.names[:where], *RESULT])

    return source.select("*", *[b.alias(n) for b, n in zip(bounds, names, strict=True)]).mapInArrow(task, schema)


def field_tokens(docs: DataFrame, ranks: dict[bytes, int], fields: Sequence[str], separator: str = "\n\n", rule: str = "first") -> DataFrame:
    """Tokens of each field of a row when its fields are encoded as one text, ``separator`` between them.

    Adds ``n_tokens``, ``span_tokens`` (in the order of ``fields``), ``n_outside`` (of the separators) and ``n_crossing``.  A null
    field counts as empty; its separators stay, so all rows are laid out alike.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    gap, lengths = len(separator), [F.char_length(p).cast("bigint") for p in parts]
    spans, at = [], F.lit(0).cast("bigint")
    for size in lengths:
        spans.append(F.struct(at.alias("begin"), (at + size).alias("end")))
        at = at + size + F.lit(gap)
    whole: Column = F.concat_ws(separator, *parts)
    inner = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT])
    rows = docs.select(inner.alias("row"), whole.alias("text"), F.array(*spans).alias("spans"))
    return span_tokens(rows, ranks, "spans", rule=rule).select("row.*", *RESULT)
