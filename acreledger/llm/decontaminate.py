"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of some megabytes of documents.  Its words become numbers of the benchmark's
vocabulary; a word outside it can lie in no occurrence, so it ends a run, and runs shorter than the shortest
phrase hold none.  The remaining runs are indexed, all phrases are searched backward at once, occurrences
are located by sampled suffix positions, and their spans are merged.  Documents are not shuffled: each
task indexes what it reads, and the benchmark travels in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .buffers import byte_table, slices, text_buffer, words_in
from .common import replace_columns
from .fmindex import FMIndex

#: Words are runs of digits, letters a-z and bytes from 80 hex on, after A-Z became small (fixed values).
WORD_BYTES = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
WINDOW = 13
#: Most bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 4 << 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        inverse = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
        for name, base in (("up", _FACTOR), ("down", inverse)):
            x = np.full(n, base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word from running sums over the whole buffer.

    For a false hit, as many consecutive words as a phrase has would have to collide.
    """
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    x = (sums[ends] - sums[begins]) * down[begins]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29)) ^ (ends - begins).astype(np.uint64)


def _words(data: np.ndarray, bounds: np.ndarray):
    data = LOWER[data]
    begins, ends, upto = words_in(WORD_BYTES[data], bounds)
    return word_hashes(data, begins, ends), begins, ends, upto


class Phrases:
    """Windows of a block of items: vocabulary, distinct windows as symbols, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        data = [(t or "").encode() for _, t in items]
        bounds = np.cumsum([0, *map(len, data)])
        hashes, _, _, upto = _words(np.frombuffer(b"".join(data), dtype=np.uint8), bounds)
        self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
        symbols = symbols + 1
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        windows: dict[tuple, set[int]] = {}
        for (name, _), a, b in zip(items, upto[:-1], upto[1:], strict=True):
            for i in range(a, max(a + 1, b - window + 1)):
                if b > a:
                    windows.setdefault(tuple(symbols[i : min(b, i + window)]), set()).add(number[name])
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        self.patterns = np.zeros((len(windows), window), dtype=np.int64)
        for row, w in enumerate(windows):
            self.patterns[row, : len(w)] = w
        self.item_from = np.cumsum([0, *(len(x) for x in windows.values())])
        self.items = np.array([k for x in windows.values() for k in sorted(x)], dtype=np.int64)

    def occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pattern and position of each occurrence; symbol 0 fits no pattern."""
        empty = np.zeros(0, np.int64)
        if not len(self.lengths) or not len(symbols):
            return empty, empty
        inside = np.concatenate([[False], symbols > 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edge[::2], edge[1::2]
        long = ends - begins >= self.lengths.min()
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return empty, empty
        size = ends - begins + 1  # one separator after each run
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(first - begins, size)
        runs = np.where(place < np.repeat(ends, size), symbols[np.minimum(place, len(symbols) - 1)], 0)
        index = FMIndex(runs)
        low, high = index.search(self.patterns, self.lengths)
        found = high - low
        pattern = np.repeat(np.arange(len(found)), found)
        rows = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)
        return pattern, place[index.locate(rows)]


def _merge(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(begins):
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], begins[1:] > reach[:-1]])
    return begins[first], reach[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(begins) - 1]])]


def _scan(column: pa.Array, phrases: Phrases, spans_before, items_before) -> tuple[list, list, list, list]:
    """Per row: number of words, merged spans of words, their bytes, and items."""
    data, bounds = text_buffer(column)
    hashes, begins, ends, upto = _words(data, bounds)
    symbols = np.zeros(len(hashes) + len(upto), dtype=np.int64)  # a separator after each row
    if len(phrases.vocabulary):
        at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
        row = np.repeat(np.arange(len(column)), np.diff(upto))
        symbols[np.arange(len(hashes)) + row] = np.where(phrases.vocabulary[at] == hashes, at + 1, 0)
    pattern, place = phrases.occurrences(symbols)
    starts = upto[:-1] + np.arange(len(column))  # of rows, with separators
    rows = np.searchsorted(starts, place, side="right") - 1
    word = place - rows  # number of the word in the slice
    count = np.diff(phrases.item_from)[pattern]
    item = phrases.items[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(phrases.item_from[pattern], count)]
    pairs = np.unique(np.repeat(rows, count) * max(1, len(phrases.names)) + item)
    items = [list(x) if x is not None else [] for x in items_before] if items_before is not None else [[] for _ in range(len(column))]
    for row, k in zip(pairs // max(1, len(phrases.names)), pairs % max(1, len(phrases.names)), strict=True):
        items[row].append(phrases.names[k])
    order = np.argsort(rows, kind="stable")
    cut = np.searchsorted(rows[order], np.arange(len(column) + 1))
    spans, pieces = [], []
    for r in range(len(column)):
        mine = order[cut[r] : cut[r + 1]]
        b, e = word[mine] - upto[r], word[mine] - upto[r] + phrases.lengths[pattern[mine]]
        if spans_before is not None and spans_before[r]:
            old = np.array([(x["begin"], x["end"]) for x in spans_before[r]], dtype=np.int64)
            b, e = np.concatenate([b, old[:, 0]]), np.concatenate([e, old[:, 1]])
        b, e = _merge(b, e)
        spans.append([{"begin": int(x), "end": int(y)} for x, y in zip(b, e, strict=True)])
        pieces.append([{"begin": int(begins[upto[r] + x] - bounds[r]), "end": int(ends[upto[r] + y - 1] - bounds[r])} for x, y in zip(b, e, strict=True)])
    return np.diff(upto).tolist(), spans, pieces, [sorted(set(x)) for x in items]


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def find_phrases(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words, spans, byte_spans, items``.

    ``spans`` are merged runs of words that lie in an occurrence of a benchmark window, ``byte_spans`` the same
    in bytes of the text, ``items`` the ids (as strings, sorted) whose windows occur.  The benchmark is read in
    as many blocks as its size asks for; between blocks the rows are checkpointed.  Null and empty texts have
    no words; a null item id counts as the id "".  Input columns with these names are replaced.  Without items
    nothing is found.
    """
    spark = docs.sparkSession
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_words", "spans", "byte_spans", "items")])
    wanted = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text")).filter("text is not null")
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // block_bytes))
    place = source.columns.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), "n_words bigint, spans array<struct<begin:bigint,end:bigint>>, byte_spans array<struct<begin:bigint,end:bigint>>, items array<string>"])
    width = len(source.columns)
    out = source
    for block in range(blocks):
        rows = wanted if blocks == 1 else wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(Phrases([(r["item"], r["text"]) for r in rows.collect()], window))

        def task(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, place):
                    old = part.num_columns > width
                    before = part.column(width + 1).to_pylist() if old else None
                    items = part.column(width + 3).to_pylist() if old else None
                    n, spans, pieces, found = _scan(part.column(place), sent.value, before, items)
                    new = [pa.array(n, pa.int64()), pa.array(spans, SPANS), pa.array(pieces, SPANS), pa.array(found, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:width], *new], [*part.schema.names[:width], "n_words", "spans", "byte_spans", "items"])

        out = out.mapInArrow(task, schema)
        if block + 1 < blocks:
            out = cut_lineage(out)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_phrases`` with ``n_hit, n_items, items_sha256, contaminated``.

    A document is contaminated if any word is hit and hit words are at least a twentieth of all.
    """
    found = find_phrases(docs, benchmark, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    found = replace_columns(found, n_hit=hit, n_items=F.size("items").cast("long"), items_sha256=F.sha2(F.concat_ws(",", F.array_sort("items")), 256))
    return replace_columns(found, contaminated=(F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
