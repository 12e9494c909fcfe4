"""Removal of repeated passages by suffix arrays of shards.

A passage is a string of ``length`` bytes.  To compare passages of all documents, equal ones must meet.
Each passage is dealt by its least ``GRAM``-byte piece (by a hash), so consecutive passages mostly go
together: a run of passages with one such anchor is a segment, a text of some 65 bytes.

1. Texts are written in blocks of some megabytes to the shared folder; later steps read their block there.
2. Each block sends the hashes of its anchors to shards, once each, and learns which of them another
   document also has.  Segments of other anchors hold nothing that repeats.
3. The remaining segments go to their shards, equal ones of a block once, with their smallest document.
4. A shard leaves aside passages that only one of its distinct segments can hold, and builds the suffix array of
   the others by induced sorting, and the permuted common prefixes.  Neighbours that share ``length`` bytes are
   one passage; its smallest document is a minimum.
5. The block gets the minima of its segments' passages back and removes what a smaller document has.

Steps 2 to 4 send a block's share of a shard in one row, so a passage that a third of all documents have
costs a row per block, wherever it lies; nothing is sampled or cut.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .buffers import slices, text_buffer
from .suffixes import permuted_lcp, suffix_array, words_at
from .warc import _Output, _place

#: Bytes of an anchor's piece; a passage of n bytes has n - GRAM + 1 of them.
GRAM = 16
#: Passages are looked at in stretches of so many, and blocks hold about so many bytes of text.
STRETCH, BLOCK = 1 << 20, 8 << 20
#: Bytes of text per shard.
SHARD = 6 << 20
#: A shard's passages are told apart by what lies round their anchors, in so many ranges of the anchor's place.
PARTS = 4
END = 0xFF  # no byte of UTF-8
NO_KEY = np.iinfo(np.int64).max  # a null key is larger than all others
_LOW = np.uint64((1 << 24) - 1)


def write_blocks(docs: DataFrame, folder: str, key: str, text: str) -> DataFrame:
    """``block, path, bytes``: texts and keys as Arrow files of about ``BLOCK`` bytes each, in order of reading."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0

        def flush():
            nonlocal held, size, number
            name = f"{TaskContext.get().partitionId()}-{number}"
            out = _Output(f"{folder}/{name}.arrow")
            table = pa.Table.from_batches(held)
            buffer = pa.BufferOutputStream()
            with ipc.new_file(buffer, table.schema, options=ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            out.write(buffer.getvalue())
            out.close()
            done = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([f"{folder}/{name}.arrow"]), pa.array([size])], ["block", "path", "bytes"])
            held, size, number = [], 0, number + 1
            return done

        for batch in batches:
            for part in slices(batch, 1, BLOCK):
                held.append(pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.large_string())], ["key", "text"]))
                size += len(text_buffer(part.column(1))[0])
                if size >= BLOCK // 2:
                    yield flush()
        if held:
            yield flush()

    return source.mapInArrow(task, "block string, path string, bytes bigint")


def load_block(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Bytes, bounds of rows, keys as numbers, keys."""
    fs, name = _place(path)
    with fs.open_input_file(name) as file:
        table = ipc.open_file(file).read_all().combine_chunks()
    data, bounds = text_buffer(table["text"].combine_chunks())
    keys = table["key"].combine_chunks()
    return data, bounds, keys.fill_null(NO_KEY).to_numpy(), keys


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First passage, number of passages, anchor hash and anchor's place of each segment.

    A passage's anchor is its piece with the least hash, the leftmost of equals: it depends on the passage
    alone.  Work is done in stretches, so memory does not grow with a text.
    """
    width = length - GRAM + 1
    ends = bounds[1:]
    firsts, counts, hashes, places = [], [], [], []
    for at in range(0, max(0, len(data) - length + 1), STRETCH):
        piece = data[at : at + STRETCH + length - 1]
        eight = words_at(piece)
        n = len(piece) - GRAM + 1
        h = eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ eight[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        least = _slide((h & ~_LOW) | np.arange(n, dtype=np.uint64), width)
        anchor = (least & _LOW).astype(np.int64)
        # passages that lie within a row; between those of two rows there is always another place
        upto = at + len(least)
        some = np.arange(np.searchsorted(ends, at, side="right"), min(np.searchsorted(ends, upto - 1, side="right") + 1, len(ends)))
        open_, shut = np.maximum(bounds[some], at), np.minimum(ends[some] - length + 1, upto)
        some = open_ < shut
        step = np.zeros(len(least) + 1, dtype=np.int8)
        step[open_[some] - at] = 1
        step[shut[some] - at] = -1
        whole = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        new = np.ones(len(least), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
        begin = np.flatnonzero(new & whole)
        stop = np.flatnonzero((new | ~whole)[1:]) + 1
        stop = np.append(stop, len(least))
        end = stop[np.searchsorted(stop, begin, side="right")]
        firsts.append(begin + at)
        counts.append(end - begin)
        hashes.append(h[anchor[begin]])
        places.append(anchor[begin] + at)
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(hashes), np.concatenate(places)


def _by_shard(hashes: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shard and the places of its hashes, in order of the hashes; none where a block has no passage."""
    if not len(hashes):
        return
    shard = (hashes % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((hashes, shard))
    cut = np.flatnonzero(np.concatenate([[True], shard[order][1:] != shard[order][:-1]]))
    for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
        yield int(shard[order[a]]), order[a:b]


def _anchors(path: str, length: int):
    """A block's distinct anchors, whether two of its rows have them, and the segments by anchor."""
    data, bounds, keys, ids = load_block(path)
    first, count, hashes, place = segments(data, bounds, length)
    row = np.searchsorted(bounds[1:], first, side="right")
    distinct, number = np.unique(hashes, return_inverse=True)
    low, high = np.full(len(distinct), NO_KEY), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, number, keys[row])
    np.maximum.at(high, number, keys[row])
    return data, bounds, keys, ids, first, count, place - first, row, distinct, number, low != high


def _contents(data, first, count, length) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a : a + n + length - 1] for a, n in zip(first.tolist(), count.tolist(), strict=True)]


def _middles(eight: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (eight or more) at each place."""
    h = np.zeros(len(at), dtype=np.uint64)
    for k in [*range(0, size - 8, 8), size - 8]:
        h = (h ^ eight[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _several(values: np.ndarray) -> np.ndarray:
    """Whether a value is there more than once."""
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    return (times > 1)[number]


def common_parts(data: np.ndarray, start: np.ndarray, count: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first passage and number of passages of the stretches of distinct segments that others may share.

    A passage that two segments have lies alike round its anchor in both.  All passages with the anchor at ``low`` to
    ``high`` bytes from their begin have the bytes from ``low`` before it in common; where no other segment has these,
    no other has one of the passages.  Equal hashes only keep more.
    """
    slack = length - GRAM
    eight = words_at(data)
    cuts = np.linspace(0, slack + 1, min(PARTS, slack + 1) + 1).astype(np.int64)
    owners, firsts, counts = [], [], []
    for low, high in zip(cuts[:-1].tolist(), (cuts[1:] - 1).tolist(), strict=True):
        # passage k of a segment has its anchor at place - k
        a, b = np.maximum(place - high, 0), np.minimum(place - low, count - 1)
        there = np.flatnonzero(a <= b)
        there = there[_several(_middles(eight, start[there] + place[there] - low, length - high + low))]
        owners.append(there)
        firsts.append(a[there])
        counts.append((b - a)[there] + 1)
    owner, first, number = np.concatenate(owners), np.concatenate(firsts), np.concatenate(counts)
    order = np.lexsort((first, owner))
    owner, first, number = owner[order], first[order], number[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (first[1:] != first[:-1] + number[:-1])
    head = np.flatnonzero(new)
    return owner[head], first[head], np.add.reduceat(number, head) if len(head) else number


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several ranges, one after the other."""
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


def passage_minima(texts: list[bytes], least: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For each passage of distinct segments, one after the other, the smallest key that has it.

    ``place`` is the anchor's in the segment, ``least`` the segment's smallest key.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    start = np.cumsum(size) - size
    passages = size - length + 1
    minima = np.repeat(least, passages)
    owner, first, count = common_parts(data, start, passages, place, length)
    if len(owner):
        at = np.cumsum(passages)[owner] - passages[owner] + first
        parts = data[_ranges(start[owner] + first, count + length - 1)]
        minima[_ranges(at, count)] = _sorted_minima(parts, count, least[owner], length)
    return minima


def _sorted_minima(parts: np.ndarray, count: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """The minima of the passages of ``parts`` by their suffix array; ``count`` are the passages of each."""
    size = count + length  # with an end mark
    start = np.cumsum(size) - size
    data = np.full(size.sum(), END, dtype=np.uint8)
    data[_ranges(start, size - 1)] = parts
    sa = suffix_array(data)
    shared = permuted_lcp(data, sa)
    passage = _ranges(start, count)
    whole = np.zeros(len(data), dtype=bool)
    whole[passage] = True
    value = np.empty(len(data), dtype=np.int64)
    value[passage] = np.repeat(least, count)
    # passages in their order: equal ones have only each other between them
    rank = np.flatnonzero(whole[sa])
    at = sa[rank]
    joined = np.zeros(len(at), dtype=bool)
    joined[1:] = (shared[at[1:]] >= length) & (np.diff(rank) == 1)
    head = np.flatnonzero(~joined)
    value[at] = np.repeat(np.minimum.reduceat(value[at], head), np.diff(np.append(head, len(at))))
    return value[passage]


def remove_repeats(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", length: int = 50, with_text: bool = False) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, spans, kept_sha256`` per document, and ``kept`` if wanted.

    A byte goes if a string of ``length`` bytes covers it that also starts in a document with a smaller key;
    strings are judged on the input.  ``spans`` are the maximal removed runs in bytes of the UTF-8 text, ``kept`` the
    rest (bytes: a cut may fall within a character).  Null texts are empty.  A null key is larger than all
    others; rows of one key do not remove from each other.  Keys are whole numbers.  Blocks of text are written below
    ``folder``, which all executors must reach; it is the caller's to remove when the result has been read.
    """
    spark = docs.sparkSession
    if length < GRAM + 1:
        raise ValueError(f"length must be above {GRAM}")
    blocks = cut_lineage(write_blocks(docs, f"{folder}/{uuid.uuid4().hex}", key, text))
    count, total = blocks.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    shards = max(1, -(-total // SHARD))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = max(1, min(count, max(least, count // 4)))
    blocks = blocks.repartition(spread)

    def send(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for block, path in zip(part["block"], part["path"], strict=True):
                *_, distinct, _, twice = _anchors(path, length)
                rows = [(p, block, path, (distinct[x] >> np.uint64(16)).astype("<u4").tobytes() + (distinct[x] & np.uint64(0xFFFF)).astype("<u2").tobytes(), np.packbits(twice[x]).tobytes()) for p, x in _by_shard(distinct, shards)]
                yield pd.DataFrame(rows, columns=["shard", "block", "path", "hashes", "twice"])

    def find(part: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(x) // 6 for x in part["hashes"]]
        top = [np.frombuffer(x, dtype="<u4", count=n) for x, n in zip(part["hashes"], sizes, strict=True)]
        low = [np.frombuffer(x, dtype="<u2", offset=4 * n) for x, n in zip(part["hashes"], sizes, strict=True)]
        short = (np.concatenate(top).astype(np.uint64) << np.uint64(16)) | np.concatenate(low)
        twice = np.concatenate([np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=n) for x, n in zip(part["twice"], sizes, strict=True)]).astype(bool)
        distinct, number, times = np.unique(short, return_inverse=True, return_counts=True)
        shared = times > 1
        shared[number[twice]] = True
        bits = np.split(shared[number], np.cumsum(sizes)[:-1])
        return pd.DataFrame({"shard": part["shard"], "block": part["block"], "path": part["path"], "shared": [np.packbits(b).tobytes() for b in bits]})

    def wanted(path: str, shard, shared):
        """The block's segments whose anchors are shared, with their shard."""
        data, bounds, keys, ids, first, count, place, row, distinct, number, _ = _anchors(path, length)
        keep = np.zeros(len(distinct), dtype=bool)
        replies = dict(zip(shard, shared, strict=True))
        for p, x in _by_shard(distinct, shards):
            if p in replies:
                keep[x] = np.unpackbits(np.frombuffer(replies[p], dtype=np.uint8), count=len(x)).astype(bool)
        use = np.flatnonzero(keep[number])
        return data, bounds, keys, ids, first[use], count[use], place[use], row[use], (distinct[number[use]] % np.uint64(shards)).astype(np.int64)

    def classes(data, first, count, place, row, shard, keys):
        """Distinct segments of a block: their number for each segment, text, anchor's place, shard and smallest key."""
        names: dict[bytes, int] = {}
        number = np.array([names.setdefault(t, len(names)) for t in _contents(data, first, count, length)], dtype=np.int64)
        smallest = np.full(len(names), NO_KEY)
        np.minimum.at(smallest, number, keys[row])
        anchor, home = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        anchor[number], home[number] = place, shard
        return number, list(names), anchor, home, smallest

    def forward(part: pd.DataFrame) -> pd.DataFrame:
        data, _, keys, _, *found, shard = wanted(part["path"].iloc[0], part["shard"], part["shared"])
        _, texts, anchor, home, smallest = classes(data, *found, shard, keys)
        order = np.argsort(home, kind="stable")
        rows, block = [], part["block"].iloc[0]
        for p, x in ((int(home[x[0]]), x) for x in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if len(x)):
            some = [texts[i] for i in x]
            rows.append((p, block, np.array([len(t) for t in some], dtype="<u4").tobytes(), b"".join(some), anchor[x].astype("<u4").tobytes(), smallest[x].astype("<i8").tobytes()))
        return pd.DataFrame(rows, columns=["shard", "block", "sizes", "texts", "places", "least"])

    def sort(part: pd.DataFrame) -> pd.DataFrame:
        names: dict[bytes, int] = {}
        numbers, smallest = [], []
        for sizes, texts, least in zip(part["sizes"], part["texts"], part["least"], strict=True):
            ends = np.cumsum(np.frombuffer(sizes, dtype="<u4")).tolist()
            numbers.append([names.setdefault(texts[a:b], len(names)) for a, b in zip([0, *ends[:-1]], ends, strict=True)])
            smallest.append(np.frombuffer(least, dtype="<i8"))
        every = np.concatenate([np.array(x, dtype=np.int64) for x in numbers])
        low, place = np.full(len(names), NO_KEY), np.zeros(len(names), dtype=np.int64)
        np.minimum.at(low, every, np.concatenate(smallest))
        place[every] = np.concatenate([np.frombuffer(x, dtype="<u4") for x in part["places"]])
        texts = list(names)
        value = passage_minima(texts, low, place, length)
        # runs of equal minima within each text
        passages = np.array([len(t) - length + 1 for t in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), passages)
        offset = _ranges(np.zeros(len(texts), dtype=np.int64), passages)
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (offset[1:] == 0)
        head = np.flatnonzero(new)
        runs = np.bincount(owner[head], minlength=len(texts))
        run_from = np.cumsum(runs) - runs
        size = np.diff(np.append(head, len(value)))
        rows = []
        for block, shard, number in zip(part["block"], part["shard"], numbers, strict=True):
            x = np.array(number, dtype=np.int64)
            pick = _ranges(run_from[x], runs[x])
            rows.append((block, shard, runs[x].astype("<u4").tobytes(), size[pick].astype("<u4").tobytes(), value[head[pick]].astype("<i8").tobytes()))
        return pd.DataFrame(rows, columns=["block", "shard", "runs", "sizes", "minima"])

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        shared = part[part["shared"].notna()]
        data, bounds, keys, ids, first, count, place, row, shard = wanted(part["path"].dropna().iloc[0], shared["shard"], shared["shared"])
        gone = np.zeros(len(data) + 1, dtype=np.int32)
        if len(first):
            number, _, _, home, _ = classes(data, first, count, place, row, shard, keys)
            order = np.argsort(home, kind="stable")
            back = part[part["runs"].notna()]
            runs = np.concatenate([np.frombuffer(x, dtype="<u4") for x in back["runs"]]).astype(np.int64)
            size = np.concatenate([np.frombuffer(x, dtype="<u4") for x in back["sizes"]]).astype(np.int64)
            value = np.concatenate([np.frombuffer(x, dtype="<i8") for x in back["minima"]])
            run_from = np.empty(len(order), dtype=np.int64)
            run_of = np.empty(len(order), dtype=np.int64)
            run_from[order], run_of[order] = np.cumsum(runs) - runs, runs
            n = run_of[number]
            pick = _ranges(run_from[number], n)
            upto = np.cumsum(size[pick])
            base = np.repeat(np.cumsum(count) - count, n)  # sizes of a segment's runs add up to its passages
            begin = np.repeat(first, n) + upto - size[pick] - base
            smaller = value[pick] < keys[np.repeat(row, n)]
            begin, size = begin[smaller], size[pick][smaller]
            np.add.at(gone, begin, 1)
            np.subtract.at(gone, begin + size + length - 1, 1)
        mask = np.cumsum(gone[:-1]) > 0
        before = np.concatenate([[False], mask[:-1]]) if len(mask) else mask
        before[bounds[:-1][bounds[:-1] < len(mask)]] = False
        after = np.concatenate([mask[1:], [False]]) if len(mask) else mask
        after[bounds[1:][bounds[1:] > 0] - 1] = False
        begins, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
        cuts = np.searchsorted(begins, bounds)
        rows = []
        for r, k in enumerate(ids.to_pylist()):
            a, b = bounds[r], bounds[r + 1]
            spans = [{"begin": int(x - a), "end": int(y - a)} for x, y in zip(begins[cuts[r] : cuts[r + 1]], ends[cuts[r] : cuts[r + 1]], strict=True)]
            kept = data[a:b][~mask[a:b]].tobytes()
            rows.append((k, int(b - a), int(b - a) - len(kept), len(spans), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        frame = pd.DataFrame(rows, columns=["key", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])
        return frame.astype({"key": "Int64"})

    sent = blocks.mapInPandas(send, "shard long, block string, path string, hashes binary, twice binary")
    # as many partitions as the bytes ask for, whatever the session's number is
    replies = cut_lineage(sent.repartition(shards, "shard").groupBy("shard").applyInPandas(find, "shard long, block string, path string, shared binary"))
    forwarded = replies.repartition(spread, "block").groupBy("block").applyInPandas(forward, "shard long, block string, sizes binary, texts binary, places binary, least binary")
    results = forwarded.repartition(shards, "shard").groupBy("shard").applyInPandas(sort, "block string, shard long, runs binary, sizes binary, minima binary")
    nothing = [F.lit(None).cast("binary").alias(c) for c in ("runs", "sizes", "minima")]
    gathered = (
        replies.select("block", "shard", "path", "shared", *nothing)
        .union(blocks.select("block", F.lit(-1).cast("long"), "path", F.lit(None).cast("binary"), *nothing))
        .union(results.select("block", "shard", F.lit(None).cast("string"), F.lit(None).cast("binary"), "runs", "sizes", "minima"))
    )
    schema = "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<begin:bigint,end:bigint>>, kept_sha256 string, kept binary"
    found = gathered.repartition(spread, "block").groupBy("block").applyInPandas(cut, schema).withColumnRenamed("key", key)
    return found if with_text else found.drop("kept")
