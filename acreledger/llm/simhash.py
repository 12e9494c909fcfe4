"""SimHash near-duplicates through a hierarchical index in Gray order.

Distinct fingerprints are sorted by the rank they have in a Gray code, where neighbours share most of their
bits, and cut into shards.  Over a shard's sorted list stands a tree: a node holds the bits that all
fingerprints below it share and its parent's do not.  A search adds up the differing bits on its way down and
leaves a whole group as soon as they exceed the limit.  The roots of the shards are the leaves of a tree of the same
kind: a fingerprint walks it and is sent only to shards whose shared bits it can match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreledger.session import cut_lineage

from .buffers import slices, text_buffer
from .components import components

SEED = 42
FAN_OUT = 8
#: Queries that walk the tree together, and pairs of queries and nodes that are looked at in one step.
CHUNK, PAIRS = 2048, 1 << 19


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        begins, ends = begins[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        begins, ends = begins[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(begins), 65536):  # a long text in parts
        part = zip(begins[at : at + 65536].tolist(), ends[at : at + 65536].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(begins)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint as a signed long.

    Words are separated by ASCII white space, A-Z count as small.  A text of fewer words than a shingle has one
    shingle of all of them; null and empty texts have fingerprint 0.  An input column ``fp`` is replaced.
    """
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "fp"])
    place = source.columns.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), "fp bigint"])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                data, bounds = text_buffer(part.column(place))
                raw = data.tobytes()
                found = [fingerprint(raw[a:b], shingle) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                new = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, new], [*part.schema.names, "fp"])

    return source.mapInArrow(task, schema)


def gray_rank(x):
    """Place of a fingerprint in the Gray code (a Spark column)."""
    for step in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, step))
    return x


class GrayTree:
    """Index over fingerprints (unsigned) that are in Gray order, or over groups of them with the bits all or any have."""

    def __init__(self, fps: np.ndarray, any_bits: np.ndarray | None = None):
        levels = [(fps, fps if any_bits is None else any_bits)]
        while len(levels[-1][0]) > 1:
            low, high = levels[-1]
            at = np.arange(0, len(low), FAN_OUT)
            levels.append((np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)))
        self.levels = []
        above = np.zeros(1, dtype=np.uint64)
        for low, high in reversed(levels):
            shared = ~(low ^ high)
            if self.levels:
                above = np.repeat(above, FAN_OUT)[: len(shared)]
            self.levels.append((shared & ~above, low))
            above = shared

    def leaves(self, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place of the query, place of the leaf) whose shared bits differ in at most ``most`` bits, in blocks."""
        label = np.append(np.zeros(len(self.levels[-1][0]), dtype=np.int8), np.int8(1))
        return self._walk(queries, most, label, np.full(len(queries), len(label) - 1), False)

    def within(self, queries: np.ndarray, most: int, label: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place of the query, place of the fingerprint) that differ in at most ``most`` bits, in blocks.

        ``label`` holds a group number for every place, fingerprints first, and may change between blocks;
        ``places`` are those of the queries.  A node whose fingerprints all have the query's label is left too,
        as it could add no new link.  The search goes down in pieces of at most ``PAIRS`` pairs, so its memory
        does not depend on how many fingerprints lie close together.
        """
        return self._walk(queries, most, label, places, True)

    def _walk(self, queries: np.ndarray, most: int, label: np.ndarray, places: np.ndarray, placed: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lows = [label[: len(self.levels[-1][0])].copy()]
        highs = [lows[0]]
        while len(lows[-1]) > 1:
            at = np.arange(0, len(lows[-1]), FAN_OUT)
            lows.append(np.minimum.reduceat(lows[-1], at))
            highs.append(np.maximum.reduceat(highs[-1], at))
        lows, highs = lows[::-1], highs[::-1]
        last = len(self.levels) - 1
        todo = [(0, np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64), np.zeros(len(queries), dtype=np.uint8))]
        while todo:
            depth, query, node, gone = todo.pop()
            if depth:
                if len(query) > 1 and len(query) * FAN_OUT > PAIRS:
                    half = len(query) // 2
                    todo += [(depth, query[half:], node[half:], gone[half:]), (depth, query[:half], node[:half], gone[:half])]
                    continue
                query, gone = np.repeat(query, FAN_OUT), np.repeat(gone, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                real = node < len(lows[depth])
                query, gone, node = query[real], gone[real], node[real]
            mask, bits = self.levels[depth]
            gone = gone + np.bitwise_count((queries[query] ^ bits[node]) & mask[node])
            mine = label[places[query]]
            near = (gone <= most) & ((lows[depth][node] != mine) | (highs[depth][node] != mine))
            query, gone, node = query[near], gone[near], node[near]
            if depth == last:
                yield places[query] if placed else query, node
            elif len(query):
                todo.append((depth + 1, query, node, gone))


def spanning_links(own: np.ndarray, everyone: np.ndarray, most: int, agree=None) -> tuple[np.ndarray, np.ndarray]:
    """Links (place, smallest place of its component) that connect what is near; ``everyone`` begins with ``own``.

    ``agree`` may reject pairs of places.  Queries come in growing chunks, and what is connected already is not
    compared again, so a large group of copies costs about its size, not its square.
    """
    tree, label = GrayTree(own), np.arange(len(everyone))
    at, size = 0, 16
    while at < len(everyone):
        places = np.arange(at, min(at + size, len(everyone)))
        for a, b in tree.within(everyone[places], most, label, places):
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
            if agree is not None:
                fine = agree(a, b)
                a, b = a[fine], b[fine]
            while len(a):
                x, y = label[a], label[b]
                apart = x != y
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                if not len(a):
                    break
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(up := label[label], label):
                    label[:] = up
        at, size = at + size, min(size * 4, CHUNK)
    nodes = np.flatnonzero(label != np.arange(len(label)))
    return nodes, label[nodes]


def ranks_of(fps: np.ndarray) -> np.ndarray:
    rank = fps.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


def gray_order(fp: Column) -> Column:
    """Place in the Gray code as a signed long: the upper half of the code comes after the lower."""
    return gray_rank(fp).bitwiseXOR(F.lit(-(1 << 63)))


def _placed(classes: DataFrame, per_shard: int, count: int) -> DataFrame:
    """``fp, shard``: shards of about ``per_shard`` fingerprints, bounded by quantiles of the Gray order.

    Shards follow from the rows alone, not from a number of partitions.  The quantiles, one per shard, are what the
    driver sees.
    """
    shards = max(1, -(-count // per_shard))
    ordered = classes.select("fp", gray_order(F.col("fp")).alias("at"))
    if shards == 1:
        return ordered.select("fp", F.lit(0).alias("shard"))
    steps = [i / shards for i in range(1, shards)]
    cuts = np.unique(np.array(ordered.agg(F.percentile_approx("at", steps, max(10_000, 20 * shards))).first()[0] or [], dtype=np.int64))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = np.searchsorted(cuts, batch.column(1).to_numpy(), side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard)], ["fp", "shard"])

    return ordered.mapInArrow(task, "fp long, shard int")


def hosts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In which of two shards they meet: in the lower if their numbers differ by an odd number, else in the upper."""
    return np.where((a + b) % 2 == 1, np.minimum(a, b), np.maximum(a, b))


def near_links(classes: DataFrame, most: int = 2, per_shard: int = 50_000, rows: int | None = None) -> DataFrame:
    """``u, v``: links that connect all distinct fingerprints at most ``most`` bits apart.

    ``classes`` has one row per fingerprint ``fp``.  A fingerprint visits the shards whose roots it can match; two shards
    meet in one of them, by their numbers, so visitors are spread evenly.  With random fingerprints and 2**s shards
    these are at most (s + s*(s-1)/2) / 2 for two bits.  Visitors of a shard are dealt over as many groups as
    hold twice ``per_shard`` each, and every group has the shard's own fingerprints, so no task holds more than
    about three times ``per_shard``.  Each group returns a spanning forest of the links that it finds, not the links, so a
    dense group costs a row per member.  The driver and the broadcast hold one row per shard.
    """
    placed = cut_lineage(_placed(classes, per_shard, classes.count() if rows is None else rows))
    roots = placed.groupBy("shard").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("shard").collect()
    low = np.array([r["low"] for r in roots], dtype=np.int64).view(np.uint64)
    high = np.array([r["high"] for r in roots], dtype=np.int64).view(np.uint64)
    names = np.array([r["shard"] for r in roots], dtype=np.int32)
    sent = placed.sparkSession.sparkContext.broadcast((names, low, high))

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high = sent.value
        tree = GrayTree(low, high)
        for batch in batches:
            fps, home = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            for q, leaf in tree.leaves(fps, most):
                there = names[leaf]
                host = (there != home[q]) & (hosts(home[q], there) == there)
                q, there = q[host], there[host]
                yield pa.RecordBatch.from_arrays([pa.array(fps[q].view(np.int64)), pa.array(there)], ["fp", "shard"])

    if len(roots) > 1:
        visits = cut_lineage(placed.mapInArrow(visit, "fp long, shard int"))
        groups = visits.groupBy("shard").agg(F.ceil(F.count("*") / (2 * per_shard)).cast("int").alias("salts"))
        visits = visits.join(groups, "shard").select("shard", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int").alias("salt"), "fp", F.lit(False).alias("member"))
        salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
        members = placed.join(groups, "shard", "left").select("shard", salts.alias("salt"), "fp", F.lit(True).alias("member"))
        dealt = members.union(visits)
    else:
        dealt = placed.select("shard", F.lit(0).alias("salt"), "fp", F.lit(True).alias("member"))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        member = part["member"].to_numpy()
        fps = part["fp"].to_numpy().view(np.uint64)
        own, others = fps[member], fps[~member]
        own = own[np.argsort(ranks_of(own))]
        everyone = np.concatenate([own, others])
        u, v = spanning_links(own, everyone, most) if len(own) else (np.zeros(0, np.int64),) * 2
        return pd.DataFrame({"u": everyone[u].view(np.int64), "v": everyone[v].view(np.int64)})

    return dealt.groupBy("shard", "salt").applyInPandas(search, "u long, v long")


def near_classes(marked: DataFrame, least: Column, most: int) -> DataFrame:
    """``fp, least, star``: for each fingerprint the least of its rows and the smallest fingerprint it reaches."""
    classes = marked.groupBy("fp").agg(F.min(least).alias("least"))
    stars = components(near_links(classes.select("fp"), most))
    named = classes.join(stars, classes["fp"] == stars["node"], "left")
    return named.select("fp", "least", F.coalesce("component", "fp").alias("star"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, most: int = 2) -> DataFrame:
    """``key, fp, component_id`` per row: the smallest key that the row's fingerprint reaches over links.

    Fingerprints link if they differ in at most ``most`` bits; equal ones, also those of texts without words,
    are one class, so copies are never compared.  A null key takes part but names no component unless
    the component has no other.  Other input columns do not matter.  An empty input gives no rows.
    """
    slim = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    marked = cut_lineage(fingerprints(slim, "_text", shingle).select("_key", "fp"))
    named = near_classes(marked, F.col("_key"), most)
    smallest = named.groupBy(F.col("star").alias("_star")).agg(F.min("least").alias("component_id"))
    found = named.join(smallest, F.col("star") == F.col("_star")).select(F.col("fp").alias("_fp"), "component_id")
    return marked.join(found, F.col("fp") == F.col("_fp")).select(F.col("_key").alias(key), "fp", "component_id")


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, most: int = 2) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the smallest key.

    Groups are those of ``near_duplicates``.  Texts without words are equal, null ones too.  A null key is larger than
    all others; equal rows are reduced to one; rows of one key with different texts are judged as different documents.
    All input columns come back, whatever their names.  An empty input gives no rows.
    """
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.col(f"`{text}`").alias("text"))
    marked = cut_lineage(fingerprints(slim, "text", shingle).select("key", "mark", "fp"))
    named = near_classes(marked, F.struct(F.col("key").isNull().alias("none"), "key", "mark"), most)
    chosen = cut_lineage(named.groupBy("star").agg(F.min("least").alias("first")).select("first.key", "first.mark"))
    kept = docs.join(chosen, docs[f"`{key}`"].eqNullSafe(chosen["key"]) & (F.xxhash64(docs[f"`{text}`"]) == chosen["mark"]), "left_semi")
    repeated = marked.groupBy("key", "mark").count().filter("count > 1")
    return kept.dropDuplicates([key, text]) if not repeated.isEmpty() else kept


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
