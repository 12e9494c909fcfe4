"""Token counts by section: texts are encoded whole, and tokens attributed by their place.

Encoding sections one by one counts other tokens than training will see, as merges stop at the cuts.  Here a
document is encoded once; the byte lengths of its tokens give their spans; the spans are joined with the
spans of sections; and a token across a boundary goes where a stated rule says.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buffers import slices, text_buffer

#: How byte-level BPE of this family cuts a text into pieces (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "most")
_encodings: dict[int, tuple[tiktoken.Encoding, np.ndarray]] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _encoding(name: int, ranks: dict[bytes, int]) -> tuple[tiktoken.Encoding, np.ndarray]:
    if name not in _encodings:
        sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for piece, rank in ranks.items():
            sizes[rank] = len(piece)
        _encodings[name] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes
    return _encodings[name]


def attribute(ends: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section and tokens across a boundary, from the ends of tokens and of sections (in bytes).

    ``first``: a token belongs to the section of its first byte; ``last``: of its last; ``most``: to
    the one that holds most of its bytes, the first of equals.  Both lists are ascending and end alike.
    """
    begins = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(sections, begins, side="right")
    last = np.searchsorted(sections, ends - 1, side="right")
    place = last if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        for t in crossing:
            cuts = np.concatenate([[begins[t]], sections[first[t] : last[t]], [ends[t]]])
            place[t] = first[t] + int(np.argmax(np.diff(cuts)))
    return np.bincount(place, minlength=len(sections)), len(crossing)


def section_tokens(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", rule: str = "most", boundary: bytes = b"\n") -> DataFrame:
    """``docs`` with ``n_tokens, n_sections, section_tokens, n_crossing``.

    A section ends after each ``boundary`` and at the end of the text; empty texts and null have no section
    and no token.  ``section_tokens`` adds up to ``n_tokens``.  The vocabulary is broadcast: its size is that of the
    tokenizer's file.  Rows are not shuffled.  Input columns with these names are replaced.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = ["n_tokens", "n_sections", "section_tokens", "n_crossing"]
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names])
    place = source.columns.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), "n_tokens bigint, n_sections bigint, section_tokens array<bigint>, n_crossing bigint"])
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    name = sent._jbroadcast.id() if hasattr(sent, "_jbroadcast") else id(sent)

    def count(raw: bytes) -> tuple[int, list[int], int]:
        encoding, sizes = _encoding(name, sent.value)
        if not raw:
            return 0, [], 0
        ends = np.cumsum(sizes[encoding.encode_to_numpy(raw.decode(), allowed_special=set(), disallowed_special=())])
        cuts = np.array([i + 1 for i in _places(raw, boundary)], dtype=np.int64)
        sections = cuts if len(cuts) and cuts[-1] == len(raw) else np.append(cuts, len(raw))
        tokens, crossing = attribute(ends, sections, rule)
        return len(ends), tokens.tolist(), crossing

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                data, bounds = text_buffer(part.column(place))
                raw = data.tobytes()
                found = [count(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                new = [pa.array([x[0] for x in found], pa.int64()), pa.array([len(x[1]) for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.int64())), pa.array([x[2] for x in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])

    return source.mapInArrow(task, schema)


def _places(raw: bytes, mark: bytes) -> np.ndarray:
    """Places of the last byte of each mark."""
    if len(mark) == 1:
        return np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == mark[0])
    found, at = [], raw.find(mark)
    while at >= 0:
        found.append(at + len(mark) - 1)
        at = raw.find(mark, at + len(mark))
    return np.array(found, dtype=np.int64)
