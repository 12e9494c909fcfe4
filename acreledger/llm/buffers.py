"""Texts of an Arrow column as one numpy buffer, and words in it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are treated in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows together, and where each begins; null is empty."""
    array = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have ``most`` bytes together, or one row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        used = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, used + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def byte_table(values) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


def words_in(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each run of marked bytes within a row, and the number of runs before each row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    firsts = bounds[:-1][bounds[:-1] < len(mask)]
    before[firsts] = False
    begins = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    after[lasts] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return begins, ends, np.searchsorted(begins, bounds)
