"""Text columns of Arrow batches as flat byte arrays.

A task sees a whole partition as a stream of record batches. The helpers below
cut each batch into slices of bounded size (a single longer text is a slice of
its own) and give the bytes of a slice as one numpy array with row offsets, so
per-byte work is vectorised and memory is bounded by the slice, not by the
partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# What tasks of one operator leave in a Python worker for its next ones.
CACHES: list = []


def forget() -> None:
    """Drop what other operators' tasks left in this worker."""
    for cache in CACHES:
        cache.cache_clear()


@dataclass
class TextSlice:
    rows: pa.RecordBatch     # the rows of the slice, all columns
    data: np.ndarray         # uint8, texts back to back (null: empty)
    offsets: np.ndarray      # int64, len(rows) + 1, into data

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off_buf, data_buf = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(off_buf, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[TextSlice]:
    """Slices of at most ``max_bytes`` of text, at least one row each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, off = flat(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, batch.num_rows
        while i < n:
            j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield TextSlice(batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i])
            i = j


def ragged(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and row lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... (lengths[i] of them), concatenated."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    base = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return base + np.arange(total, dtype=np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 values."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
