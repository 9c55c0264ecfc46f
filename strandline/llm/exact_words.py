"""Words and lines of a chunk of texts as exact numbers: equal bytes have equal numbers, different bytes different ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa


def byte_set(chars: bytes) -> np.ndarray:
    """A table that is true at the given bytes."""
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


#: The blanks between words: space and \\x09 to \\x0D.
BLANK = byte_set(b" \t\n\x0b\f\r")


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes, ended at the borders of texts: (first byte, end byte, text of each run)."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    border = np.zeros(len(inside) + 1, bool)
    border[offs] = True
    starts = inside & (border[:-1] | ~np.concatenate([[False], inside[:-1]]))
    ends = inside & (border[1:] | ~np.concatenate([inside[1:], [False]]))
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def interned(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each slice of data, and the distinct slices (binary) by number.  Slices are in order and don't overlap."""
    size = ends - starts
    mark = np.zeros(len(data) + 1, np.int8)
    mark[starts] += 1
    mark[ends] -= 1
    body = data[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key in order of first appearance, and the distinct keys."""
    return pd.factorize(key)


def per_text(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """True bytes of each text."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def gathered(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together, in order, until their texts have limit bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(len(b) for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
