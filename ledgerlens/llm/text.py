"""Words, hashes and ragged arrays over Arrow text columns (numpy, inside Spark tasks).

All helpers work on one slice of a record batch at a time, so a task's memory is bounded by
``SLICE_BYTES`` plus its longest single text.  Texts are taken whole; null counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once.
SLICE_BYTES = 2 << 20
#: Elements of list columns handled at once.
SLICE_ELEMENTS = 1 << 21
#: Elements that get 64-bit numbers of their own (places, terms of hashes) at once.
WIDE = 1 << 18

U64 = np.uint64


#: What a worker keeps from task to task and other operators' tasks in the same worker have no use for.
KEPT: list[dict] = []


def release() -> None:
    """Give back what earlier operators' tasks left in this worker."""
    if any(KEPT):
        for kept in KEPT:
            kept.clear()
        trim()


def trim() -> None:
    """Give back freed memory: a worker outlives its task, and its executor holds several of them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: its memory stays with the process
        pass


def slices(batches: Iterator[pa.RecordBatch], *texts: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut each record batch into consecutive row ranges of about ``most`` bytes in the columns ``texts`` together."""
    texts = texts or ("text",)
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = sum(pc.fill_null(pc.binary_length(batch.column(t)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
        part = (np.cumsum(size + 16) - 1) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)
    batch = None
    trim()


def list_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_ELEMENTS) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into row ranges of about ``most`` elements of a list column."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(size.astype(np.int64) + 1) - 1) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(lo, hi - lo)


def list_bounds(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """(elements, offsets) of a list column; null is empty."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.concatenate([[0], np.cumsum(size, dtype=np.int64)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Space and the controls 9-13.
BLANKS = separators(bytes([32, 9, 10, 11, 12, 13]))
#: Every ASCII byte that is no letter; bytes of other scripts belong to words.
NON_LETTERS = separators(bytes(b for b in range(128) if not chr(b).isalpha()))
#: Every ASCII byte that is neither letter nor digit.
NON_ALNUM = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


@dataclass
class Words:
    """Words of a column: byte ranges ``[start, end)`` in ``data``; ``doc`` is the row of each."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    offsets: np.ndarray

    @property
    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)

    def take(self, which: np.ndarray) -> list[bytes]:
        blob = self.data.tobytes()
        return [blob[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]


def words(column: pa.Array, breaks: np.ndarray = BLANKS) -> Words:
    """Maximal runs of bytes that are no break; a word never spans two rows."""
    data, offsets = text_bytes(column)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[:-1] = ~breaks[data]
    edge = np.diff(inside, prepend=np.int8(0))
    if len(offsets) > 2:  # a row's first byte starts a word even when the row before ends in one
        first = np.unique(offsets[1:-1])  # empty rows share a bound
        first = first[(first > 0) & (first < len(data))]
        glued = first[(inside[first] == 1) & (inside[first - 1] == 1)]
    else:
        glued = np.zeros(0, np.int64)
    start = np.sort(np.concatenate([np.flatnonzero(edge == 1), glued]))
    end = np.sort(np.concatenate([np.flatnonzero(edge == -1), glued]))
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, end, doc, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_BASE = U64(0x5851F42D4C957F2D)


def _runs(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Runs of ranges with about ``WIDE`` elements together; a longer range stays whole."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes + 1) - 1) // WIDE)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges (polynomial over the bytes, then mixed); ranges may overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    return np.concatenate([_hash_run(data, start[a:b], end[a:b]) for a, b in _runs(end - start)])


def _hash_run(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) - np.repeat(first, size)
    power = np.ones(int(size.max()) + 1, np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power, dtype=np.uint64)
    terms = _BYTE[data[at + np.repeat(start, size)]] * power[at]
    sums = np.zeros(len(size), np.uint64)
    full = size > 0
    sums[full] = np.add.reduceat(terms, first[full])
    return mix(sums + size.astype(np.uint64))


def hash_words(w: Words) -> np.ndarray:
    return hash_ranges(w.data, w.start, w.end)


def window_hashes(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` consecutive words of one row, and the position of its first word."""
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out * _BASE + h[k: k + n])
    at = np.flatnonzero(doc[:n] == doc[width - 1:])
    return out[at], at


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, distinct values, first place of each)."""
    codes, values = pd.factorize(h)
    first = np.zeros(len(values), np.int64)
    first[codes[::-1]] = np.arange(len(h) - 1, -1, -1)
    return codes, values, first


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i] .. starts[i] + sizes[i]``, one range after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def take_ranges(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values`` at the places of :func:`ragged`."""
    return np.concatenate([values[:0], *(values[ragged(starts[a:b], sizes[a:b])] for a, b in _runs(sizes))])


def binary_list(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary column whose row i is the bytes of ``data[offsets[i]:offsets[i + 1]]``."""
    width = data.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets * width).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])
