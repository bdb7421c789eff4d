"""Arrow helpers for operators that work on whole texts inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# glibc's; elsewhere the C library decides alone
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_SET = getattr(ctypes.CDLL(None), "mallopt", None)
_TRIM_ABOVE, _MAP_ABOVE = (-1, 64 << 20), (-3, 16 << 20)     # options of mallopt and their values


@lru_cache(maxsize=1)
def keep_heap() -> None:
    """Let the C library keep the memory of one slice's arrays for the next
    one: by itself it returns them each time, and every page is faulted in
    again.  What it keeps is given back after each batch."""
    if _SET is not None:
        _SET(*_TRIM_ABOVE)
        _SET(*_MAP_ABOVE)


def give_back() -> None:
    """Return to the system what Arrow's pool and the C library keep of batches
    that are gone: workers live on, and two or more of them share an executor's
    memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; null counts as 0."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices_by_chars(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``most`` bytes
    together (one longer text makes a run of its own), to bound what a task
    holds at a time.  Every row is in exactly one run."""
    keep_heap()
    n = batch.num_rows
    if not n:
        return
    ends = np.cumsum(text_lengths(batch.column(column)))
    start = 0
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, concatenated, and the n + 1 offsets
    of the texts in them.  Null texts are empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw[:0], off - off[0] if len(off) else np.zeros(1, np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by column ``key`` so that no group of equal keys
    straddles two tables."""
    keep_heap()
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(keys[1:] != keys[:-1])
        first_new = held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != batch.column(key)[0].as_py()
        if len(cut):
            at = int(cut[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = [batch.slice(at)]
        elif first_new:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys, and the end of the last."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)


def longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as signed ones of the same bits."""
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def binaries(x: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One string of bytes per run of 64-bit values between two bounds."""
    offsets = pa.py_buffer((8 * bounds).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(x))])


def longs_of(column: pa.ChunkedArray) -> np.ndarray:
    """The 64-bit values of strings of :func:`binaries`, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def lists(x: np.ndarray) -> pa.Array:
    """One list of longs per row of a matrix."""
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), longs(x.reshape(-1)))
