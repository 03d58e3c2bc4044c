"""Vectorised word work on Arrow string columns, used inside ``mapInArrow`` tasks.

A string column is one byte buffer plus offsets, so words of thousands of documents are
found and hashed by a few numpy passes over that buffer; nothing here loops per character.
A null counts as an empty text.  Batches are cut into pieces of bounded bytes
(``pieces``), so a worker holds some megabytes however long a batch is; a single text is
never cut.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
_SEED = 20240229


def ship_by_value(name: str) -> None:
    """Functions of module ``name`` run in Python workers; pickle them by value so that
    executors need not have the package installed."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[name])


def worker_cache(key, build):
    """``build()`` once per Python worker (workers are reused between tasks)."""
    holder = sys.modules.setdefault("_biblioflow_llm_cache", types.ModuleType("_biblioflow_llm_cache"))
    if key not in holder.__dict__:
        holder.__dict__[key] = build()
    return holder.__dict__[key]


def release() -> None:
    """Let go of what other operators left in this Python worker (workers are reused): word
    lists and encoders, which can be large."""
    held = sys.modules.get("_biblioflow_llm_cache")
    for key in [k for k in held.__dict__ if isinstance(k, tuple)] if held else ():
        del held.__dict__[key]


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large_string without nulls (null: empty)."""
    col = batch.column(name)
    if pa.types.is_null(col.type):
        col = col.cast(pa.large_string())
    return pc.fill_null(col.cast(pa.large_string()), "")


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a large_string array, whatever slice it is."""
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive slices of at most ``limit`` text bytes (at least one row each)."""
    if batch.num_rows == 0:
        return
    worker_cache("memory pool", lambda: pa.set_memory_pool(pa.system_memory_pool()))  # gives freed memory back
    col = text_column(batch, column)
    _, off = buffers(col)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at), col.slice(at, to - at)
        at = to


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text) of words ``[^\\x20\\x09-\\x0D]+``."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, bool)  # a text starts here
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def _tables(n: int):
    """Byte table and powers (of an odd number modulo 2^64, and of its inverse)."""
    def build():
        rng = np.random.default_rng(_SEED)
        table = rng.integers(1, 2**64, 256, dtype=np.uint64)
        lower = table.copy()
        lower[65:91] = table[97:123]
        return table, lower

    def powers():
        size = max(PIECE_BYTES + (1 << 16), 1 << int(n).bit_length() if n > PIECE_BYTES + (1 << 16) else 0)
        r = 0x9E3779B97F4A7C15 | 1
        inv = pow(r, -1, 2**64)
        out = []
        for x in (r, inv):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        return out

    table, lower = worker_cache("byte tables", build)
    p = worker_cache("powers", powers)
    if len(p[0]) < n:
        sys.modules["_biblioflow_llm_cache"].__dict__["powers"] = p = powers()
    return table, lower, p[0], p[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (xor-shift and multiply), so that every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span (A-Z as a-z if ``lower``): differences of one running
    polynomial sum, shifted back to position 0, so the cost doesn't depend on span lengths."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    table, low, power, inverse = _tables(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low if lower else table)[data] * power[:len(data)], out=run[1:], dtype=np.uint64)
    return mix((run[end] - run[start]) * inverse[start])


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` consecutive words (given by their hashes), by differences
    of one running sum like ``span_hashes``; runs over the border of two texts are included."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    _, _, power, inverse = _tables(len(words) + 1)
    run = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:len(words)], out=run[1:], dtype=np.uint64)
    return mix((run[size:] - run[:-size]) * inverse[:len(words) - size + 1])


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets per text) of the k-word shingles of each text, in order; a text of
    fewer words is one shingle as a whole, a text without words has none."""
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    off = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(off[-1]), np.uint64)
    if len(out) == 0:
        return out, off
    owner = np.repeat(np.arange(len(n)), n)
    at = first[:-1][owner] + (np.arange(len(out)) - off[:-1][owner])
    have = np.minimum(counts, k)[owner]  # words in this shingle
    for j in range(k):
        mult = np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1) + 2 * j) & (2**64 - 1) | 1)
        ok = j < have
        out += np.where(ok, words[np.minimum(at + j, len(words) - 1)] * mult, np.uint64(j + 1))
    return mix(out), off


def lists(values, offsets, kind) -> pa.Array:
    """A list array of ``kind`` from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


ship_by_value(__name__)
