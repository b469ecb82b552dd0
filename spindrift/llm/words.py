"""Vectorised word splitting and hashing over Arrow text buffers.

A chunk of documents is one byte buffer with offsets. Words are maximal runs of
accepted bytes; accepted bytes are ASCII decisions only, so UTF-8 sequences are
never cut. A word's 64-bit hash is a polynomial over random byte codes, taken
from one prefix sum over the buffer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_GRAM = U(0xD6E8FEB86659FD93)


def _lowered() -> np.ndarray:
    low = np.arange(256)
    low[65:91] += 32
    return low


#: Words separated by white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        base = _BASE if kind == "up" else _INVERSE
        out = np.ones(size, np.uint64)
        out[1:] = U(base)
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
        have = out
        if size <= 2 * CHUNK_BYTES:  # the powers for a giant document are not kept
            _powers[kind] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


@dataclass
class Words:
    """Words of a chunk: byte extents, hashes, and the first word of each document."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # documents + 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split(data: np.ndarray, offsets: np.ndarray, accepted: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Words of the documents data[offsets[i]:offsets[i+1]]; offsets begin at 0."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = accepted[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before &= ~cut[:n]
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after &= ~cut[1:]
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, span_hashes(data, start, end, lower), np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each data[start:end]."""
    n = len(data)
    codes = _CODES[_lowered()] if lower else _CODES
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes[data] * _power("up", n), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power("down", n)[start])


def hash_of(word: str, lower: bool = False) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(split(data, np.array([0, len(data)]), np.ones(256, bool), lower).hash[0])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k consecutive hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += h[j : j + n]
    return mix(out)


def whole(first: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the total - k + 1 windows stay inside one document."""
    n = max(0, total - k + 1)
    ok = np.ones(n, bool)
    for lo, hi in zip(first[:-1], first[1:], strict=True) if len(first) < 2000 else _edges(first):
        ok[max(lo, hi - k + 1) : min(hi, n)] = False
    return ok


def _edges(first):
    return zip(first[:-1], first[1:], strict=True)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w entries, by doubling."""
    have, out = 1, x
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(out) - (w - have)], out[w - have :])
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


#: The one large table that a worker keeps between tasks, by name.
_kept: dict[str, object] = {}


def keep(name: str, make: Callable[[], object]):
    """The worker's large table of that name; another one that it has is dropped."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Drops the worker's large table: for tasks that have no use for one."""
    _kept.clear()
    free()


def free() -> None:
    """Hands memory that is no longer used back to the system: workers outlive their tasks and share an executor's memory with the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES, keeps: bool = False) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of at most limit bytes of text, or of one document. Without keeps, the task has no use for a large table."""
    if not keeps:
        _kept.clear()
    try:
        yield from _chunks(batches, text, limit)
    finally:
        free()


def _chunks(batches, text, limit):
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_buffer(batch.column(text))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at), data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at]
            at = upto


def binary_column(blob: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array from one byte buffer; offsets in bytes."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(blob))])
