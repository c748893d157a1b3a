"""Words of whole Arrow text batches as numpy positions and 64-bit hashes.

Small helpers for the tasks of the operators: Spark partitions the rows and
these turn one slice of texts into arrays. A slice holds at most
`SLICE_BYTES` of text (or one text), so a task's memory doesn't follow the
size of its Arrow batches.
"""

from __future__ import annotations

import ctypes
import inspect

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

#: Bytes that end a word in the whitespace rule.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_space = np.ones(256, bool)
_space[list(SPACES)] = False
#: Word bytes when words are runs without whitespace.
NON_SPACE = _space
#: Word bytes when words are ASCII digits, a-z and everything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 0x20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every other."""
    h = (h ^ (h >> _S32)) * _M2
    h = (h ^ (h >> _S32)) * _M2
    return h ^ (h >> _S32)


def combine(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash of the pair (h, more); the order matters."""
    return mix((h * _M1) ^ more)


def give_back() -> None:
    """Return what this worker has freed to the system. Workers are kept from
    stage to stage, and so is memory that their allocators hold on to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run):
    """`run` over batches, giving memory back at the task's end."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def tidy_group(run):
    """`run` over a group (key, rows) or two (key, left, right), giving memory
    back behind it."""

    def one(key, rows):
        try:
            return run(key, rows)
        finally:
            give_back()

    def two(key, left, right):
        try:
            return run(key, left, right)
        finally:
            give_back()

    return two if len(inspect.signature(run).parameters) == 3 else one


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(start, stop) row ranges of at most `limit` bytes of text, or one row."""
    ends = np.cumsum(byte_lengths(column))
    start, n = 0, len(column)
    while start < n:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, stop
        start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    offsets, _ = _buffers(column)
    return np.diff(offsets)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    lowest = int(offsets[0])
    size = int(offsets[-1]) - lowest
    data = np.frombuffer(data, np.uint8, size, lowest) if size else np.zeros(0, np.uint8)
    return offsets.astype(np.int64) - lowest, data


class Words:
    """Words of some texts: `first[i]:first[i+1]` are the words of text i.

    A null text has no words. `starts` and `ends` are byte positions in
    `data`, the texts' bytes one after the other (lower-cased A-Z if asked).
    """

    def __init__(self, column: pa.Array, table=NON_SPACE, lower=False):
        self.offsets, data = _buffers(column)
        self.data = _lower[data] if lower else data
        n = len(self.data)
        inside = table[self.data]
        edge = np.empty(n + 1, bool)
        if n:
            edge[0], edge[n] = inside[0], inside[-1]
            np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
            # Words of neighbouring texts don't join.
            cut = self.offsets[1:-1]
            cut = np.unique(cut[(cut > 0) & (cut < n)])
            joined = cut[inside[cut] & inside[cut - 1]]
        else:
            edge[0], joined = False, np.zeros(0, np.int64)
        marks = np.flatnonzero(edge)
        if len(joined):
            marks = np.sort(np.concatenate([marks, joined, joined]))
        self.starts, self.ends = marks[0::2], marks[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self):
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(self.data) + 1, "<u8", padded, 0, (1,))
        h = size.astype(np.uint64) + np.uint64(seed)
        keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
        h = combine(h, eights[self.starts] & keep[np.minimum(size, 8)])
        at, done = np.flatnonzero(size > 8), 8
        while len(at):
            part = eights[self.starts[at] + done] & keep[np.minimum(size[at] - done, 8)]
            h[at] = combine(h[at], part)
            done += 8
            at = at[size[at] > done]
        return h

    def bytes_of(self, i: int, j: int) -> bytes:
        """Words i to j-1 of the whole slice joined by one space."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j]))


def within(first: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the words that start a window of `width` words of one text."""
    if first[-1] < width:
        return np.zeros(0, np.int64)
    ok = np.ones(first[-1], bool)
    for back in range(1, width):
        at = first[1:] - back
        ok[at[at >= first[:-1]]] = False
    return np.flatnonzero(ok)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbours; len(h) - width + 1 values."""
    n = max(0, len(h) - width + 1)
    out = h[:n].copy()
    for k in range(1, width):
        out = combine(out, h[k : k + n])
    return out
