"""Words and hashes of UTF-8 texts, computed on the bytes of a whole Arrow batch at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# fixed values: byte classes of the two word patterns (bytes of other characters are >= 0x80)
SPACED = np.ones(256, bool)  # [^\x20\x09-\x0D]+
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * C2
    h = h ^ (h >> np.uint64(29))
    h = h * C3
    return h ^ (h >> np.uint64(32))


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each text starts, with the end at last; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word, with their number at last."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = at[:-1][at[1:] > at[:-1]]  # where texts that are not empty begin
    first[full] = inside[full]
    ends = at[1:][at[1:] > at[:-1]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def padded(data: np.ndarray, n: int = 8) -> np.ndarray:
    return np.concatenate([data, np.zeros(n, np.uint8)])


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes at a time."""
    view = np.lib.stride_tricks.sliding_window_view(padded(data), 8)
    out = np.empty(len(starts), np.uint64)
    step = 1 << 20
    for a in range(0, len(starts), step):
        s, e = starts[a : a + step], ends[a : a + step]
        n = e - s
        h = mix(n.astype(np.uint64) * C1 + np.uint64(seed))
        open_ = np.arange(len(s))
        k = 0
        while len(open_):
            left = n[open_] - k
            x = np.ascontiguousarray(view[s[open_] + k]).view("<u8").ravel() & _KEEP[np.minimum(left, 8)]
            h[open_] = mix((h[open_] ^ x) * C1 + np.uint64(k + 1))
            open_ = open_[left > 8]
            k += 8
        out[a : a + step] = h
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all spans in a row."""
    if not len(counts):
        return np.zeros(0, np.int64)
    total = int(counts.sum())
    at = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, counts)


def shingles(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of n words: (hash, word index of its start, text).

    A text of fewer words, but not none, has one run of all its words.
    """
    count = np.diff(first)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    start = ragged(first[:-1], runs)
    doc = np.repeat(np.arange(len(count)), runs)
    size = np.minimum(count[doc], n)
    tail = np.concatenate([words, np.zeros(n, np.uint64)])
    h = size.astype(np.uint64)
    for k in range(n):
        h = np.where(k < size, mix(h * C1 + tail[start + k]), h)
    return h, start, doc


SLICE_BYTES = 4 << 20
# where a slice takes many times its text in arrays: what a worker took stays with it while it is idle
SMALL_BYTES = 1 << 20

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


_LARGE: list[Callable[[], None]] = []


def large(cached):
    """A cached function whose values a worker drops when it goes on to another step."""
    _LARGE.append(cached.cache_clear)
    return cached


def _drop() -> None:
    for clear in _LARGE:
        clear()


def freed(run: Run, keep: bool = False) -> Run:
    """`run`; workers are kept for later stages, so that they drop what others cached before a partition, unless `keep`
    is set, and give back the Arrow memory they do not use after it."""

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            _drop()
        try:
            yield from run(parts)
        finally:
            pa.default_memory_pool().release_unused()

    return whole


def slices(part: pa.RecordBatch, limit: int = SLICE_BYTES, columns: tuple[str, ...] = ("text",)) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most so many bytes of text, of one row at least."""
    size = sum(pc.fill_null(pc.binary_length(part[c]), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    end = np.cumsum(size + 64)
    a = 0
    while a < part.num_rows:
        before = int(end[a - 1]) if a else 0
        z = max(a + 1, int(np.searchsorted(end, before + limit, "right")))
        yield part.slice(a, z - a)
        a = z
