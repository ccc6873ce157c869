"""Words and word hashes of whole Arrow text columns, in numpy.

A word is ``[^\\x20\\x09-\\x0D]+`` on UTF-8 bytes. All functions work on the column's
own buffers, so no Python string is made per row or per word. Hashes are 64-bit:
a polynomial over random byte values modulo 2**64, then a finalising mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; larger single texts are cut at white space.
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_2 = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (every input bit reaches every output bit)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """At least n powers of the base (or of its inverse), from the 0th."""
    have = _powers.get(key := "inverse" if inverse else "base")
    if have is None or len(have) < n:
        full = np.full(max(n, CHUNK_BYTES + 1), _BASE_INVERSE if inverse else _BASE)
        full[0] = 1
        have = _powers[key] = np.cumprod(full)
        if len(have) > 8 * CHUNK_BYTES:  # a single giant word: do not keep its table
            del _powers[key]
    return have


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(at):
        at = np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words; no word spans two texts."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    return starts, ends


def _chunks(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of words that span at most CHUNK_BYTES, or one longer word."""
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + CHUNK_BYTES, "right")))
        yield k, stop
        k = stop


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each span of bytes; the spans must be in order."""
    out = np.empty(len(starts), np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    for a, b in _chunks(starts, ends):
        lo, hi = int(starts[a]), int(ends[b - 1])
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[data[lo:hi]] * powers(hi - lo)[: hi - lo], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (sums[e] - sums[s]) * powers(hi - lo, inverse=True)[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


class Words:
    """The words of a text column: spans, hashes and the range of each text's words.

    Lower-casing (A-Z only) changes the hashes, not the spans.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.at = text_buffers(column)
        self.starts, self.ends = word_spans(self.data, self.at)
        self.hashes = span_hashes(self.data, self.starts, self.ends, lower)
        #: Words of text i are first[i] to first[i + 1].
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of `size` words inside one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        begin = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return begin, self.window_hashes(begin, size)

    def window_hashes(self, begin: np.ndarray, size: int, other: bool = False) -> np.ndarray:
        """64-bit hash of windows; with other, one of another base over otherwise mixed words."""
        hashes, base = (mix(self.hashes + _BASE), _BASE_2) if other else (self.hashes, _BASE)
        total = np.zeros(len(begin), np.uint64)
        for k in range(size):
            total *= base
            total += hashes[begin + k]
        return mix(total)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Text index and hash of each shingle; a shorter text is one shingle, an empty one has none."""
        begin, hashes = self.windows(size)
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        if not len(short):
            return self.text[begin], hashes
        whole = np.array([self.sequence(i)[0] for i in short], np.uint64)
        text = np.concatenate([self.text[begin], short])
        order = np.argsort(text, kind="stable")
        return text[order], np.concatenate([hashes, mix(whole)])[order]

    def sequence(self, i: int) -> tuple[int, int]:
        """Two 64-bit hashes of the word sequence of text i."""
        words = self.hashes[self.first[i] : self.first[i + 1]]
        if not len(words):
            return 0, 0
        scale = powers(len(words))[: len(words)]
        return int((words * scale).sum(dtype=np.uint64)), int((mix(words + _BASE) * scale).sum(dtype=np.uint64))


def distinct_by_text(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, sorted by text, then hash."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes, or one longer text."""
    _, at = text_buffers(batch.column(column))
    k = 0
    while k < batch.num_rows:
        stop = max(k + 1, int(np.searchsorted(at, at[k] + limit, "right")) - 1)
        yield batch.slice(k, stop - k)
        k = stop


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
