"""Values of spans of text (ids, counts), worked out once for each distinct span a worker meets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Distinct spans that are kept, some 150 MB; beyond, the store starts anew.
MOST = 2_000_000


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy of at least twice its length, so that `size` values fit."""
    if size <= len(array):
        return array
    wider = np.zeros(max(size, 2 * len(array)), array.dtype)
    wider[: len(array)] = array
    return wider


class SpanStore:
    """Lists of numbers by span hash: codes() finds or makes them, values() lays them end to end.

    Code 0 stands for `first`, a list given from outside.
    """

    def __init__(self, make: Callable[[list[str]], list[list[int]]], first: list[int] = ()):
        self.make, self.start = make, list(first)
        self.forget()

    def forget(self) -> None:
        self.keys, self.key_codes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.at, self.n = np.zeros(1024, np.int32), np.zeros(1024, np.int64), 1
        self.flat[: len(self.start)] = self.start
        self.at[1] = len(self.start)

    def codes(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
        """A code per span of UTF-8 data; where `prefix` is true, a space stands before the span (its hash must tell)."""
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MOST:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        codes = np.zeros(len(keys), np.int64)
        codes[known] = self.key_codes[at[known]]
        if len(new := np.flatnonzero(~known)):
            raw, where = data.tobytes(), first[new]
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            if prefix is not None:
                texts = [" " + t if p else t for t, p in zip(texts, prefix[where].tolist())]
            codes[new] = self._add(self.make(texts))
            self.keys = np.insert(self.keys, at[new], keys[new])
            self.key_codes = np.insert(self.key_codes, at[new], codes[new])
        return codes[inverse]

    def _add(self, lists: list[list[int]]) -> np.ndarray:
        sizes = np.array([len(x) for x in lists], np.int64)
        used, total = int(self.at[self.n]), int(sizes.sum())
        self.flat = _room(self.flat, used + total)
        self.flat[used : used + total] = np.fromiter((i for x in lists for i in x), np.int32, total)
        self.at = _room(self.at, self.n + len(lists) + 1)
        self.at[self.n + 1 : self.n + len(lists) + 1] = used + np.cumsum(sizes)
        self.n += len(lists)
        return np.arange(self.n - len(lists), self.n)

    def values(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the codes end to end, and where each code's begin."""
        begin = self.at[codes]
        sizes = self.at[codes + 1] - begin
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.append(0, ends)
