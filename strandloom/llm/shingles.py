"""Word shingles of texts as sorted sets of 64-bit hashes, made with array operations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import raw_bytes

SHINGLE = 5


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixing permutation of 64-bit numbers (the public SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _seeds(256, 7)
_BYTE[65:91] = _BYTE[97:123]  # A-Z read as a-z
_BYTE[_SPACE] = 0
_PLACE = _seeds(4096, 11)
_TURN = _seeds(SHINGLE, 13)


def words(body: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, hash of each word) of rows laid end to end."""
    global _PLACE
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    space = _SPACE[body]
    first = np.zeros(len(body) + 1, bool)
    first[off] = True
    begins = ~space
    begins[1:] &= space[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = starts[0]
    place = np.arange(at, len(body)) - np.repeat(starts, np.diff(starts, append=len(body)))
    if place.max() >= len(_PLACE):
        _PLACE = _seeds(int(place.max()) * 2, 11)
    sums = np.add.reduceat(_BYTE[body[at:]] * _PLACE[place], starts - at)
    return np.searchsorted(off, starts, "right") - 1, mix64(sums)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each row's set of 5-word shingles, ascending; fewer words make one shingle, none an empty set."""
    body, off = raw_bytes(texts)
    row, word = words(body, off)
    n_rows = len(off) - 1
    per = np.bincount(row, minlength=n_rows)
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(n_rows + 1, np.int64)
    padded = np.concatenate([word, np.zeros(SHINGLE, np.uint64)])
    full = np.zeros(len(word), np.uint64)
    for j in range(SHINGLE):
        full += padded[j : len(word) + j] * _TURN[j]
    keep = np.zeros(len(word), bool)
    last = SHINGLE - 1
    if len(word) > last:
        keep[: len(word) - last] = row[last:] == row[: len(word) - last]
    short = np.flatnonzero((per > 0) & (per < SHINGLE))
    if len(short):
        begin = np.cumsum(per) - per
        for r in short:
            i, k = begin[r], per[r]
            full[i] = (word[i : i + k] * _TURN[:k]).sum(dtype=np.uint64) + np.uint64(k)
            keep[i] = True
    full, row = mix64(full[keep]), row[keep]
    order = np.lexsort((full, row))
    full, row = full[order], row[order]
    new = np.ones(len(full), bool)
    new[1:] = (full[1:] != full[:-1]) | (row[1:] != row[:-1])
    full, row = full[new], row[new]
    return full, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_rows))])


def long_lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
