"""Suffix order of bytes by the difference cover of 3, with array operations; used on one task's share of the text."""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names 1.. in key order, order of the keys)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]])) if len(keys) else 0
    return names, order


def suffix_order(text: np.ndarray, depth: int, span: int = 1) -> np.ndarray:
    """Starts of all suffixes of text (non-negative ints) in an order that is right for the first depth / span characters.

    Suffixes that start at 1 or 2 modulo 3 are the sample: their triples are sorted and named, and the string of the
    names is ordered by recursion, which ends when names are unique or already cover the depth. The other suffixes are
    sorted by their first character and the rank of the next suffix, and merged with the sample.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    t = np.concatenate([text.astype(np.int64) + 1, np.zeros(3, np.int64)])
    # One more sample suffix at n if n is 1 modulo 3, so that the halves of the recursion's string stay apart.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    top = int(t.max()) + 1
    if top**3 < 1 << 62:
        names, _ = _dense((t[sample] * top + t[sample + 1]) * top + t[sample + 2])
    else:
        pairs, _ = _dense(t[sample + 1] * top + t[sample + 2])
        names, _ = _dense(t[sample] * (len(sample) + 1) + pairs)
    if names.max() < len(sample) and 3 * span < depth:
        ranks = np.empty(len(sample), np.int64)
        ranks[suffix_order(names, depth, 3 * span)] = np.arange(1, len(sample) + 1)
    else:
        ranks = np.empty(len(sample), np.int64)
        ranks[np.argsort(names, kind="stable")] = np.arange(1, len(sample) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = ranks
    sorted_sample = np.empty(len(sample), np.int64)
    sorted_sample[ranks - 1] = sample
    sorted_sample = sorted_sample[sorted_sample < n]
    wide = len(sample) + 2
    rest = np.arange(0, n, 3)
    key = t[rest] * wide + rank[rest + 1]
    by = np.argsort(key, kind="stable")
    rest, key = rest[by], key[by]
    one, two = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted(_rising(t[one] * wide + rank[one + 1]), key)
    second = (t[rest] * top + t[rest + 1]) if top**2 * wide < 1 << 62 else None
    if second is not None:
        before = before + np.searchsorted(_rising((t[two] * top + t[two + 1]) * wide + rank[two + 2]), second * wide + rank[rest + 2])
    else:
        both, _ = _dense(np.concatenate([t[two + 1] * wide + rank[two + 2], t[rest + 1] * wide + rank[rest + 2]]))
        more = len(both) + 2
        before = before + np.searchsorted(_rising(t[two] * more + both[: len(two)]), t[rest] * more + both[len(two) :])
    out = np.empty(n, np.int64)
    places = _rising(before) + np.arange(len(rest))
    free = np.ones(n, bool)
    free[places] = False
    out[places] = rest
    out[free] = sorted_sample
    return out


def _rising(keys: np.ndarray) -> np.ndarray:
    """Keys of suffixes that are in order already; ties left open beyond the depth must not break the search."""
    return np.maximum.accumulate(keys) if len(keys) else keys
