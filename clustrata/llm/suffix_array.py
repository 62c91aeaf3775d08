"""Suffix arrays by the difference-cover algorithm, vectorised.

Suffixes at places 1 and 2 modulo 3 are sampled, their triples are sorted and named, and the
string of names is solved by the same algorithm unless all names differ; the remaining
suffixes are sorted by their first letter and the rank of the sampled suffix behind it, and
merged in. Letters are integers below 2**21, positive; the string ends with the least suffix.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


#: Letters and ranks below this fit one key of three.
SMALL = (1 << 21) - 2


def _triple_order(s: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(at in order of the three letters there, whether each differs from the one before)."""
    if int(s.max(initial=0)) < SMALL:
        key = (s[at] << U64(42)) | (s[at + 1] << U64(21)) | s[at + 2]
        order = np.argsort(key)
        key = key[order]
        new = np.r_[True, key[1:] != key[:-1]]
    else:
        order = np.lexsort((s[at + 2], s[at + 1], s[at]))
        a = at[order]
        new = np.r_[True, (s[a[1:]] != s[a[:-1]]) | (s[a[1:] + 1] != s[a[:-1] + 1]) | (s[a[1:] + 2] != s[a[:-1] + 2])]
    return at[order], new


def suffix_array(letters: np.ndarray) -> np.ndarray:
    """Places of the suffixes of a string of positive integers, in order."""
    n = len(letters)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: letters[i:].tolist()), np.int64)
    s = np.zeros(n + 3, U64)
    s[:n] = letters
    ones = np.arange(1, n + (n % 3 == 1), 3)  # where n is 1 modulo 3 a sample of the empty suffix keeps the halves apart
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    ordered, new = _triple_order(s, sample)
    names = np.cumsum(new)
    if names[-1] < len(sample):
        name_at = np.zeros(n + 3, np.int64)
        name_at[ordered] = names
        ordered = sample[suffix_array(name_at[sample])]
    rank = np.zeros(n + 3, U64)
    rank[ordered] = np.arange(1, len(ordered) + 1, dtype=U64)
    ordered = ordered[ordered < n]
    # the others: by letter, then by the sampled suffix behind
    rest = np.arange(0, n, 3)
    own1 = (s[rest] << U64(32)) | rank[rest + 1]
    order = np.argsort(own1)
    rest, own1 = rest[order], own1[order]
    first = ordered % 3 == 1
    ones, twos = ordered[first], ordered[~first]
    less = np.searchsorted((s[ones] << U64(32)) | rank[ones + 1], own1)
    # two letters and a rank
    if max(int(s.max()), n) < SMALL:
        three = lambda at: (s[at] << U64(42)) | (s[at + 1] << U64(21)) | rank[at + 2]
        key2, own2 = three(twos), three(rest)
    else:  # pairs of letters are named first so that the key fits 64 bits
        every = np.concatenate([twos, rest])
        order = np.lexsort((s[every + 1], s[every]))
        e = every[order]
        number = np.empty(len(every), U64)
        number[order] = np.cumsum(np.r_[True, (s[e[1:]] != s[e[:-1]]) | (s[e[1:] + 1] != s[e[:-1] + 1])])
        key2 = (number[: len(twos)] << U64(32)) | rank[twos + 2]
        own2 = (number[len(twos) :] << U64(32)) | rank[rest + 2]
    less = less + np.searchsorted(key2, own2)
    place = np.arange(len(rest)) + less
    out = np.empty(n, np.int64)
    out[place] = rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = ordered
    return out
