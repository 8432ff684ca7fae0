"""Sets of word shingles as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from masthead.llm.common import mix, words

SIZE = 5  # words of a shingle


def _factors(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) << np.uint64(20)) | np.uint64(1)


def shingle_sets(data: np.ndarray, limits: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in rising order, and the limits of each text's set.

    A word is a run without ASCII white space, A-Z as a-z. A text with fewer words than ``size`` has its whole sequence as its
    only shingle; one without words has none. Equal hashes are taken for equal shingles (64 bits, within a text or a pair).
    """
    n = len(limits) - 1
    word, owner, _ = words(data, limits)
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    factor = _factors(size + 1)
    full = np.flatnonzero(np.arange(len(word)) + size <= (first + count)[owner]) if len(word) else np.zeros(0, np.int64)
    value = np.zeros(len(full), np.uint64)
    for j in range(size):
        value += word[full + j] * factor[j]
    short = np.flatnonzero((count > 0) & (count < size))
    whole = count[short].astype(np.uint64) * factor[size]
    for j in range(size - 1):
        longer = count[short] > j
        whole[longer] += word[first[short[longer]] + j] * factor[j]
    value = mix(np.concatenate([value, whole]))
    owner = np.concatenate([owner[full], short])
    if len(short):
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    ends = np.cumsum(np.bincount(owner, minlength=n)).tolist()
    for start, end in zip([0, *ends], ends, strict=False):
        value[start:end].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)


def fingerprints(sets: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for a set, whatever its order; 0 for an empty one."""
    out = []
    for salt in (0xA5A5A5A5, 0x5A5A5A5A5A):
        running = np.zeros(len(sets) + 1, np.uint64)
        np.cumsum(mix(sets ^ np.uint64(salt)), out=running[1:])
        out.append(running[limits[1:]] - running[limits[:-1]])
    return out[0], out[1]
