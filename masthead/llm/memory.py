"""What a worker remembers of the words it has encoded."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

KNOWN_WORDS = 400_000  # at most


def distinct[Word](words: list[Word]) -> tuple[list[Word], np.ndarray]:
    """The distinct words, and for each word its place among them."""
    place: dict[Word, int] = {}
    at = np.fromiter([place.setdefault(word, len(place)) for word in words], np.int64, len(words))
    return list(place), at


def distinct_slices(data: np.ndarray, start: np.ndarray, kind: pa.DataType) -> tuple[list, np.ndarray]:
    """The same for words that stand one after the other in ``data``, given by where they begin."""
    limits = np.append(start, len(data)).astype(np.int32 if len(data) < 1 << 31 else np.int64)
    if limits.dtype == np.int64:
        kind = pa.large_string() if pa.types.is_string(kind) else pa.large_binary()
    words = pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(limits), pa.py_buffer(np.ascontiguousarray(data))])
    found = words.dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy().astype(np.int64)


def kept_words(used: np.ndarray, most: int) -> np.ndarray:
    """The numbers of words that have been used more than once, in order, and no more than ``most`` of them: the most used ones."""
    kept = np.flatnonzero(used > 1)
    if len(kept) > most:
        kept = np.sort(kept[np.argpartition(-used[kept], most)[:most]])
    return kept


def gathered(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values`` from ``begin`` to ``end``, one after the other, and where each ends there, after a zero."""
    total = np.concatenate([[0], np.cumsum(end - begin)])
    return values[np.arange(total[-1]) + np.repeat(begin - total[:-1], end - begin)], total


class WordMemory[Word]:
    """Ids of words. ``encode`` gives the ids of new words, one after the other, and how many each has.

    When there is no room for more, words that were used once only are forgotten, which are most.
    """

    def __init__(self, encode: Callable[[list[Word]], tuple[np.ndarray, np.ndarray]], most: int = KNOWN_WORDS) -> None:
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[Word, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)  # of all known words, one after the other
        self.ends = np.zeros(1 << 14, np.int64)  # of the words, after a zero
        self.used = np.zeros(1 << 14, np.int64)

    def _make_room(self, need: int) -> None:
        n = len(self.known)
        kept = kept_words(self.used[:n], min(self.most // 2, max(0, self.most - need)))
        words = list(self.known)
        ids, ends = gathered(self.ids, self.ends[kept], self.ends[kept + 1])
        used = self.used[kept] // 2
        self.forget()
        self._add([words[i] for i in kept.tolist()], ids, np.diff(ends))
        self.used[: len(used)] = used

    def _add(self, words: list[Word], ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.known)
        used = int(self.ends[n])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.ends) <= n + len(words):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.used = np.concatenate([self.used, np.zeros_like(self.used)])
        self.ids[used : used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(words)] = used + np.cumsum(counts)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _numbers(self, words: list[Word]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def flat_ids(self, words: list[Word], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the distinct ``words`` in the order of ``at``, and where those of each end, after a zero."""
        numbers = self._numbers(words)
        missing = np.flatnonzero(numbers < 0)
        if len(missing) and self.known and len(self.known) + len(missing) > self.most:
            self._make_room(len(missing))
            numbers = self._numbers(words)
            missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            numbers[missing] = np.arange(len(self.known), len(self.known) + len(new))
            self._add(new, *self.encode(new))
        self.used[numbers] += np.bincount(at, minlength=len(words))
        numbers = numbers[at]
        return gathered(self.ids, self.ends[numbers], self.ends[numbers + 1])

    def ids_of(self, texts: list[list[Word]]) -> Iterator[np.ndarray]:
        """The ids of texts, each given by its words."""
        flat, total = self.flat_ids(*distinct(list(chain.from_iterable(texts))))
        first = 0
        for own in texts:
            last = first + len(own)
            yield flat[total[first] : total[last]]
            first = last
