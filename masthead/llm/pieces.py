"""SentencePiece encoding and decoding by a Viterbi search over many words at once.

A text is cut where no piece can reach across: before a space that follows another character, and around characters that
occur in no longer piece. New words advance together, one character a step, the longest first, so that those that go on stand in front: the
characters of all words at one place lie side by side. From each character the pieces are followed in a trie, for all characters at once,
and the best predecessor of every word is a running maximum over the lengths of its last piece. Of equally good segmentations the
one whose last piece is longer wins, at every step.

The encoding is the segmentation with the highest sum of scores, those of a unigram model. A vocabulary made by merging pairs has
ranks instead of scores; a sum of ranks would prefer many short pieces. Its pieces stand in order of frequency, so a rank is
read as the log of a probability that falls with it by the law of Zipf and Mandelbrot. Nothing is fitted. The
encoding need not be that of its merges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import mix, slabs, staging, utf8
from masthead.llm.memory import WordMemory, distinct_slices, gathered

SPACE = "▁"  # a space, to the vocabulary
UNKNOWN_PENALTY = 10.0  # below the lowest score
SHIFT = 100  # added to a rank, as its probability falls with one over that sum
CELLS = 1 << 20  # characters of words that advance together, times the lengths of pieces
EMPTY = np.uint64((1 << 64) - 1)


class Trie:
    """The beginnings of pieces, numbered from 1; a table of hashes leads from one and a character to the next."""

    def __init__(self, names: list[str]) -> None:
        points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        begin = np.cumsum(lengths) - lengths
        self.longest = int(lengths.max(initial=1))
        self.ends, self.size = np.zeros(len(names), np.int64), 1
        keys, children = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for step in range(self.longest):
            going = np.flatnonzero(lengths > step)
            own, at = np.unique(self._key(self.ends[going], points[begin[going] + step]), return_inverse=True)
            keys.append(own)
            children.append(self.size + np.arange(len(own)))
            self.ends[going] = children[-1][at]
            self.size += len(own)
        key, child = np.concatenate(keys), np.concatenate(children)
        self.mask = np.uint64((1 << (4 * len(key)).bit_length()) - 1)
        self.keys, self.children = np.full(int(self.mask) + 1, EMPTY), np.zeros(int(self.mask) + 1, np.int64)
        slot = mix(key) & self.mask
        while len(key):
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = key[free]  # of several, one stays
            there = self.keys[slot] == key
            self.children[slot[there]] = child[there]
            key, child, slot = key[~there], child[~there], (slot[~there] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(node: np.ndarray, points: np.ndarray) -> np.ndarray:
        return (node.astype(np.uint64) << np.uint64(21)) | points

    def next(self, node: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Where each character leads from each beginning; 0 if no piece goes on so."""
        key = self._key(node, points)
        slot = mix(key) & self.mask
        there = self.keys[slot]
        out = np.where(there == key, self.children[slot], 0)
        left = np.flatnonzero((there != key) & (there != EMPTY))
        while len(left):
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
            there = self.keys[slot[left]]
            hit = there == key[left]
            out[left[hit]] = self.children[slot[left[hit]]]
            left = left[~hit & (there != EMPTY)]
        return out


@dataclass
class Pieces:
    """A vocabulary. ``kinds``: 0 piece, 1 not for text, 2 byte."""

    names: list[str]
    scores: list[float]
    kinds: list[int]
    unknown: int

    def __post_init__(self) -> None:
        own = [i for i, kind in enumerate(self.kinds) if kind == 0 and self.names[i]]
        self.lowest = min((self.scores[i] for i in own), default=0.0) - UNKNOWN_PENALTY
        inside = {c for i in own if len(self.names[i]) > 1 for c in self.names[i]} - {SPACE}
        own = [i for i in own if " " not in self.names[i]]  # no text has it: its spaces are U+2581
        self.trie = Trie([self.names[i].replace(SPACE, " ") for i in own])
        if len(np.unique(self.trie.ends)) < len(own):
            raise ValueError("two pieces are equal")
        self.values, self.ids = np.full(self.trie.size, -np.inf), np.zeros(self.trie.size, np.int64)
        self.values[self.trie.ends], self.ids[self.trie.ends] = [self.scores[i] for i in own], own
        self.bytes = {int(self.names[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == 2}
        self.sort = np.full(0x110000, 2, np.uint8)  # of characters: 0 space, 1 in longer pieces, 2 other
        self.sort[[ord(c) for c in inside]] = 1
        self.sort[ord(" ")] = 0
        self.plain = [n.replace(SPACE, " ").encode() if kind == 0 else b"" for n, kind in zip(self.names, self.kinds, strict=True)]
        for byte, i in self.bytes.items():
            self.plain[i] = bytes([byte])
        if self.unknown >= 0:
            self.plain[self.unknown] = " ⁇ ".encode()
        self.plain_bytes = np.frombuffer(b"".join(self.plain), np.uint8)
        self.plain_ends = np.cumsum([len(p) for p in self.plain])
        self.memory = WordMemory(self.learn)

    def _best(self, text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, the longest first, that stand one after the other in ``text``, and how many each has."""
        count, most = len(lengths), int(lengths[0])
        alive = np.searchsorted(-lengths, -np.arange(most))  # words with a character at a place
        first = np.cumsum(alive) - alive
        place = np.repeat(np.arange(most), alive)
        word = np.arange(len(place)) - first[place]
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)[(np.cumsum(lengths) - lengths)[word] + place]
        follows = word < np.append(alive[1:], 0)[place]
        best, last, picked = np.zeros(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        block = max(1, CELLS // self.trie.longest)
        for low in range(0, most, block):
            high = min(low + block, most)
            begin, end = int(first[low]), int(first[high - 1] + alive[high - 1])
            gain, piece = self._followed(points, place, follows, alive, slice(int(first[max(0, low - self.trie.longest + 1)]), end), begin, high)
            for at in range(low, high):
                own, shown = slice(first[at], first[at] + alive[at]), slice(first[at] - begin, first[at] - begin + alive[at])
                top = gain[0, shown] + best[first[at - 1] : first[at - 1] + alive[at]] if at else gain[0, shown]
                for size in range(1, min(at + 1, len(gain))):
                    total = gain[size, shown]
                    if size < at:
                        total = total + best[first[at - size - 1] : first[at - size - 1] + alive[at]]
                    np.copyto(last[own], size, where=total >= top)
                    top = np.maximum(top, total)
                best[own] = top
            picked[begin:end] = piece[last[begin:end], np.arange(end - begin)]
        words, steps, left = np.arange(count), [], lengths.copy()
        while len(words):
            at = first[left - 1] + words
            steps.append((words, picked[at]))
            left = left - last[at] - 1
            words, left = words[left > 0], left[left > 0]
        counts = np.bincount(np.concatenate([w for w, _ in steps]), minlength=count)
        ids, ends = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts)
        for step, (words, own) in enumerate(steps):
            ids[ends[words] - 1 - step] = own
        return self._spelt(ids, counts)

    def _followed(
        self, points: np.ndarray, place: np.ndarray, follows: np.ndarray, alive: np.ndarray, starts: slice, begin: int, high: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Values and ids of the pieces, a row for each length, that end at the characters from ``begin`` on, at places below ``high``."""
        shape = min(self.trie.longest, high), starts.stop - begin
        gain, piece = np.full(shape, -np.inf), np.zeros(shape, np.int32)
        here = np.arange(starts.start, starts.stop)
        node = np.zeros(len(here), np.int64)
        for size in range(shape[0]):
            node = self.trie.next(node, points[here])
            here, node = here[node > 0], node[node > 0]
            inside = here >= begin
            gain[size, here[inside] - begin], piece[size, here[inside] - begin] = self.values[node[inside]], self.ids[node[inside]]
            on = follows[here] & (place[here] + 1 < high)
            here, node = here[on], node[on]
            here = here + alive[place[here]]
        unknown = np.flatnonzero(gain[0] == -np.inf)
        gain[0, unknown], piece[0, unknown] = self.lowest, -1 - points[begin + unknown].astype(np.int64)
        return gain, piece

    def _spelt(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters (-1 - code point) as their bytes, if the vocabulary has bytes, or as unknown."""
        unknown = ids < 0
        if not unknown.any():
            return ids, counts
        if len(self.bytes) < 256:
            return np.where(unknown, self.unknown, ids), counts
        points = -1 - ids[unknown]
        size = np.ones(len(ids), np.int64)
        size[unknown] += (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        raw = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        out = np.repeat(ids, size)
        out[np.repeat(unknown, size)] = np.array([self.bytes[b] for b in range(256)])[raw]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(counts)
        return out, total[ends] - total[ends - counts]

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and how many each has. Spaces are plain ones."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        found, counts, at = [], np.zeros(len(words), np.int64), 0
        while at < len(order):
            own = order[at : at + max(1, CELLS // (int(lengths[order[at]]) * self.trie.longest))]
            ids, counts[own] = self._best("".join([words[i] for i in own.tolist()]), lengths[own])
            found.append(ids)
            at += len(own)
        ends = np.zeros(len(words), np.int64)
        ends[order] = np.cumsum(counts[order])
        return gathered(np.concatenate(found), ends - counts, ends)[0], counts

    def encode_bytes(self, data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of texts in UTF-8, one after the other, where those of each text begin, and whether decoding gives each text back."""
        data, limits = _spaced(data, limits)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        sort = self.sort[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")]
        before = np.concatenate([sort[:1], sort[:-1]])
        new = (sort == 2) | ((sort == 0) & (before > 0)) | ((sort == 1) & (before == 2))
        new[np.searchsorted(lead, limits[:-1][np.diff(limits) > 0])] = True
        start = lead[new]
        ids, total = self.memory.flat_ids(*distinct_slices(data, start, pa.string()))
        ids, ends = ids.astype(np.int32), total[np.searchsorted(start, limits)]
        plain, plain_ends = gathered(self.plain_bytes, np.append(0, self.plain_ends)[ids], self.plain_ends[ids])
        plain_ends = plain_ends[ends]
        same = np.ones(len(limits) - 1, bool)
        if not np.array_equal(plain_ends, limits) or not np.array_equal(plain, data):
            for i, (a, b) in enumerate(pairwise(limits.tolist())):
                same[i] = self.decode(ids[ends[i] : ends[i + 1]]) == data[a:b].tobytes().decode()[1:]
        return ids, ends, same

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; a space is put before a text, an empty text has no ids."""
        raw = [text.encode("utf-8", "replace") for text in texts]
        limits = np.cumsum([0, *map(len, raw)])
        ids, ends, _ = self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), limits)
        return [ids[a:b] for a, b in pairwise(ends.tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: U+2581 comes back as a space, bytes that are no UTF-8 as U+FFFD."""
        return b"".join(map(self.plain.__getitem__, ids.tolist())).decode("utf-8", "replace")[1:]


def _spaced(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with plain spaces for U+2581 and one more space before each that is not empty."""
    if SPACE.encode() in data.tobytes():
        at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        data = data.copy()
        data[at] = ord(" ")
        data = np.delete(data, np.concatenate([at + 1, at + 2]))
        limits = limits - 2 * np.searchsorted(at, limits)
    filled = np.diff(limits) > 0
    data = np.insert(data, limits[:-1][filled], ord(" "))
    return data, limits + np.concatenate([[0], np.cumsum(filled)])


def log_probabilities(scores: list[float], kinds: list[int]) -> list[float]:
    """Scores that are ranks (0 or whole numbers below, a different one for nearly every piece) as log-probabilities; others as they are."""
    own = np.array([score for score, kind in zip(scores, kinds, strict=True) if kind == 0])
    if len(own) < 2 or (own > 0).any() or (own != np.floor(own)).any() or len(np.unique(own)) < 0.99 * len(own):
        return scores
    total = np.log((1 / (SHIFT - own)).sum())
    return [float(-np.log(SHIFT - score) - total) if kind == 0 else score for score, kind in zip(scores, kinds, strict=True)]


def read_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    kinds = [2 if model.is_byte(i) else 1 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 0 for i in range(n)]
    scores = log_probabilities([model.get_score(i) for i in range(n)], kinds)
    return Pieces([model.id_to_piece(i) for i in range(n)], scores, kinds, model.unk_id())


_FIELDS = ["doc_id", "ids", "ids_crc32", "round_trip"]


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, ids_crc32 (of little-endian 32-bit ids), round_trip (decoding gives the text back).

    Null text counts as empty and has no ids. U+2581 in a text is a space to the vocabulary, and round_trip allows for that.
    Rows that repeat an id get a row each, and ids of rows may be null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    staging(spark)
    shared = spark.sparkContext.broadcast((pieces.names, pieces.scores, pieces.kinds, pieces.unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(shared.value)
        for batch in batches:
            data, limits = utf8(batch.column(1))
            for first, last in slabs(limits):
                ids, ends, same = own.encode_bytes(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:last],
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array([zlib.crc32(ids[a:b].astype("<i4", copy=False)) for a, b in pairwise(ends.tolist())], pa.int64()),
                        pa.array(same),
                    ],
                    _FIELDS,
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>, ids_crc32 long, round_trip boolean")


def decode(encoded: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: doc_id, text. Null ids give an empty text."""
    spark = encoded.sparkSession
    staging(spark)
    shared = spark.sparkContext.broadcast((pieces.names, pieces.scores, pieces.kinds, pieces.unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _vocabulary(shared.value)
        for batch in batches:
            texts = [own.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )


_vocabularies: dict[int, Pieces] = {}


def _vocabulary(parts: tuple) -> Pieces:
    """The vocabulary of this worker, with the words it remembers."""
    key = zlib.crc32("\n".join(parts[0]).encode("utf-8", "surrogatepass"))
    if key not in _vocabularies:
        _vocabularies[key] = Pieces(*parts)
    return _vocabularies[key]
