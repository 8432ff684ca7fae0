"""Packing of tokenised documents into sequences by large-item matching and best fit.

Which sequence a piece goes to depends on its length only, so the plan is made from the number of pieces of each length
(at most ``capacity`` numbers, however many documents): runs of ranks of a length go to runs of sequences. Each piece then
finds its place by its rank among the pieces of its length, which takes one count per task and length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain, pairwise
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masthead.llm.common import slabs, staging, utf8
from masthead.llm.memory import WordMemory, distinct_slices

CAPACITY = 2048
SEPARATOR = 0  # id after each document
WORD_END = "</w>"  # what the last token of a word ends with, in vocabularies that mark it

_PIECE_FIELDS = [
    ("doc_id", pa.int64()),
    ("piece", pa.int32()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("part", pa.int32()),
    ("rank", pa.int64()),
]
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


class WordEncoder:
    """Ids of texts, for a tokenizer that lower-cases, and takes white space and changes between letters and punctuation as
    limits of what it encodes.

    Many texts are lower-cased and split in that way at once, and distinct words are encoded once and remembered. Where the opening of a special token occurs, texts are split at white space only.
    """

    def __init__(self, definition: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = os.path.commonprefix([t.content for t in self.tokenizer.get_added_tokens_decoder().values()]).encode()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.plain = self._without_rules()
        self.memory = WordMemory(self.encoded)

    def _without_rules(self):
        """The model alone, with words cut at spaces, if words of small ASCII letters pass the rules before it as they are."""
        from tokenizers import Tokenizer, pre_tokenizers

        rules, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        two = f"{ascii_lowercase} {ascii_lowercase}"
        if cut is None or (rules is not None and rules.normalize_str(two) != two):
            return self.tokenizer
        if [word for word, _ in cut.pre_tokenize_str(two)] != two.split():
            return self.tokenizer
        plain = Tokenizer(self.tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return plain

    def encoded(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, and how many each has. Words of letters have one last token each, so many can be encoded as one text."""
        counts = np.zeros(len(raw), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # numbers of words, their ids
        if self.last.any():
            small = np.fromiter([w.isalpha() and w.islower() for w in raw], bool, len(raw))  # ASCII letters only
            other = [i for i in np.flatnonzero(~small).tolist() if raw[i].decode().isalpha()]
            for tokenizer, own in ((self.plain, np.flatnonzero(small).tolist()), (self.tokenizer, other)):
                for at in range(0, len(own), 1000):
                    part = own[at : at + 1000]
                    text = b" ".join([raw[i] for i in part]).decode()
                    ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                    ends = np.flatnonzero(self.last[ids]) + 1
                    if len(ends) == len(part) and ends[-1] == len(ids):
                        counts[part] = np.diff(ends, prepend=0)
                        found.append((np.array(part), ids))
        alone = np.flatnonzero(counts == 0)
        each = [x.ids for x in self.tokenizer.encode_batch_fast([raw[i].decode() for i in alone.tolist()], add_special_tokens=False)]
        counts[alone] = np.fromiter(map(len, each), np.int64, len(each))
        found.append((alone, np.fromiter(chain.from_iterable(each), np.uint32)))
        begin = np.cumsum(counts) - counts
        out = np.zeros(counts.sum(), np.uint32)
        for own, ids in found:
            n = counts[own]
            out[np.arange(len(ids)) + np.repeat(begin[own] - np.cumsum(n) + n, n)] = ids
        return out, counts

    def split(self, data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of all texts, one after the other; where each begins; how many words stand before each text, and in all."""
        solid = (data != 32) & ((data < 9) | (data > 13))
        opens = np.ones(len(data) + 1, bool)  # may a word begin here?
        opens[1:-1] = ~solid[:-1]
        if not self.special or self.special not in data.tobytes():
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
            letter = (data >= 97) & (data <= 122)
            mark = (data > 32) & (data < 127) & ~letter & ~((data >= 48) & (data <= 57)) & (data != 39)
            opens[1:-1] |= letter[:-1] & mark[1:]
        opens[limits] = True
        start = np.flatnonzero(opens[:-1] & solid)
        return data[solid], (np.cumsum(solid) - 1)[start], np.searchsorted(start, limits)

    def encode(self, data: np.ndarray, limits: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each text, with the separator."""
        letters, start, first = self.split(data, limits)
        flat, ends = self.memory.flat_ids(*distinct_slices(letters, start, pa.binary()))
        for a, b in pairwise(ends[first].tolist()):
            yield np.append(flat[a:b], np.uint32(SEPARATOR))


_encoders: dict[str, WordEncoder] = {}


def pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it starts in its document, its length, the checksum of its ids, if asked for the ids.

    ``part`` and ``rank`` number the pieces of equal length within a task, in the order of its rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value not in _encoders:
            _encoders[shared.value] = WordEncoder(shared.value)
        encoder, part, counts = _encoders[shared.value], TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            data, limits = utf8(batch.column(1))
            for first, last in slabs(limits):
                rows, kept = [], []
                own = encoder.encode(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
                for doc_id, ids in zip(batch.column(0)[first:last].to_pylist(), own, strict=True):
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        n = len(piece)
                        rows.append((doc_id, number, start, n, zlib.crc32(piece.astype("<u4").tobytes()), part, int(counts[n])))
                        counts[n] += 1
                        if with_ids:
                            kept.append(piece.astype(np.int32))
                columns = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _PIECE_FIELDS, strict=True)]
                names = [name for name, _ in _PIECE_FIELDS]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, _PIECES + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, pieces per sequence, first sequence, place in it).

    Lengths above a third of the capacity are matched first, the longest with the longest that fits beside it, at most two in a
    sequence. The others follow in falling order, each into the smallest gap that holds it; a new sequence is
    opened if there is none. Equal lengths and equal gaps are handled by number.
    """
    left = {n: c for n, c in sorted(counts.items()) if n and c}
    used = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[int] = []  # sorted
    free: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences
    opened = 0

    def place(length: int, n: int, each: int, sequence: int, at: int) -> None:
        out.append((length, used[length], used[length] + n, each, sequence, at))
        used[length] += n
        left[length] -= n

    def leave(gap: int, first: int, end: int) -> None:
        if gap and first < end:
            if gap not in free:
                free[gap] = []
                insort(gaps, gap)
            free[gap].append((first, end))

    large = [n for n in left if 3 * n > capacity]
    while large:
        a = large[-1]
        fitting = bisect_left(large, capacity - a + 1) - 1
        b = large[fitting] if fitting >= 0 else 0
        if b == a and left[a] < 2:
            b = large[fitting - 1] if fitting else 0
        if b == a:
            n = left[a] // 2
            place(a, 2 * n, 2, opened, 0)
        elif b:
            n = min(left[a], left[b])
            place(a, n, 1, opened, 0)
            place(b, n, 1, opened, a)
        else:
            n = left[a]
            place(a, n, 1, opened, 0)
        leave(capacity - a - b, opened, opened + n)
        opened += n
        large = [x for x in large if left[x]]
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                first, end, gap = opened, opened - (-left[length] // each), capacity
                opened = end
            else:
                gap = gaps[at]
                first, end = free[gap].pop()
                if not free[gap]:
                    del free[gap], gaps[at]
                each = gap // length
            full = min(end - first, left[length] // each)
            if full:
                place(length, full * each, each, first, capacity - gap)
                leave(gap - each * length, first, first + full)
            rest = left[length] if full < end - first else 0
            if rest:
                place(length, rest, rest, first + full, capacity - gap)
                leave(gap - rest * length, first + full, first + full + 1)
            leave(gap, first + full + bool(rest), end)
    return out


def pack(
    docs: DataFrame,
    definition: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    ``definition`` is the tokenizer's file content. A document is its ids and one separator; null text counts as empty, so it
    is the separator alone. Only documents longer than ``capacity`` are cut. Rows that repeat an id, or have none, are
    packed as documents of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stage = staging(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stage.save(pieces(texts, definition, capacity, with_ids), "pieces")
    counts = found.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage.save(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    # At most ``capacity`` rows, and a few runs for each: both the histogram and the plan are bounded.
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity), "length long, low long, high long, each long, first long, at long"
    )
    rank = F.col("base") + F.col("rank")
    ranked = found.join(bases.select("length", "part", "base"), ["length", "part"]).select(
        *[c for c in found.columns if c not in ("part", "rank")], rank.alias("rank")
    )
    nth = F.col("rank") - F.col("low")
    return (
        ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & rank_within())
        .drop(slots["length"])
        .withColumn("sequence_id", F.col("first") + F.floor(nth / F.col("each")))
        .withColumn("offset", F.col("at") + nth % F.col("each") * F.col("length"))
        .drop("rank", "low", "high", "each", "first", "at")
    )


def rank_within():
    return (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
