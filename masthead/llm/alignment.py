"""How the tokens of two tokenizers lie over each other, by coalescing of their byte intervals.

Both tokenizers cut the same bytes, a space and the text. All tokens of both are sorted by start, and the running maximum of their
ends tells where a group ends: a token that starts where the maximum stands begins the next one. Within a group
every token of one is linked to the tokens of the other that its bytes overlap.

A text is cut before every space that stands between two characters that are none: both tokenizers always cut there. So what
they make of a word depends on the word alone; new words are aligned many at once, and a worker remembers them. When there is
no room for more, it forgets those that were used once only.

How often two ids are linked is counted over all texts. The ``KNOWN_PAIRS`` most frequent pairs, which are most links, go
to all tasks; the links of the others are joined to their counts, and none of those pairs can be frequent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import slabs, staging, utf8
from masthead.llm.memory import distinct_slices, gathered, kept_words

KNOWN_PAIRS = 1 << 20  # pairs of ids that are sent to all tasks
KNOWN_WORDS = 400_000  # words that a worker remembers, at most
KNOWN_CHARS = 1 << 24  # and their characters
TOGETHER = 1000  # words that are encoded as one text
SPACE = "▁"
WIDE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]  # white space beyond ASCII


def byte_level() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(others)}


def blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space."""
    out = (data == 32) | ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 31))
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        padded = np.append(data, np.zeros(2, np.uint8))
        first, second, third = (padded[lead + k].astype(np.int64) for k in range(3))
        two = first == 0xC2
        point = np.where(two, (first & 31) << 6 | second & 63, (first & 15) << 12 | (second & 63) << 6 | third & 63)
        wide = np.isin(point, WIDE)
        for k in range(3):
            out[lead[wide & ~two if k == 2 else wide] + k] = True
    return out


def cut(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut at every space between two characters that are none: the words of all, one after the other, without these spaces;
    where each begins; how many stand before each text, and in all."""
    solid = ~blanks(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    space = np.zeros(len(data), bool)
    space[1:-1] = (data[1:-1] == 32) & solid[:-2] & solid[2:] & ~edge[1:-2] & ~edge[2:-1]
    edge[1:] |= space
    start = np.flatnonzero(edge[:-1])
    return data[~space], start - np.cumsum(space)[start], np.searchsorted(start, limits)


class Aligned:
    """What two tokenizers make of words. ``first`` is the definition of a byte-level BPE, ``second`` a SentencePiece model."""

    def __init__(self, first: str, second: bytes) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.n_b = self.b.get_piece_size()
        of = byte_level()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(of[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)
        ]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("a piece reaches across the beginning of a word")
        self.a_length = np.array([len(b) for b in self.a_bytes])
        self.b_length = np.array([len(b) for b in self.b_bytes])
        n = max(len(self.a_bytes), self.n_b)
        self.digits = np.char.encode(np.arange(n).astype(str)).view(np.uint8).reshape(n, -1)  # zeros behind the last
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.sums = np.zeros((1 << 12, 5), np.int64)  # of a word: whether it failed, tokens of both, groups, links
        self.used = np.zeros(1 << 12, np.int64)
        self.groups: list[str] = []
        self.ends = np.zeros(1, np.int64)
        self.pairs = np.zeros(1 << 14, np.int64)

    def _make_room(self, need: int) -> None:
        """Forget the words that were used once only, and others until half of the room is free."""
        n = len(self.known)
        words = list(self.known)
        kept = kept_words(self.used[:n], min(KNOWN_WORDS // 2, max(0, KNOWN_WORDS - need)))
        often = kept[np.argsort(-self.used[kept], kind="stable")]
        chars = np.cumsum(np.fromiter((len(words[i]) for i in often.tolist()), np.int64, len(often)))
        kept = np.sort(often[chars <= KNOWN_CHARS // 2])
        pairs, _ = gathered(self.pairs, self.ends[kept], self.ends[kept + 1])
        sums, used, at = self.sums[kept], self.used[kept] // 2, kept.tolist()
        strings = [self.groups[i] for i in at]
        self.forget()
        self._remember([words[i] for i in at], sums, strings, pairs)
        self.used[: len(used)] = used

    def _first_ids(self, words: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the first for words with a space before them, and how many each has. Words that neither begin nor end with white
        space are encoded many at once."""
        counts = np.zeros(len(words), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []  # numbers of words, their ids
        regular = [i for i, w in enumerate(words) if w.strip() == w]
        for at in range(0, len(regular), TOGETHER):
            part = np.array(regular[at : at + TOGETHER])
            text = " " + " ".join([words[i] for i in part.tolist()])
            ids = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            ends, limits = np.cumsum(self.a_length[ids]), np.cumsum(size[part])
            last = np.searchsorted(ends, limits)
            if last[-1] == len(ids) - 1 and (ends[last] == limits).all():
                counts[part] = np.diff(last, prepend=-1)
                found.append((part, ids))
        alone = np.flatnonzero(counts == 0)
        each = [x.ids for x in self.a.encode_batch_fast([" " + words[i] for i in alone.tolist()], add_special_tokens=False)]
        counts[alone] = np.fromiter(map(len, each), np.int64, len(each))
        found.append((alone, np.fromiter(chain.from_iterable(each), np.int64)))
        begin = np.cumsum(counts) - counts
        out = np.zeros(counts.sum(), np.int64)
        for own, ids in found:
            n = counts[own]
            out[np.arange(len(ids)) + np.repeat(begin[own] - np.cumsum(n) + n, n)] = ids
        return out, counts

    def learn(self, words: list[str]) -> None:
        """Align words that are not known yet."""
        said = [b" " + w.encode() for w in words]
        size = np.fromiter(map(len, said), np.int64, len(words))
        a, a_count = self._first_ids(words, size)
        other = self.b.encode(words, num_threads=1)
        b_count = np.fromiter(map(len, other), np.int64, len(words))
        b = np.fromiter(chain.from_iterable(other), np.int64, b_count.sum())
        whole = self._spelt(a, a_count, self.a_bytes, self.a_length, said, size)
        whole &= self._spelt(b, b_count, self.b_bytes, self.b_length, said, size)
        kept = np.flatnonzero(whole)
        a, b = a[np.repeat(whole, a_count)], b[np.repeat(whole, b_count)]
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        a_start, b_start = a_end - self.a_length[a], b_end - self.b_length[b]
        word_end = np.cumsum(size[kept])
        of_group, a_group = coalesced(a_start, a_end, b_start, b_end)
        # A token of the first is linked to those of the second from the first that ends behind its start to the last that starts before its end.
        first, last = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
        count = last - first
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        pairs = np.repeat(a, count) * self.n_b + b[place]

        ids, start, group = np.concatenate([a, b]), np.concatenate([a_start, b_start]), of_group
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        order = np.lexsort((start, side, group))
        ids, start, group, side = ids[order], start[order], group[order], side[order]
        fresh = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
        turn = np.r_[True, side[1:] != side[:-1]] if len(side) else np.zeros(0, bool)
        # Each token as a mark and its digits, in a row of its own; without what is empty, the rows are the text.
        rows = np.empty((len(ids), self.digits.shape[1] + 1), np.uint8)
        rows[:, 0] = np.where(fresh, ord(";"), np.where(turn, ord("|"), ord(",")))
        rows[:, 1:] = self.digits[ids]
        seen = rows > 0
        written, written_end = rows[seen].tobytes().decode(), np.append(0, np.cumsum(seen.sum(1)))

        of_word = np.searchsorted(word_end, start, "right")  # groups do not cross words, so words come one after the other
        limits = written_end[np.append(0, np.cumsum(np.bincount(of_word, minlength=len(kept))))].tolist()
        a_word, b_word = np.searchsorted(word_end, a_start, "right"), np.searchsorted(word_end, b_start, "right")
        n_links = np.bincount(a_word, count, len(kept)).astype(np.int64)
        sums = np.zeros((len(words), 5), np.int64)
        sums[~whole, 0] = 1
        sums[kept, 1] = np.bincount(a_word, minlength=len(kept))
        sums[kept, 2] = np.bincount(b_word, minlength=len(kept))
        sums[kept, 3] = np.bincount(of_word[fresh], minlength=len(kept))
        sums[kept, 4] = n_links
        strings = [""] * len(words)
        for i, (begin, end) in zip(kept.tolist(), pairwise(limits), strict=True):
            strings[i] = written[begin + 1 : end]
        self._remember(words, sums, strings, pairs)

    @staticmethod
    def _spelt(ids: np.ndarray, counts: np.ndarray, tokens: list[bytes], length: np.ndarray, said: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which words do their tokens give back? Looked at in one go, as nearly always all do."""
        flat, limits = ids.tolist(), np.append(0, np.cumsum(counts))
        ends = np.append(0, np.cumsum(length[ids]))[limits]
        if (np.diff(ends) == size).all() and b"".join(map(tokens.__getitem__, flat)) == b"".join(said):
            return np.ones(len(said), bool)
        return np.array([b"".join([tokens[t] for t in flat[i:j]]) == w for (i, j), w in zip(pairwise(limits.tolist()), said, strict=True)], bool)

    def _remember(self, words: list[str], sums: np.ndarray, strings: list[str], pairs: np.ndarray) -> None:
        n, used = len(self.known), int(self.ends[len(self.known)])
        while len(self.sums) < n + len(words):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.used = np.concatenate([self.used, np.zeros_like(self.used)])
        while len(self.pairs) < used + len(pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])
        self.sums[n : n + len(words)] = sums
        self.pairs[used : used + len(pairs)] = pairs
        self.ends = np.concatenate([self.ends[: n + 1], used + np.cumsum(sums[:, 4])])
        self.groups += strings
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.chars += sum(map(len, words))

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
        """``aligned`` of texts that are no column; null counts as empty."""
        return self.aligned(*utf8(pa.array(texts, pa.string())))

    def aligned(self, data: np.ndarray, limits: np.ndarray) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
        """For each text the sums over its words (the first is 0 if no word failed), its groups as text, its links as ``a * n_b + b``."""
        letters, start, first = cut(data, limits)
        words, at = distinct_slices(letters, start, pa.string())
        numbers = self._numbers(words)
        missing = np.flatnonzero(numbers < 0)
        if len(missing) and self.known and (len(self.known) + len(missing) > KNOWN_WORDS or self.chars > KNOWN_CHARS):
            self._make_room(len(missing))
            numbers = self._numbers(words)
            missing = np.flatnonzero(numbers < 0)
        if len(missing):
            numbers[missing] = np.arange(len(self.known), len(self.known) + len(missing))
            self.learn([words[i] for i in missing.tolist()])
        self.used[numbers] += np.bincount(at, minlength=len(words))
        strings = np.array([self.groups[i] for i in numbers.tolist()], object)[at].tolist()
        sums_of = self.sums[numbers]
        flat, total = gathered(self.pairs, self.ends[numbers[at]], self.ends[numbers[at] + 1])
        for begin, end in pairwise(first.tolist()):
            sums = sums_of[at[begin:end]].sum(0)
            if sums[0] or begin == end:
                yield np.zeros(5, np.int64), "", flat[:0]
            else:
                yield sums, ";".join(strings[begin:end]), flat[total[begin] : total[end]]


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every interval (those of the first side, then those of the second), and of those of the first side alone."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    side = np.arange(len(start)) >= len(a_start)
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.r_[False, start[order][1:] >= reached[:-1]]
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(breaks)
    return group, group[: len(a_start)]


_aligned: dict[tuple[str, bytes], Aligned] = {}


def _of_worker(parts: tuple[str, bytes]) -> Aligned:
    """The tokenizers of this worker, with the words they remember."""
    if parts not in _aligned:
        _aligned.clear()
        _aligned[parts] = Aligned(*parts)
    return _aligned[parts]


_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], kind))


def groups(docs: DataFrame, first: str, second: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct links with their number
    (``pairs``, ``times``; a pair is the id of the first times the vocabulary size of the second, plus the id of the second).

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens: zeros, and an empty
    string for the hash. Rows that repeat an id get a row each, and ids may be null. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((first, second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _of_worker(shared.value)
        for batch in batches:
            data, limits = utf8(batch.column(1))
            for begin, end in slabs(limits):
                sums, hashes, pairs, times = [], [], [], []
                for total, said, links in own.aligned(data[limits[begin] : limits[end]], limits[begin : end + 1] - limits[begin]):
                    pair, number = np.unique(links, return_counts=True)
                    sums.append(total)
                    hashes.append(hashlib.sha256(said.encode()).hexdigest() if total[1] else "")
                    pairs.append(pair)
                    times.append(number.astype(np.int32))
                table = np.stack(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[begin:end],
                        *[pa.array(table[:, k]) for k in range(1, 5)],
                        pa.array(hashes, pa.string()),
                        _lists(pairs, pa.int64()),
                        _lists(times, pa.int32()),
                    ],
                    [*_FIELDS, "pairs", "times"],
                )

    staging(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"{_ROW}, pairs array<long>, times array<int>")


def link_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, total, best) of the pairs of ids in ``groups``: how many links hold it, and whether no pair with its second id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("e"))
    totals = each.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.times").alias("total")).withColumn("b", F.col("pair") % n_b)
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    return totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))


def aligned_documents(
    docs: DataFrame, first: str, second: bytes, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN_PAIRS
) -> DataFrame:
    """``groups`` without its lists, and n_best (links whose pair is the most frequent one of its second id, ties included) and
    count_sum (the links of the whole table that hold the same pair, summed over the links of the row).

    Null, empty and broken texts have zeros. ``known`` bounds the pairs held by every task, 17 bytes each.
    """
    spark = docs.sparkSession
    stage = staging(spark)
    n_b = _of_worker((first, second)).n_b
    aligned = stage.save(
        groups(docs, first, second, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    counts = stage.save(link_counts(aligned, n_b), "counts")
    top = counts.orderBy(F.desc("total"), "pair").limit(known).toArrow()
    pair = top.column("pair").to_numpy()
    order = np.argsort(pair)
    shared = spark.sparkContext.broadcast((pair[order], top.column("total").to_numpy()[order], top.column("best").to_numpy()[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            ends = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            pairs, times = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], owner[hit], times[hit] * best[at[hit]])
            np.add.at(sums[1], owner[hit], times[hit] * totals[at[hit]])
            rest = np.concatenate([[0], np.cumsum(~hit)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in [*_FIELDS, "row"]],
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(pairs[~hit])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~hit].astype(np.int32))),
                ],
                [*_FIELDS, "row", "n_best", "count_sum", "pairs", "times"],
            )

    schema = f"{_ROW}, row long, n_best long, count_sum long, pairs array<long>, times array<int>"
    found = aligned.select(*_FIELDS, "row", "pairs", "times").mapInArrow(look_up, schema)
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= known:
        return found.select(*result)
    found = stage.save(found, "known")
    rare = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("e"))
    rare = rare.select("row", F.col("e.pairs").alias("pair"), F.col("e.times").alias("times")).join(counts, "pair")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("total")).alias("more_sum"),
    )
    return (
        found.join(rare, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
        .select(*result)
    )
