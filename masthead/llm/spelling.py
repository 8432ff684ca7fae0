"""Spelling variants of words, by k-d trees over how often each letter occurs.

One replaced letter changes the letter counts of a word by two, one more or one less letter by one. So words are points, and
those near a word lie in a small box around it. Words of a length are cut into cells by a k-d tree, fitted on a
sample; a word is sent to the cells of its own length within distance two, and to those of the next length within distance one. In a
cell a second tree finds the points at the right distance, boxes that are too far are passed over, and the words behind them are compared
letter by letter.

Many words can have the same letters, in any order. A candidate must also agree in all of its first or all of its second half, as
one edit leaves one of them as it is. A cell with too many words is divided in the same way: by all but one of
2, 4, 8, ... segments of the word, of which one edit spoils one alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import mix, prefix_hash, span_hash, staging
from masthead.sources.staging import Staging

# Which words count, and how much more frequent a form is than its variants.
SHORTEST = 7
FEWEST = 2
RATIO = 10
TYPO = 31

DIMENSIONS = 32  # a to z have one each, other characters share six
OWN = 26
CELL = 20_000  # words of a cell aimed at
CELLS = 4096  # in all trees together, at most; larger cells are divided by segments
SAMPLE = 100_000  # words the trees are fitted on
LARGEST = 1 << 21  # letters of the words that one task compares
LEAF = 48  # points of a leaf of a task's tree
CHUNK = 1 << 20  # candidates compared at once
COUNTED = 300_000  # words a task counts before it hands them on

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            # One byte a character; those beyond U+00FF are no letters here and become question marks.
            runs = text.as_py().encode("latin-1", "replace").translate(_LETTERS).split()
            key = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in Counter([r for r in runs if len(r) >= SHORTEST]).items():
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), key)
                if h % TYPO == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < SHORTEST:
                        continue
                counts[run] += n
            if len(counts) > COUNTED:
                yield out()
                counts.clear()
    yield out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``SHORTEST`` letters that occur ``FEWEST`` times or more, with typos put in.

    Runs of A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z. Where 31 divides the crc32 of ``<id>:<run>`` (a null id is written as nothing),
    the letter at that number modulo the length is left out. Counted in every task before the shuffle.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= FEWEST)


def _points(words: list[str]) -> np.ndarray:
    """Code points of equally long words, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """How often each letter occurs in the words."""
    letter = np.where((points >= 97) & (points <= 122), points - 97, OWN + points % (DIMENSIONS - OWN)).astype(np.int64)
    at = letter + np.arange(len(points))[:, None] * DIMENSIONS
    counts = np.bincount(at.ravel(), minlength=len(points) * DIMENSIONS).reshape(-1, DIMENSIONS)
    return counts.astype(np.int8 if points.shape[1] < 60 else np.int32)


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """The dimension and count that halve the points best: those with at most that count go left."""
    best = None
    for dim in range(counts.shape[1]):
        column = np.sort(counts[:, dim])
        for limit in {int(column[len(column) // 2]), int(column[len(column) // 2]) - 1}:
            left = int(np.searchsorted(column, limit, "right"))
            if 0 < left < len(column) and (best is None or abs(2 * left - len(column)) < best[0]):
                best = abs(2 * left - len(column)), dim, limit
    return best and best[1:]


def top_tree(counts: np.ndarray, cells: int, numbers: Iterator[int]):
    """A k-d tree as nested (dimension, limit, left, right), the leaves numbered."""
    split = _split(counts) if cells > 1 and len(counts) > 1 else None
    if split is None:
        return next(numbers)
    left = counts[:, split[0]] <= split[1]
    return *split, top_tree(counts[left], cells // 2, numbers), top_tree(counts[~left], cells - cells // 2, numbers)


def cells_near(tree, counts: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """The cells of a tree with the points whose distance to their box is at most ``radius``."""
    low = np.zeros(DIMENSIONS, np.int64)
    high = np.full(DIMENSIONS, np.iinfo(np.int64).max // 2)
    waiting = [(tree, np.arange(len(counts)), np.zeros(len(counts), np.int64), low, high)]
    while waiting:
        node, rows, spent, low, high = waiting.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows
            continue
        dim, limit, left, right = node
        own = counts[rows, dim].astype(np.int64)
        spent = spent - np.maximum(np.maximum(low[dim] - own, own - high[dim]), 0)
        for side, lower, upper in ((left, low[dim], limit), (right, limit + 1, high[dim])):
            now = spent + np.maximum(np.maximum(lower - own, own - upper), 0)
            ok = now <= radius
            low_, high_ = low.copy(), high.copy()
            low_[dim], high_[dim] = lower, upper
            waiting.append((side, rows[ok], now[ok], low_, high_))


def points_at(targets: np.ndarray, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (query, target) of points that are ``distance`` apart, by a k-d tree over the targets that is searched for all queries at once.

    At distance two also equal points, if they have letters that share a dimension: one may have been replaced by another.
    """
    found_q, found_t = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    waiting = [(np.arange(len(targets)), np.arange(len(queries)))]
    while waiting:
        own, asked = waiting.pop()
        box = targets[own]
        # Boxes as tight as their points: a query too far from the box is done with it.
        low, high = box.min(0), box.max(0)
        gap = np.zeros(len(asked), np.int32)
        for dim in range(DIMENSIONS):
            q = queries[asked, dim]
            gap += np.maximum(np.maximum(low[dim] - q, q - high[dim]), 0)
        asked = asked[gap <= distance]
        if not len(asked):
            continue
        split = _split(box) if len(own) > LEAF else None
        if split is not None:
            left = box[:, split[0]] <= split[1]
            waiting += [(own[left], asked), (own[~left], asked)]
            continue
        for first in range(0, len(asked), max(1, CHUNK // len(own))):
            part = asked[first : first + max(1, CHUNK // len(own))]
            apart = np.zeros((len(part), len(own)), queries.dtype)
            for dim in np.flatnonzero((high > 0) | (queries[part].max(0) > 0)).tolist():
                apart += np.abs(queries[part, dim][:, None] - box[:, dim])
            shared = box[:, OWN:].any(1) if distance == 2 else np.zeros(len(own), bool)
            q, t = np.nonzero((apart == distance) | ((apart == 0) & shared))
            found_q.append(part[q])
            found_t.append(own[t])
    return np.concatenate(found_q), np.concatenate(found_t)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter, or, where the second is longer, by one letter more."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    before = np.cumprod(short == long[:, :-1], axis=1, dtype=np.int64).sum(1)
    after = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1, dtype=np.int64).sum(1)
    return before + after >= short.shape[1]


def near_words(targets: list[str], queries: list[str] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (query, target) of equally long words, or of queries one letter shorter, that one edit apart; without queries those among
    the targets, each once."""
    own = _points(targets)
    other = own if queries is None else _points(queries)
    half = other.shape[1] // 2
    skew = own.shape[1] - other.shape[1]
    own_class, own_of = np.unique(letter_counts(own), axis=0, return_inverse=True)
    other_class, other_of = (own_class, own_of) if queries is None else np.unique(letter_counts(other), axis=0, return_inverse=True)
    q_class, t_class = points_at(own_class, other_class, 1 if skew else 2)
    if queries is None:
        once = q_class <= t_class
        q_class, t_class = q_class[once], t_class[once]

    def halves(points: np.ndarray, more: int) -> list[np.ndarray]:
        n, length = points.shape
        running = prefix_hash(mix(points.ravel().astype(np.uint64) + np.uint64(77)))
        start = np.arange(n) * length
        return [span_hash(running, start, start + half), span_hash(running, start + half + more, start + length)]

    # Queries of a class, as stretches of the queries sorted by class.
    by_class = np.argsort(other_of, kind="stable")
    first = np.searchsorted(other_of[by_class], np.arange(len(other_class) + 1))
    number = (first[1:] - first[:-1])[q_class]
    ends = np.cumsum(number)
    found = []
    own_halves, other_halves = halves(own, skew), halves(other, 0)
    spread = np.uint64(0x9E3779B97F4A7C15)
    keyed = []
    for own_half in own_halves:
        keys = mix(own_half + own_of.astype(np.uint64) * spread)
        order = np.argsort(keys)
        keyed.append((keys[order], order))
    step = 0
    while step < len(q_class):
        last = max(step + 1, int(np.searchsorted(ends, ends[step] + CHUNK)))
        count = number[step:last]
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        q = by_class[np.repeat(first[q_class[step:last]], count) + offset]
        t_of = np.repeat(t_class[step:last], count).astype(np.uint64) * spread
        for (keys, order), other_half in zip(keyed, other_halves, strict=True):
            asked = mix(other_half[q] + t_of)
            begin = np.searchsorted(keys, asked)
            hit = np.flatnonzero(keys[np.minimum(begin, len(keys) - 1)] == asked)
            begin, end = begin[hit], np.searchsorted(keys, asked[hit], "right")
            found += _compared(other, own, q[hit], begin, end, order)
        step = last
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    pairs = np.unique(np.sort(pairs, axis=1) if queries is None else pairs, axis=0)
    return pairs[:, 0], pairs[:, 1]


def _compared(other: np.ndarray, own: np.ndarray, q: np.ndarray, begin: np.ndarray, end: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """The pairs one edit apart among queries and their stretches of candidates."""
    out = []
    most = max(1, CHUNK * 8 // max(1, own.shape[1]))
    ends = np.cumsum(end - begin)
    at = 0
    while at < len(q):
        last = max(at + 1, int(np.searchsorted(ends, ends[at] + most)))
        count = (end - begin)[at:last]
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        t = order[np.repeat(begin[at:last], count) + offset]
        s = np.repeat(q[at:last], count)
        ok = _one_edit(other[s], own[t])
        out.append(np.stack([s[ok], t[ok]], 1))
        at = last
    return out


_ROUTED = "cell long, word string, n long, asks boolean"


def _dealt(words: DataFrame, stage: Staging) -> DataFrame:
    """(cell, word, n, asks): every word in the cell it belongs to, and asking in the cells that may hold words near it.

    Cells are numbered by length, leaf of the tree of that length, and whether shorter words ask in it or equally long ones.
    """
    length = F.length("word").alias("length")
    crowded = words.groupBy(length).agg(F.count("*").alias("n")).filter(F.col("n") > CELL)
    sizes = {r["length"]: r["n"] for r in crowded.collect()}  # lengths of more than CELL words
    trees = {}
    if sizes:
        total = sum(sizes.values())
        share = F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < F.lit(min(1.0, SAMPLE / total) * 1_000_000)
        sample = words.filter(F.length("word").isin(list(sizes)) & share).select("word").limit(2 * SAMPLE).toPandas()
        for size, own in sample.groupby(sample["word"].str.len())["word"]:
            cells = max(1, min(-(-sizes[size] // CELL), CELLS * sizes[size] // total))
            trees[size] = top_tree(letter_counts(_points(own.tolist())), cells, iter(range(2 * CELLS)))
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            lengths = np.fromiter(map(len, word), np.int64, len(word))
            rows, cells, asks = [], [], []
            for size in np.unique(lengths).tolist():
                of = np.flatnonzero(lengths == size)
                counts = letter_counts(_points(word[of].tolist()))
                home = np.zeros(len(of), np.int64)
                for cell, inside in cells_near(shared.value.get(size, 0), counts, 0):
                    home[inside] = cell
                for kind in (0, 1):
                    rows.append(of)
                    cells.append((size << 14 | home) << 1 | kind)
                    asks.append(np.zeros(len(of), bool))
                for kind, to, radius in ((0, size, 2), (1, size + 1, 1)):
                    for cell, inside in cells_near(shared.value.get(to, 0), counts, radius):
                        # Of two cells of one length, the words of the lower one ask in the other.
                        asking = inside if kind else inside[home[inside] < cell]
                        rows.append(of[asking])
                        cells.append(np.full(len(asking), (to << 14 | cell) << 1 | kind))
                        asks.append(np.ones(len(asking), bool))
            at = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cells)), pa.array(word[at], pa.string()), pa.array(n[at]), pa.array(np.concatenate(asks))],
                ["cell", "word", "n", "asks"],
            )

    return stage.save(words.select("word", "n").mapInArrow(deal, _ROUTED), "dealt")


def _divided(dealt: DataFrame, stage: Staging) -> DataFrame:
    """``dealt`` with a column ``part``, such that no cell and part holds more than about ``LARGEST`` letters.

    Two words one edit apart agree in all but one of the segments of the shorter one, so they meet in the part of the others.
    """
    waiting, done, segments = dealt.withColumn("part", F.lit("")), None, 1
    while True:
        sizes = waiting.groupBy("cell", "part").agg(
            F.sum(F.length("word")).alias("letters"), F.count("*").alias("words"), F.max(F.length("word")).alias("longest")
        )
        large = sizes.filter((F.col("letters") > LARGEST) & (F.col("words") > 64) & (F.col("longest") >= segments))
        large = stage.save(large.drop("words", "longest"), f"large-{segments}")
        small = waiting.join(large, ["cell", "part"], "left_anti")
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            return done
        segments *= 2
        shifted = F.col("cell").bitwiseAND(F.lit(1)) == 1  # shorter words ask here
        more = F.when(shifted & ~F.col("asks"), 1).otherwise(0)
        short = F.length("word") - more
        nth = F.col("nth")
        rest = waiting.join(large, ["cell", "part"]).withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
        begin, end = F.floor(nth * short / segments).cast("int"), F.floor((nth + 1) * short / segments).cast("int")
        others = F.xxhash64(F.substring("word", F.lit(1), begin), F.substring("word", end + more + 1, F.length("word")))
        parts = F.ceil(F.col("letters") * 2 / LARGEST)
        name = F.concat_ws("/", "part", F.concat_ws(":", nth.cast("string"), F.pmod(others, parts).cast("string")))
        waiting = stage.save(rest.withColumn("part", name).select("cell", "word", "n", "asks", "part"), f"divided-{segments}")


def _pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Both directions of the near pairs of a cell: a word, a word near it, and how often that occurs."""
    asks = frame["asks"].to_numpy()
    word, n = frame["word"].to_numpy(), frame["n"].to_numpy()
    own, other = np.flatnonzero(~asks), np.flatnonzero(asks)
    longer = int(frame["cell"].iloc[0]) & 1
    out = []
    if len(own):
        if not longer:
            q, t = near_words(word[own].tolist())
            out.append((own[q], own[t]))
        if len(other):
            q, t = near_words(word[own].tolist(), word[other].tolist())
            out.append((other[q], own[t]))
    a = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
    b = np.concatenate([y for _, y in out]) if out else np.zeros(0, np.int64)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    return pd.DataFrame({"word": word[a], "near": word[b], "near_n": n[b]})


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n; words distinct): word, form, root, n, n_near, form_n.

    Two words are near if they differ by one inserted, deleted or replaced code point. The form of a word is its near word of largest n,
    of equally frequent ones the first in code-point order, if that is at least ``ratio`` times its own n. The root is
    the last of the forms of forms. ``ratio`` must be more than one. An empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its variants")
    stage = staging(words.sparkSession)
    words = stage.save(words.select("word", "n"), "words")
    pairs = _divided(_dealt(words, stage), stage).groupBy("cell", "part").applyInPandas(_pairs, "word string, near string, near_n long")
    best = pairs.distinct().groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    form_n = -F.col("best.col1")
    is_form = F.coalesce(form_n >= ratio * F.col("n"), F.lit(False))
    found = found.select(
        "word",
        F.when(is_form, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, form_n).alias("form_n"),
    )
    found = stage.save(found, "forms")
    # Every form is ``ratio`` times as frequent, so chains are short; each round doubles the steps taken.
    links = found.filter("form is not null").select("word", F.col("form").alias("root"))
    links, step = stage.save(links, "roots-0"), 0
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step += 1
        moved = stage.save(moved, f"roots-{step}")
        links = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            break
    result = found.join(links, "word", "left")
    return result.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
