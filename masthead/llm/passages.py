"""Passages that documents share, exactly or nearly, by collinear chaining of k-mer seeds.

Every word k-mer of a text is a seed. A passage has four equal words for each place where its sides differ, so its equal words cannot all
stand in runs shorter than ``KMER``. A seed that occurs in several documents is joined to its first occurrence, never to all others, so a
passage found in n documents costs n matches. Two seeds side by side, with at most one word between, are joined to the first document that has both
like that, and every stretch of ``LENGTH`` words that another document repeats to its first occurrence: they lead to the source of a passage whose
seeds all stand in other texts before. The matches of two documents are chained: ordered in both, as many words as possible, less a cost for what lies between, found with a
Fenwick tree of prefix maxima. Along a chain, of one match or more, only what lies between its matches, and a margin, is aligned, and
stretches of at least ``LENGTH`` words that agree in ``AGREEMENT`` of them are passages. A match on another diagonal of such a region is looked at
too, unless a passage found there has its words.

Seeds are joined in ``PARTS`` by their hash, one after the other, so that only a part of them is on disk. Places and matches are shuffled as blocks of
those of one bucket of hashes or documents, in planes of bytes, and sorted as arrays. Most short chains are no passage. In a passage at least
``SEEDS`` seeds stand within ``LENGTH`` words, so where fewer repeated seeds do, nothing is cut out of the texts; of what is left, a byte
of each word shows which can be a passage, and only those are aligned.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial, reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.llm.common import mix, prefix_hash, slabs, span_hash, staging, utf8, words
from masthead.sources.staging import Staging

KMER = 4  # words
PARTS = 2  # of the seeds
SLAB = 1 << 17  # bytes of text whose words are hashed at once: their numbers stay in a core's cache
LENGTH = 50  # words of a passage
AGREEMENT = 0.8  # of the longer side's words
GAP_COST = 0.05  # per word skipped on either side
MARGIN = LENGTH  # words looked at around a chain
MISMATCH = 4  # words an alignment loses for each that differs, when it is cut back to its best part
ASKED = 1000  # stretches of a text that are cut out of it by one row
SHORT = 6 * LENGTH  # words of a stretch that is looked at by bytes first
TOGETHER = 1000  # pairs of stretches whose words are counted at once
CELLS = 1 << 28  # bits of an alignment; above, equal words are looked for near the diagonals only
DIFFER = round((1 - AGREEMENT) * LENGTH)  # words of the shortest passage that differ, at most
SEEDS = LENGTH - DIFFER - (KMER - 1) * (DIFFER + 1)  # of a passage stand within LENGTH words, at least: its equal words are in DIFFER + 1 runs
REGION = ["doc_id", "source_id", "start", "end", "source_start", "source_end"]
RUN = "array<struct<start:long,source_start:long,n:long,equal:boolean>>"
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("source_start", pa.int64()), ("n", pa.int64()), ("equal", pa.bool_())]))
PLACE = np.dtype([("seed", "<u8"), ("doc_id", "<i8"), ("at", "<i4")])
MATCH = np.dtype([("doc_id", "<i8"), ("at", "<i4"), ("source_id", "<i8"), ("source_at", "<i4"), ("whole", "?")])
LINK = np.dtype([*MATCH.descr[:-1], ("kind", "u1")])  # the same bytes: a match of a seed, of a window of LENGTH words, or of two seeds side by side
WHOLE, BESIDE = 1, 2
BLOCKS = "bucket int, rows binary"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BUCKETS = 12  # bits: of the hash of a seed, or of a document
DEALT = 1 << 20  # places or matches that are dealt to the buckets at once
SORTED = 1 << 17  # rows of whole buckets that are sorted together, at least
LIMIT = 1 << 22  # places of a bucket that a task has in memory; more lie in a temporary file


def _starts(owner: np.ndarray) -> np.ndarray:
    """Places of the k-mers; texts shorter than a k-mer have none."""
    start = np.arange(max(0, len(owner) - KMER + 1))
    return start[owner[start] == owner[start + KMER - 1]]


def _placed(value: np.ndarray, place: np.ndarray, owner: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> np.ndarray:
    text = owner[place]
    out = np.empty(len(place), PLACE)
    out["seed"], out["doc_id"], out["at"] = value, ids[text], place - begin[text]
    return out


def _dealt(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of BLOCKS: the rows of each bucket of the first column, as planes of their bytes, which compress well."""
    held, n = [], 0
    for rows in parts:
        held.append(rows)
        n += len(rows)
        if n >= DEALT:
            yield _blocks(np.concatenate(held))
            held, n = [], 0
    if n:
        yield _blocks(np.concatenate(held))


def _blocks(rows: np.ndarray) -> pa.RecordBatch:
    bucket = (mix(rows[rows.dtype.names[0]].astype(np.uint64)) >> np.uint64(64 - BUCKETS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    planes = np.concatenate([np.ascontiguousarray(rows[n][order]).view(np.uint8).reshape(len(rows), -1).T for n in rows.dtype.names])
    cut = [planes[:, a:b].tobytes() for a, b in pairwise([*first.tolist(), len(rows)])]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(cut, pa.binary())], ["bucket", "rows"])


def _gathered(batches: Iterator[pa.RecordBatch], kind: np.dtype, most: float = float("inf")) -> Iterator[tuple[np.ndarray, bool]]:
    """The rows of whole buckets from BLOCKS in order of them, and True; of a bucket with more than ``most`` rows in several parts, all but the last with False."""
    held, n, before = [], 0, None
    for batch in batches:
        data, limits = utf8(batch.column(1))
        limits = limits.tolist()
        for k, bucket in enumerate(batch.column(0).to_pylist()):
            if bucket != before and n >= SORTED or n >= most:
                yield np.concatenate(held).view(kind)[:, 0], bucket != before
                held, n = [], 0
            rows = np.ascontiguousarray(data[limits[k] : limits[k + 1]].reshape(kind.itemsize, -1).T)
            held.append(rows)
            n += len(rows)
            before = bucket
    if held:
        yield np.concatenate(held).view(kind)[:, 0], True


def _seeds(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hash and place of the k-mers of one part."""
    for batch in batches:
        data, limits = utf8(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for first, last in slabs(limits, SLAB):
            word, owner, _ = words(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
            begin = np.searchsorted(owner, np.arange(last - first))
            start = _starts(owner)
            kmer = span_hash(prefix_hash(word), start, start + KMER)
            own = kmer % np.uint64(PARTS) == part
            yield _placed(kmer[own], start[own], owner, begin, ids[first:last])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hash and place of the stretches of ``LENGTH`` words that another document can have: those without a seed that is in no other."""
    for batch in batches:
        data, limits = utf8(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        repeated, among = utf8(batch.column(2))
        for first, last in slabs(limits, SLAB):
            word, owner, _ = words(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
            begin = np.searchsorted(owner, np.arange(last - first))
            place = _starts(owner)
            known = repeated[among[first] : among[last]].view("<i4").astype(np.int64)
            count = np.diff(among[first : last + 1]) // 4
            known += np.repeat(begin, count)
            known = known[known < np.repeat(np.r_[begin[1:], len(word)], count)]  # rows that share an id have the places of all of them
            single = np.zeros(len(word) + 1, np.int64)
            single[place + 1] = 1
            single[known + 1] = 0
            single = np.cumsum(single)
            at = np.arange(max(0, len(word) - LENGTH + 1))
            at = at[(owner[at] == owner[at + LENGTH - 1]) & (single[at + LENGTH - KMER + 1] == single[at])]
            yield _placed(span_hash(prefix_hash(word), at, at + LENGTH), at, owner, begin, ids[first:last])


class PrefixMaxima:
    """A Fenwick tree: the largest (value, item) put at a place below a given one."""

    def __init__(self, n: int) -> None:
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, place: int, value: float, item: int) -> None:
        place += 1
        while place < len(self.best):
            if self.best[place][0] < value:
                self.best[place] = (value, item)
            place += place & -place

    def below(self, place: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        while place:
            if self.best[place][0] > found[0]:
                found = self.best[place]
            place -= place & -place
        return found


def chains(matches: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """The chains of matches (place in one text, place in the other): first and last places, best chains first."""
    return [(p[0][0], p[-1][0] + KMER, p[0][1], p[-1][1] + KMER) for p in paths(matches)]


def paths(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The matches of each chain, best chains first.

    A match continues the chain that leaves it the most: words so far, less GAP_COST for every word skipped on either side.
    """
    matches = sorted(set(matches))
    if all(a < c and b < d for (a, b), (c, d) in pairwise(matches)):
        return _in_order(matches)
    rank = {b: i for i, b in enumerate(sorted({b for _, b in matches}))}
    tree = PrefixMaxima(len(rank))
    total, before = [0.0] * len(matches), [-1] * len(matches)
    i = 0
    while i < len(matches):
        same = i
        while same < len(matches) and matches[same][0] == matches[i][0]:
            a, b = matches[same]
            value, item = tree.below(rank[b])
            total[same] = KMER
            if item >= 0 and value - GAP_COST * (a + b) > 0:
                pa_, pb = matches[item]
                total[same] = min(KMER, a - pa_, b - pb) + value - GAP_COST * (a + b)
                before[same] = item
            same += 1
        for k in range(i, same):  # matches at one place do not follow each other
            a, b = matches[k]
            tree.put(rank[b], total[k] + GAP_COST * (a + b), k)
        i = same
    out, used = [], [False] * len(matches)
    for end in sorted(range(len(matches)), key=lambda k: -total[k]):
        if used[end]:
            continue
        at = end
        used[at] = True
        path = [matches[at]]
        while before[at] >= 0 and not used[before[at]]:
            at = before[at]
            used[at] = True
            path.append(matches[at])
        out.append(path[::-1])
    return out


def _in_order(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The same where every match follows all before it: then the one just before leaves it the most."""
    out: list[tuple[float, int, list[tuple[int, int]]]] = []
    for a, b in matches:
        if out:
            total, _, path = out[-1]
            da, db = a - path[-1][0], b - path[-1][1]
            if total - GAP_COST * (da + db) > 0:
                path.append((a, b))
                out[-1] = total - GAP_COST * (da + db) + min(KMER, da, db), len(out), path
                continue
        out.append((KMER, len(out), [(a, b)]))
    return [path for _, _, path in sorted(out, key=lambda c: -c[0])]


def _near_diagonals(a: np.ndarray, b: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Places of equal words in order, as many as possible; they are looked for between the diagonals ``low`` and ``high`` and near them."""
    pairs: list[tuple[int, int]] = []
    places: dict[int, list[int]] = {}
    for j, word in enumerate(b.tolist()):
        places.setdefault(word, []).append(j)
    # A longest increasing run of equal words, near the diagonals; the tree keeps this n log n.
    candidates = []
    for i, word in enumerate(a.tolist()):
        own = places.get(word)
        if own:
            begin, end = bisect_left(own, i + low - MARGIN), bisect_left(own, i + high + MARGIN + 1)
            candidates += [(i, j) for j in own[begin:end]]
    tree = PrefixMaxima(len(b))
    total, before = [0] * len(candidates), [-1] * len(candidates)
    k = 0
    while k < len(candidates):
        end = k
        while end < len(candidates) and candidates[end][0] == candidates[k][0]:
            value, item = tree.below(candidates[end][1])
            total[end] = int(value) + 1 if item >= 0 else 1
            before[end] = item
            end += 1
        for c in range(k, end):
            tree.put(candidates[c][1], total[c], c)
        k = end
    if not candidates:
        return pairs
    at = max(range(len(candidates)), key=total.__getitem__)
    while at >= 0:
        pairs.append(candidates[at])
        at = before[at]
    return pairs[::-1]


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; a bit of a row says that the word of ``b`` adds nothing to what was common so far."""
    where: dict[int, int] = {}
    for j, word in enumerate(b):
        where[word] = where.get(word, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for word in a:
        if hit := row & where.get(word, 0):
            row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((i, j))
    return out[::-1]


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of equal words in order, as many as possible."""
    if not len(a) or not len(b):
        return np.zeros((0, 2), np.int64)
    if len(a) == len(b):
        same = np.flatnonzero(a == b)
        if len(same) >= AGREEMENT * len(a):
            return np.stack([same, same], 1)
    if len(a) * len(b) <= CELLS:
        pairs = _common(a.tolist(), b.tolist())
    else:
        pairs = _near_diagonals(a, b, min(0, len(b) - len(a)), max(0, len(b) - len(a)))
    return np.array(pairs, np.int64).reshape(-1, 2)


def _aligned(a: np.ndarray, b: np.ndarray, track: list[tuple[int, int, int, bool]]) -> np.ndarray:
    """Places of equal words: along the runs of ``track`` (start in either, words, known to be equal), and as many as possible between them."""
    parts, i, j = [], 0, 0
    for start, other, n, equal in track:
        skip = max(0, i - start, j - other)
        start, other, n = start + skip, other + skip, n - skip
        if n <= 0:
            continue
        parts.append(_between(a[i:start], b[j:other]) + (i, j))
        n = max(0, min(n, len(a) - start, len(b) - other))
        same = np.arange(n) if equal else np.flatnonzero(a[start : start + n] == b[other : other + n])
        parts.append(np.stack([start + same, other + same], 1))
        i, j = start + n, other + n
    parts.append(_between(a[i:], b[j:]) + (i, j))
    return np.concatenate(parts)


def align(a: np.ndarray, b: np.ndarray, track: list[tuple[int, int, int, bool]] | None = None) -> list[tuple[int, int, int, int, int]]:
    """The passages of two word sequences: start and end in either, number of equal words.

    The stretch of the highest score (equal words, less MISMATCH for each other) first, then what qualifies left and right of it.
    """
    pairs = _aligned(a, b, track or [])
    if len(pairs) < AGREEMENT * LENGTH:
        return []
    skipped = (np.diff(pairs, axis=0) - 1).max(1)
    step = 1 - MISMATCH * np.r_[0, skipped]
    out, left = [], [(0, len(pairs))]
    while left:
        first, last = left.pop()
        if found := _stretch(pairs, step, first, last):
            begin, end = found
            (i, j), (last_i, last_j) = pairs[begin].tolist(), pairs[end].tolist()
            out.append((i, last_i + 1, j, last_j + 1, end - begin + 1))
            left += [(first, begin), (end + 1, last)]
    return sorted(out)


def _stretch(pairs: np.ndarray, step: np.ndarray, first: int, last: int) -> tuple[int, int] | None:
    """First and last of the equal words of a passage among ``first`` to ``last``: of the best score, or the longest of any score from 0."""
    if last - first < AGREEMENT * LENGTH:
        return None
    total = np.cumsum(step[first:last])
    # A stretch from k scores total - before[k]: its first word counts 1, whatever lies before it.
    before = total - 1
    lowest = np.minimum.accumulate(before)
    end = int((total - lowest).argmax())
    begin = int(before[: end + 1].argmin())
    if _long(pairs, first + begin, first + end):
        return first + begin, first + end
    # The last place that scores at least as much as what lies before k.
    highest = np.maximum.accumulate(total[::-1])[::-1]
    ends = np.searchsorted(-highest, -before, "right") - 1
    spans = (pairs[first + ends] - pairs[first:last]).min(1)
    begin = int(spans.argmax())
    end = int(ends[begin])
    return (first + begin, first + end) if _long(pairs, first + begin, first + end) else None


def _long(pairs: np.ndarray, begin: int, end: int) -> bool:
    return int((pairs[end] - pairs[begin]).min()) + 1 >= LENGTH


def runs(windows: np.ndarray) -> list[tuple[int, int, int]]:
    """Equal stretches, as start in either text and number of words, from the places of their ``LENGTH``-word windows.

    Those that add no word to others are left out: in a text that repeats itself every place has one of its own.
    """
    if not len(windows):
        return []
    at, shift = windows[:, 0], windows[:, 1] - windows[:, 0]
    order = np.lexsort((at, shift))
    at, shift = at[order], shift[order]
    new = np.r_[True, (shift[1:] != shift[:-1]) | (at[1:] > at[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    out = zip(at[first].tolist(), (at + shift)[first].tolist(), (at[last] - at[first] + LENGTH).tolist(), strict=True)
    kept: list[tuple[int, int, int]] = []
    for run in sorted(out, key=lambda r: (r[0], -r[2])):
        if kept and run[0] + run[2] <= kept[-1][0] + kept[-1][2]:
            continue
        while len(kept) > 1 and run[0] <= kept[-2][0] + kept[-2][2]:
            kept.pop()
        kept.append(run)
    return kept


def _settled(path: list[tuple[int, int]], anchored: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """The matches without those that share words with the next one on another diagonal: no alignment has both."""
    return [(a, b) for (a, b), (c, d) in pairwise(path) if min(c - a, d - b) >= KMER or c - a == d - b or (a, b) in anchored] + path[-1:]


def track(path: list[tuple[int, int]], anchored: dict[tuple[int, int], int], equal: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """The runs of a chain: matches of one diagonal that are at most MARGIN apart, and the parts of equal stretches it goes along."""
    out: list[tuple[int, int, int, int]] = []  # start in either, words, number of the equal stretch or -1
    for i, j in path:
        own = anchored.get((i, j), -1)
        end = i + KMER
        if own >= 0 and end + 2 * KMER > equal[own][0] + equal[own][2]:  # its last anchor
            end = equal[own][0] + equal[own][2]
        if out:
            start, other, n, before = out[-1]
            if before == own and j - i == other - start and (own >= 0 or i <= start + n + MARGIN):
                out[-1] = start, other, max(n, end - start), own
                continue
        out.append((i, j, end - i, own))
    return [(i, j, n, own >= 0) for i, j, n, own in out]


def _pieces(start: int, end: int, holes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of ``start`` to ``end`` lies outside the holes, which are in order."""
    out = []
    for first, last in holes:
        if first > start:
            out.append((start, first))
        start = max(start, last)
    return [*out, (start, end)] if end > start else out


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches to align with their runs, and the equal stretches in each, which are passages whatever the alignment says."""
    for batch in batches:
        rows = []
        listed = batch.column(2)
        limits = np.r_[0, np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))].tolist()
        at, source_at, whole, *beside = (c.to_numpy(zero_copy_only=False) for c in listed.flatten().flatten())
        places, whole = np.stack([at, source_at], 1).astype(np.int64), whole.astype(bool)
        first = np.array(limits[:-1], np.int64)
        single = np.diff(limits) == 1
        single[single] = ~whole[first[single]]
        yield _alone(batch.filter(pa.array(single)), places[first[single]])
        for k in np.flatnonzero(~single).tolist():
            doc, source = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            own, full = places[limits[k] : limits[k + 1]], whole[limits[k] : limits[k + 1]]
            equal = runs(own[full])
            anchored = {(i + k, j + k): r for r, (i, j, n) in enumerate(equal) for k in range(0, n - KMER + 1, 2 * KMER)}
            only_beside = set(map(tuple, own[beside[0][limits[k] : limits[k + 1]]].tolist())) if beside else ()
            regions, aside = [], []
            for path in paths([*map(tuple, _outside(own[~full], equal).tolist()), *anchored]):
                if regions and (len(path) == 1 or only_beside and sum(m not in only_beside for m in path) <= 1):
                    (i, j), (last, source_last) = path[0], path[-1]
                    inside = next((k for k, r in enumerate(regions) if r[0] <= i and last < r[1] and r[2] <= j and source_last < r[3]), None)
                    if inside is not None:
                        aside[inside] += path  # may be aligned as a part of that region
                        continue
                kept = _settled(path, anchored)
                # Seeds say how the texts are aligned; those that only lead there together say how far.
                way = track(only_beside and [m for m in kept if m not in only_beside] or kept, anchored, equal)
                regions.append([*_around([*way, (*kept[0], KMER, False), (*kept[-1], KMER, False)]), way, []])
                aside.append([*set(path).difference(kept)] if len(kept) < len(path) else [])
            for i, j, n in equal:
                inside = [r for r in regions if r[0] <= i and i + n <= r[1] and r[2] <= j and j + n <= r[3]]
                if not inside:
                    inside = [[i, i + n, j, j + n, [(i, j, n, True)], []]]
                    regions += inside
                inside[0][-1].append((i, j, n, True))
            for region, off in zip(regions, aside, strict=False):
                if off:
                    off = sorted(m for m in off if not any(i <= m[0] and m[0] + KMER <= i + n for i, _, n in equal))
                    region[4] = region[4] + [(i, j, 0, False) for i, j in off]  # runs of no words: matches off the diagonals of the others
            rows += [(doc, source, *r) for r in regions]
        columns = zip(*rows, strict=True) if rows else [[]] * 8
        kinds = [pa.int64()] * 6 + [RUNS] * 2
        yield pa.RecordBatch.from_arrays([_column(c, k) for c, k in zip(columns, kinds, strict=True)], [*REGION, "track", "equal"])


def _around(way: list[tuple[int, int, int, bool]]) -> list[int]:
    """A region: runs and a margin."""
    start, source_start = min(i for i, *_ in way), min(j for _, j, *_ in way)
    limit = max(i + n for i, _, n, _ in way), max(j + n for _, j, n, _ in way)
    return [max(0, start - MARGIN), limit[0] + MARGIN, max(0, source_start - MARGIN), limit[1] + MARGIN]


def _alone(batch: pa.RecordBatch, matches: np.ndarray) -> pa.RecordBatch:
    """The same for pairs of texts with one match each."""
    n = len(matches)
    spans = [s for side in matches.T for s in (np.maximum(0, side - MARGIN), side + KMER + MARGIN)]
    run = pa.StructArray.from_arrays([matches[:, 0], matches[:, 1], np.full(n, KMER), np.zeros(n, bool)], fields=list(RUNS.value_type))
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), run) for ends in (np.arange(n + 1), np.zeros(n + 1))]
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, spans), *lists], [*REGION, "track", "equal"])


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
    return pa.array([[dict(zip(names, run, strict=True)) for run in own] for own in values], kind)


def _outside(seeds: np.ndarray, equal: list[tuple[int, int, int]]) -> np.ndarray:
    """The matches that are not part of an equal stretch."""
    if not equal or not len(seeds):
        return seeds
    i, j, n = np.array(equal, np.int64).T
    order = np.lexsort((i, j - i))
    i, n, shift = i[order], n[order], (j - i)[order]
    at, own = seeds[:, 0], seeds[:, 1] - seeds[:, 0]
    key, asked = shift * (1 << 32) + i, own * (1 << 32) + at
    k = np.searchsorted(key, asked, "right") - 1
    return seeds[~((k >= 0) & (shift[k] == own) & (at + KMER <= i[k] + n[k]))]


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A byte of each word of the asked stretches of each text."""
    for batch in batches:
        data, limits = utf8(batch.column(1))
        for first, last in slabs(limits, SLAB):
            word, owner, _ = words(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
            begin, raw = np.searchsorted(owner, np.arange(last - first + 1)), word.astype("u1").tobytes()
            asked = batch.column(2).slice(first, last - first)
            text = np.repeat(np.arange(last - first), asked.value_lengths().to_numpy(zero_copy_only=False))
            region, own, start, end = asked.flatten().flatten()
            start = begin[text] + start.to_numpy(zero_copy_only=False)
            end = np.minimum(begin[text] + end.to_numpy(zero_copy_only=False), begin[text + 1])
            cut = [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([region, own, pa.array(cut, pa.binary())], ["region", "own", "words"])


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the asked stretches of each text, without what is known to be equal."""
    for batch in batches:
        data, limits = utf8(batch.column(1))
        for first, last in slabs(limits, SLAB):
            word, owner, _ = words(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
            begin, word = np.searchsorted(owner, np.arange(last - first + 1)).tolist(), word.astype("<u8", copy=False)
            columns = [], [], []
            for asked, (start, end) in zip(batch.column(2).slice(first, last - first).to_pylist(), pairwise(begin), strict=True):
                for a in asked:
                    columns[0].append(a["region"])
                    columns[1].append(a["own"])
                    columns[2].append(b"".join(word[start + p["first"] : min(start + p["last"], end)].tobytes() for p in a["pieces"]))
            kinds = pa.int64(), pa.bool_(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["region", "own", "words"])


def _filled(cut: bytes, start: int, pieces: list[tuple[int, int]]) -> np.ndarray:
    """A stretch again, with zeros where it is known to be equal; it ends where its text does."""
    values, used = np.frombuffer(cut, "<u8"), 0
    out = np.zeros(max((last for _, last in pieces), default=start) - start, np.uint64)
    for first, last in pieces:
        part = values[used : used + last - first]
        out[first - start : first - start + len(part)] = part
        used += len(part)
        if len(part) < last - first:
            return out[: first - start + len(part)]
    return out


def _can_be(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The regions with enough words in common, in order, for a passage; words count as equal whose bytes are."""
    least = AGREEMENT * LENGTH
    for frame in frames:
        a, b = frame["own"].to_numpy(), frame["other"].to_numpy()
        can = np.zeros(len(frame), bool)
        for first in range(0, len(frame), TOGETHER):
            for k in np.flatnonzero(_most_common(a[first : first + TOGETHER], b[first : first + TOGETHER]) >= least).tolist():
                can[first + k] = _n_common(a[first + k], b[first + k]) >= least
        yield frame.loc[can, ["region"]]


def _most_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair, the number of words in common in any order: in order they have no more."""
    counts = []
    for side in (a, b):
        pair = np.repeat(np.arange(len(side)) * 256, [len(words) for words in side])
        counts.append(np.bincount(pair + np.frombuffer(b"".join(side), np.uint8), minlength=256 * len(side)))
    return np.minimum(*counts).reshape(-1, 256).sum(1)


def _n_common(a: bytes, b: bytes) -> int:
    """Length of a longest common subsequence, as in ``_common``."""
    where: dict[int, int] = {}
    for j, word in enumerate(b):
        where[word] = where.get(word, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for word in a:
        if hit := row & where.get(word, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def _passages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            every = [(t["start"], t["source_start"], t["n"], t["equal"]) for t in r.track]
            way, aside = [t for t in every if t[2]], [t[:2] for t in every if not t[2]]
            texts = []
            for cut, start, end, side in ((r.own, r.start, r.end, "start"), (r.other, r.source_start, r.source_end, "source_start")):
                pieces = _cut(start, end, r.track, side)
                first = min([start, *(p[0] for p in pieces)])
                texts.append((first, _filled(cut, first, pieces)))
            own = _found(*texts, [r.start, r.end, r.source_start, r.source_end], way)
            for e in r.equal:
                _add(own, (e["start"], e["start"] + e["n"], e["source_start"], e["source_start"] + e["n"], e["n"]))
            # What no passage so far has may be in another one, on another diagonal.
            for i, j in aside:
                region = _around([(i, j, KMER, False)])
                if not any(p[0] <= i and i + KMER <= p[1] for p in own) and _enough_words(*texts, region):
                    for passage in _found(*texts, region, [(i, j, KMER, False)]):
                        _add(own, passage)
            rows += [(r.doc_id, r.source_id, *p) for p in own]
        yield pd.DataFrame(rows, columns=[*REGION, "n_equal"], dtype="int64")


def _found(
    text: tuple[int, np.ndarray], source: tuple[int, np.ndarray], region: list[int], way: list[tuple[int, int, int, bool]]
) -> list[tuple[int, int, int, int, int]]:
    """The passages of a region of two stretches, each given by where it starts in its text, and its words."""
    (first, a), (source_first, b) = text, source
    start, end, source_start, source_end = region
    way = [(i - start, j - source_start, n, equal) for i, j, n, equal in way]
    found = align(a[start - first : end - first], b[source_start - source_first : source_end - source_first], way)
    return [(start + i, start + end_i, source_start + j, source_start + end_j, n) for i, end_i, j, end_j, n in found]


def _enough_words(text: tuple[int, np.ndarray], source: tuple[int, np.ndarray], region: list[int]) -> bool:
    """Whether a region has enough words in common, in order, for a passage; words count as equal whose bytes are."""
    (first, a), (source_first, b) = text, source
    start, end, source_start, source_end = region
    a = a[start - first : end - first].astype("u1").tobytes()
    b = b[source_start - source_first : source_end - source_first].astype("u1").tobytes()
    in_both = min(len(a) - len(a.translate(None, b)), len(b) - len(b.translate(None, a)))  # in any order
    least = AGREEMENT * LENGTH
    return in_both >= least and _n_common(a, b) >= least


def _add(found: list[tuple[int, int, int, int, int]], passage: tuple[int, int, int, int, int]) -> None:
    if not any(p[0] <= passage[0] and passage[1] <= p[1] and p[2] <= passage[2] and passage[3] <= p[3] for p in found):
        found.append(passage)


def _cut(start: int, end: int, way: list[dict], side: str) -> list[tuple[int, int]]:
    """What of a stretch is compared: all but what is known to be equal, but that too and more if there are matches on other diagonals."""
    if aside := [t[side] for t in way if not t["n"]]:
        return [(max(0, min(start, min(aside) - MARGIN)), max(end, max(aside) + KMER + MARGIN))]
    return _pieces(start, end, [(t[side], t[side] + t["n"]) for t in way if t["equal"]])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both stretches of every region, as the pieces whose words are wanted."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        docs, regions, sides, pieces = [], [], [], []
        for r in batch.to_pylist():
            for doc, start, end in (("doc_id", "start", "end"), ("source_id", "source_start", "source_end")):
                docs.append(r[doc])
                regions.append(r["region"])
                sides.append(doc == "doc_id")
                pieces.append([{"first": a, "last": b} for a, b in _cut(r[start], r[end], r["track"], start)])
        columns = [pa.array(docs, pa.int64()), pa.array(regions, pa.int64()), pa.array(sides, pa.bool_()), pa.array(pieces, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "region", "own", "pieces"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches from places in order: every place of a hash that several documents have, with the first of these places.

    Of the last hash of a batch, rows are kept only while no second document has come.
    """
    held, known = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)], None
    for batch in batches:
        seed, doc, at = (np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True))
        if not len(seed):
            continue
        new = np.r_[True, seed[1:] != seed[:-1]]
        first, run = np.flatnonzero(new), np.cumsum(new) - 1
        source, source_at = doc[first], at[first]
        several = doc[np.r_[first[1:], len(seed)] - 1] > source
        if known and known[0] == seed[0]:
            (_, source[0], source_at[0]), several[0] = known, True
        known = (seed[-1], source[-1], source_at[-1]) if several[-1] else None
        held = [c[len(c) if known else first[-1] :].copy() for c in (seed, doc, at)]
        own = several[run]
        columns = [doc[own], at[own], source[run][own], source_at[run][own]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "at", "source_id", "source_at"])


def _ordered(rows: np.ndarray) -> pa.RecordBatch:
    """Places in order, without those whose hash no other has."""
    seed = rows["seed"]
    order = np.argsort(seed)
    same = np.diff(seed[order]) == 0
    rows = rows[order[np.r_[same, False] | np.r_[False, same]]]
    rows = rows[np.lexsort((rows["at"], rows["doc_id"], rows["seed"]))]
    return pa.RecordBatch.from_arrays([pa.array(rows["seed"].view(np.int64)), pa.array(rows["doc_id"]), pa.array(rows["at"])], list(PLACE.names))


def _firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of every hash, in order of the hashes, and whether several documents have it."""
    rows = rows[np.lexsort((rows["at"], rows["doc_id"], rows["seed"]))]
    new = np.r_[True, rows["seed"][1:] != rows["seed"][:-1]]
    first = np.flatnonzero(new)
    return rows[first], rows["doc_id"][np.r_[first[1:], len(rows)] - 1] > rows["doc_id"][first]


def _large(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The matches of a bucket that has too many places for the memory: they are written to a file while the first ones are looked for."""
    seen, several = np.empty(0, PLACE), np.zeros(0, bool)
    with tempfile.TemporaryFile() as file:
        for rows in parts:
            rows.tofile(file)
            before = seen["seed"][several]
            seen, several = _firsts(np.concatenate([seen, rows]))
            several[np.searchsorted(seen["seed"], before)] = True
        file.seek(0)
        while len(rows := np.fromfile(file, PLACE, LIMIT)):
            k = np.searchsorted(seen["seed"], rows["seed"])
            own = several[k]
            rows, source = rows[own], seen[k[own]]
            yield _matches(rows["doc_id"], rows["at"], source["doc_id"], source["at"])


def _matches(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), MATCH)
    for name, column in zip(MATCH.names, columns, strict=False):
        out[name] = column
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The matches of the places of each bucket."""
    parts = _gathered(batches, PLACE, LIMIT)
    for rows, whole in parts:
        if whole:
            for batch in _linked(iter([_ordered(rows)])):
                yield _matches(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
        else:
            yield from _large(_until_whole(rows, parts))


def _until_whole(rows: np.ndarray, parts: Iterator[tuple[np.ndarray, bool]]) -> Iterator[np.ndarray]:
    yield rows
    for rows, whole in parts:
        yield rows
        if whole:
            return


def _by_bucket(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


def _to_first(texts: DataFrame, places: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], kind: int) -> DataFrame:
    """BLOCKS of matches: every place of a hash that several documents have, with the first of these places."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt(places(batches))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt(_marked(_joined(batches), kind))

    return _by_bucket(texts.mapInArrow(placed, BLOCKS)).mapInArrow(joined, BLOCKS)


def _marked(parts: Iterator[np.ndarray], kind: int) -> Iterator[np.ndarray]:
    for rows in parts:
        rows.view(LINK)["kind"] = kind
        yield rows[rows["doc_id"] > rows["source_id"]] if kind else rows


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of each document's seeds that another document has, as 32-bit numbers."""
    for rows, _ in _gathered(batches, MATCH):
        rows = rows[np.argsort(rows["doc_id"], kind="stable")]
        doc = rows["doc_id"]
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        limits = pa.array(4 * np.r_[first, len(doc)], pa.int32())
        at = pa.Array.from_buffers(pa.binary(), len(first), [None, limits.buffers()[1], pa.py_buffer(rows["at"].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(doc[first]), at], ["doc_id", "repeated"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matches of each pair of documents."""
    for rows, _ in _gathered(batches, MATCH):
        rows = rows[rows["doc_id"] > rows["source_id"]]
        rows = rows[np.lexsort((rows["source_id"], rows["doc_id"]))]
        if len(rows):
            yield _listed(rows, _changes(rows), {n: rows[n] for n in ("at", "source_at", "whole")})


def _side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Hash and place of two seeds of a document with at most one word between them, which the first document of neither has like that.

    A seed is named by its first place. Where both have one and the same first document, which has them side by side too, the seeds lead to it.
    """
    for rows, _ in _gathered(batches, MATCH):
        order = np.argsort(rows["doc_id"], kind="stable")
        doc = rows["doc_id"][order]
        place = (np.cumsum(np.r_[0, doc[1:] != doc[:-1]]) << 32) + rows["at"][order]
        again = np.argsort(place)
        order, place = order[again], place[again]
        own_doc, at, source, source_at = (rows[n][order] for n in MATCH.names[:4])
        source_at = source_at.astype(np.int64)
        name = mix(mix(source.astype(np.uint64)) + source_at.astype(np.uint64))
        for apart in (KMER, KMER + 1):
            k = np.searchsorted(place, place + apart)
            own = np.arange(len(place))
            while len(own):  # rows that share an id can have several seeds at a place
                own, k = own[k < len(place)], k[k < len(place)]
                there = place[k] == place[own] + apart
                own, k = own[there], k[there]
                step = source_at[k] - source_at[own]
                new = (source[k] != source[own]) | (step < KMER) | (step > KMER + 1)
                out = np.empty(int(new.sum()), PLACE)
                out["seed"], out["doc_id"], out["at"] = mix(name[own] * np.uint64(3) + name[k])[new], own_doc[own][new], at[own][new]
                yield out
                k = k + 1


def _changes(rows: np.ndarray) -> np.ndarray:
    """Where the matches of another pair begin."""
    doc, source = rows["doc_id"], rows["source_id"]
    return np.r_[True, (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])]


def _listed(rows: np.ndarray, new: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    first = np.flatnonzero(new)
    found = pa.StructArray.from_arrays([*map(pa.array, columns.values())], [*columns])
    found = pa.ListArray.from_arrays(pa.array(np.r_[first, len(rows)], pa.int32()), found)
    return pa.RecordBatch.from_arrays([pa.array(rows["doc_id"][first]), pa.array(rows["source_id"][first]), found], ["doc_id", "source_id", "matches"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matches of each pair of documents, in parts that no chain joins, without the parts that have too few seeds around them for a passage."""
    for rows, _ in _gathered(batches, LINK):
        rows = rows[rows["doc_id"] > rows["source_id"]]
        if not len(rows):
            continue
        place = rows["at"].astype(np.uint64) << np.uint64(33) | rows["source_at"].astype(np.uint64) << np.uint64(2) | rows["kind"]
        order = np.lexsort((place, rows["source_id"], rows["doc_id"]))
        rows, place = rows[order], place[order]
        new = _changes(rows)
        same = (place[1:] == place[:-1]) | (place[1:] >> np.uint64(2) == place[:-1] >> np.uint64(2)) & (rows["kind"][1:] == BESIDE)
        once = new | np.r_[True, ~same]
        rows, new = rows[once], new[once]
        at = rows["at"].astype(np.int64)
        first = np.flatnonzero(new)
        number = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))  # of the match in its pair
        exact = np.logical_or.reduceat(rows["kind"] == WHOLE, first)[np.cumsum(new) - 1]
        # All matches before make up for less than KMER / GAP_COST skipped words each.
        new[1:] |= ~exact[1:] & (np.diff(at) >= KMER / GAP_COST * number[1:])
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(rows)] - 1
        can = exact[first] | _enough_seeds(rows, first, at[first] - MARGIN, at[last] + MARGIN)
        own = can[np.cumsum(new) - 1]
        if own.any():
            rows, new = rows[own], new[own]
            yield _listed(rows, new, {"at": rows["at"], "source_at": rows["source_at"], "whole": rows["kind"] == WHOLE, "beside": rows["kind"] == BESIDE})


def _enough_seeds(rows: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which parts can have a passage among their places ``low`` to ``high``: in both texts SEEDS of its seeds stand within LENGTH words.

    Those are seeds of the source, so their first document is not after it. ``rows`` has all matches of the parts' documents, in order of them.
    """
    doc = np.cumsum(np.r_[0, rows["doc_id"][1:] != rows["doc_id"][:-1]]) << 32
    key = doc + rows["at"]
    order = np.lexsort((rows["source_id"], key))
    order = order[np.r_[True, np.diff(key[order]) > 0]]
    place, holder = key[order], rows["source_id"][order]
    begin = np.searchsorted(place, doc[part] + np.maximum(0, low))
    end = np.searchsorted(place, doc[part] + high, "right")
    close = np.r_[0, np.cumsum(_close(place))]
    can = np.zeros(len(part), bool)
    asked = np.flatnonzero(end - begin >= SEEDS)
    asked = asked[close[end[asked] - SEEDS + 1] > close[begin[asked]]]
    for some in np.split(asked, np.searchsorted(np.cumsum(end[asked] - begin[asked]), np.arange(DEALT, np.sum(end[asked] - begin[asked]), DEALT))):
        count = end[some] - begin[some]
        own = np.repeat(some, count)
        at = np.arange(len(own)) + np.repeat(begin[some] - np.cumsum(count) + count, count)
        held = holder[at] <= rows["source_id"][part[own]]
        own, at = own[held], at[held]
        if len(own) >= SEEDS:
            together = own[SEEDS - 1 :] == own[: len(own) - SEEDS + 1]
            can[own[: len(own) - SEEDS + 1][together & _close(place[at])]] = True
    return can


def _close(place: np.ndarray) -> np.ndarray:
    """Whether a place and the next ones, SEEDS in all, stand within LENGTH words."""
    return place[SEEDS - 1 :] - place[: max(0, len(place) - SEEDS + 1)] <= LENGTH - KMER


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _chained(_likely(batches))


def _slices(
    texts: DataFrame, asked: DataFrame, cut: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], stage: Staging, name: str
) -> tuple[DataFrame, DataFrame]:
    """(region, own) and (region, other): what ``cut`` takes of both stretches of every region. ``asked`` has a row for each: the text's id as
    ``doc``, the region, which side it is, and where."""
    asked = stage.save(asked, f"asked-{name}")
    # A document that is the source of very many is cut by several rows; a task of this join that has too many of them is split.
    many = asked.groupBy("doc").agg(F.ceil(F.count("*") / ASKED).alias("parts")).filter("parts > 1")
    part = F.pmod(F.xxhash64("region"), F.coalesce("parts", F.lit(1)))
    stretch = F.struct(*[c for c in asked.columns if c != "doc"])
    asked = asked.join(many, "doc", "left").groupBy("doc", part.alias("part")).agg(F.collect_list(stretch).alias("asked"))
    slices = texts.join(asked, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "asked")
    slices = stage.save(slices.mapInArrow(cut, "region long, own boolean, words binary"), f"slices-{name}")
    left = slices.filter("own").select("region", F.col("words").alias("own"))
    return left, slices.filter("not own").select("region", F.col("words").alias("other"))


@contextmanager
def _without_leftovers(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a step are removed once its table is written, not when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage that a document shares with an earlier one: doc_id, start, end, source_id, source_start,
    source_end (word numbers from 0, ends exclusive), n_equal (words that agree).

    A word is a run without ASCII white space, A-Z as a-z. The source is the document with the smallest id that has a seed of the
    passage. Null, empty and short texts have no passages. A repetition inside one document, or between rows
    that share an id, is none; a row without id takes no part. An empty table gives no rows.
    """
    with _without_leftovers(docs.sparkSession):
        return _repeated_passages(docs, id_col, text_col)


def _repeated_passages(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    stage = staging(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.filter("doc_id is not null")
    parts = [stage.save(_to_first(texts, partial(_seeds, k), 0), f"matches-{k}") for k in range(PARTS)]
    repeated = reduce(DataFrame.unionByName, parts)
    # Seeds of one passage can have different first documents; two seeds side by side have one that has both.
    beside = stage.save(_to_first(_by_bucket(repeated), _side_by_side, BESIDE), "beside")
    # Its windows of LENGTH words have one that has them whole.
    places = _by_bucket(repeated).mapInArrow(_repeated, "doc_id long, repeated binary")
    windows = texts.join(places, "doc_id", "left").select("doc_id", "text", "repeated")
    whole = stage.save(_to_first(windows, _windows, WHOLE), "windows")
    kinds = ", ".join(f"{c} long" for c in REGION)
    found = _by_bucket(repeated.unionByName(beside).unionByName(whole)).mapInArrow(_chains, f"{kinds}, track {RUN}, equal {RUN}")
    found = stage.save(found.withColumn("region", F.monotonically_increasing_id()), "chains")
    loose = (F.size("equal") == 0) & ~F.exists("track", lambda run: run["equal"] | (run["n"] == 0))
    short = loose & (F.col("end") - F.col("start") <= SHORT) & (F.col("source_end") - F.col("source_start") <= SHORT)
    own = F.struct(F.col("doc_id").alias("doc"), "region", F.lit(True).alias("own"), F.col("start").alias("first"), F.col("end").alias("last"))
    other = F.struct(F.col("source_id").alias("doc"), "region", F.lit(False).alias("own"), F.col("source_start").alias("first"), F.col("source_end").alias("last"))
    left, right = _slices(texts, found.filter(short).select(F.inline(F.array(own, other))), _bytes, stage, "short")
    can = left.join(right, "region").mapInPandas(_can_be, "region long").distinct()
    found = stage.save(found.filter(~short).unionByName(found.filter(short).join(can, "region", "left_semi").select(*found.columns)), "candidates")
    pieces = "array<struct<first:long,last:long>>"
    # Texts with many stretches lie in few files of the table; dealt by region, every task has as many.
    asked = found.drop("equal").repartition("region").mapInArrow(_asked, f"doc long, region long, own boolean, pieces {pieces}")
    left, right = _slices(texts, asked, _sliced, stage, "aligned")
    # Rows that share an id have a slice each.
    result = found.join(left, "region").join(right, "region").select(*REGION, "own", "other", "track", "equal").mapInPandas(
        _passages, f"{kinds}, n_equal long"
    )
    return result.distinct()
