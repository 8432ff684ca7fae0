"""Language identification by cross-parsing.

For each language a suffix automaton of a bounded sample of its labelled text recognises every stretch of that sample. A text is
cut, per language, into the fewest stretches found there (each as long as possible); the language that needs the fewest
phrases, each weighted by the bits that name a place in its sample, wins.

All texts of a batch are parsed side by side: one table lookup advances every block of every text in every language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masthead.llm.common import slabs, staging, utf8

SAMPLE_SYMBOLS = 20_000  # learned per language
SAMPLE_DOCS = 64  # read for it at most, each up to SAMPLE_CHARS
SAMPLE_CHARS = 8_000
BLOCK = 1024  # symbols parsed as one run; a phrase does not cross its end
UNDETERMINED = "und"

_alphabet: np.ndarray | None = None


def lowered() -> np.ndarray:
    """For every code point the lower-case letter it is, or 0 for what is no letter."""
    global _alphabet
    if _alphabet is None:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _alphabet = table
    return _alphabet


def letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, every run of other characters as one 0."""
    points = lowered()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    keep[:1] = True
    return points[keep]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of each state; state 0 is the start, and a path from it exists for each substring."""
    moves: list[dict[int, int]] = [{}]
    link, depth, last = [-1], [0], 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        link.append(0)
        depth.append(depth[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if depth[target] == depth[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                depth.append(depth[at] + 1)
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = link[at]
                link[target] = link[state] = copy
        last = state
    return moves


@dataclass
class Languages:
    """One table of all automata. An entry holds the next state and how many phrases ended on the way there."""

    names: list[str]
    points: np.ndarray  # the code points of symbols 1, 2, ...; 0 is a gap, the last symbol any other letter
    table: np.ndarray
    starts: np.ndarray
    bits: np.ndarray  # cost of a phrase in each language, in nats

    def phrases(self, symbols: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Phrases of each block in each language; ``blocks`` are the limits of the blocks in ``symbols``."""
        lengths = np.diff(blocks)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        steps = int(lengths[0]) if len(lengths) else 0
        padded = np.zeros((steps, len(order)), np.int32)
        row = np.arange(len(symbols)) - np.repeat(blocks[:-1], np.diff(blocks))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        padded[row, np.repeat(place, np.diff(blocks))] = symbols
        state = np.repeat(self.starts[:, None], len(order), 1)
        count = np.zeros(state.shape, np.int32)
        active = np.searchsorted(-lengths, -np.arange(steps), "left")
        for step in range(steps):
            n = active[step]
            entry = self.table[state[:, :n] + padded[step, :n]]
            count[:, :n] += entry & 3
            state[:, :n] = entry >> 2
        count += state != self.starts[:, None]
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def classify(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and posterior of each text; of equally good languages the first by name."""
        index = np.full(0x110000, len(self.points) + 1, np.int32)
        index[0] = 0
        index[self.points] = np.arange(1, len(self.points) + 1)
        rows = [letters(t) for t in texts]
        some = [bool(r.any()) for r in rows]
        if not self.names or not any(some):
            return [(UNDETERMINED, 0.0)] * len(texts)
        sizes = np.array([len(r) if s else 0 for r, s in zip(rows, some, strict=True)])
        symbols = index[np.concatenate([r for r, s in zip(rows, some, strict=True) if s])]
        parts = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        blocks = np.concatenate([[0], np.cumsum(length)])
        total = np.zeros((len(self.names), len(texts)), np.int64)
        np.add.at(total.T, owner, self.phrases(symbols, blocks).T)
        cost = total * self.bits[:, None]
        best = cost.argmin(0)
        weight = np.exp(cost.min(0) - cost).sum(0)
        return [(self.names[b], float(1 / w)) if s else (UNDETERMINED, 0.0) for b, w, s in zip(best, weight, some, strict=True)]


def learn(samples: dict[str, list[str]], budget: int = SAMPLE_SYMBOLS) -> Languages:
    """Automata from sample texts, of each language as many symbols as the smallest budget allows."""
    names = sorted(n for n, texts in samples.items() if any(letters(t).any() for t in texts))
    streams = [np.concatenate([np.append(letters(t), 0) for t in samples[n]])[:budget] for n in names]
    points = np.unique(np.concatenate(streams)) if streams else np.zeros(1, np.uint32)
    points = points[points > 0]
    width = len(points) + 2
    tables, starts, base = [], [], 0
    for stream in streams:
        symbols = np.where(stream == 0, 0, np.searchsorted(points, stream) + 1).tolist()
        moves = suffix_automaton(symbols)
        root = np.full(width, 0, np.int64)
        root[:] = (base * 4) + 1  # a symbol the sample lacks is a phrase of its own
        for symbol, to in moves[0].items():
            root[symbol] = (base + to * width) * 4
        own = np.repeat((root + 1)[None, :], len(moves), 0)  # no way on: a phrase ends, the next begins here
        own[0] = root
        for state, ways in enumerate(moves):
            if ways:
                own[state, list(ways)] = [(base + to * width) * 4 for to in ways.values()]
        tables.append(own.ravel())
        starts.append(base)
        base += own.size
    table = np.concatenate(tables) if tables else np.zeros(0, np.int64)
    if len(table) and table.max() < 2**31:
        table = table.astype(np.int32)
    return Languages(
        names, points.astype(np.int64), table, np.array(starts, table.dtype), np.array([math.log(len(s)) for s in streams])
    )


def sample(labelled: DataFrame) -> dict[str, list[str]]:
    """At most SAMPLE_DOCS texts per language, the first by a hash of their ids, so the same ones every time."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = Window.partitionBy("lang", F.pmod(F.hash("doc_id"), F.lit(64))).orderBy(*order)
    ids = (
        labelled.select("doc_id", "lang")
        .withColumn("_nth", F.row_number().over(parts))
        .filter(F.col("_nth") <= SAMPLE_DOCS)
        .withColumn("_nth", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .filter(F.col("_nth") <= SAMPLE_DOCS)
    )
    chosen = {}
    for row in ids.collect():
        chosen.setdefault(row["doc_id"], row["lang"])
    texts = (
        labelled.filter(F.col("doc_id").isin(list(chosen)))
        .select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .dropDuplicates(["doc_id"])
        .collect()
    )
    out: dict[str, list[str]] = {}
    for row in sorted(texts, key=lambda r: r["doc_id"]):
        out.setdefault(row["lang"], []).append(row["text"])
    return out


def identify(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (the posterior of the language, 0 to 1).

    ``labelled`` (doc_id, text, lang) is what may be learned from; rows without text, lang or id teach nothing. A null text,
    or one without letters, is ``und`` with score 0, as is everything if nothing could be learned. Rows that repeat an
    id get a row each, and ids may be null. An empty table gives no rows. With ``keep``, a struct ``kept`` of those columns
    of the row comes along.
    """
    spark = docs.sparkSession
    staging(spark)
    model = learn(sample(labelled.select("doc_id", "text", "lang").dropna()))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = utf8(batch.column(1))
            for first, last in slabs(limits):
                texts = [data[limits[i] : limits[i + 1]].tobytes().decode() for i in range(first, last)]
                found = shared.value.classify(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:last],
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        *[column[first:last] for column in batch.columns[2:]],
                    ],
                    ["doc_id", "lang_pred", "score", *(["kept"] if keep else [])],
                )

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    )
    schema = "doc_id long, lang_pred string, score double"
    if keep:
        schema += f", kept {texts.schema['kept'].dataType.simpleString()}"
    return texts.mapInArrow(run, schema)
