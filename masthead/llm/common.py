"""Helpers of the operators: UTF-8 columns as numpy arrays, rolling hashes, staged tables, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.session import ship_package
from masthead.sources.staging import Staging

SLAB = 1 << 20  # bytes of text worked on at once


_watched: list[list[Staging]] = []


def staging(spark: SparkSession) -> Staging:
    """Staged tables in the folder of ``spark.checkpoint.dir``; makes the package importable in Python workers.

    The results of operators are read from them lazily, so they stay; see ``opened``.
    """
    ship_package(spark)
    stage = Staging(spark)
    for own in _watched:
        own.append(stage)
    return stage


@contextmanager
def opened() -> Iterator[list[Staging]]:
    """Collects the staged tables of the operators called inside, for whoever wants to close them once the results are written."""
    own: list[Staging] = []
    _watched.append(own)
    try:
        yield own
    finally:
        _watched[:] = [other for other in _watched if other is not own]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 2 when divided by 4. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the limits of its values; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, limits, data = column.buffers()
    limits = np.frombuffer(limits, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[limits[0] : limits[-1]], (limits - limits[0]).astype(np.int64)


def slabs(limits: np.ndarray, size: int = SLAB) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``size`` bytes together; a longer text stands alone."""
    first, n = 0, len(limits) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(limits, limits[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = last


_MULTIPLIER = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A 64-bit value for each byte, the same in every process."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS["up"]) < n:
        n = max(n, SLAB + 1)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running sums ``c`` of values times powers; span_hash gives the hash of any stretch from them."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches: equal for equal content, wherever it stands."""
    _, down = powers(len(running))
    return mix((running[end] - running[start]) * down[start])


def words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and start byte of every run of characters that are not ASCII white space; A-Z count as a-z."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[limits] = True
    solid = ~blank
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = True, blank[:-1]
        after[-1], after[:-1] = True, blank[1:]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    end = np.flatnonzero(solid & (after | edge[1:])) + 1
    codes = byte_codes()
    codes[65:91] = codes[97:123]
    hashes = span_hash(prefix_hash(codes[data]), start, end) + (end - start).astype(np.uint64)
    return mix(hashes), np.searchsorted(limits, start, "right") - 1, start


def contracted(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges (u > v): each partition replaces its own by stars."""

    def roots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent[x]
            return top

        for frame in frames:
            for a, b in zip(frame["u"].tolist(), frame["v"].tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        out = pd.DataFrame({"u": nodes, "v": [find(x) for x in nodes]}, dtype="int64")
        yield out[out["u"] != out["v"]]

    return edges.mapInPandas(roots, "u long, v long")


def components(edges: DataFrame, stage: Staging, name: str = "links") -> DataFrame:
    """(node, component) of every node that ``edges`` (two columns of ids) links to another; component is the smallest id.

    Alternating large and small stars: no task holds a component, the links stay in written tables, and only a
    count and a checksum of them reach the driver. The number of rounds grows with the logarithm of a component's size.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v")
    links = stage.save(contracted(pairs), f"{name}-0")
    seen, number = None, 0
    while True:
        found = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(found) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen, number = tuple(found), number + 1
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-{number}-a")
        large = stage.save(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(),
            f"{name}-{number}-b",
        )
        least = stage.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{number}-c")
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage.save(
            contracted(small.union(least.select("u", F.col("m").alias("v"))).distinct()), f"{name}-{number}"
        )
