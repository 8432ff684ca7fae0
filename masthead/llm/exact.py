"""Exact duplicates by content-defined chunk recipes.

A normalised text (white space deleted) is cut where a rolling hash of its last 32 bytes says so, and each chunk leaves its
task as fingerprint and SHA-256 only. Fingerprints are deduplicated to identifiers: one that two digests share gets a
further number for each, so an identifier stands for one digest. Two texts are equal when their ordered lists of
identifiers are. The text itself never moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masthead.llm.common import byte_codes, prefix_hash, span_hash, staging, utf8

WINDOW = 32  # bytes that decide on a cut
CHUNK = 2048  # mean bytes of a chunk
SHORTEST = 256  # a chunk, but for a text's last, is no shorter

_RECIPES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("text_sha256", pa.string()),
        ("chunk", pa.list_(pa.int64())),
        ("digest", pa.list_(pa.binary())),
    ]
)


def cuts(data: np.ndarray, mean: int = CHUNK, shortest: int = SHORTEST) -> list[int]:
    """The ends of the chunks of ``data``; they depend on its content only."""
    n = len(data)
    ends, last = [], 0
    if n > WINDOW:
        start = np.arange(n - WINDOW)
        rolling = span_hash(prefix_hash(byte_codes()[data]), start, start + WINDOW)
        for at in (np.flatnonzero(rolling % np.uint64(mean) == 0) + WINDOW).tolist():
            if at - last >= shortest:
                ends.append(at)
                last = at
    return [*ends, n] if last < n or not ends else ends


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, limits = utf8(batch.column(1))
        chars, whole, chunks, digests = [], [], [], []
        for first, last in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            text = data[first:last]
            chars.append(int(np.count_nonzero((text & 0xC0) != 0x80)))
            text = text[(text != 32) & ((text < 9) | (text > 13))]
            raw = text.tobytes()
            whole.append(hashlib.sha256(raw).hexdigest())
            at, prints, own = 0, [], []
            for end in cuts(text):
                own.append(hashlib.sha256(raw[at:end]).digest())
                prints.append(int.from_bytes(hashlib.blake2b(raw[at:end], digest_size=8).digest(), "little", signed=True))
                at = end
            chunks.append(prints)
            digests.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(chars, pa.int64()), pa.array(whole), pa.array(chunks, _RECIPES.field(3).type), pa.array(digests, _RECIPES.field(4).type)],
            schema=_RECIPES,
        )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of texts that are equal without ASCII white space, the one with the most code points stays, then the smallest id. Null
    text counts as empty, and all empty texts are equal. Rows that repeat an id count as members each and are kept
    or dropped together. A null id loses every tie; its row is kept only in a group without other ids. An empty table gives none.
    """
    stage = staging(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_chars long, text_sha256 string, chunk array<long>, digest array<binary>"
    rows = stage.save(texts.mapInArrow(_recipes, schema).withColumn("row", F.monotonically_increasing_id()), "chunks")

    used = rows.select("row", F.posexplode(F.arrays_zip("chunk", "digest")).alias("place", "c")).select(
        "row", "place", "c.chunk", "c.digest"
    )
    known = used.select("chunk", "digest").distinct()
    # A fingerprint almost always has one digest; its window holds as many rows as it has digests.
    known = stage.save(
        known.withColumn("number", F.row_number().over(Window.partitionBy("chunk").orderBy("digest"))), "identifiers"
    )
    recipes = (
        used.join(known, ["chunk", "digest"])
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "chunk", "number"))).alias("list"))
        .select("row", F.expr("transform(list, x -> struct(x.chunk, x.number))").alias("recipe"))
    )
    members = rows.select("row", "doc_id", "n_chars", "text_sha256").join(recipes, "row")
    members = stage.save(members, "members")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id")))
    groups = members.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("group_size"))
    groups = stage.save(groups.select("recipe", F.col("best.doc_id").alias("keep_id"), "group_size"), "groups")
    return members.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
