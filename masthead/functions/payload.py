"""The compressed article text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNIPPET_CHARS = 1500  # fixed value: what a prompt sees of an article, unless a job is told otherwise
_SLICE = 500

_UNPACKED = T.StructType().add("content", T.StringType()).add("cause", T.StringType())

# Why a text cannot be read.
NOT_COMPRESSED, CUT_OFF, DAMAGED, NOT_UTF8 = "not compressed", "cut off", "damaged", "not UTF-8"


def _unpack(packed: bytes | None) -> tuple[str, str | None]:
    if not packed:
        return "", None
    reader = zlib.decompressobj()
    try:
        text = reader.decompress(packed)
        if not reader.eof:
            return "", CUT_OFF
        return text.decode("utf-8"), None
    except zlib.error:
        header = len(packed) > 1 and packed[0] & 15 == 8 and (packed[0] * 256 + packed[1]) % 31 == 0
        return "", DAMAGED if header else NOT_COMPRESSED
    except UnicodeDecodeError:
        return "", NOT_UTF8


def _unpack_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    # In slices, as the texts of a whole Arrow batch may be many times larger than their bytes.
    for packed in batches:
        for start in range(0, len(packed), _SLICE):
            content, cause = zip(*map(_unpack, packed[start : start + _SLICE].to_pylist()), strict=True)
            yield pa.StructArray.from_arrays([pa.array(content, pa.string()), pa.array(cause, pa.string())], ["content", "cause"])


def _pack_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for text in batches:
        for start in range(0, len(text), _SLICE):
            part = text[start : start + _SLICE].to_pylist()
            yield pa.array([None if t is None else zlib.compress(t.encode("utf-8")) for t in part], pa.binary())


def inflate(packed: Column) -> Column:
    """zlib bytes to ``struct<content, cause>``. NULL and empty bytes are empty text; unreadable bytes are
    too, and have the cause."""
    return F.arrow_udf(_unpack_batches, _UNPACKED)(packed)


def deflate(text: Column) -> Column:
    """Text to zlib bytes, the inverse of :func:`inflate`."""
    return F.arrow_udf(_pack_batches, T.BinaryType())(text)


def with_content(df: DataFrame, packed: str = "rephrased_article") -> DataFrame:
    """Replace the packed column by ``content``, ``corrupt`` and the ``cause`` of that."""
    rest = [name for name in df.columns if name != packed]
    unpacked = df.select(*rest, inflate(F.col(packed)).alias("_inflated"))
    return unpacked.select(*rest, "_inflated.content", F.col("_inflated.cause").isNotNull().alias("corrupt"), "_inflated.cause")


def snippet(content: Column, chars: int | None = SNIPPET_CHARS) -> Column:
    """The first ``chars`` characters, or with None the whole text."""
    return content if chars is None else F.substring(content, 1, chars)
