"""What Python workers hold at once is bounded by slices and single rows, not by what Spark sends together."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Row

from masthead.functions.payload import _SLICE, _pack_batches
from masthead.streaming.once import _COLUMNS, Arrivals


def test_texts_are_packed_in_slices():
    texts = [f"text {n}" if n % 7 else None for n in range(2 * _SLICE + 3)]
    parts = list(_pack_batches(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert [len(p) for p in parts] == [_SLICE, _SLICE, 3]
    assert [None if b is None else zlib.decompress(b).decode() for p in parts for b in p.to_pylist()] == texts


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Clock:
    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 5


def test_arrivals_are_taken_row_by_row():
    """The first of a new id, the last in the place of what failed, none of what has been seen; rows pass as they are."""
    state = Arrivals(1000, 0)
    state.seen, state.waiting = _Value(), _Value()
    article = Row(*_COLUMNS)
    one, two, failed = article(1, "one", b"x", None, None, None, 0), article(1, "two", b"y", 3, None, 1, 0), article(1, "one", b"x", None, None, None, 2)
    assert list(state.handleInputRows((1,), iter([one, two]), _Clock())) == [one]
    assert list(state.handleInputRows((1,), iter([two]), _Clock())) == []
    assert list(state.handleInputRows((1,), iter([failed]), _Clock())) == [failed]
    assert list(state.handleInputRows((1,), iter([failed, one, two]), _Clock())) == [two]
