"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by naive Bayes log-count ratios.

Two kinds of n-grams count, each once per text: three bytes in a row, and one to four words in a row described by their shape
(repeats the word before, capital letters, digits, other characters, length). All are hashed to ``DIMENSIONS`` places. An indicator
is worth the log of how much more often it occurs in one class than in the other; texts are scaled to length one, and
dual coordinate descent finds the weights. A logistic curve through the margins of rows left out turns them into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masthead.llm.common import mix, slabs, staging, utf8, words

DIMENSIONS = 1 << 18
FIT_ROWS = 2000  # rows per class that the model is fitted on
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 20
BIAS = 1.0


def _shapes(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code for the shape of every word, and the text it belongs to."""
    word, owner, start = words(data, limits)
    if not len(word):
        return np.zeros(0, np.uint64), owner
    end = np.append(start[1:], len(data))
    end = np.minimum(end, limits[owner + 1])

    def any_of(flags: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(flags)])
        return running[end] > running[start]

    upper = (data >= 65) & (data <= 90)
    lower = ((data >= 97) & (data <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    code = again.astype(np.uint64)
    for flags in (upper, lower, digit, ~(upper | lower | digit | blank)):
        code = code * np.uint64(2) + any_of(flags).astype(np.uint64)
    solid = np.concatenate([[0], np.cumsum(~blank)])
    size = np.minimum(3, np.log2(solid[end] - solid[start])).astype(np.uint64)
    return code * np.uint64(4) + size, owner


def features(data: np.ndarray, limits: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct places of each text."""
    n = len(limits) - 1
    wide = data.astype(np.uint64)
    threes = np.zeros(max(0, len(data) - 2), np.uint64)
    if len(threes):
        threes = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
    threes = (mix(threes + np.uint64(1)) % np.uint64(DIMENSIONS)).astype(np.int64)
    shape, owner = _shapes(data, limits)
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    grams = []
    value = np.zeros(len(shape), np.uint64)
    for size in range(1, 5):
        rest = len(shape) - size + 1
        if rest <= 0:
            break
        value = value[:rest] * np.uint64(1024) + shape[size - 1 :]
        grams.append((mix(value * np.uint64(5) + np.uint64(size) + (np.uint64(1) << np.uint64(60))) % np.uint64(DIMENSIONS)).astype(np.int64))
    seen = np.zeros(DIMENSIONS, np.int32)
    for i in range(n):
        own = [threes[limits[i] : max(limits[i], limits[i + 1] - 2)]]
        own += [g[first[i] : max(first[i], first[i] + count[i] - size)] for size, g in enumerate(grams)]
        places = np.concatenate(own)
        nth = np.arange(len(places), dtype=np.int32)
        seen[places] = nth
        yield places[seen[places] == nth]


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratios
    weight: np.ndarray  # of the scaled indicators
    bias: float
    slope: float
    shift: float

    def score(self, data: np.ndarray, limits: np.ndarray) -> np.ndarray:
        value, square = self.weight * self.ratio, self.ratio**2
        margins = np.full(len(limits) - 1, self.bias)
        for i, places in enumerate(features(data, limits)):
            norm = np.sqrt(square[places].sum())
            if norm:
                margins[i] += value[places].sum() / norm
        return 1 / (1 + np.exp(-(self.slope * margins + self.shift)))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.full(DIMENSIONS, SMOOTHING), np.full(DIMENSIONS, SMOOTHING)]
    for places, label in zip(rows, labels.tolist(), strict=True):
        counts[label][places] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def hinge(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + PENALTY * sum of hinge losses, by dual coordinate descent."""
    sign = labels * 2.0 - 1
    scaled = []
    for places in rows:
        values = ratio[places]
        norm = np.sqrt((values**2).sum())
        scaled.append(values / norm if norm else values)
    diagonal = np.array([(v**2).sum() + BIAS**2 for v in scaled])
    dual, weight, bias = np.zeros(len(rows)), np.zeros(DIMENSIONS), 0.0
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in order.permutation(len(rows)).tolist():
            places, values = rows[i], scaled[i]
            gradient = sign[i] * (weight[places] @ values + bias * BIAS) - 1
            new = min(max(dual[i] - gradient / diagonal[i], 0.0), PENALTY)
            step = (new - dual[i]) * sign[i]
            if step:
                weight[places] += step * values
                bias += step * BIAS
                largest = max(largest, abs(step))
            dual[i] = new
        if largest < 1e-4:
            break
    return weight, bias * BIAS


def _margins(rows: list[np.ndarray], ratio: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(rows), bias)
    for i, places in enumerate(rows):
        values = ratio[places]
        norm = np.sqrt((values**2).sum())
        if norm:
            out[i] += weight[places] @ values / norm
    return out


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the score curve, by Newton steps; targets are kept off 0 and 1."""
    n1 = labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * at)
        at = at + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model from the places and labels (0 or 1) of the rows. With rows of one class only, it scores all texts alike."""
    n1 = int(labels.sum())
    if not n1 or n1 == len(labels):
        share = (n1 + 1) / (len(labels) + 2)
        return Model(np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0, float(np.log(share / (1 - share))))
    fold = np.zeros(len(labels), int)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        fold[own] = np.arange(len(own)) % 2
    margins = np.zeros(len(labels))
    for out in (0, 1):
        into = np.flatnonzero(fold != out)
        left = np.flatnonzero(fold == out)
        part = [rows[i] for i in into]
        ratio = log_count_ratio(part, labels[into])
        margins[left] = _margins([rows[i] for i in left], ratio, *hinge(part, labels[into], ratio))
    ratio = log_count_ratio(rows, labels)
    return Model(ratio, *hinge(rows, labels, ratio), *_logistic(margins, labels))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, limits = utf8(batch.column(1))
        found = []
        for first, last in slabs(limits):
            own = features(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
            found += [p.astype("<i4").tobytes() for p in own]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "places"])


def learn(texts: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most FIT_ROWS rows of either class of ``labels`` (doc_id, label), the first by a hash of their ids."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = Window.partitionBy("label", F.pmod(F.hash("doc_id"), F.lit(64))).orderBy(*order)
    some = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .distinct()
        .withColumn("nth", F.row_number().over(parts))
        .filter(F.col("nth") <= FIT_ROWS)
        .withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy(*order)))
        .filter(F.col("nth") <= FIT_ROWS)
        .select("doc_id", "label")
    )
    chosen = texts.join(F.broadcast(some.select("doc_id")), "doc_id", "left_semi")  # 2 * FIT_ROWS ids at most
    places = {r["doc_id"]: r["places"] for r in chosen.mapInArrow(_featured, "doc_id long, places binary").collect()}
    pairs = sorted((r["doc_id"], r["label"]) for r in some.collect() if r["doc_id"] in places)
    return fit([np.frombuffer(places[d], "<i4").astype(np.int64) for d, _ in pairs], np.array([c for _, c in pairs], int))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1, the higher the likelier label 1).

    ``labels`` holds the rows that may be learned from; rows with a null or other label are ignored. Null text counts as
    empty, and an empty text gets the score of the bias. With labels of one class only, or none, all texts get
    the same score. Rows that repeat an id get a row each, and ids may be null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    staging(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    shared = spark.sparkContext.broadcast(learn(texts, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = utf8(batch.column(1))
            found = [
                shared.value.score(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])
                for first, last in slabs(limits)
            ]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    return texts.mapInArrow(run, "doc_id long, score double")
