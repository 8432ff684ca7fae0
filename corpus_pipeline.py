"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the caller writes as Parquet and rereads as the next
stage's ``docs``. All but the last return the columns of ``documents``. Duplicates are dropped by row: of rows repeated whole
one stays, and rows that share an id, or have none, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.llm import exact, jaccard, language, packing, pii
from masthead.llm.common import held_out, opened, staging, table
from masthead.llm.queries import word_tokenizer
from masthead.sources.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: list[Staging] = []  # staged tables behind the result of the last stage


def _stage(build: Stage) -> Stage:
    """A stage's result has been written when the next one is called, which therefore deletes what it was read from."""

    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            _left.pop().close()
        with opened() as own:
            result = build(spark, docs, sf_dir)
        _left.extend(own)
        return result

    return run


@_stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; a missing ``lang`` is filled in."""
    columns = docs.columns
    found = language.identify(docs, docs.filter(~held_out()), keep=columns).filter(F.col("lang_pred") != language.UNDETERMINED)
    filled = F.coalesce("kept.lang", "lang_pred")
    return found.select(*[(filled if c == "lang" else F.col(f"kept.{c}")).alias(c) for c in columns])


def _numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own each, as ids may repeat or be null, and the name of that column, which is not among
    the others; written, so that it stays the same."""
    row = "row_of_stage"
    while row in docs.columns:
        row += "_"
    return staging(spark).save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _first_of(docs: DataFrame, row: str, groups: DataFrame, *rank: Column) -> DataFrame:
    """Of each group (row, member_of) the row of lowest rank, then of the smallest id; a row without id comes last."""
    order = F.struct(*rank, F.col("doc_id").isNull(), F.col("doc_id"), F.col(row).alias("row"))
    best = docs.select(row, order.alias("order")).join(groups, row).groupBy("member_of").agg(F.min("order").alias("best"))
    return docs.join(best.select(F.col("best.row").alias(row)), row, "left_semi").drop(row)


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the one with the smallest id."""
    docs, row = _numbered(spark, docs)
    groups = exact.exact_duplicates(docs, row).select(F.col("doc_id").alias(row), F.col("keep_id").alias("member_of"))
    return _first_of(docs, row, groups, -F.length(F.coalesce("text", F.lit(""))))


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the one with the smallest id, of each group of similar texts."""
    docs, row = _numbered(spark, docs)
    groups = jaccard.similar_groups(docs, row).select(F.col("doc_id").alias(row), F.col("component_id").alias("member_of"))
    return _first_of(docs, row, groups)


@_stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and revealing terms replaced; ``n_chars`` follows the new text."""
    columns = docs.columns
    found = pii.find(docs, keep=[c for c in columns if c != "text"]).withColumn("clean", pii.sanitised())
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return found.select(*[new.get(c, F.col(f"kept.{c}")).alias(c) for c in columns])


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in the training sequences."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language", known_language),
    ("exact duplicates", without_copies),
    ("near duplicates", without_near_copies),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: Parsing by suffix automata, shingle similarity and the packing order are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is written to the session's shared folder."""
    docs = table(spark, sf_dir, "documents")
    written: list[Staging] = []  # not among the tables that a stage releases
    for _, stage in STAGES[:-1]:
        written.append(Staging(spark))
        docs = written[-1].save(stage(spark, docs, sf_dir), "documents")
        if len(written) > 1:
            written[-2].close()
    return STAGES[-1][1](spark, docs, sf_dir)
