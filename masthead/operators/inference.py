"""Batched calls of a user-supplied model.

A model is any callable ``model(prompts, options) -> texts`` over lists of equal length. The job is given a
factory that builds it, which runs once per Python worker. Spark partitions the prompts and streams them to the
workers in Arrow batches; only the prompt column crosses to Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.prompt import STOPS, cut_at_stops, render, verdict
from masthead.schema import ANSWER


@dataclass(frozen=True)
class CallOptions:
    """Sampling settings of one kind of call, handed to the model as they are."""

    max_tokens: int
    temperature: float
    top_p: float | None = None
    repeat_penalty: float | None = None
    stop: tuple[str, ...] = STOPS


# Settings of the calls.
HOOK_CALL = CallOptions(max_tokens=50, temperature=0.4, top_p=0.9, repeat_penalty=1.1)
SAFE_CALL = CallOptions(max_tokens=50, temperature=0.2)
REPAIR_CALL = CallOptions(max_tokens=50, temperature=0.0)
CRITIC_CALL = CallOptions(max_tokens=5, temperature=0.0)

CHARS_PER_TASK = 2_000_000  # of prompts, about half a million tokens
CALL_CHARS = 500  # what a call costs beside the text it shows: its template and its answer

Model = Callable[[list[str], CallOptions], Sequence[str | None]]
ModelFactory = Callable[[], Model]

@lru_cache(maxsize=1)
def _model(factory: ModelFactory) -> Model:
    """The model of this worker process, kept from task to task as long as the factory is the same."""
    return factory()


def _ask(model: Model, prompts: list[str], options: CallOptions) -> list[tuple[str | None, str | None]]:
    """(text, error) per prompt. If a batch fails, its prompts are asked one by one, so that only the bad
    ones carry an error."""
    try:
        texts = model(prompts, options)
        if len(texts) != len(prompts):
            raise ValueError(f"model gave {len(texts)} texts for {len(prompts)} prompts")
        return [(text or "", None) for text in texts]
    except Exception as failure:  # noqa: BLE001 - whatever a model raises belongs to its row
        if len(prompts) == 1:
            return [(None, f"{type(failure).__name__}: {failure}")]
        return [answer for prompt in prompts for answer in _ask(model, [prompt], options)]


def _caller(factory: ModelFactory, options: CallOptions, batch: int):
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for prompts in batches:
            asked = prompts.dropna()
            answers = []
            for start in range(0, len(asked), batch):
                answers += _ask(model, asked.iloc[start : start + batch].tolist(), options)
            told = pd.DataFrame(answers, columns=["text", "error"], index=asked.index, dtype=object)
            yield told.reindex(prompts.index)

    call.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    # Not deterministic: the optimizer must neither repeat nor move the call.
    return F.pandas_udf(call, ANSWER).asNondeterministic()


def deal(df: DataFrame, chars: Column, chars_per_task: int) -> DataFrame:
    """Partitions of about equal work, whatever the lengths: a row costs ``chars`` and ``CALL_CHARS``.

    Rows are put on a line as long as all their work, by class of cost and within a class by a hash of ``id``, and
    the line is cut into equal pieces, one a task. Costs of a class differ by less than a half, so a piece holds as much
    work wherever it lies. Only the sums of the classes come to the driver, two classes for each doubling of the length.
    """
    cost = F.coalesce(chars, F.lit(0)).cast("long") + CALL_CHARS
    place = F.floor(F.log2(cost) * 2).cast("int")
    classes = df.groupBy(place.alias("place")).agg(F.sum(cost).alias("work"), F.count("*").alias("calls")).collect()
    sums = {row["place"]: row["work"] for row in classes}
    tasks = max(1, min(-(-sum(sums.values()) // chars_per_task), sum(row["calls"] for row in classes)))
    starts, lengths, at = [], [], 0
    for n in range(max(sums, default=0) + 1):
        starts.append(F.lit(float(at)))
        lengths.append(F.lit(float(sums.get(n, 0))))
        at += sums.get(n, 0)
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    point = F.get(F.array(*starts), place) + share * F.get(F.array(*lengths), place)
    return df.repartitionById(tasks, F.floor(point / F.lit(max(at, 1) / tasks)).cast("int"))


@dataclass(frozen=True)
class ModelRunner:
    """How to run a model.

    ``factory`` builds it. An importable function, or a value that compares equal to its copies, lets a worker
    keep the model between tasks. ``batch`` is the number of prompts per call.

    Model calls are far slower than reading, so partitions sized for reading are too large for them. Unless told
    otherwise, a call is dealt into tasks of equal work, about ``chars_per_task`` characters of prompt each.
    ``rows_per_task`` counts the rows of every stage and spreads them accordingly, ``partitions`` spreads them
    over a fixed number; either takes the place of the first. With none of the three (``chars_per_task`` None), rows
    stay in the partitions they come in.
    """

    factory: ModelFactory
    batch: int = 64
    partitions: int | None = None
    rows_per_task: int | None = None
    chars_per_task: int | None = CHARS_PER_TASK

    @property
    def by_work(self) -> bool:
        """Are calls dealt by the length of their prompts, which must then be known before the call?"""
        return bool(self.chars_per_task) and not (self.partitions or self.rows_per_task)

    def spread(self, df: DataFrame, chars: str | None = None) -> DataFrame:
        """Distribute the rows of a stage by ``id``. To be called while they are narrow: before text is unpacked
        or a prompt rendered. Ids are unique, so the partitions come out even.

        ``chars`` names the length of what differs between the prompts, in a table that is stored, as it is read
        on its own first. Without it, rows that would be dealt by work stay where they are."""
        if self.by_work:
            return df if chars is None else deal(df, F.col(chars), self.chars_per_task)
        partitions = self.partitions
        if self.rows_per_task:
            partitions = max(1, -(-df.count() // self.rows_per_task))
        return df.repartition(partitions, "id") if partitions else df

    def generate(self, df: DataFrame, prompt: Column, options: CallOptions, into: str) -> DataFrame:
        """Add ``into`` = ``struct<text, error>``, the model's answer to ``prompt``, cut and stripped. A NULL
        prompt is not asked and has neither.

        The result must be staged before it is used more than once.
        """
        ask = _caller(self.factory, options, self.batch)
        answer = F.col(into)
        cut = F.struct(
            cut_at_stops(answer["text"], options.stop).alias("text"), answer["error"].alias("error")
        )
        return df.withColumn(into, ask(prompt)).withColumn(into, cut)

    def critique(
        self,
        df: DataFrame,
        template: str,
        headline: Column,
        into: str,
        snippet: str = "snippet",
        options: CallOptions = CRITIC_CALL,
    ) -> DataFrame:
        """Add ``into`` = ``struct<approved, answer, error>``, the critic's view of ``headline``."""
        prompt = render(template, body_snippet=F.col(snippet), headline=headline)
        answered = self.generate(df, prompt, options, into)
        text = F.col(into)["text"]
        judged = F.struct(
            verdict(text).alias("approved"), text.alias("answer"), F.col(into)["error"].alias("error")
        )
        return answered.withColumn(into, judged)
