"""Vectors, conversations, the registered queries and the pipeline."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from masthead.llm import exact, neighbours, preference
from masthead.llm.common import components, staging
from masthead.llm.oracles import oracles
from masthead.llm.queries import registered
from tests.compare import connection, differences

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, 900), (900, 3), (7, 7)] + [(1000, 1000 + k) for k in range(1, 300)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    found = {r.node: r.component for r in components(frame, staging(spark)).collect()}
    want = {k: 100 for k in range(100, 161)} | {3: 3, 5: 3, 900: 3} | {1000 + k: 1000 for k in range(300)}
    assert found == want


def test_vectors(spark):
    pick = np.random.default_rng(1)
    centres = pick.normal(size=(12, 8))
    rows = [(k, (centres[k % 12] + pick.normal(size=8) * 0.12).tolist(), k % 2) for k in range(400)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 0), (502, rows[0][1], None), (503, None, 1), (504, [0.0] * 8, 1), (505, [], 1)]
    rows += [(506, [float("nan")] * 8, 1), (507, [None, 1.0], 1), (508, [float("inf")] * 8, 1), (None, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, space string, node int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.linked_vectors(frame).collect()}
    usable = {i: (np.array(v, np.float32).astype(float), c) for i, v, c in rows if i is not None and v and c is not None and None not in v and np.isfinite(v).all() and any(v)}
    links, top = Counter(), {i: i for i, *_ in rows if i is not None}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (x, c) in usable.items():
        for b, (y, d) in usable.items():
            if a < b and c == d and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                links.update([a, b])
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    assert found.pop(None) == (0, None, True)
    assert found == {i: (links[i], find(i), find(i) == i) for i in top}


def test_vectors_of_oversized_shards(spark, monkeypatch):
    """Scaled down so that shards are split anew, and a crowd that no split makes smaller is compared in blocks."""
    for name, value in {"SAMPLE": 80, "SHARD": 20, "LARGEST": 60, "FANOUT": 4, "FIT": 16, "PART": 150, "BLOCK": 50}.items():
        monkeypatch.setattr(neighbours, name, value)
    random = np.random.default_rng(11)
    centres = random.normal(size=(30, 8))
    x = centres[random.integers(0, 30, 900)] + 0.12 * random.normal(size=(900, 8))
    rows = [(i, x[i].tolist(), "a" if i % 3 else "b") for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(4)
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    alike = (unit @ unit.T >= neighbours.SIMILARITY) & ((np.arange(900) % 3 == 0)[:, None] == (np.arange(900) % 3 == 0))
    np.fill_diagonal(alike, False)
    space = frame.select(F.col("label").alias("space"), F.col("vec_id").alias("node"), F.col("embedding").alias("vector"))
    exact_links = neighbours.true_links(space, space).collect()
    assert {(r.a, r.b) for r in exact_links} == {(i, j) for i, j in np.argwhere(alike).tolist() if i < j}
    stage = staging(spark)
    shards, stuck = neighbours._dealt(space, 2, stage, "test")
    assert shards.groupBy("space").count().agg(F.max("count")).first()[0] <= neighbours.LARGEST
    left = set() if stuck is None else {r.node for r in stuck.select("node").collect()}
    assert {r.node for r in shards.select("node").collect()} | left == set(range(900))
    none = spark.createDataFrame([], "a long, b long")
    whole = neighbours.completed(space, space.filter("node % 100 = 0"), none, neighbours.SIMILARITY, stage)
    assert {tuple(r) for r in whole.collect()} == {(r.a, r.b) for r in exact_links}


def test_robust_prune_keeps_no_neighbour_that_a_kept_one_rules_out():
    pick = np.random.default_rng(2)
    x = pick.normal(size=(60, 5))
    x /= np.sqrt((x * x).sum(1))[:, None]
    order = np.argsort(-(x @ x[0]))
    kept = neighbours.robust_prune(x, 0, order, alpha=1.2, degree=60)
    assert kept[0] == order[1]
    for i, a in enumerate(kept):
        for b in kept[i + 1 :]:
            assert 1.2 * (1 - x[a] @ x[b]) > 1 - x[b] @ x[0]


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "é"), (1, 3, "assistant", "good"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"),
             (2, 2, "user", "é"), (2, 3, "assistant", None), (3, None, None, None), (None, 0, "user", "lost"), (4, 0, "user", "hi"), (4, 0, "user", "hi")]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn int, role string, text string, side string")
    pairs = spark.createDataFrame([(1, 1, 2), (2, 1, 1), (3, 1, 3), (4, 1, 99), (5, None, 1), (6, 4, 1)], "pair_id long, chosen_id long, rejected_id long")
    found = {r.pair_id: r for r in preference.preference_pairs(frame, pairs).collect()}
    assert set(found) == {1, 2, 3, 6}
    one = found[1]
    assert one.prompt_turns == 3
    assert one.prompt == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\né<|end|>\n"
    assert (one.chosen, one.rejected) == ("<|assistant|>\ngood<|end|>\n", "<|assistant|>\n<|end|>\n")
    start, end = map(int, one.chosen_mask.split(":"))
    assert one.chosen[start:end] == "good<|end|>\n"
    assert (found[2].prompt_turns, found[2].chosen, found[2].rejected_mask) == (4, "", "")
    assert found[3].prompt_turns == 0 and found[3].rejected == "<|unknown|>\n<|end|>\n" and found[3].rejected_mask == ""
    assert found[6].prompt_turns == 1
    assert preference.preference_pairs(frame, pairs.filter("pair_id > 9")).collect() == []


@pytest.mark.parametrize("name", sorted(oracles()))
def test_against_sql(spark, name):
    assert differences(registered()[name](spark, SF_DIR), connection(SF_DIR), oracles()[name]) == []


def test_pipeline(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    seen = set(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = _kept(spark, stage, docs)
        assert docs.columns == columns
        left = {r.doc_id for r in docs.collect()}
        assert left <= seen and len(left) == docs.count()
        seen = left
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == seen


def test_duplicates_are_dropped_by_row(spark):
    a, b, c = (" ".join(f"{name}{k}" for k in range(60)) for name in "abc")
    rows = [(7, a), (3, a), (7, b), (5, c), (5, c), (9, c + " "), (None, b), (None, "x y"), (None, "x y"), (1, None), (2, " ")]
    near = [(4, a + " z"), (7, b + " z"), (6, b + " q"), (None, c + " z"), (8, "p q"), (8, "q p")]
    docs = spark.createDataFrame([(k, text, "en", "s", len(text or "")) for k, text in rows + near], "doc_id long, text string, lang string, source string, n_chars long")

    def same(x, y):
        return "".join((x or "").split()) == "".join((y or "").split())

    def rank(row):
        return row[0] is None, row[0] or 0

    want = []
    for row in sorted(rows + near, key=lambda r: (-len(r[1] or ""), *rank(r))):
        if not any(same(row[1], kept[1]) for kept in want):
            want.append(row)
    left = _kept(spark, corpus_pipeline.without_copies, docs)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(want)

    def group(row):
        return row[1][:2] if row[1] and len(row[1]) > 9 else row[1]

    want_near = [min((r for r in want if group(r) == g), key=rank) for g in {group(r) for r in want}]
    found = Counter((r.doc_id, r.text) for r in corpus_pipeline.without_near_copies(spark, left, SF_DIR).collect())
    assert found == Counter(want_near)


def _kept(spark, stage, docs):
    found = stage(spark, docs, SF_DIR)
    return spark.createDataFrame(found.collect(), found.schema)


def test_stages_leave_the_results_of_others_alone(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k % 3}", "en", "s", 1, "x") for k in range(9)], f"{DOCUMENT}, row_of_stage string")
    before = exact.exact_duplicates(docs)
    first = _kept(spark, corpus_pipeline.without_copies, docs)
    assert before.count() == 9
    assert sorted((r.doc_id, r.row_of_stage) for r in first.collect()) == [(0, "x"), (1, "x"), (2, "x")]
    second = _kept(spark, corpus_pipeline.without_near_copies, first)
    assert second.columns == docs.columns and second.count() == 3


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DOCUMENT)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = _kept(spark, stage, docs)
        assert docs.count() == 0 and docs.columns == [c.split()[0] for c in DOCUMENT.split(", ")], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0
