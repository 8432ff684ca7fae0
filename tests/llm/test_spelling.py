"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from masthead.llm import oracles, spelling
from masthead.llm.queries import op11_kd_letter_counts
from tests.compare import connection, differences


def counted(rows) -> dict[str, int]:
    lower = {c: c + 32 for c in range(65, 91)}
    out: Counter[str] = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def edits(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def expected(words: dict[str, int]) -> set[tuple]:
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, []) if edits(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def found(df) -> set[tuple]:
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(seed: int, size: int) -> dict[str, int]:
    """Words of few letters, with chains of forms, anagrams and neighbours of every kind."""
    pick, out = random.Random(seed), {}
    while len(out) < size:
        word = "".join(pick.choice("abcéßóí") for _ in range(pick.randint(6, 11)))
        out[word] = pick.choice([2, 3, 25, 40, 400, 6000])
        for _ in range(3):
            at = pick.randrange(len(word))
            word = word[:at] + pick.choice(["", "x", "ab", word[at] + "ä"]) + word[at + pick.randint(0, 1) :]
            out[word] = pick.choice([2, 2, 20, 200])
    return out


def test_count_words(documents):
    pick = random.Random(4)
    rows = [(1, None), (2, ""), (None, "Straße straße Überwindung"), (3, " \n"), (4, "ẞtraßen ABCDEFG×÷ abcdefg×÷ a1bcdefgh")]
    rows += [(k, " ".join(pick.choice(["Über", "wiederholt", "ÀÉÎÕÜabc", "Zwischenfall", "seven77letters"]) for _ in range(60))) for k in range(10, 60)]
    rows += [(5, "x" * 20000 + " " + "x" * 20000), (12, rows[-1][1])]
    got = {r.word: r.n for r in spelling.count_words(documents(rows)).collect()}
    assert got == counted(rows)
    assert any(w not in " ".join(t or "" for _, t in rows).lower() for w in got)  # a typo was put in


@pytest.mark.parametrize(("cell", "largest"), [(20_000, 1 << 21), (150, 1500), (20_000, 2500)])
def test_variants(spark, monkeypatch, cell, largest):
    """Whatever the sizes at which words are cut into cells and cells are divided."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "LARGEST", largest)
    words = vocabulary(1, 900) | {"l" * 3000: 5, "l" * 3001: 60, "l" * 2999 + "m": 600}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variants(table)) == expected(words)


def test_divided_parts_are_small(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(spelling, "CELL", 100)
    monkeypatch.setattr(spelling, "LARGEST", 4000)
    table = spark.createDataFrame([("".join(p), 2) for p in {tuple(random.Random(k).sample("abcdefgh", 8)) for k in range(3000)}], "word string, n long")
    stage = spelling.staging(spark)
    parts = spelling._divided(spelling._dealt(table, stage), stage).groupBy("cell", "part").agg({"word": "count"}).collect()
    assert table.count() > 2500  # all with the same letters, which no tree can tell apart
    assert max(r[2] for r in parts) * 8 <= 2 * 4000


def test_points_at():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 3, (300, spelling.DIMENSIONS)).astype(np.int8) * (rng.random((300, spelling.DIMENSIONS)) < 0.08).astype(np.int8) for _ in range(2))
    for distance in (1, 2):
        q, t = spelling.points_at(a, b, distance)
        apart = np.abs(b[:, None] - a).sum(2)
        apart[(apart == 0) & (distance == 2) & a[:, spelling.OWN :].any(1)] = 2
        want = set(zip(*np.nonzero(apart == distance), strict=True))
        assert set(zip(q.tolist(), t.tolist(), strict=True)) == want and len(q) == len(want) > 0


def test_empty(spark, documents):
    assert found(spelling.variants(spelling.count_words(documents([])))) == set()
    assert found(spelling.variants(spelling.count_words(documents([(1, None), (2, ""), (3, "short words only")])))) == set()


def test_repeated_rows_and_ids(documents):
    rows = [(7, "Wiederholung eins"), (7, "Wiederholung eins"), (None, "Wiederholung eins"), (8, "Wiederholing Wiederholing " + "Wiederholung " * 40)]
    words = spelling.count_words(documents(rows))
    assert found(spelling.variants(words)) == expected(counted(rows))


def test_query_and_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    result = op11_kd_letter_counts(spark, sf_dir)
    assert found(result) == expected(counted(rows))
    assert differences(result, connection(sf_dir), oracles.oracles()["op11_kd_letter_counts"]) == []
