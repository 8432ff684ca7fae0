"""Alignment of two tokenizers against a plain version over whole texts, without words, sorting or remembering."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from masthead.llm import alignment
from masthead.llm.common import utf8
from masthead.llm.queries import op13_interval_coalescing, tokenizer_path


@pytest.fixture(scope="module")
def files():
    return Path(tokenizer_path("byte_bpe_50k.json")).read_text(), Path(tokenizer_path("piece_bpe_32k.model")).read_bytes()


@cache
def tokenizers_of(files):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=files[1])


def tokens(text: str | None, files) -> tuple[list, list]:
    """(id, start byte, end byte) of the tokens of both sides, over the whole text."""
    a, b = tokenizers_of(files)
    if not text:
        return [], []
    of = alignment.byte_level()
    whole = b" " + text.encode()
    sides = []
    raw = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    for side in (raw, pieces):
        if b"".join(x for _, x in side) != whole:
            return [], []
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        sides.append(out)
    return sides[0], sides[1]


def expected(rows, files) -> list[tuple]:
    parts, count = [], Counter()
    for doc, text in rows:
        a, b = tokens(text, files)
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, rest = [], (list(reversed(a)), list(reversed(b)))
        for end in common:
            inside = []
            for side in rest:
                own = []
                while side and side[-1][2] <= end:
                    own.append(str(side.pop()[0]))
                inside.append(",".join(own))
            groups.append("|".join(inside))
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        count.update(links)
        parts.append((doc, len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    return [
        (
            doc, n_a, n_b, len(groups), len(links),
            sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc, n_a, n_b, groups, links in parts
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def texts() -> list[tuple]:
    pick = random.Random(3)
    odd = ["  two  spaces ", "a\n\n b", "\ttab", "x <|endoftext|> y", "<unk> <s> </s>", "a▁b", "ﬁ é é", "日本語 と 中文", "🙂 👩‍👩‍👧", "\x00nul", "　wide", "don't we'll I'M", "12345 6,789.0", " ", "\n", "a", "né\xa0né", "\x1cx \x85y", "﻿bom ​zero"]
    rows = [(1, None), (2, ""), (None, "No id here"), (3, "the same"), (3, "the same")]
    rows += [(10 + k, t) for k, t in enumerate(odd)]
    alphabet = "abcdeé .,'\n 🙂日x-—\t1"
    rows += [(100 + k, "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 120)))) for k in range(150)]
    rows += [(400, "".join(pick.choice("abc") for _ in range(20_000))), (401, "lorem ipsum " * 5000), (402, " " * 3000 + "x")]
    return rows


def test_documents(documents, files):
    rows = texts()
    want = Counter(expected(rows, files))
    assert any(w[1] == 0 for w in want if w[0] == 15)  # U+2581 does not come back
    assert found(alignment.aligned_documents(documents(rows), *files)) == want


@pytest.mark.parametrize("known", [0, 1, 40])
def test_rare_pairs_are_joined(documents, files, known):
    rows = texts()[:60]
    assert found(alignment.aligned_documents(documents(rows), *files, known=known)) == Counter(expected(rows, files))


def test_forgetting_changes_nothing(files, monkeypatch):
    rows = [t for _, t in texts()]
    one, other = alignment.Aligned(*files), alignment.Aligned(*files)
    want = [(s.tolist(), g, p.tolist()) for s, g, p in one.texts(rows)]
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 30)
    assert [(s.tolist(), g, p.tolist()) for t in rows for s, g, p in other.texts([t])] == want


def test_words_in_use_are_not_aligned_again(files, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 50)
    one, seen, learn = alignment.Aligned(*files), Counter(), alignment.Aligned.learn
    monkeypatch.setattr(alignment.Aligned, "learn", lambda self, words: (seen.update(words), learn(self, words))[1])
    for k in range(40):
        list(one.texts([f"often {k}x", None, "often used " + " ".join(f"n{n}" for n in range(10 * k, 10 * k + 10))]))
        assert len(one.known) <= 50
    assert seen["often"] == seen["used"] == 1


def test_cut():
    pick = random.Random(4)
    texts = ["".join(pick.choices("ab     \n\x1c\x85\xa0\u1680\u2003\u200b\u2028\u3000é…¢", k=pick.randrange(30))) for _ in range(3000)]
    data, limits = utf8(pa.array(texts))
    letters, start, first = alignment.cut(data, limits)
    want = [re.split(r"(?<=\S) (?=\S)", text) if text else [] for text in texts]
    ends = [*start[1:].tolist(), len(letters)]
    assert [letters[a:b].tobytes().decode() for a, b in zip(start.tolist(), ends, strict=True)] == [w for own in want for w in own]
    assert first.tolist() == np.cumsum([0, *map(len, want)]).tolist()


def test_coalesced():
    group, own = alignment.coalesced(*(np.array(x) for x in ([0, 2, 5], [2, 5, 9], [0, 3, 5, 6], [3, 5, 6, 9])))
    assert own.tolist() == [0, 0, 1] and group.tolist() == [0, 0, 1, 0, 0, 1, 1]


def test_empty(documents, files):
    assert alignment.aligned_documents(documents([]), *files).count() == 0
    assert found(alignment.aligned_documents(documents([(1, None)]), *files)) == Counter([(1, 0, 0, 0, 0, 0, 0, "")])


def test_query(spark, files):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_interval_coalescing(spark, sf_dir)) == Counter(expected(rows, files))
