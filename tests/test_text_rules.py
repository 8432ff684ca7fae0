"""The text rules on hand-written cases, and on many small random texts against plain Python."""

from __future__ import annotations

import random
import re
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from masthead.functions.clean import clean_headline, with_clean_headline
from masthead.functions.lead import TAIL_WORDS, with_lead_headline
from masthead.functions.payload import deflate, snippet, with_content
from masthead.functions.prompt import cut_at_stops, render, verdict
from masthead.functions.skip import should_skip, skip_reason
from masthead.functions.text import WS, WS_CHARS, drop_markers, squeeze, strip
from masthead.functions.validate import validate_headline, with_format_reason

CLEAN = {
    # one rule at a time
    "Harbour reopens after storm.": "Harbour reopens after storm",
    '"Harbour reopens"': "Harbour reopens",
    "'Harbour reopens'": "Harbour reopens",
    "*Harbour reopens*": "Harbour reopens",
    "''Harbour reopens''": "Harbour reopens",
    "***Harbour reopens***": "Harbour reopens",
    "'*Harbour reopens*'": "Harbour reopens",
    "Harbour \t reopens": "Harbour reopens",
    "harbour of Genoa reopens": "Harbour of Genoa reopens",
    "NATO meets": "NATO meets",
    # wrappers, periods and white space in odd places
    '"': "",
    '""': "",
    '"""': "",
    '" "': "",
    '"*"': "",
    '"*': '"*',
    '"* \'"': "* '",
    '"Foo".': '"Foo"',
    "Foo..": "Foo.",
    "Foo .": "Foo",
    '"Foo."': "Foo",
    '"*abc"*': '"*abc"*',
    "'A' and 'B'": "A' and 'B",
    '" * Foo bar * "': "Foo bar",
    "": "",
    " \t\n": "",
    ".": "",
    "　wide blanks here\x1c": "Wide blanks here",
    "ßtrasse": "SStrasse",
    "éclair": "Éclair",
    "\U0001f600 smile": "\U0001f600 smile",
}

FORMAT = {
    "Harbour reopens after three days of storm": None,
    "": "empty headline",
    "   ": "empty headline",
    None: "empty headline",
    "Harbour reopens": "too short",
    "a b c": None,
    " ".join("w" * 14): None,
    " ".join("w" * 15): "length 15 exceeds 14 words",
    "The harbour at the mouth of the river reopens today after a storm that had closed it for three whole "
    "days": "length 21 exceeds 14 words",
    "नमस्ते to all": "contains non-Latin script characters",
    "Привет to all": "contains non-Latin script characters",
    "你好 to all": "contains non-Latin script characters",
    "tiếng to all": "contains non-Latin script characters",
    "₹2 lakh a": None,
    "café x ɏ": None,
    "café x ɐ": "contains non-Latin script characters",
}

SKIP = [
    ("Harbour reopens", "x" * 15001, "content too long"),
    ("Harbour reopens", "x" * 15000, None),
    ("Storm at the coast, live updates", "text", "title phrase"),
    ("Why harbours close, explained", "text", "title phrase"),
    ("Sailing from a to z", "text", "title phrase"),
    ("Coast | Storm | Harbour", "text", "title pipes"),
    ("Harbour reopens", "Opinion on harbours", "opinion content"),
    ("Harbour reopens", " Opinion on harbours", None),
    ("Harbour reopens", "opinion on harbours", None),
    ("Opinion | Harbours", "text", "opinion title"),
    ("Harbours | Comment", "text", "opinion title"),
    ("Editorial: Harbours", "text", "opinion title"),
    ("editorial: Harbours", "text", None),
    ("Harbour reopens", "Ships leave.", None),
    (None, None, None),
    ("EXPLAINED || all of it", "Opinion" + "a" * 15000, "content too long"),
    ("EXPLAINED || all of it", "Opinion", "title phrase"),
]

LEAD = {
    None: "",
    "": "",
    "# #": "",
    "Dr. Smith wins": "Dr",
    "On July 17, 2026, the court ruled. x": "The court ruled",
    "ON JULY 7 2026 the court ruled": "The court ruled",
    "On 17 July 2026, the court ruled. x": "On 17 July 2026, the court ruled",
    "On Jan. 5, 2026, the court ruled": "On Jan",
    "** On July 17, 2026, x y z": "On July 17, 2026, x y z",
    "It **ended.** Next one": "It ended",
    "It ended?! Next one": "It ended?!",
    "No stop here": "No stop here",
    "a.b.c d e.": "A.b.c d e",
    "  \n Two  lines\n of\ttext. More": "Two lines of text",
    " ".join(f"w{i}" for i in range(1, 14)): "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13",
    " ".join(f"w{i}" for i in range(1, 15)): "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14",
    " ".join(f"w{i}" for i in range(1, 16)): "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12",
    "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 the w13 w14 w15": "W1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11",
    "Cats eat fish \"The\", and,": "Cats eat fish",
    "One two three four five six running": "One two three four five six",
    "One two three four five six RUNNING of the": "One two three four five six",
    "One two three four five six running, and": "One two three four five six running",
    "One two three four five running": "One two three four five running",
    "the of and to": "The of and to",
    "cats the of and to": "Cats the of and to",
    "cats eat the of and to": "Cats eat the of and to",
    "one two three; :": "One two three",
}


def mapped(spark, inputs, make):
    """The inputs in order, each with its result."""
    rows = spark.createDataFrame(list(enumerate(inputs)), "n int, value string")
    return [row["out"] for row in make(rows).orderBy("n").select("out").collect()]


def test_clean(spark):
    got = mapped(spark, CLEAN, lambda df: with_clean_headline(df, "value", "out"))
    assert dict(zip(CLEAN, got, strict=True)) == CLEAN


def test_clean_as_one_expression(spark):
    got = mapped(spark, CLEAN, lambda df: df.withColumn("out", clean_headline(F.col("value"))))
    assert dict(zip(CLEAN, got, strict=True)) == CLEAN


@pytest.mark.parametrize("depth", [2_999, 20_000])
def test_wrappers_of_any_depth(spark, depth):
    cases = {
        "*" * depth + "deep down" + "*" * depth: "Deep down",
        "* " * depth + "deep down" + ' "' * depth: "* " * depth + "deep down" + ' "' * depth,
        "* " * depth + '"deep\'' + " *" * depth: '"deep\'',
        "*" * depth + "one side": "*" * depth + "one side",
        "*" * depth + "'": "*" * depth + "'",
        "*" * depth: "",
    }
    expected = {text: " ".join(out.split()) for text, out in cases.items()}
    got = mapped(spark, cases, lambda df: with_clean_headline(df, "value", "out"))
    assert dict(zip(cases, got, strict=True)) == expected


def test_format(spark):
    got = mapped(spark, FORMAT, lambda df: df.withColumn("out", validate_headline(F.col("value"))))
    assert {text: check["reason"] for text, check in zip(FORMAT, got, strict=True)} == FORMAT
    assert all(check["valid"] == (check["reason"] is None) for check in got)
    got = mapped(spark, FORMAT, lambda df: with_format_reason(df, "value", "out"))
    assert dict(zip(FORMAT, got, strict=True)) == FORMAT


def test_skip(spark):
    df = spark.createDataFrame(
        [(n, *case) for n, case in enumerate(SKIP)], "n int, title string, content string, expected string"
    )
    reason = skip_reason(F.col("title"), F.col("content"))
    skip = should_skip(F.col("title"), F.col("content"))
    for row in df.select("*", reason.alias("reason"), skip.alias("skip")).collect():
        assert row["reason"] == row["expected"], row
        assert row["skip"] == (row["expected"] is not None)


def test_lead(spark):
    got = mapped(spark, LEAD, lambda df: with_lead_headline(df, "value", "out"))
    assert dict(zip(LEAD, got, strict=True)) == LEAD


def test_tail_words_are_complete():
    assert len(set(TAIL_WORDS)) == len(TAIL_WORDS) == 82


def test_white_space_is_that_of_python(spark):
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert sorted(blanks) == sorted(WS_CHARS)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c]
    df = spark.createDataFrame([(c,) for c in points[:0x3100]], "c string")
    hit = df.filter(F.col("c").rlike(f"^[{WS}]$")).collect()
    assert sorted(row["c"] for row in hit) == sorted(blanks)


# ---- random texts against plain Python ---------------------------------------------------------------


def random_texts(alphabet: list[str], longest: int, count: int) -> list[str]:
    draw = random.Random(7)
    return ["".join(draw.choices(alphabet, k=draw.randrange(longest))) for _ in range(count)]


def bare(text: str) -> str:
    text = text.strip()
    wrapped = text[:1] in ('"', "'", "*") and text[:1] == text[-1:]
    return bare(text[1:-1]) if wrapped and text else text


def plain_clean(text: str) -> str:
    text = re.sub(r"\.\Z", "", bare(text)).strip()
    text = " ".join(text.split())
    return text[:1].upper() + text[1:]


def plain_lead(text: str) -> str:
    flat = re.sub("[*_`#]", "", " ".join(text.split()))
    sentence = re.search(r".*?[.!?](?=\s)|.*", flat).group()
    month = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    sentence = re.sub(rf"(?i)^On\s+{month}[a-z]*\.?\s+\d\d?,?\s+\d{{4}},?\s*", "", sentence)
    words = sentence.split()
    seen = words[:12] if len(words) > 14 else words
    stays = [
        at
        for at, word in enumerate(map(str.lower, seen), 1)
        if word.strip(".,;:\"'") not in TAIL_WORDS and not (at > 6 and word.endswith("ing"))
    ]
    kept = max(stays, default=0)
    return plain_clean(" ".join(seen[:kept] if kept >= 3 else words[:12]).rstrip(".,;: "))


def test_clean_on_random_texts(spark):
    texts = random_texts(['"', "'", "*", " ", "a", ".", "\t", "ß"], 14, 6000)
    got = mapped(spark, texts, lambda df: with_clean_headline(df, "value", "out"))
    assert got == [plain_clean(text) for text in texts]


def test_lead_on_random_texts(spark):
    words = "cat dog sing RUNNING the of, \"and\" new *new* ** # . end. why? On July 4, 2026, 'to' key Jan 12 1999 \n"
    pieces = [f"{w} " for w in words.split(" ")] + ["_", "`", "x", "!", "  "]
    texts = random_texts(pieces, 22, 6000)
    got = mapped(spark, texts, lambda df: with_lead_headline(df, "value", "out"))
    assert got == [plain_lead(text) for text in texts]


def test_format_on_random_texts(spark):
    texts = random_texts(["a", " ", "é", "ɏ", "ɐ", "ж", "₹", "1", "\t", "ẽ"], 40, 3000)

    def reason(text: str) -> str | None:
        words = text.split()
        if len(words) < 3:
            return "too short" if words else "empty headline"
        if len(words) > 14:
            return f"length {len(words)} exceeds 14 words"
        foreign = any(unicodedata.category(c).startswith("L") and c > "ɏ" for c in text)
        return "contains non-Latin script characters" if foreign else None

    got = mapped(spark, texts, lambda df: df.withColumn("out", validate_headline(F.col("value"))))
    assert [check["reason"] for check in got] == [reason(text) for text in texts]


# ---- helpers, prompts and payload --------------------------------------------------------------------


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a \t b　",), (None,)], "c string")
    rows = df.select(strip(F.col("c")).alias("s"), squeeze(F.col("c")).alias("q")).collect()
    assert [tuple(row) for row in rows] == [("a \t b", "a b"), (None, "")]
    df = spark.createDataFrame([("**a** _b_ `c` # d",)], "c string")
    assert df.select(drop_markers(F.col("c"))).first()[0] == "a b c  d"


@pytest.mark.parametrize(
    ("answer", "expected"),
    [
        ("YES", True), ("yes.", True), ("YES\n", True), (" Yes", True), ("NO", False), ("no", False),
        ("Yes, notably", False), ("I know: YES", False), ("maybe", False), ("", False), (None, False),
    ],
)
def test_verdict(spark, answer, expected):
    df = spark.createDataFrame([(answer,)], "a string")
    assert df.select(verdict(F.col("a"))).first()[0] is expected


def test_cut_at_stops(spark):
    cases = {
        " A headline ": "A headline",
        "A headline<|im_end|>\nArticle: x": "A headline",
        "A Article: x<|im_end|>": "A",
        "<|im_start|>A<|im_end|>": "",
        "An article: kept": "An article: kept",
        "": "",
    }
    got = mapped(spark, cases, lambda df: df.withColumn("out", cut_at_stops(F.col("value"))))
    assert dict(zip(cases, got, strict=True)) == cases


def test_render_leaves_inserted_braces_alone(spark):
    df = spark.createDataFrame([("{headline} {x} {{", "{body_snippet}", None)], "b string, h string, n string")
    template = "A {{literal}} {body_snippet} | {headline} | {body_snippet}"
    out = df.select(
        render(template, body_snippet=F.col("b"), headline=F.col("h")).alias("both"),
        render("<{body_snippet}>", body_snippet=F.col("n")).alias("empty"),
    ).first()
    assert out["both"] == "A {literal} {headline} {x} {{ | {body_snippet} | {headline} {x} {{"
    assert out["empty"] == "<>"


def test_payload(spark):
    packed = zlib.compress("a text, ünïcode \U0001f600".encode())
    cases = [
        (packed, "a text, ünïcode \U0001f600", False),
        (None, "", False),
        (b"", "", False),
        (b"junk bytes", "", True),
        (packed[:-6], "", True),
        (zlib.compress(b"\xff\xfe\xfa"), "", True),
    ]
    df = spark.createDataFrame(
        [(n, p) for n, (p, _, _) in enumerate(cases)], "n int, rephrased_article binary"
    )
    rows = with_content(df).orderBy("n").collect()
    assert [(row["content"], row["corrupt"]) for row in rows] == [(c, k) for _, c, k in cases]


def test_payload_round_trip(spark):
    texts = ["", "x", "é" * 5000, "\U0001f600" * 1600, None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    rows = (
        with_content(df.withColumn("p", deflate(F.col("t"))), "p")
        .withColumn("s", snippet(F.col("content")))
        .withColumn("whole", snippet(F.col("content"), None))
        .orderBy("n")
        .collect()
    )
    assert [row["content"] for row in rows] == [text or "" for text in texts]
    assert [row["s"] for row in rows] == [(text or "")[:1500] for text in texts]
    assert [row["whole"] for row in rows] == [row["content"] for row in rows]
