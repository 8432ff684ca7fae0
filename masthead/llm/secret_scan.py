"""Secrets, also those inside URL, Unicode, base64 and compressed wrappings.

A text is scanned, then unwrapped: its lines with escapes without them, its runs of base64 as the text they stand for, compressed bytes
as what they hold. What comes out is a new layer, scanned and unwrapped in turn, until nothing is left to unwrap. A layer that is equal
to one it comes from is a cycle and is not entered. Every layer knows where its characters come from, so a secret found in it is a span
of the text itself, as wide as the wrappings it was read from.

No pattern reaches across a line end, so a line is unwrapped by itself, and only lines that hold a wrapping are looked at again.
After ``PASSES`` passes over a line, what is still escaped in it is resolved to its end at once, so that nested escapes cost no
square time; the layers between are then not scanned one by one.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import staging

# The kinds in their order, their patterns and least sizes (of group 2, of the whole match).
PATTERNS = {
    "assign": re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{32,}"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = [*PATTERNS, *[f"wrapped_{kind}" for kind in PATTERNS], "unread"]
PASSES = 8  # over a line with escapes inside escapes
SHORTEST = 19  # characters of base64 that can hold a secret, keyword and all
MOST_BYTES = 1 << 26  # of one unpacked layer; a larger one is reported as a span of kind ``unread``
_BYTES = r"%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}"
_ESCAPE = re.compile(
    rf"(?P<bytes>(?:{_BYTES})+)|(?P<units>(?:\\u[0-9A-Fa-f]{{4}})+)|\\U(?P<wide>[0-9A-Fa-f]{{8}})"
    r"|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|&#(?P<number>[0-9]{1,7});|&#[xX](?P<hex>[0-9A-Fa-f]{1,6});"
)
_MAYBE = re.compile(rf"{_BYTES}|\\[uU]|&#")
_RUN = re.compile(rf"(?:[A-Za-z0-9+/_-]{{60,76}}\r?\n)+[A-Za-z0-9+/_-]+|[A-Za-z0-9+/_-]{{{SHORTEST},}}")
_URL_SAFE = str.maketrans("-_", "+/")


@dataclass
class Layer:
    """A text that came out of a wrapping. ``at`` are its characters that stand for more than themselves, in order, ``begin`` and
    ``end`` what they stand for in the layer above; other characters lie at a fixed distance from those before them. ``solid``
    layers stand as a whole for their place; ``sixes`` have three bytes for four characters, starting at ``begin``."""

    text: str
    above: Layer | None = None
    start: int = 0  # of the line or run in the layer above
    stop: int = 0
    form: str = "line"
    at: list[int] = field(default_factory=list)
    begin: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    passes: int = 0

    def place(self, start: int, end: int) -> tuple[int, int]:
        """Where a stretch comes from in the layer above."""
        if self.form == "solid":
            return self.start, self.stop
        if self.form == "sixes":
            first, last = self._bytes(start), self._bytes(end) - 1
            return self.begin[first // 3 * 4 + first % 3], self.begin[last // 3 * 4 + last % 3 + 1] + 1
        return self.start + self._up(start)[0], self.start + self._up(end - 1)[1]

    def _bytes(self, place: int) -> int:
        """The bytes before a character."""
        if self.text.isascii():
            return place
        if not self.at:
            self.at = [0, *accumulate(len(c.encode("utf-8", "replace")) for c in self.text)]
        return self.at[place]

    def _up(self, place: int) -> tuple[int, int]:
        k = bisect_right(self.at, place) - 1
        if k < 0:
            return place, place + 1
        if self.at[k] == place:
            return self.begin[k], self.end[k]
        return (moved := self.end[k] + place - self.at[k] - 1), moved + 1

    def changed(self, start: int, end: int) -> bool:
        """Does the stretch hold a character that is not in the layer above as it is?"""
        if self.form != "line":
            return True
        k = bisect_left(self.at, start)
        return k < len(self.at) and self.at[k] < end

    def root(self, start: int, end: int) -> tuple[int, int]:
        layer: Layer | None = self
        while layer is not None and layer.above is not None:
            start, end = layer.place(start, end)
            layer = layer.above
        return start, end

    def seen_above(self) -> bool:
        layer = self.above
        while layer is not None:
            if layer.text == self.text:
                return True
            layer = layer.above
        return False


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the secrets that can be read in a text as it is."""
    lowered = text.lower()
    if "pass" in lowered or "secret" in lowered or "token" in lowered or "api" in lowered:
        for m in PATTERNS["assign"].finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in PATTERNS["access"].finditer(text):
            if len(m[0]) >= LEAST["access"]:
                yield "access", m.start(), m.end()
    for m in PATTERNS["hex"].finditer(text):
        yield "hex", m.start(), m.end()


_LINE = re.compile("[^\n]+")


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Limits of the lines that may hold an escape."""
    for line in _LINE.finditer(text):
        if _MAYBE.search(text, line.start(), line.end()):
            yield line.span()


def _resolved(m: re.Match) -> tuple[list[tuple[str, int, int]], bytes]:
    """The characters a match stands for, each with its place in the match, and its bytes if it is a run of them."""
    if m["bytes"] is not None:
        raw = bytes(int(h, 16) for h in re.findall(r"(?:%|\\x)(..)", m["bytes"]))
        widths = [3 if c == "%" else 4 for c in re.findall(r"%|\\x", m["bytes"])]
        edges = [0]
        for w in widths:
            edges.append(edges[-1] + w)
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append((raw[at : at + n].decode(), edges[at], edges[min(at + n, len(raw))]))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append(("�", edges[at], edges[at + 1]))
                at += 1
        return out, raw
    if m["units"] is not None:
        units = [int(h, 16) for h in re.findall(r"\\u(....)", m["units"])]
        out, k = [], 0
        while k < len(units):
            if 0xD800 <= units[k] < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1] < 0xE000:
                out.append((chr(0x10000 + (units[k] - 0xD800) * 1024 + units[k + 1] - 0xDC00), 6 * k, 6 * k + 12))
                k += 2
            else:
                out.append((_char(units[k]), 6 * k, 6 * k + 6))
                k += 1
        return out, b""
    code = int(m["wide"] or m["braced"] or m["hex"], 16) if not m["number"] else int(m["number"])
    return [(_char(code), 0, len(m[0]))], b""


def _char(code: int) -> str:
    return chr(code) if code < 0xD800 or 0xDFFF < code < 0x110000 else "�"


def unescaped(text: str) -> tuple[str, list[int], list[int], list[int], list[tuple[int, int, bytes]]]:
    """A text with its escapes resolved once: the new text, its resolved characters and what each stands for, and runs of
    escaped bytes with their place."""
    out: list[str] = []
    at, begin, end, raw = [], [], [], []
    done = length = 0
    for m in _ESCAPE.finditer(text):
        plain = text[done : m.start()]
        out.append(plain)
        length += len(plain)
        found, own = _resolved(m)
        for char, a, b in found:
            out.append(char)
            at.append(length)
            begin.append(m.start() + a)
            end.append(m.start() + b)
            length += 1
        if own:
            raw.append((m.start(), m.end(), own))
        done = m.end()
    out.append(text[done:])
    return "".join(out), at, begin, end, raw


_TAIL = re.compile(
    r"%([0-9A-Fa-f]{2})|\\x([0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)


def fully_unescaped(text: str) -> tuple[str, list[int], list[int], list[int]]:
    """A text with its escapes resolved until none is left, in one pass: as soon as the end of what was written is an escape, it
    gives way to its character. An escaped byte is the character of that number here."""
    chars: list[str] = []
    place: list[tuple[int, int]] = []

    def reduced() -> bool:
        for n in range(3, min(10, len(chars)) + 1):
            if m := _TAIL.fullmatch("".join(chars[-n:])):
                decimal = m[7]
                value = _char(int(decimal) if decimal else int(next(d for d in m.groups() if d), 16))
                place[-n:] = [(place[-n][0], place[-1][1])]
                chars[-n:] = [value]
                return True
        return False

    for i, char in enumerate(text):
        chars.append(char)
        place.append((i, i + 1))
        while chars[-1] in _LAST and reduced():
            pass
    moved = [k for k, (a, b) in enumerate(place) if b - a > 1]
    return "".join(chars), moved, [place[k][0] for k in moved], [place[k][1] for k in moved]


_LAST = set("0123456789abcdefABCDEF;}")


def unpacked(raw: bytes) -> bytes | None:
    """What compressed bytes hold; None if they are not compressed. Raises OverflowError above ``MOST_BYTES``."""
    try:
        if raw.startswith(b"\x1f\x8b"):
            return _bounded(lambda: zlib.decompressobj(31), raw)
        if raw.startswith(b"BZh"):
            return _bounded(bz2.BZ2Decompressor, raw)
        if raw.startswith(b"\xfd7zXZ\x00"):
            return _bounded(lzma.LZMADecompressor, raw)
        if raw.startswith(b"\x28\xb5\x2f\xfd"):
            return _zstandard(raw)
        if len(raw) > 2 and raw[0] & 15 == 8 and raw[0] >> 4 < 8 and (raw[0] * 256 + raw[1]) % 31 == 0:
            reader = zlib.decompressobj()
            out = _within(reader.decompress(raw, MOST_BYTES + 1))
            return out if reader.eof else None
    except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError):
        pass
    return None


def _within(out: bytes) -> bytes:
    if len(out) > MOST_BYTES:
        raise OverflowError
    return out


def _bounded(make: Callable, raw: bytes) -> bytes | None:
    """All members of a compressed file; a broken end is left out."""
    out = b""
    while raw:
        reader = make()
        try:
            out += reader.decompress(raw, MOST_BYTES + 1 - len(out))
        except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError):
            break
        _within(out)
        raw = reader.unused_data
    return out or None


def _zstandard(raw: bytes) -> bytes | None:
    import zstandard

    try:
        with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as reader:
            return _within(reader.read(MOST_BYTES + 1)) or None
    except zstandard.ZstdError:
        return None


def _readable(raw: bytes) -> str | None:
    """Bytes as text, if they are text."""
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not _CONTROL.search(text) else None


_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f]")


def _inside(raw: bytes, layer: Layer, start: int, stop: int, places: list[int] | None) -> Iterator[Layer | tuple[int, int]]:
    """The layer that bytes make, found at a place of ``layer``: of what they hold if they are compressed, however often, else of
    themselves. A place alone if that is too large."""
    held, seen = raw, set()
    try:
        while (inner := unpacked(held)) is not None and (key := hashlib.blake2b(inner).digest()) not in seen:
            seen.add(key)
            held = inner
    except OverflowError:
        yield start, stop
        return
    if seen:
        yield Layer(held.decode("utf-8", "replace"), layer, start, stop, "solid")
    elif places is not None and (text := _readable(raw)) is not None:
        yield Layer(text, layer, start, stop, "sixes", begin=places)


def _base64(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    for m in _RUN.finditer(layer.text):
        if layer.form == "line" and layer.above is not None and not layer.changed(m.start(), m.end()):
            continue  # looked at in the layer above
        places = [m.start() + i for i, c in enumerate(m[0]) if c not in "\r\n"] if "\n" in m[0] else list(range(m.start(), m.end()))
        run = m[0].translate(_URL_SAFE).replace("\r", "").replace("\n", "")
        if len(run) % 4 == 1:
            run, places = run[:-1], places[:-1]
        try:
            raw = base64.b64decode(run + "=" * (-len(run) % 4))
        except binascii.Error:
            continue
        yield from _inside(raw, layer, m.start(), m.end(), places)


def unwrapped(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    """The layers right below one."""
    yield from _base64(layer)
    if not _MAYBE.search(layer.text):
        return
    for start, stop in _lines(layer.text):
        line = layer.text[start:stop]
        # A line that is not new here was unwrapped in the layer above.
        if layer.form == "line" and layer.above is not None and not layer.changed(start, stop):
            continue
        if layer.passes >= PASSES:
            text, at, begin, end = fully_unescaped(line)
            raw = []
        else:
            text, at, begin, end, raw = unescaped(line)
        if text != line:
            yield Layer(text, layer, start, stop, "line", at, begin, end, layer.passes + 1)
        for a, b, own in raw:
            try:
                packed = unpacked(own)
            except OverflowError:
                yield start + a, start + b
                continue
            if packed is not None:
                yield from _inside(own, layer, start + a, start + b, None)


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the secrets of a text, in order."""
    found = {(start, KINDS.index(kind), end) for kind, start, end in matches(text)}
    if not (_MAYBE.search(text) or _RUN.search(text)):
        return sorted(found)
    waiting, done = [Layer(text)], set()
    while waiting:
        layer = waiting.pop()
        for below in unwrapped(layer):
            if isinstance(below, tuple):
                start, end = layer.root(*below)
                found.add((start, KINDS.index("unread"), end))
                continue
            place = below.root(0, max(1, len(below.text)))
            key = (place, hashlib.blake2b(below.text.encode("utf-8", "replace"), digest_size=16).digest())
            if key in done or below.seen_above():
                continue
            done.add(key)
            waiting.append(below)
            for kind, start, end in matches(below.text):
                if below.changed(start, end):
                    start, end = below.root(start, end)
                    found.add((start, KINDS.index(f"wrapped_{kind}"), end))
    return sorted(found)


_SCHEMA = "doc_id long, spans array<struct<start:long,rank:int,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (start, rank in ``KINDS``, end; code points, the end exclusive; in order).

    Secrets read in the text as it is have the kinds of ``PATTERNS``; those read in an unwrapped layer have the kind with ``wrapped_``
    before it. Null and empty texts have none. Rows that repeat an id get a row each, and ids may be null. An empty table gives no rows.
    """
    staging(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": a, "rank": rank, "end": b} for a, rank, b in find_secrets(text.as_py())] if text.is_valid else []
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, _SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Counts and span lists of the rows of ``scan``; ``n_wrapped`` counts what was read in unwrapped layers."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    base = len(PATTERNS)

    def joined(which: str):
        return F.expr(
            f"concat_ws(',', transform(filter(spans, s -> {which}), s -> concat(element_at(array({names}), s.rank + 1), ':', s.start, ':', s.end)))"
        )

    counts = [F.expr(f"cast(size(filter(spans, s -> s.rank = {k})) as long)").alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    more = F.expr(f"cast(size(filter(spans, s -> s.rank >= {base})) as long)").alias("n_wrapped")
    return found.select("doc_id", *counts, F.sha2(joined(f"s.rank < {base}"), 256).alias("base_sha256"), joined("true").alias("spans"), more)
