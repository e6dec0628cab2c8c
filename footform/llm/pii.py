"""Personal data with offset-preserving deobfuscation.

A transducer rewrites homoglyphs, spelled digits and at/dot disguises and keeps, for each piece it rewrites, where it
came from. The same detectors run over the source text and over the rewritten one; what only the rewritten text shows
is mapped back to source characters and added.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

KINDS = ("email", "ip", "card", "phone")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and a run is taken whole: linear in the text.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Characters that look like ASCII ones.
HOMOGLYPHS = dict(zip("авеіјкмнорсѕтухАВЕІЈКМНОРСЅТУХαοινΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abeijkmhopcstyxABEIJKMHOPCSTYXaoivABEZHIKMNOPTYX", strict=True))
HOMOGLYPHS |= dict(zip("Ьԁɡһӏոԛѡ", "bdghlnqw", strict=True))
HOMOGLYPHS |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}  # full-width forms
HOMOGLYPHS |= {chr(base + i): str(i) for base in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for i in range(10)}
HOMOGLYPHS |= dict.fromkeys("。｡․·", ".") | dict.fromkeys("‐‑‒–−", "-") | {"﹫": "@", " ": " ", " ": " ", " ": " "}
HOMOGLYPHS |= dict.fromkeys("­​‌‍⁠﻿", "")
# Digits as words.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_NUMBER = rf"(?:{'|'.join(sorted(SPELLED, key=len, reverse=True))})"
_SEP = r"[\x20,.-]{1,2}"
_OPEN, _CLOSE = r"\x20{0,3}[(\[{<]\x20{0,3}", r"\x20{0,3}[)\]}>]\x20{0,3}"
_DOT = r"(?:dot|punkt|punto|point)"
#: Top-level domains that end an address whose last dot is a mere ".".
_TLD = r"(?:com|org|net|edu|gov|info|biz|io|co|ai|app|dev|eu|uk|us|de|fr|es|it|nl|ch|at|test|example|invalid)"
_SPELT_DOT = rf"(?:\x20dot\x20|{_OPEN}{_DOT}{_CLOSE})"
_LABEL = r"[\w-]{1,63}"
#: A host whose last dot is spelled may end in any letters; "the dot", "a dot" and their like are prose.
_HOST = rf"(?!(?:an?|the|this|that|each|every|any|some|no|which)\x20dot\x20)(?:(?:{_LABEL}(?:{_SPELT_DOT}|\.)){{1,8}}{_TLD}\b|(?:{_LABEL}(?:{_SPELT_DOT}|\.)){{0,7}}{_LABEL}{_SPELT_DOT}[a-z]{{2,24}}\b)"
#: Between blanks a dot may end a sentence, so that endings which are words as well don't count.
_SPACED = rf"(?:{_LABEL}(?:{_SPELT_DOT}|\x20?\.\x20?)){{0,8}}(?!(?:info|app|us|de|es|it|at|test|example|invalid)\b){_TLD}\b"
RULES = re.compile(
    rf"(?P<glyph>[{re.escape(''.join(HOMOGLYPHS))}])"
    rf"|(?P<at>{_OPEN}(?:at|arroba|@){_CLOSE}|\x20@\x20(?={_SPACED})|\x20at\x20(?={_HOST})(?=[\w.-]{{1,200}}(?:\x20dot\x20|{_OPEN})))"
    rf"|(?P<dot>{_OPEN}(?:{_DOT}|\.){_CLOSE}|\x20dot\x20(?=\w)|(?<=\w)\x20\.\x20(?={_SPACED}))"
    rf"|(?P<plus>\bplus\x20(?=[0-9]|{_NUMBER}\b))"
    rf"|(?P<digits>\b{_NUMBER}(?:{_SEP}(?:{_NUMBER}|[0-9]+))*+(?!\w))",
    re.IGNORECASE,
)
_PART = re.compile(rf"{_NUMBER}(?!\w)|[0-9]|[^0-9A-Za-z]+", re.IGNORECASE)
_BRACKETED = re.compile(rf"[(\[{{<]\x20{{0,3}}(?:at|arroba|@|\.|{_DOT})\x20{{0,3}}[)\]}}>]", re.IGNORECASE)
_GLYPHS = frozenset(HOMOGLYPHS)
#: Folds ASCII capitals and turns ASCII punctuation into blanks, byte for byte.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORDS = frozenset(w.encode() for w in SPELLED) | {"FÜNF".encode(), "ZÉRO".encode()}
_BESIDE = frozenset([b"dot", b"plus"])


def disguised(text: str) -> bool:
    """Whether the transducer could rewrite anything: false for nearly every text, at the cost of one split."""
    if not text.isascii() and not _GLYPHS.isdisjoint(text):
        return True
    if " @ " in text or any(c in text for c in "([{<") and _BRACKETED.search(text):
        return True
    words = text.encode().translate(_FOLD).split()
    seen = _WORDS.union(_BESIDE).intersection(words)
    if not seen:
        return False
    if b"dot" in seen:
        return True
    numeric = [w in _WORDS or w in _BESIDE or w.isdigit() for w in words]
    return any(a and b for a, b in zip(numeric, numeric[1:], strict=False))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each identifier, in order; leftmost and non-overlapping within a kind."""
    out, at, floor = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and LOCAL.match(text, start - 1):
            start -= 1
        m = start < at and DOMAIN.match(text, at + 1)
        if m:
            out.append((start, 0, m.end()))
            floor = m.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", max(floor, at + 1))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() <= 37 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def transduce(text: str, ends: frozenset[int] = frozenset()) -> tuple[str, list[int], list[tuple[int, int, int]]]:
    """Normalised text, and its rewritten pieces as (normalised start) and (normalised end, source start, source end).

    A lone digit word goes on with the figures before it, unless an identifier ends there (``ends``).
    """
    out: list[str] = []
    starts: list[int] = []
    pieces: list[tuple[int, int, int]] = []
    n = done = 0

    def put(a: int, b: int, new: str) -> None:
        nonlocal n, done
        out.append(text[done:a])
        n += a - done
        out.append(new)
        starts.append(n)
        pieces.append((n + len(new), a, b))
        n, done = n + len(new), b

    for m in RULES.finditer(text):
        if m.lastgroup == "glyph":
            put(m.start(), m.end(), HOMOGLYPHS.get(m[0], m[0]))
        elif m.lastgroup == "at":
            put(m.start(), m.end(), "@")
        elif m.lastgroup == "dot":
            put(m.start(), m.end(), ".")
        elif m.lastgroup == "plus":
            put(m.start(), m.end(), "+")
        else:
            parts = list(_PART.finditer(text, m.start(), m.end()))
            alone = sum(p[0][0].isalnum() for p in parts) < 2
            before = m.start() - 1
            follows = before > 0 and text[before] in " ,.-" and text[before - 1] in "0123456789" and before not in ends
            if alone and not follows and not (text[max(0, m.start() - 5) : m.start()].lower().endswith(("+", "plus ", "dot ")) or text.startswith(" dot ", m.end())):
                continue
            spelled = [p[0].lower() in SPELLED for p in parts] + [False]
            for k, p in enumerate(parts):
                if spelled[k]:
                    put(p.start(), p.end(), SPELLED[p[0].lower()])
                elif k and p[0].isspace() and spelled[k - 1] and spelled[k + 1]:
                    put(p.start(), p.end(), "")  # blanks between digit words are no part of the number
                elif not p[0][0].isalnum() and len(p[0]) > 1:
                    put(p.start(), p.end(), p[0].strip()[:1] or " ")
    out.append(text[done:])
    return "".join(out), starts, pieces


def source_span(a: int, b: int, starts: list[int], pieces: list[tuple[int, int, int]]) -> tuple[int, int] | None:
    """Source span of a normalised one; None if nothing in it was rewritten."""

    def source(pos: int, end: bool) -> int:
        k = bisect_right(starts, pos) - 1
        if k < 0:
            return pos + end
        stop, s, e = pieces[k]
        return (e if end else s) if pos < stop else e + pos - stop + end

    first, last = source(a, False), source(b - 1, True)
    k = bisect_right(starts, b - 1) - 1
    return (first, last) if k >= 0 and (pieces[k][0] > a or starts[k] >= a) else None


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base identifiers and those that only the normalised text shows, as (start, kind, end) of the source text."""
    text = text or ""
    base = detect(text)
    if not disguised(text):
        return base, []
    normal, starts, pieces = transduce(text, frozenset(e for _, _, e in base))
    more = []
    for a, kind, b in detect(normal):
        span = source_span(a, b, starts, pieces)
        if span and not any(k == kind and s < span[1] and span[0] < e and not (span[0] <= s and e <= span[1] and (s, e) != span) for s, k, e in base):
            more.append((span[0], kind, span[1]))
    return base, more


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("disguised", pa.bool_())]))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, found`` (start, kind, end, disguised; code points, end exclusive).

    Null and empty texts have none. Rows that repeat an id each get a row. An empty table gives no rows; extra columns
    are ignored. Every detector is linear in the length of the text.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                base, more = find(text)
                found.append([{"start": s, "kind": KINDS[k], "end": e, "disguised": (s, k, e) in more} for s, k, e in sorted(base + more)] if base or more else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN)], ["doc_id", "found"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, found array<struct<start:int,kind:string,end:int,disguised:boolean>>")


def op9(spark, sf_dir: str) -> DataFrame:
    found = personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("found", lambda x: ~x["disguised"])
    # The list is ordered by start, then by kind as listed.
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
