"""Operator 3, personal data, with disguises undone and offsets kept.

Two passes find the same four kinds of identifiers. The first reads the text as it is (the
base). The second reads a normalised text: transducers replace homoglyphs and full-width
forms, drop zero-width characters, turn runs of spelled digits into digits and bracketed or
spelled "at" and "dot" into @ and full stop. Each normalised character remembers the stretch
of source it came from, so spans found there are mapped back to the source. The base spans
always stay; a span of the second pass is added unless it lies in a base span of its kind, so
an identifier that is disguised in part has its base span and the whole one. Redaction takes
out the union of spans that overlap, under the kind of the longest.

Defined cases: a null text is empty; matches of one kind and pass never overlap; a match that fails its
rule (part over 255, number of digits, Luhn) is dropped without another try; repeated rows
get equal results; other columns are ignored. The time for a text grows in proportion to its
length, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.store import table

KINDS = ("email", "ip", "card", "phone")
#: The base patterns.
#: (email and ip as whole runs of their first class, possessive, with the rest as an optional
#: group: a run without the rest is passed over once instead of from each of its characters)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Letters that look like ASCII ones (Cyrillic, Greek); full-width forms follow from their offset.
LOOK_ALIKE = dict(zip("аВвсԁеНһіјКМморԛЅѕТтуѡхАСЕІЈОРХУΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαν", "aBBcdeHhijKMMopqSsTTywxACEIJOPXYABEZHIKMNOPTYXoav"))
FOLD = str.maketrans(LOOK_ALIKE | {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {"﹫": "@", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", " ": " "})
#: Letters that case-insensitive patterns take for ASCII ones.
FOLD |= str.maketrans("\u017f\u0131\u0130\u212a", "siIK")
HIDDEN = "​‌‍⁠﻿­"
#: Digits as words.
SPELLED = {w: str(d) for words in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve") for d, w in enumerate(words.split())}
_DIGIT = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + "|[0-9])"
#: A run of digits, some as words; it counts if a word follows a digit with a space or hyphen between.
_RUN = re.compile(rf"(?i)(?<!\w)((?:plus|\+)[ ]?)?{_DIGIT}(?!\w)(?:[ .-]{{1,2}}{_DIGIT}(?!\w))*+")
_PAIR = re.compile(rf"(?i)(?<=\w)[ -]{{1,2}}(?:{'|'.join(SPELLED)})(?!\w)")
_ONE = re.compile(rf"(?i)plus[ ]?|{'|'.join(sorted(SPELLED, key=len, reverse=True))}")
_AT = r"[ ]?[\[({<][ ]?(?:at|arroba)[ ]?[\])}>][ ]?"
_DOT = r"[ ]?[\[({<][ ]?(?:dot|punkt|point|punto)[ ]?[\])}>][ ]?"
_NAME = r"[A-Za-z0-9_%+-]++"
#: Addresses whose "at" or "dots" are bracketed, or whose "at" and "dot" are both spelled out, and
#: numbers with such dots. As above, a chain of names that no "at" follows is passed over once.
_ADDRESSES = (
    re.compile(rf"(?i){_NAME}(?:(?:\.|{_DOT}){_NAME})*+((?:@|{_AT}){_NAME}(?:(?:\.|{_DOT}){_NAME})++)?"),
    re.compile(rf"(?i){_NAME}(?:(?:\.| dot ){_NAME})*+( at {_NAME}(?: dot {_NAME})++)?"),
    re.compile(rf"(?i)[0-9]{{1,3}}((?:(?:{_DOT}| dot )[0-9]{{1,3}}){{3}})"),
)
_PART = re.compile(rf"(?i){_AT}| at |{_DOT}| dot ")
_BRACKETED = re.compile(r"[\[({<] ?(?:at|arroba|dot|punkt|point|punto) ?[\])}>]")
#: Two neighbours that any match of _RUN holds, in lower-case text.
_SPELLED = re.compile(rf"[ -](?=[ -]?(?:{'|'.join(SPELLED)})(?!\w))(?:(?<=[0-9].)|{'|'.join(f'(?<={w}.)' for w in SPELLED)})")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """Base spans by kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = [m.span() for m in EMAIL.finditer(text) if m[1]]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    if "." in text:
        out["ip"] = [m.span() for m in IP.finditer(text) if m[1] and all(int(p[-9:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


class Normalised:
    """A text under rewriting; ``first`` and ``last`` give each character's source stretch."""

    def __init__(self, text: str):
        self.text = text
        self.first: list[int] = list(range(len(text)))
        self.last: list[int] = list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces stretches (in order, disjoint); each new character stands for all of its own."""
        parts, first, last, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            first += self.first[at:a] + [self.first[a]] * len(new)
            last += self.last[at:a] + [self.last[b - 1]] * len(new)
            at = b
        self.text = "".join([*parts, self.text[at:]])
        self.first, self.last = first + self.first[at:], last + self.last[at:]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.first[a], self.last[b - 1]


def _disguised(text: str) -> bool:
    if not text.isascii() and (text.translate(FOLD) != text or any(c in text for c in HIDDEN)):
        return True
    low = text.lower()
    if " dot " in low or any(c in low for c in "[({<") and _BRACKETED.search(low):
        return True
    return _SPELLED.search(low) is not None


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """The runs of digits with words among them."""
    return (m.span() for m in _RUN.finditer(text) if _PAIR.search(text, max(m.start(), m.end(1)), m.end()))


def normalise(text: str) -> Normalised:
    out = Normalised(text.translate(FOLD))  # one character for one
    hidden = [(m.start(), m.end(), "") for m in re.finditer(f"[{HIDDEN}]+", out.text)]
    if hidden:
        out.rewrite(hidden)
    spelled = []
    for run in _runs(out.text):
        for m in _ONE.finditer(out.text, *run):
            spelled.append((*m.span(), SPELLED.get(m[0].lower(), "+")))
    # spelled digits lose the spaces between them, so that groups read as one number
    merged: list[tuple[int, int, str]] = []
    for a, b, new in spelled:
        if merged and re.fullmatch(r"[ .-]{1,2}", out.text[merged[-1][1]:a]):
            merged.append((merged[-1][1], b, new))
        else:
            merged.append((a, b, new))
    if merged:
        out.rewrite(merged)
    parts, end = [], 0
    for a, b in sorted((m.span() for pattern in _ADDRESSES for m in pattern.finditer(out.text) if m[1]), key=lambda x: (x[0], -x[1])):
        if a < end:
            continue
        end = b
        for m in _PART.finditer(out.text, a, b):
            parts.append((*m.span(), "@" if re.search("(?i)at|arroba", m[0]) else "."))
    if parts:
        out.rewrite(parts)
    return out


def find_all(text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans, and base and added spans, by kind."""
    base = find(text)
    if not _disguised(text):
        return base, base
    plain = normalise(text)
    every = {k: list(spans) for k, spans in base.items()}
    for kind, spans in find(plain.text).items():
        starts = [x for x, _ in base[kind]]  # base spans are disjoint: only the last one that starts by then can hold it
        for a, b in spans:
            a, b = plain.source(a, b)
            at = bisect_right(starts, a) - 1
            if at < 0 or b > base[kind][at][1]:
                every[kind].append((a, b))
        every[kind].sort()
    return base, every


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every union of overlapping spans replaced by the kind of the longest, in brackets."""
    unions: list[tuple[int, int, int, str]] = []  # start, end, length of the longest span, its kind
    for a, b, k in sorted(((a, b, k) for k in KINDS for a, b in spans[k]), key=lambda s: (s[0], -s[1])):
        if unions and a < unions[-1][1]:
            first, end, most, kind = unions[-1]
            unions[-1] = (first, max(end, b), *((b - a, k) if b - a > most else (most, kind)))
        else:
            unions.append((a, b, b - a, k))
    out, at = [], 0
    for a, b, _, k in unions:
        out += [text[at:a], f"[{k.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _scan(with_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = find_all(text or "")
                rows.append((*(len(base[k]) for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every),
                             redact(text, every) if with_text and text is not None else None))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"]
            n = 7 if with_text else 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols[:n], kinds))], names=["doc_id", *names[:n]])

    return task


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, base counts, the hash of the base spans, all spans, and the redacted text."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_scan(with_text), schema + (", redacted string" if with_text else "")))


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if t is None else redact(t, find_all(t)[1]) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "redacted"])


def with_redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` in a column ``row``, and the redacted text."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_redact, f"row {rows.schema['row'].dataType.simpleString()}, redacted string")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), with_text=False)
