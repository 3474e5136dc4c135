"""Personal data in plain and in disguised form, with spans in the source text."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintel.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A dotted number can only begin where its first run of digits does.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, str]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from their @ in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Spans (start, end, kind) of the four base patterns: per kind leftmost, not overlapping, failing matches dropped."""
    spans: list[Span] = []
    if "@" in text:
        spans += [(a, b, "email") for a, b in emails(text)]
    if DIGITS.search(text) is None:
        return spans
    if "." in text:
        for m in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
                spans.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return spans


# Characters that look like an ASCII one, in rows of lookalikes and what they stand for.
LOOKALIKES = [
    ("АВЕКМНОРСТХаеорсухіјѕԁԛԝһ", "ABEKMHOPCTXaeopcyxijsdqwh"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ", "ABEZHIKMNOPTYXovp"),
    ("‐‑‒–—−﹣", "-------"),
    ("․。｡﹒", "...."),
    ("﹢₊⁺", "+++"),
    ("﹫", "@"),
    ("⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"),
    ("₀₁₂₃₄₅₆₇₈₉", "0123456789"),
    ("٠١٢٣٤٥٦٧٨٩", "0123456789"),
    ("۰۱۲۳۴۵۶۷۸۹", "0123456789"),
    ("०१२३४५६७८९", "0123456789"),
    ("      　", "       "),
]
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
FOLD: dict[str, str] = {a: b for odd, plain in LOOKALIKES for a, b in zip(odd, plain, strict=True)}
FOLD |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
FOLD |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}
FOLD |= {chr(0x24B6 + i): chr(65 + i) for i in range(26)} | {chr(0x24D0 + i): chr(97 + i) for i in range(26)}
FOLD |= {chr(0x2460 + i): str(i + 1) for i in range(9)} | {"⓪": "0"}
FOLD |= dict.fromkeys(INVISIBLE, "")
ODD = re.compile("[" + "".join(map(re.escape, FOLD)) + "]")

# Digits spelled in four languages.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORDS = "|".join(sorted(SPELLED, key=len, reverse=True))
#: Three spelled digits in a row at least, alone or with plain digits, dots and signs between: less is prose.
SPELLED_RUN = re.compile(
    rf"(?<!\w)(?:{_WORDS})(?:[ ]?[-.()+,]?[ ]?(?:(?:{_WORDS})(?!\w)|[0-9]++|(?:dot|plus|dash|minus)(?!\w))){{2,}}+(?!\w)", re.IGNORECASE
)
SPELLED_ONE = re.compile(rf"(?<!\w)({_WORDS})(?!\w)(?:[ -](?=(?:{_WORDS})(?!\w)))?", re.IGNORECASE)
PLUS = re.compile(r"(?<!\w)plus[ ]?(?=[0-9])", re.IGNORECASE)
NUMBER_DOT = re.compile(r"(?<=[0-9]) ?(?:[\[({<] ?(?:dot|punkt|point|punto|\.) ?[\])}>]|(?<= )(?:dot|punkt|point|punto)(?= )) ?(?=[0-9])", re.IGNORECASE)

_AT = r" ?[\[({<] ?(?:at|ät|arroba|arobase|@) ?[\])}>] ?"
_BARE_AT = r" (?:at|arroba) "
_DOT = r" ?[\[({<] ?(?:dot|punkt|point|punto|\.) ?[\])}>] ?| (?:dot|punkt|punto) "
_NAME = r"[A-Za-z0-9_%+-]++"
_LABEL = r"[A-Za-z0-9-]++"
# Last labels that make "name at label dot label" an address rather than prose.
_LAST = "com|org|net|edu|gov|mil|int|info|biz|name|io|ai|app|dev|co|me|tv|eu|de|fr|es|it|nl|be|ch|pt|pl|se|no|dk|fi|cz|uk|ie|us|ca|mx|br|ar|cl|au|nz|jp|cn|kr|in|ru|za|test|example|invalid|local"
# Words after "at" in prose, as in "at the dot".
_PROSE = "the|this|that|a|an|any|some|no|each|every|my|your|his|her|our|their|its|one"
#: name AT label DOT label, AT or DOT disguised. A bare "at" needs a spelled dot, for "at x.y" is prose, and a known last label or else any of
#: letters that ends its phrase, for "at polka dot dresses are" is prose as well.
DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9_%+-]){_NAME}(?:(?:\.|{_DOT}){_NAME}){{0,8}}?"
    rf"(?:(?:{_AT}|@){_LABEL}(?:(?:\.|{_DOT}){_LABEL})+"
    rf"|{_BARE_AT}{_LABEL}(?:(?:\.|{_DOT}){_LABEL}){{0,8}}(?:{_DOT})(?:{_LAST})(?![A-Za-z0-9-])"
    rf"|{_BARE_AT}(?!(?:{_PROSE}) ){_LABEL}(?:(?:\.|{_DOT}){_LABEL}){{0,8}}(?:{_DOT})[A-Za-z]{{2,12}}+(?= ?(?:[^\w\s-]|\n|\Z)))",
    re.IGNORECASE,
)
_BARE_AROBASE = r" ?(?:[\[({<] ?arobase ?[\])}>]| arobase ) ?"
_POINT = rf"{_DOT}| point "
#: The same in French: "arobase" is no word of prose, so a bare "point" is a dot beside it. "at this point in" stays prose.
AROBASE = re.compile(rf"(?<![A-Za-z0-9_%+-]){_NAME}(?:(?:\.|{_DOT}){_NAME}){{0,8}}?{_BARE_AROBASE}{_LABEL}(?:(?:\.|{_POINT}){_LABEL})+", re.IGNORECASE)
AROBASE_HINT = re.compile(r"arobase", re.IGNORECASE)
DISGUISE_HINT = re.compile(r"[\[({<] ?(?:at|ät|arroba|@|dot|punkt|point|punto|\.) ?[\])}>]| (?:dot|punkt|punto) ", re.IGNORECASE)
AT_SIGN = re.compile(rf"{_AT}|{_BARE_AT}", re.IGNORECASE)
AROBASE_SIGN = re.compile(_BARE_AROBASE, re.IGNORECASE)
DOT_SIGN = re.compile(_DOT, re.IGNORECASE)
POINT_SIGN = re.compile(_POINT, re.IGNORECASE)

Edit = tuple[int, int, str]


class Normalised:
    """A text with, for every character, the span of the source that it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text), dtype=np.int64)
        self.ends = self.starts + 1

    def apply(self, edits: list[Edit]) -> None:
        """Replace spans, given in order; every new character stands for the whole span replaced."""
        if not edits:
            return
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            texts += [self.text[at:a], new]
            starts += [self.starts[at:a], np.full(len(new), self.starts[a])]
            ends += [self.ends[at:a], np.full(len(new), self.ends[b - 1])]
            at = b
        texts.append(self.text[at:])
        self.text = "".join(texts)
        self.starts = np.concatenate([*starts, self.starts[at:]])
        self.ends = np.concatenate([*ends, self.ends[at:]])

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


def fold_lookalikes(text: str) -> list[Edit]:
    return [(m.start(), m.end(), FOLD[m[0]]) for m in ODD.finditer(text)]


def fold_digits(text: str) -> list[Edit]:
    """Spelled digits of a run, with the space between two of them; "plus" before digits."""
    edits = []
    for run in SPELLED_RUN.finditer(text):
        edits += [(m.start(), m.end(), SPELLED[m[1].lower()]) for m in SPELLED_ONE.finditer(text, run.start(), run.end())]
    return edits


def fold_signs(text: str) -> list[Edit]:
    """At and dot signs of disguised addresses, and dots and pluses of numbers."""
    edits = []
    for found in DISGUISED.finditer(text) if DISGUISE_HINT.search(text) else ():
        span = found.span()
        edits += [(m.start(), m.end(), "@") for m in AT_SIGN.finditer(text, *span)]
        edits += [(m.start(), m.end(), ".") for m in DOT_SIGN.finditer(text, *span)]
    for found in AROBASE.finditer(text) if AROBASE_HINT.search(text) else ():
        span = found.span()
        edits += [(m.start(), m.end(), "@") for m in AROBASE_SIGN.finditer(text, *span)]
        edits += [(m.start(), m.end(), ".") for m in POINT_SIGN.finditer(text, *span)]
    edits += [(m.start(), m.end(), ".") for m in NUMBER_DOT.finditer(text)]
    edits += [(m.start(), m.end(), "+") for m in PLUS.finditer(text)]
    out: list[Edit] = []
    for edit in sorted(edits):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


def disguised_spans(text: str) -> list[Span]:
    """Spans, in the source, of what the base patterns find only after the text has been normalised."""
    made = Normalised(text)
    changed = False
    for transducer in (fold_lookalikes, fold_digits, fold_signs):
        if transducer is fold_lookalikes and text.isascii():
            continue
        edits = transducer(made.text)
        changed = changed or bool(edits)
        made.apply(edits)
    return [(*made.source(a, b), kind) for a, b, kind in plain_spans(made.text)] if changed else []


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those added by normalising, both by start and then kind.

    A span is added unless it overlaps a base span of its kind, so base spans stay as they are.
    """
    base = plain_spans(text)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    more = disguised_spans(text)
    if more:
        taken = {k: sorted(s[:2] for s in base if s[2] == k) for k in KINDS}
        more = [s for s in dict.fromkeys(more) if not any(a < s[1] and s[0] < b for a, b in taken[s[2]])]
    return sorted(base, key=order), sorted(base + more, key=order)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of the base spans; spans lists these and the n_added ones that appear after
    homoglyphs, spelled digits and at/dot disguises are normalised, as kind:start:end in code points of the source.
    Null text counts as empty; repeated rows each get a row; an empty table gives an empty one; other columns are not looked at. Whole texts are
    read, however long; a text is the unit of work, and time grows with its length. No shuffle.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            found = [all_spans(t) for t in batch["text"].to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            digests = pa.array([hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found])
            added = pa.array([len(every) - len(base) for base, every in found], pa.int64())
            out = [batch["doc_id"], *counts, digests, pa.array([shown(every) for _, every in found]), added]
            yield pa.RecordBatch.from_arrays(out, names)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    kinds = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(batches, kinds)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for a, b, kind in all_spans(text)[1]:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """docs with all its rows and columns, personal data in text replaced, and n_chars (where there is one) counted anew.

    Null texts stay null; repeated rows stay; an empty table stays empty; whole texts are read and written.
    """

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            at = batch.schema.get_field_index("text")
            texts = pa.array([None if t is None else masked(t) for t in batch["text"].to_pylist()], pa.string())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field("text", pa.string())))

    done = docs.mapInArrow(batches, docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
