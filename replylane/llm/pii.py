"""Personal data behind disguises, with spans in the characters of the source.

Two layers. The base layer reads the text as it is. The second runs transducers that rewrite
look-alike characters, spelled digits and disguised "at" and "dot", keeping for every written
character the source range it stands for; the same detectors read the rewritten text, and a
span that holds a disguise and lies in no base span of its kind is mapped back and added.

Defined results: a null text is an empty one and has no spans; repeated rows give repeated
results; offsets are code points, the end exclusive; other columns are ignored. Bare words
"at" and "dot" count only together ("ann at mail dot org"), so plain prose is left alone.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from replylane.llm.words import Texts, chunks

KINDS = ("email", "ip", "card", "phone")
#: digits below which nothing is found, and items from which one spelled digit, or plus, is enough
MIN_DIGITS, MIN_ITEMS = 4, 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A match can only begin where a run of digits begins: from inside it, it would end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other alphabets that look like Latin ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅαοερυνκιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlABEKMHOPCTXIJSaoepuvkiABEZHIKMNOPTYX",
))
INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in the four languages, from zero to nine.
SPELLED = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_OF = {word: str(i) for row in SPELLED for i, word in enumerate(row.split())} | {"oh": "0"}
PLUS = "plus"

_DIGIT = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
_DOTTED = "dot|punto|punkt|point"
_ITEM = f"(?:{_DIGIT}|{PLUS}|[0-9]++)"
_RUN = re.compile(
    rf"(?<!\w){_ITEM}(?:[ \t.-]{{1,3}}(?:(?:{_DOTTED})[ \t.-]{{1,3}})?{_ITEM})+(?!\w)", re.IGNORECASE
)
_RUN_ITEM = re.compile(f"{_ITEM}|{_DOTTED}", re.IGNORECASE)
# Letters that the patterns take for i and s, but whose lower case is not.
_ODD_CASE = str.maketrans("İıſ", "iis")
_SIGN = {"at": "@", "@": "@", "arroba": "@", "dot": ".", "punto": ".", "punkt": ".", "point": ".", ".": "."}
_BRACKETED = re.compile(
    r"[ \t]{0,2}[\[({<][ \t]{0,2}(at|@|arroba|dot|punto|punkt|point|\.)[ \t]{0,2}[\])}>][ \t]{0,2}",
    re.IGNORECASE,
)
_BARE_AT = re.compile(
    r"(?<=[A-Za-z0-9])[ \t]{1,2}at[ \t]{1,2}"
    r"(?=[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}[ \t]{1,2}dot[ \t]{1,2}[A-Za-z0-9])",
    re.IGNORECASE,
)
_DOT = re.compile(r"[ \t]dot[ \t]", re.IGNORECASE)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])[ \t]{1,2}dot[ \t]{1,2}(?=[A-Za-z0-9])", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """From each at sign back to where its local part can begin, so no run is read twice."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        # what lies before this sign, or in the found span, cannot begin another address
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return out


def detect(text: str) -> list[tuple[str, int, int]]:
    """Base spans, by kind as listed and then by start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


@lru_cache(maxsize=1)
def _characters() -> tuple[dict[str, str], re.Pattern]:
    """Characters that stand for one ASCII character, and a pattern that finds any."""
    table = {c: "" for c in INVISIBLE} | LOOKALIKES
    for code in [*range(0x2000, 0x3000), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D800)]:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and "!" <= plain <= "~":
            table.setdefault(chr(code), plain)
    return table, re.compile("[" + "".join(map(re.escape, table)) + "]")


class Rewritten:
    """A text under rewriting: what it reads now, and the source range of each character."""

    def __init__(self, text: str):
        self.text = text
        self.begin: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.disguised = bytearray(len(text))

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges, in order and apart, by short strings."""
        if not edits:
            return
        parts, begin, end, marks, at = [], [], [], bytearray(), 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            parts += [self.text[at:a], new]
            begin.extend(self.begin[at:a])
            end.extend(self.end[at:a])
            marks += self.disguised[at:a]
            if a < b:
                begin.extend([self.begin[a]] * len(new))
                end.extend([self.end[b - 1]] * len(new))
            marks += b"\1" * len(new)
            if a < b and not new and marks:
                marks[-1] = 1
            at = b
        self.text, self.begin, self.end, self.disguised = "".join(parts), begin, end, marks


def _spell(rewritten: Rewritten) -> list[tuple[int, int, str]]:
    """Edits that write spelled digits, with what stands beside them, as one number.

    What parts two plain groups of digits stays. Whether the number is anything is for the
    detectors to say, by its length, check digit or parts.
    """
    edits = []
    for run in _RUN.finditer(rewritten.text):
        items = []
        for m in _RUN_ITEM.finditer(rewritten.text, run.start(), run.end()):
            word = m[0].translate(_ODD_CASE).lower()
            new = m[0] if m[0].isdigit() else "+" if word == PLUS else DIGIT_OF.get(word, ".")
            items.append((m.start(), m.end(), new, m[0].isdigit()))
        spelled = sum(not plain and new.isdigit() for *_, new, plain in items)
        signs = sum(new == "+" for *_, new, _ in items)
        digits = sum(len(new) for *_, new, _ in items if new.isdigit())
        # one number in letters beside digits is prose ("… 1373 un autre") in a short run
        if len(items) < MIN_ITEMS and (spelled < 2 or digits < MIN_DIGITS):
            continue
        if not spelled and not signs:
            continue
        before = None
        for a, b, new, plain in items:
            if before and a > before[0] and not (plain and before[1]):
                edits.append((before[0], a, ""))
            if not plain:
                edits.append((a, b, new))
            before = b, plain
    return edits


def rewrite(text: str, spelled: bool = True) -> Rewritten | None:
    """The text without disguises; None where nothing looks like one.

    ``spelled`` tells whether the text as it is can hold a run of spelled digits; once
    something in it was rewritten, that is looked for in any case.
    """
    out = Rewritten(text)
    if not text.isascii():
        table, any_of = _characters()
        if not table.keys().isdisjoint(set(text)):
            out.apply([(m.start(), m.end(), table[m[0]]) for m in any_of.finditer(text)])
    if any(c in out.text for c in "[({<"):
        out.apply([(m.start(), m.end(), _SIGN[m[1].lower()]) for m in _BRACKETED.finditer(out.text)])
    if _DOT.search(out.text):
        out.apply([(m.start(), m.end(), "@") for m in _BARE_AT.finditer(out.text)])
        # a bare dot belongs to an address only after its at sign, or between numbers
        edits, reach = [], -1
        for m in _BARE_DOT.finditer(out.text):
            before = re.search(r"[A-Za-z0-9.-]*$", out.text[max(0, m.start() - 80) : m.start()])[0]
            start = m.start() - len(before)
            after_at = start > 0 and out.text[start - 1] == "@"
            number = before.replace(".", "").isdigit() and out.text[m.end()].isdigit()
            if after_at or number or start == reach:
                edits.append((m.start(), m.end(), "."))
                reach = m.end()
        out.apply(edits)
    if spelled or 1 in out.disguised or len(out.text) != len(text):
        out.apply(_spell(out))
    return out if 1 in out.disguised else None


def added(
    text: str, base: list[tuple[str, int, int]], spelled: bool = True
) -> list[tuple[str, int, int]]:
    """Spans found only behind disguises, in source characters."""
    out = rewrite(text, spelled)
    if out is None:
        return []
    spans = []
    for kind, a, b in detect(out.text):
        if 1 in out.disguised[a:b]:
            start, end = out.begin[a], out.end[b - 1]
            if not any(k == kind and s <= start and end <= e for k, s, e in base):
                spans.append((kind, start, end))
    return spans


_SPELLING = np.full(256, 32, np.uint8)
_SPELLING[48:58] = np.arange(48, 58)
_SPELLING[65:91] = _SPELLING[97:123] = np.arange(97, 123)
# The first byte of the letters U+00C0 to U+00FF, in upper case those before U+00DF.
_ACCENTED = 0xC3


def _folded(data: np.ndarray) -> np.ndarray:
    """Digits, and Latin letters in lower case; all other bytes become blanks."""
    out = _SPELLING[data]
    if len(data):
        first, second = data[:-1], data[1:]
        pair = np.flatnonzero((first == _ACCENTED) & (second >= 0x80) & ((second & 0x1F) != 0x17))
        out[pair] = _ACCENTED
        out[pair + 1] = np.where(second[pair] < 0x9F, second[pair] + 0x20, second[pair])
    return out


def _odd_case(data: np.ndarray) -> np.ndarray:
    """Where a letter of ``_ODD_CASE`` begins: C4 B0, C4 B1 and C5 BF."""
    first, second = data[:-1], data[1:]
    return np.flatnonzero(
        ((first == 0xC4) & ((second == 0xB0) | (second == 0xB1))) | ((first == 0xC5) & (second == 0xBF))
    )


@lru_cache(maxsize=1)
def _item_hashes() -> np.ndarray:
    _, _, texts = next(chunks(pa.array([" ".join([*DIGIT_OF, PLUS])])))
    return np.unique(texts.word_hashes())


def may_spell(column: pa.Array) -> np.ndarray:
    """Texts with a spelled digit, or plus, beside another or beside a number.

    A quick test before the pattern, which passes every text in which the pattern finds one as
    the text is (``rewrite`` reads the others after look-alikes, invisible characters and
    signs). Words end here at everything but digits and Latin letters, and words for dots are
    passed over, so all that touches an item of the pattern is apart from it. Case is that of
    the pattern; texts with letters whose case changes their length all pass.
    """
    out = np.zeros(len(column), bool)
    for first, _, texts in chunks(column):
        odd = _odd_case(texts.data)
        out[first + np.searchsorted(texts.offsets, odd, "right") - 1] = True
        texts = Texts(_folded(texts.data), texts.offsets)
        hashes = texts.word_hashes()
        if len(hashes) < 2:
            continue
        known = _item_hashes()
        spelled = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
        digits = np.append(0, np.cumsum((texts.data >= 48) & (texts.data < 58)))
        item = spelled | (digits[texts.ends] > digits[texts.starts])
        for step in (1, 2):  # beside each other, or with a word for a dot between
            near = (spelled[:-step] & item[step:]) | (item[:-step] & spelled[step:])
            out[first + texts.text_of[np.flatnonzero(near & (texts.text_of[:-step] == texts.text_of[step:]))]] = True
    return out


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(text: str | None, spelled: bool = True) -> tuple[list[int], str, str]:
    """Base counts by kind, the digest of the base spans, and all spans."""
    text = text or ""
    base = detect(text)
    spans = sorted([*base, *added(text, base, spelled)], key=lambda s: (KINDS.index(s[0]), s[1]))
    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
    return counts, hashlib.sha256(_join(base).encode()).hexdigest(), _join(spans)


def detect_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans, one row per document."""
    def run(batches):
        for batch in batches:
            column = batch.column("text")
            rows = list(map(find, column.to_pylist(), may_spell(column).tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *[pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(KINDS))],
                 pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, {counts}, base_sha256 string, spans string"
    )
