"""Personal data in plain and disguised form, with offsets of the source text.

Plain identifiers (email, ip, card, phone) are found on the source. Disguised ones are found on a normalised text made
by a chain of transducers: look-alike letters and foreign digits become ASCII and invisible characters go; runs of
spelled digits become digits (few of them beside a number or with a sign in words); "(at)", "[dot]", " at " ... " dot " become signs. Every normalised character keeps the
source span it came from, so a span found there maps back to the source. Spans that add nothing to a plain one of
their kind are left out; plain ones always stay.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlift.llm import spans as sp
from searchlift.llm.tables import packed, small_batches, unpacked

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. Addresses of either kind are found from a sign outwards (see `plain_spans`); the patterns as they are
# would start again at every character of a long run.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Letters of other scripts that look like ASCII ones, and characters that show nothing.
LOOK_ALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅοανιρΑΒΕΗΙΚΜΝΟΡΤΧΥΖ", "aeopcyxijshdqwABEKMHOPCTXIJSoavipABEHIKMNOPTXYZ"))
INVISIBLE = "​‌‍⁠﻿­"
SIGNS = {"․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " "}

# Names of the digits in English, German, French and Spanish.
DIGIT_NAMES = {
    0: "zero oh null zéro cero",
    1: "one eins un uno",
    2: "two zwei deux dos",
    3: "three drei trois tres",
    4: "four vier quatre cuatro",
    5: "five fünf cinq cinco",
    6: "six sechs seis",
    7: "seven sieben sept siete",
    8: "eight acht huit ocho",
    9: "nine neun neuf nueve",
}
NAMED = {name: str(digit) for digit, names in DIGIT_NAMES.items() for name in names.split()}
#: Digits in words that stand in a row before they are read as a number with nothing beside them.
LEAST_NAMED = 7

_ODD_SET = frozenset([*LOOK_ALIKES, *INVISIBLE, *SIGNS, *map(chr, range(0xFF01, 0xFF5F))])
_NAME = "(?:" + "|".join(sorted(NAMED, key=len, reverse=True)) + ")"
_POINT = r"(?:dot|point|punkt|punto)"
_SEP = r"[\x20,-]+"
# Digits in words, single digits among them; points and dashes in words stand between these or digits.
_WORDS = rf"{_NAME}(?!\w)(?:{_SEP}(?:{_NAME}(?!\w)|[0-9](?!\w|\.[0-9])))*"
_SPELLED = re.compile(rf"(?<!\w)(?:plus{_SEP})?(?:{_WORDS}|[0-9]+)(?:{_SEP}(?:{_POINT}|dash|hyphen){_SEP}(?:{_WORDS}|[0-9]+))*(?!\w)", re.IGNORECASE)
_DIGITS = re.compile(r"[0-9]+")
_GAP = " ,()-"
_PIECE = re.compile(rf"(?P<plus>plus)|(?P<name>{_NAME})|(?P<digit>[0-9])|(?P<dot>{_POINT})|(?P<dash>dash|hyphen)", re.IGNORECASE)
_OPEN, _CLOSE = r"\x20?[(\[{<]\x20?", r"\x20?[)\]}>]\x20?"
_AT = re.compile(rf"{_OPEN}(?:at|@){_CLOSE}", re.IGNORECASE)
_DOT = re.compile(rf"{_OPEN}(?:dot|\.|punkt|punto){_CLOSE}", re.IGNORECASE)
_LABEL = r"[A-Za-z0-9-]+"
_SPOKEN_AT = re.compile(r"\x20at\x20|@", re.IGNORECASE)
_SPOKEN_HOST = re.compile(rf"{_LABEL}(?:(?:\x20dot\x20|\.){_LABEL})+", re.IGNORECASE)
_WORD_SIGN = re.compile(r"\x20at\x20|\x20dot\x20", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _local_before(text: str, end: int, floor: int) -> int:
    """Start of the run of characters of a mailbox that ends here."""
    while end > floor and text[end - 1] in _LOCAL_SET:
        end -= 1
    return end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL: a mailbox holds no @, so a match is the whole run before an @ with what the pattern takes behind."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = _local_before(text, at, floor)
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            floor = host.end()
        at = text.find("@", max(at + 1, floor))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """The matches of IP whose parts are small enough: numbers joined by points, four at a time."""
    for m in _CHAIN.finditer(text):
        parts = m.group().split(".")
        end = m.start() - 1
        for k in range(0, len(parts) - 3, 4):
            start = end + 1
            end = start + sum(map(len, parts[k : k + 4])) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in parts[k : k + 4]):
                yield start, end


def plain_spans(text: str) -> list[sp.Span]:
    """What the fixed patterns find, in time that grows with the text."""
    found: list[sp.Span] = [("email", *span) for span in _emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *span) for span in _ips(text)]
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sp.ordered(found, KINDS)


class Normalised:
    """A text with, for every character, the source span it stands for."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None, made: np.ndarray | None = None):
        self.text = text
        self.starts = np.arange(len(text)) if starts is None else starts
        self.ends = np.arange(1, len(text) + 1) if ends is None else ends
        #: Whether the character was a digit in words.
        self.made = np.zeros(len(text), dtype=bool) if made is None else made

    def rewritten(self, edits: list[tuple[int, int, list[tuple[str, int, int, bool]]]]) -> Normalised:
        """Replaces each [start, end) by characters with places of their own; edits are in order and apart."""
        if not edits:
            return self
        text, starts, ends, made, at = [], [], [], [], 0
        for start, end, chars in edits:
            text += [self.text[at:start], "".join(c for c, _, _, _ in chars)]
            starts += [self.starts[at:start], np.array([self.starts[a] for _, a, _, _ in chars], dtype=int)]
            ends += [self.ends[at:start], np.array([self.ends[b - 1] for _, _, b, _ in chars], dtype=int)]
            made += [self.made[at:start], np.array([m for _, _, _, m in chars], dtype=bool)]
            at = end
        text.append(self.text[at:])
        return Normalised("".join(text), np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]]), np.concatenate([*made, self.made[at:]]))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


def _folded(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES or c in SIGNS:
        return LOOK_ALIKES.get(c) or SIGNS[c]
    if "！" <= c <= "～":  # full-width forms follow ASCII in order
        return chr(ord(c) - 0xFEE0)
    return str(unicodedata.decimal(c, c))


def fold_characters(n: Normalised) -> Normalised:
    if n.text.isascii():
        return n
    odd = [c for c in set(n.text) if c in _ODD_SET or (c > "\x7f" and c.isdecimal())]
    if not odd:
        return n
    folded = {c: _folded(c) for c in odd}
    found = re.finditer("[" + "".join(map(re.escape, odd)) + "]+", n.text)
    return n.rewritten([(m.start(), m.end(), [(x, k, k + 1, False) for k, c in enumerate(m.group(), m.start()) for x in folded[c]]) for m in found])


def _beside_number(text: str, start: int, end: int) -> bool:
    """Whether a digit or a plus stands before or behind, at most signs between groups apart, or a point with no gap."""
    k = start - 1
    while k >= 0 and text[k] in _GAP:
        k -= 1
    if k >= 0 and (text[k] in "+0123456789" or (text[k] == "." and k == start - 1)):
        return True
    k = end
    while k < len(text) and text[k] in _GAP:
        k += 1
    if k < len(text) and text[k] in "0123456789":
        return True
    return text[end : end + 1] == "." and text[end + 1 : end + 2].isalnum()


def read_digits(n: Normalised) -> Normalised:
    """Digits in words become digits where they are many, hold a sign in words, or stand beside a number or such words."""
    edits, group, named, wanted, last = [], [], 0, False, 0

    def close() -> None:
        if wanted or named >= LEAST_NAMED:
            edits.extend(group)

    for m in _SPELLED.finditer(n.text):
        if _DIGITS.fullmatch(m.group()):
            continue
        gap = n.text[last : m.start()]
        if group and gap != "." and gap.strip(_GAP):
            close()
            group, named, wanted = [], 0, False
        chars, sign = [], False
        for piece in _PIECE.finditer(n.text, m.start(), m.end()):
            made = {"plus": "+", "dot": ".", "dash": "-"}.get(piece.lastgroup)
            sign |= made is not None
            chars.append((made or NAMED.get(piece.group().lower(), piece.group()), piece.start(), piece.end(), piece.lastgroup == "name"))
        group.append((m.start(), m.end(), chars))
        named += sum(made for *_, made in chars)
        wanted = wanted or sign or _beside_number(n.text, m.start(), m.end())
        last = m.end()
    close()
    return n.rewritten(edits)


def _spoken(text: str) -> Iterator[tuple[int, int]]:
    """Addresses whose signs may be words: from an "at" to the left over mailbox parts joined by "dot", to the right over a host."""
    floor = 0
    for at in _SPOKEN_AT.finditer(text):
        if at.start() < floor:
            continue
        start, end = None, at.start()
        while True:
            part = _local_before(text, end, floor)
            if part == end or (part == floor and part and text[part - 1] in _LOCAL_SET):
                break
            start, end = part, part - 5
            if end < floor or text[end:part].lower() != " dot ":
                break
        host = _SPOKEN_HOST.match(text, at.end()) if start is not None else None
        if host:
            yield start, host.end()
            floor = host.end()


def read_signs(n: Normalised) -> Normalised:
    if any(c in n.text for c in "([{<"):
        marks = [(m.start(), m.end(), "@") for m in _AT.finditer(n.text)] + [(m.start(), m.end(), ".") for m in _DOT.finditer(n.text)]
        n = n.rewritten([(a, b, [(c, a, b, False)]) for a, b, c in _apart(marks)])
    words = []
    if _WORD_SIGN.search(n.text):
        for start, end in _spoken(n.text):
            words += [(w.start(), w.end(), "@" if "at" in w.group().lower() else ".") for w in _WORD_SIGN.finditer(n.text, start, end)]
    return n.rewritten([(a, b, [(c, a, b, False)]) for a, b, c in _apart(words)])


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    kept: list[tuple[int, int, str]] = []
    for edit in sorted(edits):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


def disguised_spans(text: str, plain: list[sp.Span]) -> list[sp.Span]:
    """What the chain of transducers brings to light beyond `plain`."""
    n = read_signs(read_digits(fold_characters(Normalised(text))))
    if n.text == text:
        return []
    found = [(kind, *n.source(a, b)) for kind, a, b in plain_spans(n.text)]
    near = _holder(found)
    for m in CARD.finditer(n.text):  # a number in words needs no plus to be one to call
        digits = len(re.sub("[^0-9]", "", m.group()))
        if 9 <= digits <= 15 and n.made[m.start()] and n.made[m.end() - 1] and n.made[m.start() : m.end()].sum() >= LEAST_NAMED:
            span = n.source(*m.span())
            if not any(near(kind, *span) for kind in KINDS):
                found.append(("phone", *span))
    known = _holder(plain)
    return [s for s in dict.fromkeys(found) if not known(*s)]


def _holder(spans: list[sp.Span]) -> Callable[[str, int, int], bool]:
    """Tells whether a span lies inside one of its kind; spans of a kind are in order and apart."""
    starts: dict[str, list[int]] = {kind: [] for kind in KINDS}
    ends: dict[str, list[int]] = {kind: [] for kind in KINDS}
    for kind, start, end in spans:
        starts[kind].append(start)
        ends[kind].append(end)

    def holds(kind: str, start: int, end: int) -> bool:
        k = bisect_right(starts[kind], start) - 1
        return k >= 0 and end <= ends[kind][k]

    return holds


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        base, every = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            plain = plain_spans(text)
            base.append(sp.as_rows(plain))
            every.append(sp.as_rows(sp.ordered([*plain, *disguised_spans(text, plain)], KINDS)))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(base, row), pa.array(every, row)], names=["row", "base", "every"])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` without their text, with `base_spans` (plain) and `spans` (plain and disguised).

    A null or empty text has no spans. Repeated rows are scanned alike. Columns of `docs` called base_spans or spans
    are replaced; others stay.
    """
    names = [name for name in docs.columns if name not in (text, "base_spans", "spans")]
    rows = small_batches(docs).select(packed(names), F.col(text).alias("text"))
    found = rows.mapInArrow(_scan, f"row {rows.schema['row'].dataType.simpleString()}, base {sp.SPANS}, every {sp.SPANS}")
    return found.select(*unpacked(names), F.col("base").alias("base_spans"), F.col("every").alias("spans"))
