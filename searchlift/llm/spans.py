"""Spans of text in results: (kind, start, end) in code points, end exclusive."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]
SPANS = "array<struct<kind:string,start:long,end:long>>"


def ordered(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    rank = {kind: k for k, kind in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def as_rows(spans: Iterable[Span]) -> list[dict]:
    return [{"kind": kind, "start": start, "end": end} for kind, start, end in spans]


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order of the list."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: str, spans: Sequence[Span], mark: str) -> str:
    """The text with the union of the spans replaced, each run of touching spans by one mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            if start > at or not out:
                out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sha256_of(spans: Sequence[Span]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
