"""Secret scans: known shapes, and strings that a battery of randomness tests tells from written text.

Known shapes (kinds assign, access and hex) are regular expressions and always reported. Besides, every run of 16 or
more letters, digits, +, /, - and _ is tested, and so is every part of 16 or more characters that ends at some of these
signs, since a sign may belong to a token or stand beside it. Its encoding is inferred (the smallest of hex, base32,
base36, base62, base64 and base64url that holds its characters) and must not contradict an even use of that alphabet
in any of three tests: chi-squared of the symbol counts, Wald-Wolfowitz runs about the alphabet's middle, and lag-1
serial correlation (all within GATE standard deviations). A finding inside a whole run that is found is left out.

What passes gets a p-value under "this is written text", by the same three views: written text repeats letters (few
coincidences of symbols are unlikely), seldom changes between letters, capitals and digits (many changes are unlikely)
and alternates vowels and consonants (few alternations are unlikely). Fisher's method joins them. All tested runs of
the corpus, sorted into classes by length, then go through Benjamini-Hochberg: within a class the share of false
findings stays below FALSE_SHARE. P-values are rounded up to steps of 10^(1/8), so a class is a table of STEPS counts,
whatever the size of the corpus; these tables alone reach the driver.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchlift.llm import spans as sp
from searchlift.llm.tables import packed, small_batches, stored, unpacked

KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

# Fixed patterns. A run of [0-9a-f]+ of 16 characters or more is the same as [0-9a-f]{16,}: both take whole runs.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
TESTED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_PARTS = [re.compile(rf"(?<![{chars}])[{chars}]{{16,}}={{0,2}}") for chars in ("A-Za-z0-9+/", "A-Za-z0-9_-", "A-Za-z0-9")]
_SIGNS = re.compile("[+/_-]")

#: Standard deviations within which a random string must stay in each test.
GATE = 4.0
FALSE_SHARE = 0.01
#: Lengths at which a new class begins.
LENGTH_CLASSES = (16, 24, 32, 48)
STEPS = 400

#: Chance that two letters of written text are equal, that neighbours differ in kind, that neighbouring letters alternate.
SAME, CHANGE, ALTERNATE = 0.07, 0.1, 0.6

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HEX, _BASE32, _BASE36 = _DIGITS + "abcdef", _UPPER + "234567", _DIGITS + _LOWER
_BASE62 = _UPPER + _LOWER + _DIGITS
#: From the smallest.
_ALPHABETS = (_HEX, _HEX.upper(), _BASE32, _BASE32.lower(), _BASE36, _BASE36.upper(), _BASE62, _BASE62 + "+/", _BASE62 + "-_")
_PLACES = [(a, {c: k for k, c in enumerate(a)}) for a in _ALPHABETS]


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _log_poisson(mean: float, k: int) -> float:
    if k < 1000:
        return k * math.log(mean) - mean - math.lgamma(k + 1)
    # Stirling's form: large numbers of nearly equal size are not subtracted.
    return k * math.log1p((mean - k) / k) + k - mean - math.log(2 * math.pi * k) / 2 - 1 / (12 * k)


def _summed(log: float, up: Iterable[float], down: Iterable[float]) -> float:
    """The sum of terms from the largest one on to both sides, by their ratios; it ends where terms vanish."""
    total = 1.0
    for ratios in (up, down):
        term = 1.0
        for ratio in ratios:
            term *= ratio
            total += term
            if term < 1e-18:
                break
    return min(1.0, math.exp(log) * total) if log > -700 else 0.0


def _binomial_tail(n: int, p: float, least: int) -> float:
    """Chance of `least` or more successes."""
    if least <= 0:
        return 1.0
    if least > n:
        return 0.0
    top = min(n, max(least, int((n + 1) * p)))
    odds = p / (1 - p)
    log = _log_choose(n, top) + top * math.log(p) + (n - top) * math.log1p(-p)
    return _summed(log, ((n - k) / (k + 1) * odds for k in range(top, n)), (k / (n - k + 1) / odds for k in range(top, least, -1)))


def _poisson_lower(mean: float, most: int) -> float:
    """Chance of `most` or fewer."""
    top = min(most, int(mean))
    return _summed(_log_poisson(mean, top), (mean / (k + 1) for k in range(top, most)), (k / mean for k in range(top, 0, -1)))


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else ""


def looks_random(body: str) -> bool:
    """Whether an even use of the inferred alphabet stands up to the three tests."""
    used = set(body)
    alphabet, place = next(((a, p) for a, p in _PLACES if used <= p.keys()), ("", {}))
    if not alphabet:
        return False
    n, k = len(body), len(alphabet)
    index = [place[c] for c in body]
    chi = k / n * sum(v * v for v in Counter(index).values()) - n
    if abs(chi - (k - 1)) > GATE * math.sqrt(2 * (k - 1)):
        return False
    high = [i >= k // 2 for i in index]
    n1 = sum(high)
    n0 = n - n1
    if not n0 or not n1:
        return False
    mean = 2 * n0 * n1 / n + 1
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    if abs(1 + sum(a != b for a, b in zip(high, high[1:])) - mean) > GATE * spread:
        return False
    middle = sum(index) / n
    variance = sum((i - middle) ** 2 for i in index)
    serial = sum((a - middle) * (b - middle) for a, b in zip(index, index[1:])) / variance
    return abs(serial) * math.sqrt(n) <= GATE


def written_p(body: str) -> float:
    """Fisher's joint p-value of the three tests under written text."""
    n = len(body)
    same = sum(v * (v - 1) // 2 for v in Counter(body.lower()).values())
    kinds = [_kind(c) for c in body]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]) if a and b)
    vowels = ["v" if c in "aeiouy" else "c" for c in body.lower()]
    letters = sum(x.isalpha() and y.isalpha() for x, y in zip(body, body[1:]))
    alternate = sum(a != b for a, b, x, y in zip(vowels, vowels[1:], body, body[1:]) if x.isalpha() and y.isalpha())
    parts = (
        _poisson_lower(SAME * n * (n - 1) / 2, same),
        _binomial_tail(n - 1, CHANGE, changes),
        _binomial_tail(letters, 1 - ALTERNATE, letters - alternate),
    )
    half = -sum(math.log(max(p, 1e-300)) for p in parts)
    return min(1.0, math.exp(-half) * (1 + half + half * half / 2))


def step_of(p: float) -> int:
    """The p-value rounded up to 10^(-step/8), as its step."""
    return min(STEPS, max(0, math.floor(-8 * math.log10(max(p, 1e-300)))))


def base_spans(text: str) -> list[sp.Span]:
    found: list[sp.Span] = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sp.ordered(found, KINDS)


def _candidates(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A run and its parts, as far as one alphabet may hold them."""
    found = {(start, end)}
    if _SIGNS.search(text, start, end):
        found.update(m.span() for part in _PARTS for m in part.finditer(text, start, end))
        if re.search("[+/]", text[start:end]) and re.search("[_-]", text[start:end]):
            found.discard((start, end))
    return sorted(found)


def tested_runs(text: str, base: list[sp.Span]) -> list[dict]:
    """Runs outside the known shapes with their length class and p-value step (none where an even use is ruled out).

    `outer` is the place of the run that a part belongs to; a whole run has none.
    """
    out = []
    starts = [a for _, a, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # the farthest end of this span and those before it
    for m in TESTED.finditer(text):
        for start, end in _candidates(text, *m.span()):
            before = bisect_left(starts, end)
            if before and reach[before - 1] > start:
                continue
            body = text[start:end].rstrip("=")
            kind = max(k for k, least in enumerate(LENGTH_CLASSES) if len(body) >= least)
            step = step_of(written_p(body)) if looks_random(body) else None
            out.append({"start": start, "end": end, "class": kind, "step": step, "outer": None if (start, end) == m.span() else m.start()})
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    run = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("class", pa.int32()), ("step", pa.int32()), ("outer", pa.int64())]))
    for batch in batches:
        base, runs = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            known = base_spans(text)
            base.append(sp.as_rows(known))
            runs.append(tested_runs(text, known))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(base, row), pa.array(runs, run)], names=["row", "base", "runs"])


def _thresholds(scanned: DataFrame) -> dict[int, int]:
    """For each length class the least step that Benjamini-Hochberg lets pass; classes without one are left out."""
    runs = scanned.select(F.explode("runs").alias("r")).groupBy(F.col("r.class").alias("class"), F.coalesce("r.step", F.lit(0)).alias("step"))
    table = runs.agg(F.count("*").alias("n")).collect()  # at most 4 classes x 401 steps
    least = {}
    for kind in {r["class"] for r in table}:
        counts = {r["step"]: r["n"] for r in table if r["class"] == kind}
        total, seen = sum(counts.values()), 0
        for step in sorted(counts, reverse=True):
            seen += counts[step]
            if step and 10 ** (-step / 8) <= FALSE_SHARE * seen / total:
                least[kind] = step
    return least


def _rows(docs: DataFrame, names: list[str], text: str) -> tuple[DataFrame, str]:
    rows = small_batches(docs).select(packed(names), F.col(text).alias("text"))
    return rows, f"row {rows.schema['row'].dataType.simpleString()}"


_FOUND = f"base {sp.SPANS}, runs array<struct<start:long,end:long,class:int,step:int,outer:long>>"


def redact_secrets(docs: DataFrame, mark: str, text: str = "text") -> DataFrame:
    """The rows of `docs` with `mark` in place of every span that scan_secrets finds; a null text stays null.

    Texts are read twice, first for the thresholds, and not kept in between.
    """
    names = [n for n in docs.columns if n != text]
    least = _thresholds(_rows(docs, [], text)[0].mapInArrow(_scan, f"row struct<end:int>, {_FOUND}"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column("text").to_pylist():
                found = base_spans(value or "")
                runs = tested_runs(value or "", found)
                found += [("random", r["start"], r["end"]) for r in runs if r["step"] is not None and r["step"] >= least.get(r["class"], STEPS + 1)]
                texts.append(sp.redacted(value, found, mark) if found else value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows, kind = _rows(docs, names, text)
    done = rows.mapInArrow(cut, f"{kind}, text string")
    return done.select(*unpacked(names), F.col("text").alias(text)).select(*[f"`{n}`" for n in docs.columns])


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with `base_spans` and `spans` (base and random ones), lists of (kind, start, end).

    A null or empty text has no spans. Repeated rows are scanned alike, and each counts as tested. Columns of `docs`
    called base_spans or spans are replaced; others stay.
    """
    kept = [name for name in docs.columns if name not in ("base_spans", "spans")]
    rows, kind = _rows(docs, [n for n in kept if n != text], text)
    scanned = stored(rows.mapInArrow(_scan, f"{kind}, {_FOUND}"), "secrets")
    least = _thresholds(scanned)
    limit = F.lit(None).cast("int")
    if least:
        limit = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])

    def flagged(run: Column) -> Column:
        return F.coalesce(run["step"] >= (limit[run["class"]] if least else limit), F.lit(False))

    whole = F.transform(F.filter("flagged", lambda r: r["outer"].isNull()), lambda r: r["start"])
    alone = F.filter("flagged", lambda r: r["outer"].isNull() | ~F.array_contains("whole", r["outer"]))
    scanned = scanned.withColumn("flagged", F.filter("runs", flagged)).withColumn("whole", whole)
    random = F.transform(alone, lambda r: F.struct(F.lit("random").alias("kind"), r["start"].alias("start"), r["end"].alias("end")))
    order = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])

    def compare(a: Column, b: Column) -> Column:
        one = a["start"] * len(KINDS) + order[a["kind"]]
        other = b["start"] * len(KINDS) + order[b["kind"]]
        return F.when(one < other, -1).when(one > other, 1).otherwise(0)

    every = F.array_sort(F.concat("base", random), compare)
    names = [n for n in kept if n != text]
    found = scanned.select("row", "base", every.alias("every"))  # on its own, where no other column bears these names
    return found.select(*unpacked(names), F.col("base").alias("base_spans"), F.col("every").alias("spans"))
