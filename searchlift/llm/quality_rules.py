"""Quality rules: one table of thresholds compiled into one Spark projection, without user functions.

The measures of a text are columns made of built-in functions; a rule is a row of RULES that bounds one measure from
below or above. `judged` turns the table into one boolean column and a list of the rules that a text breaks.

Repeated passages are found inside the row: every window of 8 words becomes a 64-bit hash, hashes are sorted with
their places, equal neighbours mark places, and the places are folded into the count of words they cover. Only texts
that hold an equal pair of windows are sorted at all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
BULLETS = ("-", "*", "•")

# Frequent function words of English, German, French and Spanish, as they stand inside and at the start of a line.
STOP_WORDS = (
    "the of and to in that is for it as was with be by on not this are from or have an they which you were all "
    "der die das und ist nicht ein eine zu den mit von für auf im dem des sich als auch werden "
    "le la les et de un une est que qui dans pour pas sur au avec ce il par plus "
    "el los las y del en con para su al lo como más o no"
).split()


@dataclass(frozen=True)
class Rule:
    """Keeps a text whose measure lies within [least, most]; a bound of None doesn't hold."""

    name: str
    measure: Callable[[dict[str, Column]], Column]
    least: float | None = None
    most: float | None = None

    def broken(self, of: dict[str, Column]) -> Column:
        value = self.measure(of)
        parts = [value < self.least] if self.least is not None else []
        parts += [value > self.most] if self.most is not None else []
        return F.coalesce(parts[0] if len(parts) == 1 else parts[0] | parts[1], F.lit(False))


def _share(part: str, whole: str) -> Callable[[dict[str, Column]], Column]:
    return lambda of: F.try_divide(of[part], of[whole])


BASE_RULES = (
    Rule("words", lambda of: of["n_words"], least=20),
    Rule("repeated_words", lambda of: 100 * of["n_repeat_words"] - 30 * of["n_words"], most=0),
)
RULES = (
    *BASE_RULES,
    Rule("word_length", _share("word_chars", "n_words"), least=3, most=10),
    Rule("symbols", _share("n_symbols", "n_words"), most=0.1),
    Rule("stop_words", lambda of: of["n_stop_words"], least=2),
    Rule("repeated_lines", _share("n_dup_lines", "n_lines"), most=0.5),
    Rule("bullet_lines", _share("n_bullet_lines", "n_lines"), most=0.9),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def _windows(words: Column) -> Column:
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    last = F.size(words) - WINDOW_WORDS + 1
    return F.when(
        last >= 1, _let(hashes, lambda h: F.transform(F.sequence(F.lit(1), last), lambda k: F.xxhash64(F.slice(h, k, WINDOW_WORDS))))
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words inside windows that stand in the text twice or more."""

    def places(rows: Column) -> Column:
        def twin(row: Column, k: Column) -> Column:
            return (F.get(rows, k - 1)["h"] == row["h"]) | (F.get(rows, k + 1)["h"] == row["h"])

        return F.transform(F.filter(rows, lambda row, k: F.coalesce(twin(row, k), F.lit(False))), lambda row: row["k"])

    in_order = F.array_sort(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    start = F.struct(F.lit(-WINDOW_WORDS).alias("at"), F.lit(0).cast("bigint").alias("sum"))
    return F.aggregate(
        F.sort_array(_let(in_order, places)),
        start,
        lambda state, at: F.struct(at.alias("at"), (state["sum"] + F.least(F.lit(WINDOW_WORDS), at - state["at"])).alias("sum")),
        lambda state: state["sum"],
    )


def _measures(body: Column) -> Column:
    """All measures of a text in one struct; its words, windows and lines are each made once."""
    stops = F.array(*map(F.lit, dict.fromkeys([*STOP_WORDS, *map(str.capitalize, STOP_WORDS)])))

    def of(text: Column, words: Column, lines: Column, windows: Column) -> Column:
        repeated = F.size(F.array_distinct(windows)) < F.size(windows)
        measures = {
            "n_words": F.size(words),
            "word_chars": F.length(F.translate(text, SPACES, "")),
            "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_bullet_lines": F.size(F.filter(lines, lambda line: F.substring(F.ltrim(line), 1, 1).isin(*BULLETS))),
            "n_repeat_words": F.when(repeated, _covered(windows)).otherwise(F.lit(0)),
            "n_stop_words": F.size(F.array_intersect(words, stops)),
        }
        return F.struct(*[column.cast("bigint").alias(name) for name, column in measures.items()])

    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    parts = F.struct(body.alias("text"), _words(body).alias("words"), lines.alias("lines"))
    return _let(parts, lambda p: _let(_windows(p["words"]), lambda windows: of(p["text"], p["words"], p["lines"], windows)))


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_bullet_lines", "n_repeat_words", "n_stop_words",
)


def _verdict(measures: Column, rules: tuple[Rule, ...]) -> Column:
    of = {name: measures[name] for name in MEASURES}
    any_of = lambda rows: F.greatest(*[rule.broken(of) for rule in rows])
    names = F.filter(F.array(*[F.when(rule.broken(of), F.lit(rule.name)) for rule in rules]), lambda n: n.isNotNull())
    return F.struct(any_of(BASE_RULES).alias("base_failed"), (~any_of(rules)).alias("kept"), names.alias("broken"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with the measures of their text; a null text counts as an empty one.

    Measures go into one struct column `measures`, so that columns of `docs` may bear any other name.
    """
    return docs.withColumn("measures", _measures(F.coalesce(F.col(text), F.lit(""))))


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` with struct columns `measures` and `verdict(base_failed, kept, broken)`.

    A null or empty text has no words and fails. Repeated rows are judged alike and all stay. `docs` may have any
    columns besides `measures` and `verdict`, which are replaced.
    """
    return measured(docs, text).withColumn("verdict", _verdict(F.col("measures"), rules))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text breaks no rule, with the columns they came with.

    The condition binds the measures where it uses them, since a filter is moved below the columns it is made of and
    would work them out again for every rule.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.where(_let(_measures(body), lambda m: _verdict(m, rules)["kept"]))
