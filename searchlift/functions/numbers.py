"""Exact arithmetic: every rounding is half up on integers or decimals, never on doubles."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from searchlift.functions.text import BLANKS

WIDE = T.DecimalType(24, 0)

# The longest numeric prefix of a text, as a lenient float parser reads it.
_NUMBER = r"^[+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def floor_div(numerator: Column, denominator: Column) -> Column:
    """Integer quotient (BIGINT) of non-negative integers or decimals, without a detour through doubles."""
    return F.call_function("div", numerator, denominator)


def half_up_div(numerator: Column, denominator: Column) -> Column:
    """round(numerator / denominator) to an integer, half up, for a non-negative numerator."""
    return floor_div(numerator * 2 + denominator, denominator * 2)


def wide_half_up_div(numerator: Column, denominator: Column) -> Column:
    """``half_up_div`` as DECIMAL(24,0), for quotients beyond BIGINT."""
    twice, base = numerator * 2 + denominator, denominator * 2
    return ((twice - twice % base) / base).cast(WIDE)


def from_units(units: Column, scale: int) -> Column:
    """An integer count of 10^-scale units as a decimal."""
    return units.cast(WIDE) * F.lit(Decimal(1).scaleb(-scale))


def to_units(value: Column, scale: int, wide: bool = False) -> Column:
    """A decimal of at most ``scale`` places as an integer count of 10^-scale units."""
    scaled = value * F.lit(Decimal(10**scale))
    return scaled.cast(WIDE if wide else "bigint")


def mean_half_up(value: Column, scale_in: int, scale_out: int, wide: bool = False) -> Column:
    """Aggregate: mean of a non-negative decimal column rounded half up; null over no values.

    Positions sum as BIGINT; rates and tickets of any size (``wide``) sum as decimals.
    """
    n = F.count(value)
    shrink = n.cast(T.DecimalType(19, 0) if wide else "bigint") * F.lit(10 ** (scale_in - scale_out)).cast("bigint")
    total = F.sum(to_units(value, scale_in, wide))
    mean = wide_half_up_div(total, shrink.cast(WIDE)) if wide else half_up_div(total, shrink)
    return F.when(n > 0, from_units(mean, scale_out))


def round_to_long(value: Column) -> Column:
    """Decimal rounded half away from zero, as BIGINT."""
    return F.round(value, 0).cast("bigint")


def loose_number(text: Column) -> Column:
    """The leading number of a text (``12abc`` is 12, ``0,005`` is 0); 0 where there is none."""
    prefix = F.regexp_extract(F.ltrim(text, F.lit(BLANKS)), _NUMBER, 0)
    return F.coalesce(F.nullif(prefix, F.lit("")).try_cast("double"), F.lit(0.0))


def leading_number(value: float | str | None) -> float | None:
    """The number a lenient parser reads at the start of an argument; None where there is none."""
    found = re.match(_NUMBER, str("" if value is None else value).strip())
    return float(found.group().replace("Infinity", "inf")) if found else None


def leading_integer(value: float | str | None) -> int | None:
    """The whole number at the start of an argument (``1000.5`` and ``1000e3`` are 1000); None where there is none."""
    found = re.match(r"[+-]?[0-9]+", str("" if value is None else value).strip())
    return int(found.group()) if found else None
