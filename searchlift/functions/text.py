"""Labels, page URLs and brand patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from searchlift.schemas import HOST_MARKER

# The blanks that are trimmed, Unicode separators and the byte-order mark included.
BLANKS = (
    "\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Brand spellings that may stand anywhere in a query, and the one that must be a whole word.
BRAND_TERMS = (
    "paris", "pars", "paeis", "paaris", "pariw", "parus", "parid",
    "patis", "paros", "paria", "parís", "cenco", "almacen", "almacenes",
)
BRAND_WORD = "aris"

# Departments sold on taste rather than on specification.
SOFT_DEPARTMENTS = ("mujer", "hombre", "ninos", "zapatos", "belleza", "deportes", "outlet", "regalos")

# Fixed value: label of a page without a second path segment.
NO_SUBCATEGORY = "(sin subcategoría)"


def normalise_label(text: Column) -> Column:
    """Lowercase without surrounding blanks; null becomes the empty text."""
    return F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))


def path_segment(url: Column, n: int, marker: str = HOST_MARKER) -> Column:
    """The n-th path segment after the host marker; empty when the URL has none."""
    path = F.split_part(url, F.lit(marker), F.lit(2))
    return F.split_part(path, F.lit("/"), F.lit(n))


def department(url: Column, marker: str = HOST_MARKER) -> Column:
    return F.lower(path_segment(url, 1, marker))


def category_l1(url: Column, marker: str = HOST_MARKER) -> Column:
    return F.lower(path_segment(url, 2, marker))


def subcategory(url: Column, marker: str = HOST_MARKER) -> Column:
    """Display label of the second segment, in the case of the URL."""
    return F.coalesce(F.nullif(path_segment(url, 2, marker), F.lit("")), F.lit(NO_SUBCATEGORY))


def url_path(url: Column) -> Column:
    """URL without scheme, host and one trailing slash; ``/`` for the home page."""
    path = F.regexp_replace(F.regexp_replace(url, "^https?://[^/]+", ""), "/$", "")
    return F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))


def is_soft_department(name: Column) -> Column:
    return name.isin(*SOFT_DEPARTMENTS)


def _either_case(term: str) -> str:
    # (?i) folds ASCII only, so other letters are spelled in both cases.
    return "".join(c if c.isascii() else f"[{c.lower()}{c.upper()}]" for c in term)


def is_branded_regex(
    text: Column, terms: tuple[str, ...] = BRAND_TERMS, word: str | None = BRAND_WORD
) -> Column:
    """Whether the text holds a brand spelling anywhere, or ``word`` between ASCII word edges."""
    choices = [_either_case(t) for t in terms]
    starts = [t[0] for t in terms]
    if word:
        choices.append(f"(?<![A-Za-z0-9_]){_either_case(word)}(?![A-Za-z0-9_])")
        starts.append(word[0])
    # The look-ahead rejects most places of a long text on one letter, before any spelling is tried.
    letters = "".join(sorted({c for start in starts for c in (start.lower(), start.upper())}))
    return text.rlike(f"(?i)(?=[{letters}])(?:{'|'.join(choices)})")
