"""The opportunity list: filters, display rounding, order, pages and top lists."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from searchlift.functions.numbers import half_up_div, leading_integer, leading_number
from searchlift.functions.text import subcategory as subcategory_of
from searchlift.operators.dimensions import snapshot
from searchlift.operators.filters import active
from searchlift.schemas import HOST_MARKER, POSITION, POSITION_PLACES

# The columns a list may be sorted by, and the first of all orders.
SORT_KEYS = (
    "query", "avg_position", "delta_clicks", "ctr_actual",
    "ctr_expected", "revenue_final", "agency_factor", "opportunity_score",
)
DEFAULT_SORT = "opportunity_score"
#: What decides between rows of one date with equal sort values.
TIES = ("query", "page_url")

#: Rows that are sorted for a page, at most; marks that one round counts up to, and rows drawn for each.
SORTED_ROWS = 1000
RANGES, DRAWN = 40, 8

PERCENT = T.DecimalType(12, 2)


def by_factor(df: DataFrame, factor: str | None) -> DataFrame:
    return df.where(F.col("agency_factor") == factor) if factor else df


def by_max_position(df: DataFrame, max_pos: float | str | None) -> DataFrame:
    """Empty means no filter; of a text its leading number counts, and a text without one is refused."""
    if max_pos is None or max_pos == "":
        return df
    most = leading_number(max_pos)
    if most is None:
        raise ValueError(f"no number in {max_pos!r}")
    if most >= 10 ** (POSITION.precision - POSITION.scale):
        return df.where(F.col("avg_position").isNotNull())
    # Positions have so many places, so the bound may be cut to them; the column is compared as it is stored.
    bound = Decimal(repr(most)).quantize(Decimal(1).scaleb(-POSITION_PLACES), rounding=ROUND_FLOOR)
    return df.where(F.col("avg_position") <= F.lit(bound).cast(POSITION))


def by_min_revenue(df: DataFrame, min_revenue: int | str | None) -> DataFrame:
    """Empty and 0 mean no filter, so rows without revenue stay; of a text its leading whole number counts."""
    if min_revenue is None or str(min_revenue) in ("", "0"):
        return df
    least = leading_integer(min_revenue)
    if least is None:
        raise ValueError(f"no number in {min_revenue!r}")
    return df.where(F.col("revenue_final") >= least)


def by_subcategory(df: DataFrame, name: str | None, marker: str = HOST_MARKER) -> DataFrame:
    return df.where(subcategory_of(F.col("page_url"), marker) == F.lit(name)) if name else df


def matching(
    gaps: DataFrame,
    *,
    date=None,
    factor: str | None = None,
    max_pos: float | str | None = None,
    min_revenue: int | str | None = None,
    subcategory: str | None = None,
    marker: str = HOST_MARKER,
) -> DataFrame:
    """Active rows of a date, the newest by default, that pass every given filter."""
    rows = active(snapshot(gaps, date))
    rows = by_min_revenue(by_max_position(by_factor(rows, factor), max_pos), min_revenue)
    return by_subcategory(rows, subcategory, marker)


def displayed(gaps: DataFrame, *also: str) -> DataFrame:
    """The list's columns, and others asked for: positions at two decimals, CTRs in percent, score at one decimal, missing rates as 0."""
    score = F.round(F.col("opportunity_score"), 1).cast(T.DecimalType(6, 1))
    return gaps.select(
        "query",
        "page_url",
        F.round("avg_position", 2).cast(T.DecimalType(8, 2)).alias("avg_position"),
        "impressions",
        "delta_clicks",
        F.round(F.col("ctr_actual") * 100, 2).cast(PERCENT).alias("ctr_actual"),
        F.round(F.col("ctr_expected") * 100, 2).cast(PERCENT).alias("ctr_expected"),
        "revenue_final",
        "agency_factor",
        score.alias("opportunity_score"),
        F.coalesce("conversion_rate", F.lit(0)).cast("double").alias("conversion_rate"),
        F.coalesce("avg_ticket", F.lit(0)).cast("bigint").alias("avg_ticket"),
        *also,
    )


def sort_order(sort_key: str | None = None, sort_dir: str | None = None, ties: tuple[str, ...] = TIES) -> list[Column]:
    """Unknown keys sort by score, unknown directions downwards; nulls count as the largest value."""
    key = F.col(sort_key if sort_key in SORT_KEYS else DEFAULT_SORT)
    ascending = (sort_dir or "").upper() == "ASC"
    first = key.asc_nulls_last() if ascending else key.desc_nulls_first()
    return [first, *[F.col(name) for name in ties]]


def opportunities_sorted(gaps: DataFrame, sort_key=None, sort_dir=None, **filters) -> DataFrame:
    """Every matching row in display form and order."""
    return displayed(matching(gaps, **filters)).orderBy(*sort_order(sort_key, sort_dir))


def _is_beyond(rows: DataFrame, after: dict, sort_key=None, sort_dir=None, ties: tuple[str, ...] = TIES) -> Column:
    """Whether a displayed row follows the row ``after`` in list order."""
    name = sort_key if sort_key in SORT_KEYS else DEFAULT_SORT
    ascending = (sort_dir or "").upper() == "ASC"

    def value(column: str) -> Column:
        return F.lit(after[column]).cast(rows.schema[column].dataType)

    key, last = F.col(name), value(name)
    place, past = F.struct(*ties), F.struct(*[value(tie).alias(tie) for tie in ties])
    farther = key > last if ascending else key < last
    if after[name] is None:  # nulls are the largest value: first downwards, last upwards
        return (key.isNull() & (place > past)) | (F.lit(not ascending) & key.isNotNull())
    return F.coalesce(farther, F.lit(ascending)) | (F.coalesce(key == last, F.lit(False)) & (place > past))


def beyond(rows: DataFrame, after: dict, sort_key=None, sort_dir=None) -> DataFrame:
    """Displayed rows that follow the row ``after`` (its sort column, query and page_url) in list order."""
    return rows.where(_is_beyond(rows, after, sort_key, sort_dir))


def page_by_count(
    rows: DataFrame, *, sort_key=None, sort_dir=None, page: int | None = None, page_size: int = 10, ties: tuple[str, ...] = TIES
) -> DataFrame:
    """A page of displayed rows, the last one by default, found by counting instead of sorting what comes before it.

    Each round counts the rows up to some marks, rows of a sample in list order, and keeps the stretch between two marks
    that holds the page; when it is short it is sorted. A round costs two passes and shortens the stretch by about
    RANGES, so the cost hardly depends on where the page stands. ``ties`` make the order of rows unique.
    """
    order = sort_order(sort_key, sort_dir, ties)
    left, passed, turn = rows.count(), 0, 0
    start = ((left - 1) // page_size if page is None else page - 1) * page_size if left else 0
    while left > SORTED_ROWS:
        drawn = rows.where(F.pmod(F.xxhash64(F.lit(turn), *ties), F.lit(left)) < RANGES * DRAWN)
        marks = [r.asDict() for r in drawn.orderBy(*order).collect()][DRAWN - 1 :: DRAWN]
        if not marks:
            break
        up_to = list(rows.agg(*[F.count_if(~_is_beyond(rows, m, sort_key, sort_dir, ties)).alias(f"n{k}") for k, m in enumerate(marks)]).first())
        first = bisect_right(up_to, start - passed)
        last = bisect_left(up_to, start - passed + page_size)
        begin, end = up_to[first - 1] if first else 0, up_to[last] if last < len(marks) else left
        if end - begin >= left:
            break
        if first:
            rows = rows.where(_is_beyond(rows, marks[first - 1], sort_key, sort_dir, ties))
        if last < len(marks):
            rows = rows.where(~_is_beyond(rows, marks[last], sort_key, sort_dir, ties))
        left, passed, turn = end - begin, passed + begin, turn + 1
    return rows.orderBy(*order).offset(start - passed).limit(page_size)


def opportunities(
    gaps: DataFrame, *, sort_key=None, sort_dir=None, page: int = 1, page_size: int = 10, after: dict | None = None, **filters
) -> DataFrame:
    """One page of the matching rows.

    A page by number costs its offset up to SORTED_ROWS, and is found by counting beyond. ``after``, the last row seen,
    asks for the rows behind it at the cost of one page.
    """
    rows = displayed(matching(gaps, **filters))
    if after is not None:
        return beyond(rows, after, sort_key, sort_dir).orderBy(*sort_order(sort_key, sort_dir)).limit(page_size)
    if page * page_size > SORTED_ROWS:
        return page_by_count(rows, sort_key=sort_key, sort_dir=sort_dir, page=page, page_size=page_size)
    return rows.orderBy(*sort_order(sort_key, sort_dir)).offset((page - 1) * page_size).limit(page_size)


def opportunities_total(gaps: DataFrame, **filters) -> DataFrame:
    """Number of matching rows."""
    return matching(gaps, **filters).agg(F.count("*").alias("total"))


def subcategories(gaps: DataFrame, marker: str = HOST_MARKER) -> DataFrame:
    """Subcategories of the newest date's active rows, sorted."""
    label = subcategory_of(F.col("page_url"), marker).alias("subcategory")
    return active(snapshot(gaps)).select(label).distinct().orderBy("subcategory")


def with_index(page_rows: DataFrame, order: list[Column], start: int = 1) -> DataFrame:
    """Numbers the rows of one page from ``start``; the window sees the page only."""
    return page_rows.withColumn("row_index", F.row_number().over(Window.orderBy(*order)) + (start - 1))


def page_opportunities(
    gaps: DataFrame, *, sort_key=None, sort_dir=None, page: int = 1, page_size: int = 10, **filters
) -> DataFrame:
    """One page with absolute row numbers and where it stands in the whole list."""
    start = (page - 1) * page_size + 1
    order = sort_order(sort_key, sort_dir)
    rows = opportunities(
        gaps, sort_key=sort_key, sort_dir=sort_dir, page=page, page_size=page_size, **filters
    )
    total = opportunities_total(gaps, **filters).scalar()
    return with_index(rows, order, start).withColumns(
        {
            "start_row": F.lit(start),
            "end_row": F.least(F.lit(page * page_size), total),
            "total": total,
            "total_pages": F.ceil(total / page_size),
        }
    )


def top_n(rows: DataFrame, n: int) -> DataFrame:
    """The n rows with the largest revenue, of whatever frame is given: a page or the whole list."""
    order = [F.col("revenue_final").desc_nulls_last(), F.col("query"), F.col("page_url")]
    return with_index(rows.orderBy(*order).limit(n), order)


def share_of_max(top: DataFrame) -> DataFrame:
    """Adds revenue as a whole percent of the largest in the frame; a largest of 0 counts as 1."""
    best = top.select(F.max("revenue_final")).scalar()
    base = F.when(best != 0, best).otherwise(F.lit(1))
    return top.withColumn("share_pct", half_up_div(F.col("revenue_final") * 100, base))


def in_thousands(top: DataFrame) -> DataFrame:
    return top.withColumn("revenue_k", half_up_div(F.col("revenue_final"), F.lit(1000)))


def export_list(gaps: DataFrame, sort_key=None, sort_dir=None, **filters) -> DataFrame:
    """Matching rows in list order under the export's headers; written, the parts by name hold them in this order."""
    return export_frame(opportunities_sorted(gaps, sort_key, sort_dir, **filters))


def export_frame(rows: DataFrame) -> DataFrame:
    """Displayed rows under the export's headers, positions at two decimals, CTRs with a percent sign."""

    def percent(name):
        return F.concat(F.col(name).cast("string"), F.lit("%"))

    return rows.select(
        F.col("query").alias("keyword"),
        F.col("page_url").alias("url"),
        F.col("avg_position").cast(T.DecimalType(8, 2)).cast("string").alias("posicion"),
        F.col("delta_clicks").alias("delta_clics"),
        percent("ctr_actual").alias("ctr_real"),
        percent("ctr_expected").alias("ctr_esperado"),
        F.col("revenue_final").alias("revenue_clp"),
        F.col("agency_factor").alias("agency_factor"),
        F.col("opportunity_score").cast("string").alias("score"),
    )
