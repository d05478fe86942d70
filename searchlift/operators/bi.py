"""Business rates: cleaning, means, and the exact, department, site cascade."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from searchlift.functions.numbers import half_up_div, mean_half_up, round_to_long
from searchlift.functions.text import category_l1, department, is_soft_department, normalise_label
from searchlift.schemas import HOST_MARKER, RATE, TICKET

# Site rates when there is no business data at all.
DEFAULT_CONVERSION = Decimal("0.002")
DEFAULT_TICKET = 80000

#: A page with one row in so many, or more, is hot.
HOT_SHARE = 64

# Department labels that are not departments.
JUNK_PREFIXES = ("sin_path", "http", "?")


def clean_bi(rows: DataFrame) -> DataFrame:
    """Usable rows of the business file: labels normalised, junk dropped, numbers as decimals.

    Any finite positive number is usable. One beyond the decimals (a rate of 10^12, a ticket of 10^18) is an error
    rather than a lost row.
    Input columns: dept, sub, tasa_conversion, ticket_promedio, ord (row order in the file).
    """
    infinite = F.lit(float("inf"))  # NaN sorts above it
    labelled = rows.select(
        normalise_label(F.col("dept")).alias("dept"),
        normalise_label(F.col("sub")).alias("sub"),
        "tasa_conversion",
        "ticket_promedio",
        "ord",
    )
    good = (F.col("dept") != "") & (F.col("sub") != "")
    for name in ("tasa_conversion", "ticket_promedio"):
        good = good & (F.col(name) > 0) & (F.col(name) < infinite)
    for prefix in JUNK_PREFIXES:
        good = good & ~F.startswith(F.col("dept"), F.lit(prefix))
    return labelled.where(good).select(
        "dept", "sub", F.col("tasa_conversion").cast(RATE).alias("conversion_rate"), F.col("ticket_promedio").cast(TICKET).alias("ticket"), "ord"
    )


def bi_sub(clean: DataFrame) -> DataFrame:
    """One row per (dept, sub): the last in file order, its ticket rounded."""
    return clean.groupBy("dept", "sub").agg(
        F.max_by("conversion_rate", "ord").alias("conversion_rate"),
        round_to_long(F.max_by("ticket", "ord")).alias("avg_ticket"),
    )


def _mean_rates():
    return (
        mean_half_up(F.col("conversion_rate"), 12, 12, wide=True).cast(RATE).alias("conversion_rate"),
        mean_half_up(F.col("ticket"), 6, 0, wide=True).cast("bigint").alias("avg_ticket"),
    )


def bi_dept(clean: DataFrame) -> DataFrame:
    """Mean rates per department over every usable row, repeated pairs included."""
    return clean.groupBy("dept").agg(*_mean_rates(), F.count("*").alias("n"))


def bi_site(clean: DataFrame) -> DataFrame:
    """One row: mean rates of the whole site, or the defaults without data."""
    means = clean.agg(*_mean_rates())
    return means.select(
        F.coalesce("conversion_rate", F.lit(DEFAULT_CONVERSION)).cast(RATE).alias("conversion_rate"),
        F.coalesce("avg_ticket", F.lit(DEFAULT_TICKET)).cast("bigint").alias("avg_ticket"),
    )


def with_taxonomy(df: DataFrame, url: str = "page_url", marker: str = HOST_MARKER) -> DataFrame:
    """Adds department and category read from the URL."""
    return df.withColumns(
        {"department": department(F.col(url), marker), "category_l1": category_l1(F.col(url), marker)}
    )


def seed_catalog(facts: DataFrame, marker: str = HOST_MARKER) -> DataFrame:
    """One catalog row per page of the facts, rates still empty."""
    pages = facts.select(F.col("page").alias("page_url")).distinct()
    return with_taxonomy(pages, marker=marker).select(
        "page_url",
        "department",
        "category_l1",
        F.lit(None).cast("boolean").alias("is_blando"),
        F.lit(None).cast(RATE).alias("conversion_rate"),
        F.lit(None).cast("bigint").alias("avg_ticket"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def reset_catalog(catalog: DataFrame, marker: str = HOST_MARKER) -> DataFrame:
    """Taxonomy recomputed for pages of the site, rates blanked for all pages."""
    ours = F.contains(F.col("page_url"), F.lit(marker))
    return catalog.withColumns(
        {
            "department": F.when(ours, department(F.col("page_url"), marker)).otherwise(F.col("department")),
            "category_l1": F.when(ours, category_l1(F.col("page_url"), marker)).otherwise(F.col("category_l1")),
            "conversion_rate": F.lit(None).cast(RATE),
            "avg_ticket": F.lit(None).cast("bigint"),
        }
    )


def _with_exact(df: DataFrame, pairs: DataFrame) -> DataFrame:
    lookup = pairs.select(
        F.col("dept").alias("department"),
        F.col("sub").alias("category_l1"),
        F.col("conversion_rate").alias("exact_rate"),
        F.col("avg_ticket").alias("exact_ticket"),
    )
    return df.join(lookup, ["department", "category_l1"], "left")


def _with_department(df: DataFrame, departments: DataFrame) -> DataFrame:
    lookup = departments.select(
        F.col("dept").alias("department"),
        F.col("conversion_rate").alias("department_rate"),
        F.col("avg_ticket").alias("department_ticket"),
    )
    return df.join(lookup, "department", "left")


def _with_site(df: DataFrame, site: DataFrame) -> DataFrame:
    """One row, read as scalar subqueries."""
    return df.withColumns(
        {
            "site_rate": site.select("conversion_rate").scalar(),
            "site_ticket": site.select("avg_ticket").scalar(),
        }
    )


def _resolve(df: DataFrame, tiers: tuple[str, ...]) -> DataFrame:
    """Rows without a rate take the first tier that has one; ``rate_source`` names it.

    The exact and department tiers also set softness; the site tier leaves it as it was.
    """
    open_row = F.col("conversion_rate").isNull()
    source, ticket = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for tier in reversed(tiers):
        found = F.col(f"{tier}_rate").isNotNull()
        source = F.when(found, tier).otherwise(source)
        ticket = F.when(found, F.col(f"{tier}_ticket")).otherwise(ticket)
    old_source = F.col("rate_source") if "rate_source" in df.columns else F.lit(None).cast("string")
    columns = {
        "conversion_rate": F.coalesce("conversion_rate", *[F.col(f"{tier}_rate") for tier in tiers]),
        "avg_ticket": F.when(open_row, F.coalesce(ticket, F.col("avg_ticket"))).otherwise(F.col("avg_ticket")),
        "rate_source": F.when(open_row, source).otherwise(old_source),
    }
    if "is_blando" in df.columns:
        sets_softness = open_row & source.isin("exact", "department")
        soft = is_soft_department(F.col("department"))
        columns["is_blando"] = F.when(sets_softness, soft).otherwise(F.col("is_blando"))
    spent = [f"{tier}_{part}" for tier in tiers for part in ("rate", "ticket")]
    return df.withColumns(columns).drop(*spent)


def fill_exact(catalog: DataFrame, pairs: DataFrame) -> DataFrame:
    """First tier: the rates of the row's own (department, category)."""
    return _resolve(_with_exact(catalog, pairs), ("exact",))


def fill_department(catalog: DataFrame, departments: DataFrame) -> DataFrame:
    """Second tier: the department's mean rates."""
    return _resolve(_with_department(catalog, departments), ("department",))


def fill_site(catalog: DataFrame, site: DataFrame) -> DataFrame:
    """Last tier: the site's mean rates."""
    return _resolve(_with_site(catalog, site), ("site",))


def cascade(catalog: DataFrame, clean: DataFrame) -> DataFrame:
    """The three tiers in order, in one pass over the catalog."""
    tiered = _with_department(_with_exact(catalog, bi_sub(clean)), bi_dept(clean))
    return _resolve(_with_site(tiered, bi_site(clean)), ("exact", "department", "site"))


def with_rates(gaps: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rates of a gap row from the catalog, by page URL.

    Pages that hold a HOT_SHARE of the rows or more get their rates from a broadcast, which has as many rows at most as
    shares make a whole; their rows are dealt by query. All other rows meet the catalog on the page.
    """
    rates = catalog.select("page_url", "conversion_rate", "avg_ticket")
    counts = gaps.where(F.col("page_url").isNotNull()).groupBy("page_url").agg(F.count("*").alias("n"))
    total = gaps.agg(F.count("*")).scalar()
    hot = counts.where(F.col("n") * HOT_SHARE >= total).select("page_url")
    known = hot.join(rates, "page_url", "left").select(F.col("page_url").alias("hot_url"), F.col("conversion_rate").alias("hot_rate"), F.col("avg_ticket").alias("hot_ticket"))
    flagged = gaps.join(F.broadcast(known), gaps["page_url"] == known["hot_url"], "left")
    # A key no page has, so that hot rows, and rows without a page, spread over all tasks.
    spread = F.concat(F.lit("\x00"), F.xxhash64("query").cast("string"))
    keyed = flagged.withColumn("rate_key", F.when(F.col("hot_url").isNull() & F.col("page_url").isNotNull(), F.col("page_url")).otherwise(spread))
    joined = keyed.join(rates.withColumnRenamed("page_url", "rate_key"), "rate_key", "left")
    cold = F.col("hot_url").isNull()
    return joined.withColumns(
        {
            "conversion_rate": F.when(cold, F.col("conversion_rate")).otherwise(F.col("hot_rate")),
            "avg_ticket": F.when(cold, F.col("avg_ticket")).otherwise(F.col("hot_ticket")),
        }
    ).drop("rate_key", "hot_url", "hot_rate", "hot_ticket")


def with_cascade_rates(gaps: DataFrame, clean: DataFrame, marker: str = HOST_MARKER) -> DataFrame:
    """The same rates worked out from the row's own URL.

    A freshly refreshed catalog is a function of the URL and the small business tables, so a run that
    holds them needs no join on page URLs, which would shuffle every gap row.
    """
    blank = with_taxonomy(gaps, marker=marker).withColumns(
        {"conversion_rate": F.lit(None).cast(RATE), "avg_ticket": F.lit(None).cast("bigint")}
    )
    return cascade(blank, clean).drop("department", "category_l1", "rate_source")


def bi_check(catalog: DataFrame, dept: str, top: int = 25) -> DataFrame:
    """The largest categories of a department with their mean rates."""
    n = F.count("*")
    ticket = half_up_div(F.sum("avg_ticket"), F.count("avg_ticket"))
    percent = mean_half_up(F.col("conversion_rate"), 12, 5, wide=True) * 100
    return (
        catalog.where((F.col("department") == dept) & (F.col("conversion_rate") > 0))
        .groupBy("category_l1")
        .agg(n.alias("urls"), percent.alias("conv_pct"), ticket.alias("ticket"))
        .orderBy(F.desc("urls"), "category_l1")
        .limit(top)
    )


def bi_coverage(catalog: DataFrame) -> DataFrame:
    """Rows per tier of the cascade."""
    return catalog.groupBy("rate_source").agg(F.count("*").alias("n"))
