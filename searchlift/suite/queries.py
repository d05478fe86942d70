"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from searchlift.functions import numbers as N
from searchlift.functions import scoring as S
from searchlift.functions import text as X
from searchlift.functions import tracking as K
from searchlift.operators import bi, filters, gaps as G, kpis as KP, opportunities as O, watchlist as W, whatif as WI
from searchlift.operators import branding, ctr_curve, dimensions as D
from searchlift.plans import catalog as C
from searchlift.plans import scoring as P
from searchlift.schemas import CATALOG, FACT_KEYS, FACTORS, FACTS, GAPS
from searchlift.session import scratch_folder
from searchlift.sources import bucketed, readers, store
from searchlift.streaming import incremental
from searchlift.suite.fixtures import AS_OF, HOME, NOW, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def edge(df: DataFrame) -> DataFrame:
    """Output types both engines share: BIGINT, DOUBLE, DATE and VARCHAR."""

    def cast(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint")
        if isinstance(field.dataType, T.BooleanType):
            return column.cast("string")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column

    return df.select(*[cast(f).alias(f.name) for f in df.schema.fields])


def register(key: str):
    def wrap(build: Callable[[Inputs], DataFrame]):
        QUERIES[key] = lambda spark, folder: edge(build(Inputs(spark, folder)))
        return build

    return wrap


# Shared frames


def facts(i: Inputs) -> DataFrame:
    return i.view("fx_fine")


def kept(i: Inputs) -> DataFrame:
    return filters.ingest_filter(facts(i))


def clean(i: Inputs) -> DataFrame:
    return bi.clean_bi(i.view("fx_bi"))


def dims(i: Inputs) -> P.Dimensions:
    return P.Dimensions(
        curve=i.view("fx_ctr_curve"),
        params=i.view("fx_params"),
        terms=i.view("fx_branded"),
        business=clean(i),
    )


def raw(i: Inputs) -> DataFrame:
    """The month up to the raw score, one lazy plan: filters and column choice reach the facts."""
    return P.score_raw(kept(i), dims(i))


_STORED: dict[tuple[str, str], str] = {}


def scored(i: Inputs) -> DataFrame:
    """The stored table of scored gaps, as the daily job leaves it: written once in a session, then only read."""
    key = (i.spark.sparkContext.applicationId, i.folder)
    if key not in _STORED:
        path = scratch_folder(i.spark, "gaps")
        done = P.score_day(facts(i), dims(i), stage=scratch_folder(i.spark, "stage"), gather=True)
        store.write_days(done, path, gather=False)
        _STORED[key] = path
    return store.read_table(i.spark, _STORED[key], GAPS)


def catalog(i: Inputs) -> DataFrame:
    return bi.seed_catalog(facts(i))


def priced_catalog(i: Inputs) -> DataFrame:
    return C.refresh_catalog(catalog(i), i.view("fx_bi"), NOW)


def diagnosed(i: Inputs) -> DataFrame:
    return G.classify(G.diagnose(G.seed_rows(kept(i)), i.view("fx_ctr_curve"), i.view("fx_branded")))


def best_raw(i: Inputs, rows: DataFrame) -> DataFrame:
    return WI.max_raw_score(rows, i.view("fx_params"))


def projected(i: Inputs, rows: DataFrame, **options) -> DataFrame:
    return WI.what_if(rows, i.view("fx_params"), i.view("fx_ctr_curve"), best_raw(i, scored(i)), **options)


def projected_daily(i: Inputs, rows: DataFrame, **options) -> DataFrame:
    """The what-if of every date, each held against its own best."""
    best = WI.max_raw_scores(scored(i), i.view("fx_params"))
    return WI.what_if(rows, i.view("fx_params"), i.view("fx_ctr_curve"), best, **options)


def calibrated(i: Inputs) -> DataFrame:
    return ctr_curve.calibrate_curve(facts(i), scratch_folder(i.spark, "ctr"))


def land(rows: DataFrame, folder: str) -> None:
    """Writes facts as landed day files."""
    rows.select(
        F.array("query", "page").alias("keys"),
        "clicks",
        "impressions",
        F.col("ctr").cast("double").alias("ctr"),
        F.col("position").cast("double").alias("position"),
        "date",
    ).write.mode("append").partitionBy("date").json(folder)


GAP_OUT = [f.name for f in GAPS.fields if f.name != "raw_score"]
CATALOG_OUT = ["page_url", "department", "category_l1", "conversion_rate", "avg_ticket"]


# Sources, sinks and table maintenance


@register("scan_search_facts")
def _(i):
    folder = scratch_folder(i.spark, "landing")
    land(facts(i), folder)
    return readers.read_search_facts(i.spark, folder).drop("landing_order")


@register("scan_section")
def _(i):
    return filters.in_section(facts(i), ".cl/small/")


@register("scan_bi_csv")
def _(i):
    folder = scratch_folder(i.spark, "bi")
    one, two, rate, ticket = readers.BI_COLUMNS
    named = i.view("fx_bi").select("dept", "sub", "tasa_conversion", "ticket_promedio").toDF(one, two, rate, ticket)
    moved = named.select(F.lit("7").alias("extra"), f"`{ticket}`", f"`{two}`", f"`{one}`", f"`{rate}`")
    moved.write.option("header", True).csv(folder)
    rows = readers.read_bi(i.spark, folder).drop("ord")
    return rows.withColumns({c: X.normalise_label(F.col(c)) for c in ("dept", "sub")})


def _updates(i):
    """The second half of the month landed again, twice, and once more as the days after it."""
    again = kept(i).where(F.col("date") >= F.lit("2024-01-15"))
    first = again.withColumns({"clicks": F.col("clicks") + 1, "ord": F.lit(0)})
    second = again.withColumns({"clicks": F.col("clicks") + 2, "ord": F.lit(1)})
    later = again.withColumns({"date": F.date_add("date", 28), "ord": F.lit(0)})
    return first.unionByName(second).unionByName(later)


@register("upsert_facts")
def _(i):
    fresh = store.stage_updates(_updates(i), FACT_KEYS, "ord", scratch_folder(i.spark, "updates"))
    return store.put(kept(i), fresh, FACT_KEYS)


@register("upsert_facts_bucketed")
def _(i):
    """The same in a table whose days lie in buckets of keys."""
    name, path = f"facts_{uuid.uuid4().hex}", scratch_folder(i.spark, "bucketed")
    bucketed.create_facts_table(i.spark, name, path, int(i.spark.conf.get("spark.sql.shuffle.partitions")))
    bucketed.write_bucketed(kept(i), name)
    bucketed.upsert_table(i.spark, name, _updates(i), "ord")
    i.spark.sql(f"DROP TABLE {name}")  # the folder stays
    return store.read_table(i.spark, path, FACTS)


def _twice(i):
    """Every kept fact landed twice, the later copy behind the first in the same file; a day lies in many files."""
    rows = kept(i)
    copies = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("clicks", F.col("clicks") + F.col("copy"))
    return copies.repartition(*FACT_KEYS).sortWithinPartitions("date", "copy", "query", "page")


@register("upsert_landed_order")
def _(i):
    """Files without row numbers, read in several splits: the later place in the file wins."""
    folder = scratch_folder(i.spark, "landing")
    land(_twice(i), folder)
    before = i.spark.conf.get("spark.sql.files.maxPartitionBytes")
    i.spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        landed = readers.read_search_facts(i.spark, folder)
        fresh = store.stage_updates(landed, FACT_KEYS, "landing_order", scratch_folder(i.spark, "updates"))
    finally:
        i.spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return store.put(i.spark.createDataFrame([], FACTS), fresh, FACT_KEYS)


#: Rows that one response holds.
RESPONSE_ROWS = 25_000


def land_responses(rows: DataFrame, folder: str) -> None:
    """Writes facts as landed responses, each fact twice: documents of about RESPONSE_ROWS rows, one in a file."""
    record = F.struct(
        F.array("query", "page").alias("keys"), "clicks", "impressions",
        F.col("ctr").cast("double").alias("ctr"), F.col("position").cast("double").alias("position"),
    )
    copies = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), record.withField("clicks", F.col("clicks") + n).alias("row")) for n in (1, 2)]))
    sizes = rows.groupBy("date").agg(F.ceil(F.count("*") * 2 / F.lit(RESPONSE_ROWS)).alias("responses"))
    dealt = rows.join(F.broadcast(sizes), "date").withColumn("response", F.pmod(F.xxhash64("query", "page"), F.col("responses")))
    found = dealt.select("date", "response", copies.alias("c")).groupBy("date", "response").agg(F.sort_array(F.collect_list("c")).alias("copies"))
    body = F.to_json(F.struct(F.transform("copies", lambda c: c["row"]).alias("rows")))
    found.select("date", body.alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("date").text(folder)


@register("scan_search_responses")
def _(i):
    """Whole responses, a few for each day; both copies of a fact are in one of them."""
    folder = scratch_folder(i.spark, "responses")
    land_responses(kept(i), folder)
    landed = readers.read_search_responses(i.spark, folder)
    return store.last_wins(landed, FACT_KEYS, "landing_order")


@register("curve_map")
def _(i):
    found = D.curve_map(calibrated(i))
    return found.select(F.explode("ctr_curve").alias("position", "ctr_mid"))


@register("insert_if_absent")
def _(i):
    seeds = G.seed_rows(kept(i))
    present = seeds.where(F.col("impressions") >= 1000).withColumn("agency_factor", F.lit("BOTH"))
    return store.seed_gaps(present, seeds)


def _watch_updates(i):
    rows = filters.active(D.snapshot(scored(i)))
    each = projected(i, rows, factors=("CONTENT", "BOTH"))
    return WI.to_watch(each, AS_OF).withColumn("ord", F.col("agency_factor_aplicado"))


@register("upsert_watchlist")
def _(i):
    return store.upsert_watchlist(i.view("fx_watch"), _watch_updates(i), NOW, "ord")


@register("delete_by_id")
def _(i):
    watch = i.view("fx_watch")
    ids = watch.where(F.col("target_position") <= 3).select("id").unionByName(
        watch.agg((F.max("id") + 1).alias("id"))
    )
    left, gone = store.delete_by_id(watch, ids)
    return left.select("id", F.lit("kept").alias("outcome")).unionByName(
        gone.select("id", F.lit("deleted").alias("outcome"))
    )


@register("update_params")
def _(i):
    before = D.set_boost(D.set_boost(i.view("fx_params"), ["BOTH"], "1.35"), ["LINK_BUILDING"], "1.10")
    after = D.set_boost(before, ["LINK_BUILDING", "BOTH"], "1.00")
    used = diagnosed(i).groupBy("agency_factor").agg(F.count("*").alias("n"))
    old = D.with_params(used, before, "inner").withColumnRenamed("ctr_boost", "old_boost").drop("success_prob")
    return D.with_params(old, after, "inner").withColumnRenamed("ctr_boost", "new_boost")


@register("reset_rates")
def _(i):
    old = catalog(i).unionByName(
        i.table("pages").select(F.col("url").alias("page_url")).distinct(), allowMissingColumns=True
    )
    stale = old.withColumns(
        {
            "department": F.lit("old"),
            "category_l1": F.lit("old"),
            "conversion_rate": F.lit(0.5).cast(CATALOG["conversion_rate"].dataType),
            "avg_ticket": F.length("page_url").cast("bigint"),
        }
    )
    return bi.reset_catalog(stale).select(*CATALOG_OUT)


@register("backfill_dates")
def _(i):
    landed = kept(i).groupBy("date").agg(F.count("*").alias("n"))
    days = P.backfill_calendar(i.spark, "2024-03-10")
    return days.join(landed, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("landed_rows"))


@register("consolidated_date")
def _(i):
    today = F.col("o_orderdate").cast("date")
    days = i.table("orders").groupBy(today.alias("today")).agg(F.count("*").alias("n"))
    return days.withColumn("consolidated", K.consolidated_date(F.col("today")))


@register("export_opportunities")
def _(i):
    folder = scratch_folder(i.spark, "export")
    store.export_csv(O.export_list(scored(i)), folder)
    text = T.StringType()
    names = [
        "keyword", "url", "posicion", "delta_clics", "ctr_real",
        "ctr_esperado", "revenue_clp", "agency_factor", "score",
    ]
    return store.read_exported(i.spark, folder, T.StructType([T.StructField(n, text) for n in names]))


@register("ingest_accounting")
def _(i):
    return filters.ingest_report(_with_gaps(facts(i)))


def _with_gaps(rows):
    """Some rows without a query or a page."""
    return rows.withColumns({"query": F.when(F.col("clicks") % 11 != 0, F.col("query")), "page": F.when(F.col("clicks") % 13 != 0, F.col("page"))})


@register("ingest_balance")
def _(i):
    """Rows landed, and rows kept plus rows excluded for a reason."""
    rows = _with_gaps(facts(i))
    landed = rows.groupBy("date").agg(F.count("*").alias("landed"))
    kept_rows = filters.ingest_filter(rows).groupBy("date").agg(F.count("*").alias("n"))
    excluded = filters.ingest_report(rows).where("reason <> 'kept'").select("date", "n")
    both = kept_rows.unionByName(excluded).groupBy("date").agg(F.sum("n").alias("accounted"))
    return landed.join(both, "date", "left")


# Filters


@register("exclude_pages")
def _(i):
    return filters.exclude_pages(facts(i))


@register("max_rank")
def _(i):
    return filters.within_rank(facts(i))


@register("brand_regex")
def _(i):
    flag = X.is_branded_regex(F.col("text"))
    return i.table("documents").select("doc_id", flag.alias("is_branded"))


def _by_query(flagged):
    return flagged.groupBy("query", "is_branded").agg(F.count("*").alias("n"))


@register("brand_table")
def _(i):
    return _by_query(branding.flag_branded(facts(i), i.view("fx_branded")))


@register("brand_table_join")
def _(i):
    nations = i.table("nation").select(F.col("n_name").alias("term"))
    terms = i.view("fx_branded").select("term").unionByName(nations)
    return _by_query(branding.flag_branded(facts(i), terms, by_join=True))


def _brand_words(i):
    """A list as long as a table, and texts that repeat (part names) and that don't (URLs, whole documents)."""
    # Cut behind the second word first: splitting would take every whole text apart, for each use of the terms.
    word = F.split_part(F.substring_index("text", " ", 2), F.lit(" "), F.lit(2))
    terms = i.table("documents").select(word.alias("term")).where(F.length("term") >= 6)
    texts = i.table("part").select(F.col("p_name").alias("text")).unionByName(i.table("pages").select(F.col("url").alias("text")))
    return texts.unionByName(i.table("documents").select("text")), terms


@register("brand_table_words")
def _(i):
    texts, terms = _brand_words(i)
    return branding.flag_branded(texts, terms, text="text", by_join=None)


@register("brand_table_words_join")
def _(i):
    texts, terms = _brand_words(i)
    return branding.flag_branded(texts, terms, text="text", by_join=True)


def _whole_texts(i):
    """The same terms, looked up in whole documents."""
    _, terms = _brand_words(i)
    return i.table("documents").select("doc_id", "text"), terms


@register("brand_table_texts")
def _(i):
    texts, terms = _whole_texts(i)
    return branding.flag_branded(texts, terms, text="text", by_join=None).select("doc_id", "is_branded")


@register("brand_table_texts_join")
def _(i):
    texts, terms = _whole_texts(i)
    return branding.flag_branded(texts, terms, text="text", by_join=True).select("doc_id", "is_branded")


def _shared_starts(i):
    """Terms that all start with the same nine letters, of several lengths, and one text for each order; some hold one."""
    customers = i.table("customer")
    terms = customers.select(F.col("c_name").alias("term")).unionByName(
        customers.select(F.concat(F.lit("Customer#"), "c_custkey", F.lit("-"), "c_mktsegment").alias("term"))
    )
    number = (F.col("o_custkey") * 2).cast("string")
    text = F.concat_ws(
        " ", "o_orderpriority", F.concat(F.lit("customer#"), F.lpad(number, 9, "0")), F.concat(F.lit("CUSTOMER#"), "o_custkey", F.lit("-BUILDING"))
    )
    return i.table("orders").select("o_orderkey", text.alias("text")), terms


@register("brand_table_shared")
def _(i):
    texts, terms = _shared_starts(i)
    return branding.flag_branded(texts, terms, text="text", by_join=None).select("o_orderkey", "is_branded")


@register("brand_table_shared_join")
def _(i):
    texts, terms = _shared_starts(i)
    return branding.flag_branded(texts, terms, text="text", by_join=True).select("o_orderkey", "is_branded")


@register("filter_factor")
def _(i):
    return O.by_factor(raw(i), "BOTH").select("date", "query", "page_url", "agency_factor")


@register("filter_max_pos")
def _(i):
    return O.by_max_position(raw(i), "9.5").select("date", "query", "page_url", "avg_position")


@register("filter_max_pos_fine")
def _(i):
    return O.by_max_position(raw(i), "9.9999and more").select("date", "query", "page_url", "avg_position")


@register("filter_min_revenue")
def _(i):
    return O.by_min_revenue(raw(i), "1000").select("date", "query", "page_url", "revenue_final")


@register("filter_subcategory")
def _(i):
    return O.by_subcategory(raw(i), "brand-10").select("date", "query", "page_url")


@register("active_only")
def _(i):
    return filters.active(raw(i)).select("date", "query", "page_url", "delta_clicks")


@register("latest_snapshot")
def _(i):
    return D.snapshot(kept(i)).select("date", "query", "page", "impressions")


@register("trailing_7d")
def _(i):
    return filters.trailing(kept(i), AS_OF).select("date", "query", "page", "position")


@register("bi_junk_filter")
def _(i):
    return clean(i)


@register("bi_large_values")
def _(i):
    """Rates and tickets a billion times as large."""
    large = {c: F.col(c) * float(1 << 30) for c in ("tasa_conversion", "ticket_promedio")}
    return bi.bi_sub(bi.clean_bi(i.view("fx_bi").withColumns({c: v for c, v in large.items()})))


@register("site_urls_only")
def _(i):
    urls = facts(i).select(F.col("page").alias("url")).unionByName(i.table("pages").select("url"))
    return filters.on_site(urls, "url").groupBy("url").agg(F.count("*").alias("n"))


@register("revenue_guard")
def _(i):
    present = filters.has_revenue(raw(i)).groupBy("date").agg(F.count("*").alias("with_revenue"))
    positive = filters.has_revenue(raw(i), positive=True).groupBy("date")
    return present.join(positive.agg(F.count("*").alias("with_positive")), "date", "left")


@register("watchlist_validation")
def _(i):
    records = raw(i).select(
        "date",
        "query",
        "page_url",
        F.when(F.col("agency_factor") == "NONE", "OTHER").otherwise(F.col("agency_factor")).alias(
            "agency_factor_aplicado"
        ),
        F.col("avg_position").alias("baseline_position"),
        F.col("pos_target").alias("target_position"),
        F.col("date").alias("baseline_date"),
    )
    checked = filters.validate_watch(records)
    return checked.select("date", "query", "page_url", "agency_factor_aplicado", "rejected_reason")


# Joins


@register("join_ctr_curve")
def _(i):
    return D.with_ctr(facts(i), i.view("fx_ctr_curve"), "position", "ctr_expected").select(
        "date", "query", "page", "position", "ctr_expected"
    )


@register("join_factor_params")
def _(i):
    partial = i.view("fx_params").where(F.col("factor_name") != "LINK_BUILDING")
    return G.project(diagnosed(i), i.view("fx_ctr_curve"), partial).select(
        "date", "query", "page_url", "agency_factor", "pos_target",
        "ctr_target", "ctr_target_adjusted", "delta_clicks",
    )


CASCADE_OUT = [*CATALOG_OUT, "is_blando", "rate_source"]


def _softened(i):
    """A catalog whose pages carry an earlier softness."""
    return catalog(i).withColumn("is_blando", F.contains(F.col("page_url"), F.lit("brand-2")))


@register("bi_exact")
def _(i):
    return bi.fill_exact(_softened(i), bi.bi_sub(clean(i))).select(*CASCADE_OUT)


@register("bi_dept_fallback")
def _(i):
    return bi.fill_department(_softened(i), bi.bi_dept(clean(i))).select(*CASCADE_OUT)


@register("bi_site_fallback")
def _(i):
    return bi.fill_site(_softened(i), bi.bi_site(clean(i))).select(*CASCADE_OUT)


@register("join_catalog")
def _(i):
    rows = bi.with_rates(G.seed_rows(kept(i)), priced_catalog(i))
    return rows.select("date", "query", "page_url", "conversion_rate", "avg_ticket")


@register("watch_history")
def _(i):
    return W.watched_facts(facts(i), i.view("fx_watch")).select("date", "query", "page", "position")


@register("join_catalog_skewed")
def _(i):
    """About half of all rows on one page: those with an even number of clicks."""
    home = F.when(F.col("clicks") % 2 == 0, F.lit(HOME)).otherwise(F.col("page"))
    rows = bi.with_rates(G.seed_rows(kept(i).withColumn("page", home)), priced_catalog(i))
    return rows.select("date", "query", "page_url", "conversion_rate", "avg_ticket")


@register("watch_report_join")
def _(i):
    report = W.watch_report(i.view("fx_watch"), facts(i), AS_OF)
    return report.select("id", "query", "page_url", F.size("weekly_series").alias("weeks"), "current_position")


@register("max_score_join")
def _(i):
    return best_raw(i, scored(i))


@register("factor_cross")
def _(i):
    return WI.factor_cross(raw(i)).select("date", "query", "page_url", "agency_factor")


# Aggregates


@register("kpis")
def _(i):
    return KP.kpis(scored(i))


@register("kpis_newest")
def _(i):
    return KP.kpis_of(scored(i))


@register("factor_distribution")
def _(i):
    return KP.factor_distribution(diagnosed(i))


@register("actionable_share")
def _(i):
    return KP.actionable_share(diagnosed(i))


@register("bi_dept_means")
def _(i):
    return bi.bi_dept(clean(i))


@register("bi_site_means")
def _(i):
    return bi.bi_site(clean(i))


@register("bi_last_wins")
def _(i):
    return bi.bi_sub(clean(i))


@register("weekly_avg_position")
def _(i):
    return W.weekly_position(facts(i))


@register("current_position")
def _(i):
    return W.current_position(facts(i), AS_OF)


def _series_text(series):
    points = F.transform(
        series, lambda p: F.concat(p["week"], F.lit("="), (p["avg_position"] * 100).cast("bigint").cast("string"))
    )
    return F.concat_ws(",", points)


@register("weekly_series")
def _(i):
    series = W.weekly_series(W.weekly_position(facts(i)))
    return series.withColumn("weekly_series", _series_text(F.col("weekly_series")))


@register("daily_max_score")
def _(i):
    return G.daily_max_score(P.score_raw(kept(i), dims(i)))


@register("count_matching")
def _(i):
    return O.opportunities_total(scored(i), factor="BOTH", max_pos="9.5")


@register("bi_check")
def _(i):
    return bi.bi_check(priced_catalog(i), "small")


@register("bi_coverage")
def _(i):
    return bi.bi_coverage(priced_catalog(i))


@register("calibrate_ctr_curve")
def _(i):
    return calibrated(i)


@register("distinct_subcategories")
def _(i):
    return O.subcategories(scored(i))


@register("score_summary")
def _(i):
    return G.scoring_report(scored(i))


# Window-shaped


@register("normalise_score")
def _(i):
    return scored(i).select("date", "query", "page_url", "opportunity_score")


@register("row_index")
def _(i):
    page = O.opportunities(scored(i), page=2, page_size=25)
    return O.with_index(page, O.sort_order(), 26).select("row_index", "query", "page_url", "opportunity_score")


@register("share_of_max")
def _(i):
    top = O.share_of_max(O.top_n(O.opportunities(scored(i)), 5))
    return top.select("row_index", "query", "page_url", "revenue_final", "share_pct")


@register("series_trend")
def _(i):
    return W.series_trend(W.weekly_position(facts(i)))


# Sorts and top-k


@register("sort_opportunities")
def _(i):
    return O.opportunities_sorted(scored(i), "ctr_expected", "ASC")


@register("page_opportunities")
def _(i):
    return O.page_opportunities(scored(i), sort_key="revenue_final", sort_dir="desc", page=3)


def _history(i):
    """Every active row of every date in display form."""
    return O.displayed(filters.active(scored(i)), "date")


@register("page_last_history")
def _(i):
    """The last page of the whole history."""
    return O.page_by_count(_history(i), sort_key="revenue_final", sort_dir="desc", ties=("query", "page_url", "date"))


@register("page_middle_history")
def _(i):
    """A page in the middle, by a sort key that many rows share."""
    return O.page_by_count(_history(i), sort_key="agency_factor", sort_dir="asc", page=20, page_size=7, ties=("query", "page_url", "date"))


@register("top_opportunity")
def _(i):
    return KP.top_opportunity(D.snapshot(scored(i)))


@register("top5_revenue")
def _(i):
    return O.top_n(O.opportunities(scored(i)), 5).select("row_index", "query", "page_url", "revenue_final")


@register("top5_revenue_all")
def _(i):
    every = O.displayed(O.matching(scored(i)))
    return O.top_n(every, 5).select("row_index", "query", "page_url", "revenue_final")


@register("top10_revenue")
def _(i):
    top = O.in_thousands(O.top_n(O.opportunities(scored(i)), 10))
    return top.select("row_index", "query", "page_url", "revenue_final", "revenue_k")


@register("ordered_params")
def _(i):
    in_use = diagnosed(i).select(F.col("agency_factor").alias("factor_name")).distinct()
    factors = D.ordered_params(i.view("fx_params").join(in_use, "factor_name", "left_semi"))
    curve = D.ordered_curve(calibrated(i))
    return factors.withColumnRenamed("factor_name", "name").unionByName(
        curve.select(F.col("position").cast("string").alias("name"), "ctr_mid"), allowMissingColumns=True
    )


# Scalar expressions


@register("ctr_gap")
def _(i):
    rows = D.with_ctr(facts(i), i.view("fx_ctr_curve"), "position", "ctr_expected")
    return rows.select("date", "query", "page", S.ctr_gap(F.col("ctr_expected"), F.col("ctr")).alias("ctr_gap"))


@register("classify_factor")
def _(i):
    rows = D.with_ctr(facts(i), i.view("fx_ctr_curve"), "position", "ctr_expected")
    factor = S.classify_factor(F.col("impressions"), F.col("position"), F.col("ctr"), F.col("ctr_expected"))
    return rows.select("date", "query", "page", factor.alias("agency_factor"))


@register("target_position")
def _(i):
    rows = WI.factor_cross(facts(i))
    target = S.target_position(F.col("position"), F.col("agency_factor"))
    return rows.select("date", "query", "page", "agency_factor", target.alias("pos_target"))


def _projection(i):
    return G.project(diagnosed(i), i.view("fx_ctr_curve"), i.view("fx_params"))


@register("ctr_target")
def _(i):
    return _projection(i).select("date", "query", "page_url", "ctr_target", "ctr_target_adjusted")


@register("delta_clicks")
def _(i):
    return _projection(i).select("date", "query", "page_url", "agency_factor", "delta_clicks")


@register("revenue")
def _(i):
    rows = P.score_raw(kept(i), dims(i))
    return rows.select("date", "query", "page_url", "conversion_rate", "avg_ticket", "revenue_final")


@register("position_weight")
def _(i):
    weight = S.position_weight(F.col("position"))
    return facts(i).select("date", "query", "page", weight.alias("position_weight"))


@register("raw_score")
def _(i):
    return P.score_raw(kept(i), dims(i)).select("date", "query", "page_url", "raw_score")


@register("whatif_score")
def _(i):
    rows = filters.active(D.snapshot(scored(i)))
    return projected(i, rows, ctr_source="exact").select("query", "page_url", "agency_factor", "score")


@register("display_rounding")
def _(i):
    return O.displayed(scored(i)).drop("impressions", "delta_clicks", "agency_factor").withColumn(
        "n", F.lit(1)
    ).groupBy("query", "page_url", "avg_position", "ctr_actual", "ctr_expected", "revenue_final",
              "opportunity_score", "conversion_rate", "avg_ticket").agg(F.count("n").alias("n"))


def _urls(i):
    return facts(i).select(F.col("page").alias("url")).unionByName(i.table("pages").select("url")).distinct()


@register("url_department")
def _(i):
    return _urls(i).withColumn("department", X.department(F.col("url")))


@register("url_category")
def _(i):
    return _urls(i).withColumn("category_l1", X.category_l1(F.col("url")))


@register("subcategory_label")
def _(i):
    return _urls(i).withColumn("subcategory", X.subcategory(F.col("url")))


@register("url_path")
def _(i):
    return _urls(i).withColumn("path", X.url_path(F.col("url")))


@register("is_soft_department")
def _(i):
    segment = F.split_part(F.col("url"), F.lit("/"), F.lit(4))
    pages = i.table("pages").select(segment.alias("department"))
    every = catalog(i).select("department").unionByName(pages)
    return every.distinct().withColumn("is_blando", X.is_soft_department(F.col("department")))


@register("loose_number")
def _(i):
    return i.table("orders").select(
        "o_orderkey",
        N.loose_number(F.col("o_orderpriority")).alias("priority"),
        N.loose_number(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" CLP"))).alias("price"),
        N.loose_number(F.col("o_orderstatus")).alias("status"),
    )


@register("normalise_label")
def _(i):
    label = X.normalise_label(F.col("text"))
    return i.table("documents").select("doc_id", F.md5(label).alias("label_md5"))


@register("iso_week_label")
def _(i):
    date = F.col("o_orderdate").cast("date")
    return i.table("orders").select("o_orderkey", K.iso_week(date).alias("week"))


def _pair_positions(i):
    watch = i.view("fx_watch").withColumnRenamed("page_url", "page")
    current = W.current_position(facts(i), AS_OF)
    joined = watch.join(current, ["query", "page"], "left")
    delta = K.position_delta(F.col("current_position"), F.col("baseline_position"))
    return joined.withColumn("delta", delta)


@register("position_delta")
def _(i):
    return _pair_positions(i).select("id", "delta")


@register("delta_status")
def _(i):
    return _pair_positions(i).select("id", K.delta_status(F.col("delta")).alias("status"))


@register("position_band")
def _(i):
    band = S.position_band(F.col("position"))
    return facts(i).groupBy("date", band.alias("band")).agg(F.count("*").alias("n"))


@register("target_improves")
def _(i):
    rows = projected_daily(i, scored(i))
    improves = S.target_improves(F.col("pos_target"), F.col("avg_position"))
    return rows.select("date", "query", "page_url", "agency_factor", improves.alias("improves"))


@register("watch_record")
def _(i):
    return WI.to_watch(projected(i, filters.active(D.snapshot(scored(i)))), AS_OF)


# Streams and composite jobs


_STREAMED: dict[tuple[str, str], incremental.Tables] = {}


def _joined_apart(i) -> DataFrame:
    """The month, with parts met by a shuffle: they grow with the facts, and a broadcast would pass through the driver."""
    apart = Inputs(i.spark, i.folder)
    apart.keep("part", lambda: i.table("part").hint("merge"))
    return facts(apart)


def _landed_twice(i) -> incremental.Tables:
    """The tables of a stream that lands the month with its last week still unsettled, then that week again; run once in a session."""
    key = (i.spark.sparkContext.applicationId, i.folder)
    if key not in _STREAMED:
        base = scratch_folder(i.spark, "incremental")
        tables = incremental.Tables.below(base)
        # Landed twice, worked out once.
        _joined_apart(i).write.parquet(f"{base}/month")
        month = i.spark.read.parquet(f"{base}/month")
        unsettled = F.col("date") >= F.lit("2024-01-22")
        early = month.withColumn(
            "impressions", F.when(unsettled, F.col("impressions") * 2).otherwise(F.col("impressions"))
        )
        for rows in (early, month.where(unsettled)):
            land(rows, f"{base}/landing")
            incremental.run_incremental(i.spark, f"{base}/landing", tables, dims(i), f"{base}/checkpoint")
        _STREAMED[key] = tables
    return _STREAMED[key]


@register("incremental_daily")
def _(i):
    return incremental.read_gaps(i.spark, _landed_twice(i)).select(*GAP_OUT)


@register("incremental_facts")
def _(i):
    return incremental.read_facts(i.spark, _landed_twice(i))


def _newest_counts(i, table: str) -> DataFrame:
    """The counts of each day's last batch."""
    rows = incremental.accounting(i.spark, _landed_twice(i)).where(F.col("table") == table)
    return rows.groupBy("date").agg(F.max_by("counts", "batch_id").alias("counts"))


@register("incremental_accounting")
def _(i):
    """Landed rows by reason, as counted while they were landed."""
    return _newest_counts(i, "landed").select("date", F.explode("counts").alias("reason", "n"))


@register("incremental_summary")
def _(i):
    """Rows touched by each scoring step, as counted while they were scored."""
    steps = ("branded", "diagnosed", "classified", "projected", "scored", "normalised")
    return _newest_counts(i, "gaps").select("date", *[F.col("counts")[name].alias(name) for name in steps])


@register("watch_report_weeks")
def _(i):
    """The report from the weekly sums that the stream keeps, whose last week was corrected."""
    tables = _landed_twice(i)
    report = W.watch_report_of(i.view("fx_watch"), incremental.read_weeks(i.spark, tables), incremental.read_facts(i.spark, tables), AS_OF)
    return report.withColumn("weekly_series", _series_text(F.col("weekly_series")))


@register("score_day")
def _(i):
    return P.score_day(facts(i), dims(i), AS_OF, stage=scratch_folder(i.spark, "stage"), gather=True).select(*GAP_OUT)


@register("score_backfill")
def _(i):
    stage = scratch_folder(i.spark, "stage")
    return P.score_backfill(facts(i), dims(i), "2024-03-10", stage=stage, gather=True).select(*GAP_OUT)


@register("refresh_catalog")
def _(i):
    folder = scratch_folder(i.spark, "catalog")
    store.write_snapshot(priced_catalog(i), folder, CATALOG)
    return store.read_snapshot(i.spark, folder, CATALOG)


@register("opportunities")
def _(i):
    return O.opportunities(
        scored(i), factor="BOTH", max_pos="9.5", min_revenue="100", sort_key="revenue_final", page_size=20
    )


@register("watch_report")
def _(i):
    report = W.watch_report(i.view("fx_watch"), facts(i), AS_OF)
    return report.withColumn("weekly_series", _series_text(F.col("weekly_series")))


@register("opportunities_lenient")
def _(i):
    """Arguments as a form sends them: numbers with text behind, an empty date."""
    return O.opportunities(scored(i), date="", max_pos="9.5abc", min_revenue="1000.5")


@register("opportunities_after")
def _(i):
    """The third page, asked for by the last row of the second."""
    second = O.opportunities(scored(i), sort_key="revenue_final", page=2)
    last = second.collect()[-1].asDict()
    return O.opportunities(scored(i), sort_key="revenue_final", after=last)


@register("what_if")
def _(i):
    return projected_daily(i, scored(i))


@register("what_if_newest")
def _(i):
    return projected(i, D.snapshot(scored(i)))


@register("whatif_extra_factor")
def _(i):
    """A factor beyond the four, with params of its own."""
    fifth = i.spark.sql("SELECT 'AUDIT' AS factor_name, CAST(1.1 AS DECIMAL(6,3)) AS ctr_boost, CAST(0.75 AS DECIMAL(6,3)) AS success_prob, CAST(0 AS DECIMAL(6,2)) AS pos_delta, 1 AS impact_weeks_min, 2 AS impact_weeks_max")
    params = i.view("fx_params").unionByName(fifth)
    return WI.what_if(D.snapshot(scored(i)), params, i.view("fx_ctr_curve"), best_raw(i, scored(i)), factors=(*FACTORS, "AUDIT"))
