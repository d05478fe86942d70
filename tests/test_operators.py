"""Operators on small frames, against hand results or brute force."""

import datetime
import random
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from searchlift.functions import scoring as S
from searchlift.operators import bi, branding, ctr_curve, filters, gaps, kpis, opportunities as O, order_statistics, watchlist as W
from searchlift.operators import dimensions as dim
from searchlift.operators import whatif
from searchlift.plans import catalog as C
from searchlift.schemas import CATALOG, CTR_CURVE, FACTOR_PARAMS, FACTS, GAPS, WATCHLIST
from searchlift.sources import store

DAY = datetime.date(2024, 1, 10)


def fact(query, page, position, impressions=1000, ctr="0.010000", day=DAY, clicks=10):
    place = None if position is None else D(position)
    return (query, page, clicks, impressions, D(ctr), place, day)


@pytest.fixture(scope="module")
def curve(spark):
    rows = [(p, D(0), D("0.3") / p, D(1), "zone") for p in range(1, 21)]
    return spark.createDataFrame([(p, a, round(m, 6), h, z) for p, a, m, h, z in rows], CTR_CURVE)


@pytest.fixture(scope="module")
def params(spark):
    rows = [
        ("NONE", D(1), D(0), D(0), 0, 0),
        ("CONTENT", D("1.2"), D("0.65"), D(0), 2, 6),
        ("LINK_BUILDING", D(1), D("0.55"), D("5.5"), 8, 16),
        ("BOTH", D(1), D("0.75"), D("7.5"), 4, 12),
    ]
    return spark.createDataFrame(rows, FACTOR_PARAMS)


def test_curve_lookup_clamps_and_keeps_null(spark, curve):
    positions = ["0.40", "1.49", "1.50", "20.00", "24.99", None]
    df = spark.createDataFrame([(D(p) if p else None,) for p in positions], "p decimal(8,2)")
    got = {r.p: r.ctr for r in dim.with_ctr(df, curve, "p", "ctr").collect()}
    assert got[D("0.40")] == D("0.300000") and got[D("1.49")] == D("0.300000")
    assert got[D("1.50")] == D("0.150000")
    assert got[D("20.00")] == got[D("24.99")] == D("0.015000")
    assert got[None] == 0


def test_curve_entry_missing_gives_zero(spark, curve):
    df = spark.createDataFrame([(D("7.00"),)], "p decimal(8,2)")
    assert dim.with_ctr(df, curve.where("position <> 7"), "p", "ctr").first().ctr == 0


def test_landing_filters(spark):
    rows = [
        fact("a", "https://x.cl/d/s/", "20.00"),
        fact("b", "https://x.cl/d/s/", "20.01"),
        fact("c", "https://x.cl/d/s/", None),
        fact("d", "https://x.cl/listas/s/", "3.00"),
        fact("e", "https://x.cl/LISTAS/s/", "3.00"),
        fact("f", "https://x.cl/d/search?q", "3.00"),
        fact("g", "https://x.cl/d/a.html", "30.00"),
        fact("tienda paris", "https://x.cl/d/s/", "3.00"),
    ]
    df = spark.createDataFrame(rows, FACTS)
    assert {r.query for r in filters.ingest_filter(df).collect()} == {"a", "c", "e"}
    assert {r.query for r in filters.ingest_filter(df, brands=False).collect()} == {"a", "c", "e", "tienda paris"}
    report = {r.reason: r.n for r in filters.ingest_report(df).collect()}
    assert report == {"kept": 3, "position": 1, "page": 3, "branded": 1}
    assert sum(report.values()) == len(rows)


def test_branded_flag_both_ways_equal_brute_force(spark):
    rng = random.Random(7)
    terms = ["".join(rng.choice("abcñ ") for _ in range(rng.randint(1, 4))) for _ in range(25)] + ["", "ABC", "abc"]
    texts = ["".join(rng.choice("abcñ xyz") for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["xABCx", None]
    # One text holds a third of the rows.
    texts += [texts[0]] * 150
    want = sorted(
        (t or "", any(x and x.lower() in t.lower() for x in terms) if t is not None else False) for t in texts
    )
    df = spark.createDataFrame([(t,) for t in texts], "query string")
    term_rows = spark.createDataFrame([(t,) for t in terms] + [(None,)], "term string")
    for by_join in (False, True):
        got = branding.flag_branded(df, term_rows, by_join=by_join).collect()
        assert sorted((r.query or "", r.is_branded) for r in got) == want


def test_terms_that_share_a_start_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(branding, "PIECE", 16)  # terms lie across the ends of pieces, and some are longer than one
    rng = random.Random(11)
    terms = ["longstart" + "".join(rng.choice("01") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    terms = [t for t in terms if len(t) > 13]
    texts = ["x" * rng.randint(0, 40) + "LongStart" + "".join(rng.choice("01") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["longstart" * 9, "longstartlongstart0101", "", "ñ" * 37 + terms[0] + "ñ", terms[1][:-1], terms[2]]
    want = sorted((t, any(x in t.lower() for x in terms)) for t in texts)
    assert {hit for _, hit in want} == {True, False}
    df = spark.createDataFrame([(t,) for t in texts], "query string")
    term_rows = spark.createDataFrame([(t,) for t in terms], "term string")
    for by_join in (False, True):
        got = branding.flag_branded(df, term_rows, by_join=by_join).collect()
        assert sorted((r["query"], r["is_branded"]) for r in got) == want


def test_branded_flag_without_terms(spark):
    df = spark.createDataFrame([("a",)], "query string")
    none = spark.createDataFrame([], "term string")
    for by_join in (False, True):
        assert branding.flag_branded(df, none, by_join=by_join).first().is_branded is False


def test_a_crowded_filter_loses_no_term(spark, monkeypatch):
    # One word of bits for all terms: nearly every cut passes by chance, and the join looks all of them up.
    monkeypatch.setattr(branding, "CHUNK_BITS", 64)
    monkeypatch.setattr(branding, "FILTER_BYTES", 8)
    rng = random.Random(5)
    terms = ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 9))) for _ in range(40)]
    texts = ["".join(rng.choice("abcde ") for _ in range(rng.randint(0, 60))) for _ in range(120)]
    want = sorted((t, any(x in t for x in terms)) for t in texts)
    assert {hit for _, hit in want} == {True, False}
    df = spark.createDataFrame([(t,) for t in texts], "query string")
    got = branding.flag_branded(df, spark.createDataFrame([(t,) for t in terms], "term string"), by_join=True).collect()
    assert sorted((r["query"], r["is_branded"]) for r in got) == want


def test_a_text_is_exchanged_with_one_cut_however_many_terms_it_holds(spark):
    terms = spark.createDataFrame([(f"start{k}",) for k in range(50)], "term string")
    texts = spark.createDataFrame([(" ".join(f"start{k}" for k in range(50)),), ("nothing here",)], "text string")
    listed = texts.withColumn("brand_index", branding.term_filter(terms).scalar())
    cut = branding._first_cut(F.col("brand_index"), F.col("text")).alias("cut")
    assert sorted([c["term"] for c in r.cut] for r in listed.select(cut).collect()) == [[], ["start0"]]


def test_a_cut_of_most_texts_is_split_over_tasks(spark):
    settings = {
        "autoBroadcastJoinThreshold": "-1",
        "shuffle.partitions": "16",
        "files.maxPartitionBytes": "64k",
        "adaptive.coalescePartitions.enabled": "false",
        "adaptive.advisoryPartitionSizeInBytes": "16k",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(f"spark.sql.{name}") for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(f"spark.sql.{name}", value)
        texts = spark.range(20000).select(F.concat(F.lit("common "), F.sha2(F.col("id").cast("string"), 256)).alias("query"))
        terms = spark.createDataFrame([("common",), ("rare",)], "term string")
        flagged = branding.flag_branded(texts, terms, by_join=True)
        assert {r.is_branded for r in flagged.collect()} == {True}
        assert "SortMergeJoin(skew=true)" in flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(f"spark.sql.{name}", value)


def test_a_list_beyond_the_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(branding, "INDEX_BYTES", 3)
    df, terms = spark.createDataFrame([("xabcdx",)], "query string"), spark.createDataFrame([("abcd",)], "term string")
    with pytest.raises(Exception, match="use by_join"):
        branding.flag_branded(df, terms).collect()
    assert branding.flag_branded(df, terms, by_join=True).first().is_branded is True


def test_a_list_beyond_the_bound_goes_through_the_join_when_the_size_decides(spark, monkeypatch):
    monkeypatch.setattr(branding, "INDEX_BYTES", 3)
    df, terms = spark.createDataFrame([("xabcdx",), ("xabcx",)], "query string"), spark.createDataFrame([("abcd",)], "term string")
    got = branding.flag_branded(df, terms, by_join=None).collect()
    assert sorted((r["query"], r.is_branded) for r in got) == [("xabcdx", True), ("xabcx", False)]


def test_large_rates_and_tickets_are_kept(spark):
    rows = [("a", "x", 1e7, 2e12, 0), ("a", "y", 3e7, 4e12, 1), ("a", "z", float("nan"), 1.0, 2), ("a", "w", float("-inf"), 1.0, 3)]
    clean = bi.clean_bi(spark.createDataFrame(rows, BI))
    assert {(r["sub"], r.conversion_rate, r.avg_ticket) for r in bi.bi_sub(clean).collect()} == {("x", D(10**7), 2 * 10**12), ("y", D(3 * 10**7), 4 * 10**12)}
    mean = bi.bi_dept(clean).first()
    assert (mean.conversion_rate, mean.avg_ticket, mean.n) == (D(2 * 10**7), 3 * 10**12, 2)


def test_null_keys_are_malformed(spark):
    rows = [fact("a", "https://x.cl/d/s/", "3.00"), fact(None, "https://x.cl/d/s/", "3.00"), fact("b", None, "30.00")]
    df = spark.createDataFrame(rows, FACTS)
    assert {r.reason: r.n for r in filters.ingest_report(df).collect()} == {"kept": 1, "malformed": 2}
    for brands in (True, False):
        assert [r.query for r in filters.ingest_filter(df, brands).collect()] == ["a"]


def test_positions_are_judged_as_landed(spark):
    rows = [fact("a", "https://x.cl/d/s/", "20.004"), fact("b", "https://x.cl/d/s/", "20.000"), fact("c", "https://x.cl/d/s/", "5.004")]
    df = filters.ingest_filter(spark.createDataFrame(rows, FACTS))
    band = S.position_band(F.col("position"))
    assert {(r.query, r.band) for r in df.select("query", band.alias("band")).collect()} == {("b", "deep"), ("c", "mid")}


BI = "dept string, sub string, tasa_conversion double, ticket_promedio double, ord int"


def test_bi_cleaning_and_means(spark):
    rows = [
        (" Mujer ", "Moda", 0.01, 1000.4, 0),
        ("mujer", "moda", 0.02, 2000.5, 1),
        ("mujer", "sin_path2", 0.03, 3000.0, 2),
        ("sin_path1", "x", 0.5, 10.0, 3),
        ("http://a", "x", 0.5, 10.0, 4),
        ("?q", "x", 0.5, 10.0, 5),
        ("a|b", "x", 0.04, 400.0, 6),
        ("", "x", 0.5, 10.0, 7),
        ("mujer", None, 0.5, 10.0, 8),
        ("mujer", "cero", 0.0, 10.0, 9),
        ("mujer", "negativo", 0.1, -1.0, 10),
        ("mujer", "infinito", float("inf"), 1.0, 11),
    ]
    clean = bi.clean_bi(spark.createDataFrame(rows, BI))
    pairs = {(r.dept, r["sub"]): (r.conversion_rate, r.avg_ticket) for r in bi.bi_sub(clean).collect()}
    assert pairs == {
        ("mujer", "moda"): (D("0.02"), 2001),
        ("mujer", "sin_path2"): (D("0.03"), 3000),
        ("a|b", "x"): (D("0.04"), 400),
    }
    depts = {r.dept: (r.conversion_rate, r.avg_ticket, r.n) for r in bi.bi_dept(clean).collect()}
    assert depts["mujer"] == (D("0.02"), 2000, 3)
    site = bi.bi_site(clean).first()
    assert (site.conversion_rate, site.avg_ticket) == (D("0.025"), 1600)


def test_bi_site_defaults(spark):
    site = bi.bi_site(bi.clean_bi(spark.createDataFrame([], BI))).first()
    assert (site.conversion_rate, site.avg_ticket) == (D("0.002"), 80000)


def test_refresh_cascade(spark):
    rows = [("mujer", "moda", 0.01, 1000.0, 0), ("mujer", "x", 0.03, 3000.0, 1), ("hogar", "y", 0.05, 500.0, 2)]
    old = D("0.9")
    pages = [
        ("https://s.cl/Mujer/Moda/", "stale", "stale", False, old, 9, None),
        ("https://s.cl/mujer/otra/", None, None, None, None, None, None),
        ("https://s.cl/autos/z/", None, None, True, old, 9, None),
        ("https://elsewhere.com/a/b", "hogar", "y", None, old, 9, None),
    ]
    catalog = spark.createDataFrame(pages, CATALOG)
    out = C.refresh_catalog(catalog, spark.createDataFrame(rows, BI), "2024-02-01 00:00:00")
    got = {r.page_url: (r.department, r.category_l1, r.is_blando, r.conversion_rate, r.avg_ticket, r.rate_source) for r in out.collect()}
    assert got["https://s.cl/Mujer/Moda/"] == ("mujer", "moda", True, D("0.01"), 1000, "exact")
    assert got["https://s.cl/mujer/otra/"] == ("mujer", "otra", True, D("0.02"), 2000, "department")
    assert got["https://s.cl/autos/z/"] == ("autos", "z", True, D("0.03"), 1500, "site")
    assert got["https://elsewhere.com/a/b"] == ("hogar", "y", False, D("0.05"), 500, "exact")
    coverage = {r.rate_source: r.n for r in bi.bi_coverage(out).collect()}
    assert coverage == {"exact": 2, "department": 1, "site": 1}


def test_tiers_one_by_one_equal_the_cascade(spark, folder):
    from searchlift.suite.fixtures import Inputs

    i = Inputs(spark, folder)
    clean = bi.clean_bi(i.view("fx_bi"))
    blank = bi.seed_catalog(i.view("fx_facts"))
    step = bi.fill_exact(blank, bi.bi_sub(clean))
    step = bi.fill_site(bi.fill_department(step, bi.bi_dept(clean)), bi.bi_site(clean))
    columns = step.columns
    assert sorted(map(str, step.collect())) == sorted(map(str, bi.cascade(blank, clean).select(columns).collect()))


GAP_ROW = {f.name: None for f in GAPS.fields}


def gap(**values):
    row = {**GAP_ROW, "date": DAY, "is_branded": False, "agency_factor": "BOTH", "delta_clicks": 1, **values}
    return tuple(row[f.name] for f in GAPS.fields)


def test_kpis_count_branded_rows_and_ignore_missing_revenue(spark):
    rows = [
        gap(query="a", page_url="p", agency_factor="BOTH", revenue_final=10),
        gap(query="b", page_url="p", agency_factor="NONE", revenue_final=0),
        gap(query="c", page_url="p", agency_factor="NONE", revenue_final=None, is_branded=True),
        gap(query="d", page_url="p", agency_factor="CONTENT", revenue_final=5),
    ]
    row = kpis.kpis(spark.createDataFrame(rows, GAPS)).first()
    assert (row.total_keywords, row.with_opportunity, row.factor_none) == (4, 2, 2)
    assert (row.total_revenue, row.active_revenue) == (15, 15)
    empty = kpis.kpis(spark.createDataFrame(rows[2:3], GAPS)).first()
    assert (empty.total_revenue, empty.active_revenue) == (0, 0)


def test_unknown_params_leave_rows_alone(spark, curve, params):
    facts = spark.createDataFrame(
        [fact("a", "u", "12.00", 5000), fact("b", "u", "12.00", 500), fact("c", "u", "7.00", 500, "0.000001")], FACTS
    )
    none = spark.createDataFrame([], "term string, note string")
    classed = gaps.classify(gaps.diagnose(gaps.seed_rows(facts), curve, none))
    known = params.where("factor_name = 'BOTH'")
    out = {r.query: r for r in gaps.project(classed, curve, known).collect()}
    assert out["a"].agency_factor == "LINK_BUILDING" and out["a"].delta_clicks is None and out["a"].pos_target is None
    assert out["b"].agency_factor == "NONE" and out["b"].delta_clicks == 0
    assert out["c"].pos_target == D("3.00") and out["c"].delta_clicks == 50


def test_normalise_without_positive_score(spark):
    rows = [gap(query="a", page_url="p", raw_score=D(0)), gap(query="b", page_url="p", raw_score=None)]
    df = spark.createDataFrame(rows, GAPS).drop("opportunity_score")
    out = {r.query: r.opportunity_score for r in gaps.normalise(df).collect()}
    assert out == {"a": D("0.00"), "b": None}


@pytest.fixture(scope="module")
def listing(spark):
    scores = [("a", D("90.04"), D("0.011149")), ("b", D("90.01"), D("0.011151")), ("c", None, None), ("d", D("5"), D("0.5"))]
    rows = [
        gap(
            query=q, page_url=f"https://s.cl/d/{q.upper()}/", opportunity_score=s, ctr_actual=c, ctr_expected=c,
            avg_position=D("4.00"), revenue_final=k * 1000, impressions=1,
        )
        for k, (q, s, c) in enumerate(scores)
    ]
    rows.append(gap(query="idle", page_url="https://s.cl/d/", delta_clicks=0, revenue_final=7))
    rows.append(gap(query="old", page_url="https://s.cl/d/", date=datetime.date(2024, 1, 9), revenue_final=7))
    return spark.createDataFrame(rows, GAPS)


def queries_of(df):
    return [r.query for r in df.collect()]


def test_list_order(listing):
    # Nulls are the largest value; equal displayed scores fall back to the query.
    assert queries_of(O.opportunities(listing)) == ["c", "a", "b", "d"]
    assert queries_of(O.opportunities(listing, sort_dir="asc")) == ["d", "a", "b", "c"]
    assert queries_of(O.opportunities(listing, sort_key="drop table", sort_dir="sideways")) == ["c", "a", "b", "d"]
    # Order by the displayed CTR: 1.11 and 1.12.
    assert queries_of(O.opportunities(listing, sort_key="ctr_actual", sort_dir="ASC")) == ["a", "b", "d", "c"]
    assert queries_of(O.opportunities(listing, sort_key="revenue_final")) == ["d", "c", "b", "a"]


def test_list_filters(listing):
    assert queries_of(O.opportunities(listing, min_revenue="0", sort_key="query", sort_dir="asc")) == ["a", "b", "c", "d"]
    assert queries_of(O.opportunities(listing, min_revenue="2000", sort_key="query", sort_dir="asc")) == ["c", "d"]
    assert queries_of(O.opportunities(listing, subcategory="B")) == ["b"]
    assert queries_of(O.opportunities(listing, subcategory="' OR 1=1 --")) == []
    assert queries_of(O.opportunities(listing, max_pos="3.99")) == []
    assert queries_of(O.opportunities(listing, factor="CONTENT")) == []
    assert queries_of(O.opportunities(listing, date="2024-01-09")) == ["old"]
    assert O.opportunities_total(listing).first().total == 4


def test_pages_do_not_overlap_and_cover_everything(listing):
    pages = [O.page_opportunities(listing, page=p, page_size=3).orderBy("row_index").collect() for p in (1, 2)]
    assert [r.query for r in pages[0] + pages[1]] == ["c", "a", "b", "d"]
    assert [r.row_index for r in pages[0] + pages[1]] == [1, 2, 3, 4]
    last = pages[1][0]
    assert (last.start_row, last.end_row, last.total, last.total_pages) == (4, 4, 4, 2)


@pytest.mark.parametrize("key,way", [("opportunity_score", "DESC"), ("opportunity_score", "ASC"), ("ctr_actual", "DESC"), ("query", "ASC"), ("revenue_final", "DESC")])
def test_pages_by_the_last_row(listing, key, way):
    whole = queries_of(O.opportunities(listing, sort_key=key, sort_dir=way))
    seen, last = [], None
    while len(seen) < len(whole):
        (row,) = O.opportunities(listing, sort_key=key, sort_dir=way, page_size=1, after=last).collect()
        seen.append(row.query)
        last = row.asDict()
    assert seen == whole
    assert O.opportunities(listing, sort_key=key, sort_dir=way, after=last).collect() == []


def test_lenient_arguments(listing):
    assert queries_of(O.opportunities(listing, date="", min_revenue="2000.9", sort_key="query", sort_dir="asc")) == ["c", "d"]
    assert len(queries_of(O.opportunities(listing, max_pos="4.0000001abc"))) == 4
    assert queries_of(O.opportunities(listing, max_pos="3.9999999999")) == []
    assert len(queries_of(O.opportunities(listing, max_pos="1e9"))) == 4
    for wrong in ({"max_pos": "abc"}, {"min_revenue": "abc"}):
        with pytest.raises(ValueError):
            O.opportunities(listing, **wrong)


def test_top_lists(listing):
    page = O.opportunities(listing, page_size=2)
    assert queries_of(O.top_n(page, 5)) == ["c", "a"]
    shares = O.share_of_max(O.top_n(O.displayed(O.matching(listing)), 5)).orderBy("row_index").collect()
    assert [(r.query, r.share_pct) for r in shares] == [("d", 100), ("c", 67), ("b", 33), ("a", 0)]
    assert [r.subcategory for r in O.subcategories(listing).collect()] == ["A", "B", "C", "D"]


def test_export_text(listing):
    row = O.export_frame(O.displayed(O.matching(listing))).where("keyword = 'a'").first()
    assert (row.posicion, row.ctr_real, row.score) == ("4.00", "1.11%", "90.0")


def test_whatif_uses_the_displayed_ctr(spark, curve, params):
    rows = [gap(query="a", page_url="u", impressions=100000, avg_position=D("8.00"), ctr_actual=D("0.011149"),
                conversion_rate=D("0.01"), avg_ticket=1000)]
    df = spark.createDataFrame(rows, GAPS)
    best = spark.createDataFrame([(D("10000.0000"),)], "max_raw_score decimal(29,4)")
    shown = {r.agency_factor: r for r in whatif.what_if(df, params, curve, best).collect()}
    exact = {r.agency_factor: r for r in whatif.what_if(df, params, curve, best, ctr_source="exact").collect()}
    assert shown["NONE"].delta_clicks == 0 and shown["NONE"].score == 0.0
    assert shown["BOTH"].pos_target == D("3.00")
    assert shown["BOTH"].delta_clicks == 8890 and exact["BOTH"].delta_clicks == 8885
    assert shown["BOTH"].revenue == 88900
    assert shown["BOTH"].score == pytest.approx(100.0)
    assert {r.agency_factor_aplicado for r in whatif.to_watch(whatif.what_if(df, params, curve, best), "2024-01-10").collect()} == {
        "CONTENT", "LINK_BUILDING", "BOTH",
    }


def test_whatif_unknown_factor_gains_nothing(spark, curve, params):
    df = spark.createDataFrame([gap(query="a", page_url="u", impressions=1000, avg_position=D("8.00"), ctr_actual=D(0))], GAPS)
    best = spark.createDataFrame([(None,)], "max_raw_score decimal(29,4)")
    row = whatif.what_if(df, params, curve, best, factors=("OTHER",)).first()
    assert (row.pos_target, row.score) == (D("8.00"), 0.0)


def test_calibration_equals_numpy(spark):
    import numpy as np

    rng = random.Random(3)
    # A third of the rows stand at one position.
    rows = [(D(rng.randint(50, 2500)) / 100, D(rng.randint(0, 300)) / 10**6) for _ in range(2000)]
    rows += [(D("3.00"), D(rng.randint(0, 9000)) / 10**6) for _ in range(1000)]
    df = spark.createDataFrame(rows, "position decimal(8,2), ctr decimal(12,6)")
    groups = {}
    for position, ctr in rows:
        slot = min(max(int(position + D("0.5")), 1), 20)
        groups.setdefault(slot, []).append(int(ctr * 10**6))
    got = {r.position: r for r in ctr_curve.calibrate_curve(df).collect()}
    assert set(got) == set(groups)
    for slot, values in groups.items():
        want = [int(np.floor(q + 0.5)) for q in np.quantile(values, [0.25, 0.5, 0.75])]
        row = got[slot]
        assert [int(x * 10**6) for x in (row.ctr_low, row.ctr_mid, row.ctr_high)] == want
        assert row.n == len(values)


def test_watch_report_of_a_hot_pair(spark):
    start = datetime.date(2024, 1, 1)
    rows = [fact("hot", "u", f"{1 + (d % 7)}.00", day=start + datetime.timedelta(days=d)) for d in range(28)]
    rows += [fact("cold", "u", "9.00", day=start)]
    watch = spark.createDataFrame(
        [
            (1, "hot", "u", D("9.00"), start, D("3.00"), "BOTH", "note", datetime.datetime(2024, 1, 2)),
            (2, "never", "u", D("9.00"), start, D("3.00"), "BOTH", None, datetime.datetime(2024, 1, 3)),
            (3, "cold", "u", D("9.00"), start, D("3.00"), "BOTH", None, datetime.datetime(2024, 1, 1)),
        ],
        WATCHLIST,
    )
    report = W.watch_report(watch, spark.createDataFrame(rows, FACTS), "2024-01-28").collect()
    assert [r.query for r in report] == ["never", "hot", "cold"]
    never, hot, cold = report
    assert never.weekly_series == [] and never.status == "nodata" and never.trend is None
    assert [p.week for p in hot.weekly_series] == ["2024-W01", "2024-W02", "2024-W03", "2024-W04"]
    assert {p.avg_position for p in hot.weekly_series} == {D("4.00")} and hot.trend == "flat"
    # Eight days: the trailing span keeps both ends.
    assert hot.current_position == D("4.38") and hot.delta == D("-4.62") and hot.status == "improved"
    assert cold.current_position is None and cold.status == "nodata" and len(cold.weekly_series) == 1


def test_watch_validation(spark):
    schema = "query string, page_url string, agency_factor_aplicado string, baseline_position decimal(6,2), target_position decimal(6,2), baseline_date date"
    good = ("q", "u", "BOTH", D("5.00"), D("3.00"), DAY)
    bad = [
        ("", "u", "BOTH", D(5), D(3), DAY), ("q", None, "BOTH", D(5), D(3), DAY), ("q", "u", "BOTH", D(0), D(3), DAY),
        ("q", "u", "BOTH", D(5), None, DAY), ("q", "u", "BOTH", D(5), D(3), None),
    ]
    odd = ("q", "u", "MAGIC", D(5), D(3), DAY)
    checked = filters.validate_watch(spark.createDataFrame([good, *bad, odd], schema)).collect()
    assert [r.rejected_reason for r in checked] == [None] + ["missing_field"] * 5 + ["unknown_factor"]


def test_means_round_half_up_exactly(spark):
    from searchlift.functions.numbers import mean_half_up

    df = spark.createDataFrame([(D("1.00"),), (D("1.01"),), (None,)], "v decimal(8,2)")
    assert df.agg(mean_half_up(F.col("v"), 2, 2)).first()[0] == D("1.01")
    assert df.where("false").agg(mean_half_up(F.col("v"), 2, 2)).first()[0] is None


def test_seed_keeps_present_rows(spark):
    seeds = gaps.seed_rows(spark.createDataFrame([fact("a", "u", "3.00"), fact("b", "u", "3.00")], FACTS))
    present = seeds.where("query = 'a'").withColumn("agency_factor", F.lit("CONTENT")).withColumn("extra", F.lit(1))
    out = {r.query: (r.agency_factor, r.extra) for r in store.seed_gaps(present, seeds).collect()}
    assert out == {"a": ("CONTENT", 1), "b": ("NONE", None)}


def listed(spark, n):
    rng = random.Random(n)
    values = [None, 0, 5, 5, 5, 7] + list(range(40))
    rows = [(f"q{rng.randrange(n)}", f"u{k}", rng.choice(values)) for k in range(n)]
    rows += [("same", "same", 5)] * 30  # rows that no mark can part
    return rows, spark.createDataFrame(rows, "query string, page_url string, revenue_final long").repartition(6)


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_pages_found_by_counting_are_those_of_the_sorted_list(spark, monkeypatch, direction):
    monkeypatch.setattr(O, "SORTED_ROWS", 25)
    rows, df = listed(spark, 700)
    # Nulls are the largest value.
    key = (lambda r: (r[2] is None, r[2] or 0)) if direction == "asc" else (lambda r: (r[2] is not None, -(r[2] or 0)))
    ordered = sorted(rows, key=lambda r: (key(r), r[0], r[1]))
    for page, size in ((1, 10), (2, 10), (37, 10), (None, 10), (None, 7), (20, 33), (500, 10)):
        got = [tuple(r) for r in O.page_by_count(df, sort_key="revenue_final", sort_dir=direction, page=page, page_size=size).collect()]
        start = ((len(ordered) - 1) // size if page is None else page - 1) * size
        assert got == ordered[start : start + size], (page, size)
    assert O.page_by_count(df.limit(0), sort_key="revenue_final").collect() == []


def test_a_deep_page_sorts_few_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "SORTED_ROWS", 100)
    _, df = listed(spark, 4000)
    plan = O.page_by_count(df, sort_key="revenue_final", page=350)._jdf.queryExecution().optimizedPlan().toString()
    offsets = [int(n) for n in re.findall(r"Offset (\d+)", plan)]
    assert offsets and max(offsets) < 100


def test_order_statistics_are_those_of_the_sorted_values(spark, monkeypatch):
    monkeypatch.setattr(order_statistics, "PARTS", 5)
    rng = random.Random(2)
    values = {g: [rng.choice([0, 1, 7, 10**12, rng.randrange(10**12)]) for _ in range(200)] for g in range(4)} | {9: [3]}
    df = spark.createDataFrame([(g, v) for g, own in values.items() for v in own], "g int, v long")
    ranks = {g: {0, len(own) // 3, len(own) // 2, len(own) - 1} for g, own in values.items()}
    found = order_statistics.order_statistics(df, "g", "v", ranks, order_statistics.extent(df, "g", "v"))
    assert found == {(g, r): sorted(values[g])[r] for g, wanted in ranks.items() for r in wanted}
    assert order_statistics.extent(df.where("g > 50"), "g", "v") == {}


def test_a_curve_of_no_facts(spark):
    assert ctr_curve.calibrate_curve(spark.createDataFrame([], FACTS)).collect() == []


def test_rates_of_a_hot_page_are_spread(spark):
    rows = [("hot" if k % 2 else f"p{k}", f"q{k}") for k in range(2000)] + [("gone", f"q{k}") for k in range(500)]
    gaps_df = spark.createDataFrame(rows, "page_url string, query string").repartition(8)
    catalog = spark.createDataFrame([("hot", 1, 10)] + [(f"p{k}", 2, k) for k in range(0, 2000, 4)], "page_url string, conversion_rate int, avg_ticket int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        joined = bi.with_rates(gaps_df, catalog)
        got = joined.collect()
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    want = {"hot": (1, 10), "gone": (None, None)} | {f"p{k}": (2, k) if k % 4 == 0 else (None, None) for k in range(0, 2000, 2)}
    assert len(got) == len(rows) and all((r.conversion_rate, r.avg_ticket) == want[r.page_url] for r in got)
    assert max(sizes) <= 2 * sum(sizes) / 8
