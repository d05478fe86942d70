"""Expressions on hand-made values, every threshold from both sides."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from searchlift.functions import numbers as N
from searchlift.functions import scoring as S
from searchlift.functions import text as X
from searchlift.functions import tracking as K


def lit(value, kind):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize(
    "impressions,position,actual,expected,factor",
    [
        (199, "3.00", "0.00", "0.10", "NONE"),
        (200, "3.00", "0.00", "0.10", "CONTENT"),
        (200, "5.00", "0.00", "0.06", "CONTENT"),
        (200, "5.00", "0.06", "0.06", "NONE"),
        (200, "5.01", "0.00", "0.06", "BOTH"),
        (200, "5.50", "0.06", "0.06", "LINK_BUILDING"),
        (200, "10.00", "0.01", "0.03", "BOTH"),
        (200, "10.00", "0.03", "0.03", "LINK_BUILDING"),
        (1000, "10.01", "0.00", "0.03", "NONE"),
        (1001, "10.01", "0.00", "0.03", "LINK_BUILDING"),
        (1001, "20.00", "0.50", "0.01", "LINK_BUILDING"),
        (5000, None, "0.00", "0.00", "LINK_BUILDING"),
        (500, None, "0.00", "0.00", "NONE"),
        (None, "3.00", "0.00", "0.10", "CONTENT"),
        (500, "3.00", None, "0.10", "NONE"),
        (500, "8.00", None, "0.10", "LINK_BUILDING"),
    ],
)
def test_classify(one, impressions, position, actual, expected, factor):
    column = S.classify_factor(
        lit(impressions, "bigint"), lit(position, "decimal(8,2)"),
        lit(actual, "decimal(12,6)"), lit(expected, "decimal(12,6)"),
    )
    assert one(column) == factor


@pytest.mark.parametrize(
    "position,factor,target",
    [
        ("12.00", "LINK_BUILDING", "6.50"),
        ("8.50", "LINK_BUILDING", "3.00"),
        ("8.51", "LINK_BUILDING", "3.01"),
        ("10.60", "BOTH", "3.10"),
        ("6.00", "BOTH", "3.00"),
        ("4.00", "CONTENT", "4.00"),
        ("4.00", "NONE", "4.00"),
        ("4.00", "OTHER", "4.00"),
        (None, "LINK_BUILDING", None),
    ],
)
def test_target_position(one, position, factor, target):
    value = one(S.target_position(lit(position, "decimal(8,2)"), F.lit(factor)))
    assert value == (D(target) if target else None)


@pytest.mark.parametrize(
    "position,band,weight",
    [("5.00", "top", "1.0"), ("5.01", "mid", "0.8"), ("10.00", "mid", "0.8"), ("10.01", "deep", "0.5"), (None, "deep", "0.5")],
)
def test_bands_and_weights(one, position, band, weight):
    column = lit(position, "decimal(8,2)")
    assert one(S.position_band(column)) == band
    assert one(S.position_weight(column)) == D(weight)


def test_delta_clicks_rounds_half_up_and_never_falls_below_zero(one):
    def clicks(impressions, target, actual):
        return one(S.delta_clicks(F.lit(impressions), lit(target, "decimal(19,9)"), lit(actual, "decimal(12,6)")))

    assert clicks(1000, "0.0105", "0.01") == 1
    assert clicks(1000, "0.010499999", "0.01") == 0
    assert clicks(1000, "0.01", "0.02") == 0
    assert clicks(1000, "0.01", None) == 0
    assert clicks(10**15, "0.100000001", "0.1") == 10**6


def test_revenue_is_exact(one):
    def pesos(clicks, rate, ticket):
        return one(S.revenue(F.lit(clicks).cast("bigint"), lit(rate, "decimal(18,12)"), F.lit(ticket).cast("bigint")))

    assert pesos(1, "0.5", 1) == 1
    assert pesos(1, "0.499999999999", 1) == 0
    assert pesos(3, "0.001", 500) == 2
    assert pesos(0, "0.5", 1000) == 0
    assert pesos(None, "0.5", 1000) is None


def test_golden_rows(spark):
    """Published rows: revenue is clicks x 4625 and the score its share of the best."""
    clicks = [452, 284, 283, 280, 235]
    rows = spark.createDataFrame([(c,) for c in clicks], "delta_clicks bigint").withColumns(
        {
            "revenue_final": S.revenue(F.col("delta_clicks"), lit("0.05", "decimal(18,12)"), lit(92500, "bigint")),
        }
    )
    raw = S.raw_score(F.col("revenue_final"), lit("0.75", "decimal(6,3)"), lit("7.77", "decimal(8,2)"))
    from searchlift.operators.gaps import normalise

    scored = normalise(rows.withColumn("raw_score", raw).withColumn("date", F.lit("2026-05-28").cast("date")))
    out = scored.orderBy(F.desc("delta_clicks")).collect()
    assert [r.revenue_final for r in out] == [2090500, 1313500, 1308875, 1295000, 1086875]
    assert [r.opportunity_score for r in out] == [D("100.00"), D("62.83"), D("62.61"), D("61.95"), D("51.99")]


def test_whatif_score_caps_and_needs_a_best(one):
    def score(raw, best):
        return one(S.whatif_score(lit(raw, "decimal(29,4)"), lit(best, "decimal(29,4)")))

    assert score("50", "100") == 50.0
    assert score("500", "100") == 100.0
    assert score("500", None) == 0.0
    assert score("500", "0") == 0.0


def test_target_improves(one):
    def improves(target, baseline):
        return one(S.target_improves(lit(target, "decimal(8,2)"), lit(baseline, "decimal(8,2)")))

    assert improves("4.94", "5.00") is True
    assert improves("4.95", "5.00") is False


@pytest.mark.parametrize(
    "text,value",
    [
        ("12abc", 12.0), ("0,005", 0.0), ("  3.5 ", 3.5), ("-2", -2.0), (".5x", 0.5), ("1e3kg", 1000.0),
        ("1e", 1.0), ("5.", 5.0), ("", 0.0), ("abc", 0.0), ("+7", 7.0), (" 9", 9.0), ("--1", 0.0),
        ("Infinityx", float("inf")), ("0.005392863043597986", 0.005392863043597986),
    ],
)
def test_loose_number(one, text, value):
    assert one(N.loose_number(F.lit(text))) == value


def test_loose_number_of_null(one):
    assert one(N.loose_number(F.lit(None).cast("string"))) == 0.0


@pytest.mark.parametrize(
    "query,hit",
    [
        ("tienda paris", True), ("PARIS", True), ("comparison", True), ("almacenamiento", True), ("parís", True),
        ("PARÍS", True), ("aris", True), ("la aris 2", True), ("áaris", True), ("arista", False), ("aris_x", False),
        ("notebook", False), ("pari", False), ("", False),
    ],
)
def test_brand_regex(one, query, hit):
    assert one(X.is_branded_regex(F.lit(query))) is hit


@pytest.mark.parametrize(
    "url,dept,cat,label,path",
    [
        ("https://www.shop.cl/Tecnologia/Celulares/", "tecnologia", "celulares", "Celulares", "/Tecnologia/Celulares"),
        ("https://www.shop.cl/small/", "small", "", "(sin subcategoría)", "/small"),
        ("https://www.shop.cl/", "", "", "(sin subcategoría)", "/"),
        ("https://www.shop.cl", "", "", "(sin subcategoría)", "/"),
        ("http://a.example.com/x/y", "", "", "(sin subcategoría)", "/x/y"),
    ],
)
def test_urls(one, url, dept, cat, label, path):
    column = F.lit(url)
    assert one(X.department(column)) == dept
    assert one(X.category_l1(column)) == cat
    assert one(X.subcategory(column)) == label
    assert one(X.url_path(column)) == path


def test_labels(one):
    assert one(X.normalise_label(F.lit("   Ropa MUJER\t"))) == "ropa mujer"
    assert one(X.normalise_label(F.lit(None).cast("string"))) == ""
    assert one(X.is_soft_department(F.lit("mujer"))) is True
    assert one(X.is_soft_department(F.lit("muebles"))) is False


@pytest.mark.parametrize(
    "day,week", [("2024-12-31", "2025-W01"), ("2021-01-03", "2020-W53"), ("2024-01-01", "2024-W01"), ("2024-03-10", "2024-W10")]
)
def test_iso_week(one, day, week):
    assert one(K.iso_week(F.lit(day).cast("date"))) == week


@pytest.mark.parametrize(
    "delta,status", [(None, "nodata"), ("-0.51", "improved"), ("-0.50", "stable"), ("0.50", "stable"), ("0.51", "worsened")]
)
def test_delta_status(one, delta, status):
    assert one(K.delta_status(lit(delta, "decimal(8,2)"))) == status


@pytest.mark.parametrize(
    "first,last,n,way", [("5.00", "4.89", 2, "up"), ("5.00", "4.90", 2, "flat"), ("5.00", "5.11", 2, "down"), ("5.00", "1.00", 1, None)]
)
def test_trend(one, first, last, n, way):
    assert one(K.trend(lit(first, "decimal(8,2)"), lit(last, "decimal(8,2)"), F.lit(n))) == way


def test_calendar(one):
    import datetime

    days = one(K.backfill_dates(F.lit("2024-03-10").cast("date")))
    assert len(days) == 57
    assert days[0] == datetime.date(2024, 1, 10) and days[-1] == datetime.date(2024, 3, 6)
    assert one(K.consolidated_date(F.lit("2024-03-02").cast("date"))) == datetime.date(2024, 2, 28)


@pytest.mark.parametrize("text,number,whole", [("9.5abc", 9.5, 9), ("1000.5", 1000.5, 1000), ("1e3", 1000.0, 1), (" 12", 12.0, 12), ("-3", -3.0, -3), ("abc", None, None), ("", None, None), (None, None, None), (7, 7.0, 7)])
def test_leading_numbers(text, number, whole):
    assert (N.leading_number(text), N.leading_integer(text)) == (number, whole)
