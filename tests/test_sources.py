"""Files, table maintenance and the incremental run."""

import datetime
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from searchlift.operators import bi, watchlist as W
from searchlift.operators.filters import ingest_filter
from searchlift.plans import scoring as P
from searchlift.schemas import FACT_KEYS, FACTS, WATCHLIST
from searchlift.sources import readers, store
from searchlift.streaming import incremental, ledger
from searchlift.suite.fixtures import Inputs
from searchlift.suite.queries import dims

DAY = datetime.date(2024, 1, 10)


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def row(query, page, clicks, position=3.0, ord=None):
    record = {"keys": [query, page], "clicks": clicks, "impressions": 100, "ctr": 0.0123456, "position": position}
    if position is None:
        del record["position"]
    if ord is not None:
        record["ord"] = ord
    return record


def test_read_one_day(spark, tmp_path):
    write_lines(tmp_path / "day.json", [row("a", "u", 1), row("b", "u", 2, None)])
    got = {r.query: r for r in readers.read_search_facts(spark, str(tmp_path / "day.json"), "2024-01-10").collect()}
    assert got["a"].date == DAY and got["a"].ctr == D("0.0123456") and got["a"].position == D("3.00")
    assert got["b"].position is None


def test_empty_day(spark, tmp_path):
    write_lines(tmp_path / "day.json", [])
    assert readers.read_search_facts(spark, str(tmp_path / "day.json"), "2024-01-10").count() == 0


def test_last_row_of_a_file_wins(spark, tmp_path):
    write_lines(tmp_path / "date=2024-01-10" / "a.json", [row("a", "u", 2, ord=1), row("a", "u", 1, ord=0)])
    facts = readers.read_search_facts(spark, str(tmp_path))
    merged = store.upsert(spark.createDataFrame([], FACTS), facts, FACT_KEYS, "landing_order")
    assert [(r.date, r.clicks) for r in merged.collect()] == [(DAY, 2)]


def test_response_documents_keep_array_order(spark, tmp_path):
    folder = tmp_path / "date=2024-01-10"
    folder.mkdir()
    (folder / "page1.json").write_text(json.dumps({"rows": [row("a", "u", 1), row("a", "u", 5), row("b", "u", 3)]}))
    facts = readers.read_search_responses(spark, str(tmp_path))
    merged = store.upsert(spark.createDataFrame([], FACTS), facts, FACT_KEYS, "landing_order")
    assert {r.query: r.clicks for r in merged.collect()} == {"a": 5, "b": 3}


def test_the_later_place_wins_without_row_numbers(spark, tmp_path):
    rows = [row(f"q{k % 50}", "u", k) for k in range(3000)]
    write_lines(tmp_path / "date=2024-01-10" / "a.json", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        landed = readers.read_search_facts(spark, str(tmp_path))
        assert landed.rdd.getNumPartitions() > 5
        got = {r.query: r.clicks for r in store.last_wins(landed, FACT_KEYS, "landing_order").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"q{k % 50}": k for k in range(2950, 3000)}


def test_a_later_batch_goes_before_file_time(spark, tmp_path):
    write_lines(tmp_path / "date=2024-01-10" / "z.json", [{**row("a", "u", 2), "batch": 2}])
    write_lines(tmp_path / "date=2024-01-10" / "late.json", [{**row("a", "u", 1), "batch": 1}])
    facts = store.last_wins(readers.read_search_facts(spark, str(tmp_path)), FACT_KEYS, "landing_order")
    assert [r.clicks for r in facts.collect()] == [2]


def test_updates_without_an_order_must_agree(spark):
    target = spark.createDataFrame([], FACTS)
    same = spark.createDataFrame([("q", "u", 1, 1, D(0), D(1), DAY)] * 3, FACTS)
    assert store.upsert(target, same, FACT_KEYS).count() == 1
    mixed = same.unionByName(spark.createDataFrame([("q", "u", 2, 1, D(0), D(1), DAY)], FACTS))
    with pytest.raises(Exception, match="name an order"):
        store.upsert(target, mixed, FACT_KEYS).collect()


def test_bi_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "bi.csv"
    path.write_text('n,Ticket Promedio,group_.two,tasa_conversion,group_.one\n7,100,moda,0.01,mujer\n8,50,"a, b",0.5,hogar\n', encoding="utf-8")
    got = {(r.dept, r["sub"], r.tasa_conversion, r.ticket_promedio) for r in readers.read_bi(spark, str(path)).collect()}
    assert got == {("mujer", "moda", 0.01, 100.0), ("hogar", "a, b", 0.5, 50.0)}
    path.write_text("group_.one,group_.two,tasa,Ticket Promedio\nmujer,moda,0.01,100\n", encoding="utf-8")
    with pytest.raises(ValueError, match="tasa_conversion"):
        readers.read_bi(spark, str(path))


def test_bi_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "bi.csv"
    path.write_text('group_.one,group_.two,tasa_conversion,Ticket Promedio\n"muj\ner",moda,0.01,100\n', encoding="utf-8")
    assert [r.dept for r in readers.read_bi(spark, str(path), multi_line=True).collect()] == ["muj\ner"]


def test_bi_csv(spark, tmp_path):
    path = tmp_path / "bi.csv"
    path.write_text(
        "group_.one,group_.two,tasa_conversion,Ticket Promedio\n"
        ' Mujer ,MODA,0.01,12abc\n\n"a|b",x,0.5,100\nmujer,moda,0.02,30.5\nhogar,z,"0,005",10\n',
        encoding="utf-8",
    )
    clean = bi.clean_bi(readers.read_bi(spark, str(path)))
    pairs = {(r.dept, r["sub"]): (r.conversion_rate, r.avg_ticket) for r in bi.bi_sub(clean).collect()}
    assert pairs == {("mujer", "moda"): (D("0.02"), 31), ("a|b", "x"): (D("0.5"), 100)}


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([("q", "u", 1, 1, D(0), D(1), DAY), ("r", "u", 1, 1, D(0), D(1), DAY)], FACTS)
    # One key holds most of the updates.
    updates = spark.createDataFrame([("q", "u", n, 1, D(0), D(1), DAY) for n in range(500)], FACTS).withColumn(
        "ord", F.col("clicks")
    )
    once = store.upsert(target, updates, FACT_KEYS, "ord")
    twice = store.upsert(once, updates, FACT_KEYS, "ord")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert {r.query: r.clicks for r in once.collect()} == {"q": 499, "r": 1}


def test_days_are_rewritten_alone(spark, tmp_path):
    path = str(tmp_path / "facts")
    other = DAY + datetime.timedelta(days=1)
    both = spark.createDataFrame([("q", "u", 1, 1, D(0), D(1), DAY), ("q", "u", 2, 1, D(0), D(1), other)], FACTS)
    store.write_days(both, path)
    update = spark.createDataFrame([("q", "u", 9, 1, D(0), D(1), other)], FACTS).withColumn("ord", F.lit(0))
    fresh = store.stage_updates(update, FACT_KEYS, "ord", str(tmp_path / "stage"))
    store.upsert_days(spark, path, fresh, store.touched_days(fresh))
    got = {r.date: r.clicks for r in store.read_table(spark, path, FACTS).collect()}
    assert got == {DAY: 1, other: 9}


def test_snapshot_versions(spark, tmp_path):
    path = str(tmp_path / "watch")
    watch = spark.createDataFrame([(1, "q", "u", D(5), DAY, D(3), "BOTH", None, datetime.datetime(2024, 1, 1))], WATCHLIST)
    store.write_snapshot(watch, path, WATCHLIST)
    again = store.read_snapshot(spark, path, WATCHLIST)
    store.write_snapshot(again.withColumn("notas", F.lit("seen")), path, WATCHLIST)
    assert [r.notas for r in store.read_snapshot(spark, path, WATCHLIST).collect()] == ["seen"]
    left, gone = store.delete_by_id(again, spark.createDataFrame([(1,), (7,)], "id bigint"))
    assert left.count() == 0 and [r.id for r in gone.collect()] == [1]


def test_watchlist_upsert_keeps_id_and_note(spark):
    old = datetime.datetime(2024, 1, 1)
    watch = spark.createDataFrame(
        [(1, "q", "u", D(5), DAY, D(3), "BOTH", "keep", old), (2, "r", "u", D(5), DAY, D(3), "BOTH", None, old)], WATCHLIST
    )
    schema = "query string, page_url string, agency_factor_aplicado string, baseline_position decimal(6,2), target_position decimal(6,2), baseline_date date, ord int"
    updates = spark.createDataFrame(
        [("q", "u", "CONTENT", D(8), D(4), DAY, 0), ("q", "u", "LINK_BUILDING", D(9), D(4), DAY, 1), ("n", "u", "BOTH", D(7), D(3), DAY, 0)],
        schema,
    )
    now = "2024-02-01 06:00:00"
    out = {r.query: r for r in store.upsert_watchlist(watch, updates, now, "ord").collect()}
    assert (out["q"].id, out["q"].notas, out["q"].agency_factor_aplicado) == (1, "keep", "LINK_BUILDING")
    assert out["q"].baseline_position == D(9) and out["q"].created_at == datetime.datetime(2024, 2, 1, 6)
    assert out["r"].created_at == old
    assert out["n"].notas is None and out["n"].id == 3
    many = spark.createDataFrame([(f"q{k:03}", "u", "BOTH", D(5), D(3), DAY, 0) for k in range(300)], schema).repartition(5)
    new = store.upsert_watchlist(watch, many, now, "ord").where(F.col("notas").isNull() & F.col("query").startswith("q"))
    assert [(r.query, r.id) for r in new.orderBy("id").collect()] == [(f"q{k:03}", k + 3) for k in range(300)]
    none = spark.createDataFrame([], WATCHLIST)
    assert [r.id for r in store.upsert_watchlist(none, updates.where("query = 'n'"), now, "ord").collect()] == [1]


def test_export_quotes_commas(spark, tmp_path):
    path = str(tmp_path / "csv")
    store.export_csv(spark.createDataFrame([("a, b", 1)], "keyword string, n int"), path)
    assert spark.read.option("header", True).csv(path).first().keyword == "a, b"


def test_an_export_keeps_its_order_over_the_parts(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(f"k{(n * 7919) % 1000:04}", "a\"b, c") for n in range(1000)]
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "false")
        store.export_csv(spark.createDataFrame(rows, "keyword string, x string").orderBy("keyword"), path)
    finally:
        spark.conf.set(conf, before)
    assert len(list((tmp_path / "csv").glob("part-*"))) > 1
    read = store.read_exported(spark, path, spark.createDataFrame(rows[:1], "keyword string, x string").schema)
    assert [(r.row_index, r.keyword, r.x) for r in read.orderBy("row_index").collect()] == [(k + 1, f"k{k:04}", "a\"b, c") for k in range(1000)]


@pytest.fixture(scope="module")
def month(spark, folder):
    return Inputs(spark, folder)


def test_backfill_is_the_union_of_days(spark, month):
    facts = month.view("fx_facts")
    days = ["2024-01-10", "2024-01-11"]
    both = P.score_day(facts.where(F.col("date").isin(days)), dims(month))
    one_by_one = P.score_day(facts, dims(month), days[0]).unionByName(P.score_day(facts, dims(month), days[1]))
    assert sorted(map(str, both.collect())) == sorted(map(str, one_by_one.collect()))


def test_staged_and_lazy_scores_agree(spark, month, tmp_path):
    facts = month.view("fx_facts")
    lazy = P.score_day(facts, dims(month))
    staged = P.score_day(facts, dims(month), stage=str(tmp_path / "stage"))
    assert sorted(map(str, lazy.collect())) == sorted(map(str, staged.collect()))


def test_catalog_and_derived_rates_agree(spark, month):
    facts = ingest_filter(month.view("fx_facts"))
    derived = dims(month)
    catalog = bi.cascade(bi.seed_catalog(month.view("fx_facts")), derived.business)
    stored = P.Dimensions(derived.curve, derived.params, derived.terms, catalog=catalog)
    assert sorted(map(str, P.score(facts, derived).collect())) == sorted(map(str, P.score(facts, stored).collect()))


def test_score_properties(spark, month):
    rows = P.score_day(month.view("fx_facts"), dims(month)).collect()
    by_date = {}
    for r in rows:
        by_date.setdefault(r.date, []).append(r)
        if r.opportunity_score is not None:
            assert 0 <= r.opportunity_score <= 100
        if r.agency_factor == "NONE":
            assert r.delta_clicks == 0 and not r.revenue_final
        if r.is_branded:
            assert (r.agency_factor, r.ctr_gap, r.revenue_final, r.opportunity_score) == ("NONE", 0, None, None)
    for group in by_date.values():
        if any(r.raw_score and r.raw_score > 0 for r in group):
            assert max(r.opportunity_score for r in group if r.opportunity_score is not None) == 100


PAGE = "https://www.shop.cl/small/brand-1/"


def impressions(spark, tables):
    return {(str(r.date), r.query): r.impressions for r in incremental.read_gaps(spark, tables).collect()}


def test_incremental_run(spark, month, tmp_path):
    tables = incremental.Tables.below(str(tmp_path))
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")

    def run():
        counted = incremental.run_incremental(spark, str(landing), tables, dims(month), checkpoint)
        return {(r.table, str(r.date)): {k: n for k, n in r.counts.items() if n} for r in counted.collect()}

    first = [row("a", PAGE, 1), row("b", PAGE, 1), row("b", PAGE, 1), row("tienda paris", PAGE, 1), row("c", PAGE + "search", 1)]
    write_lines(landing / "date=2024-01-10" / "one.json", first)
    write_lines(landing / "date=2024-01-11" / "one.json", [row("a", PAGE, 1)])
    write_lines(landing / "date=2024-01-12" / "one.json", [row("tienda paris", PAGE, 1)])  # a day without a kept row
    expected = {("2024-01-10", "a"): 100, ("2024-01-10", "b"): 100, ("2024-01-11", "a"): 100}
    counted = run()
    assert impressions(spark, tables) == expected
    assert counted["landed", "2024-01-10"] == {"kept": 3, "branded": 1, "page": 1}
    assert counted["landed", "2024-01-12"] == {"branded": 1}
    assert counted["gaps", "2024-01-10"]["diagnosed"] == 2 and ("gaps", "2024-01-12") not in counted
    assert run() == {} and impressions(spark, tables) == expected
    # A late correction replaces its key and leaves the other day's file alone.
    write_lines(landing / "date=2024-01-10" / "two.json", [{**row("a", PAGE, 2), "impressions": 500}])
    assert set(run()) == {("landed", "2024-01-10"), ("gaps", "2024-01-10")}
    assert impressions(spark, tables) == {**expected, ("2024-01-10", "a"): 500}
    batch = P.score(incremental.read_facts(spark, tables), dims(month))
    streamed = incremental.read_gaps(spark, tables).select(batch.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    weeks = W.weekly_sums(incremental.read_facts(spark, tables))
    assert sorted(map(str, incremental.read_weeks(spark, tables).collect())) == sorted(map(str, weeks.collect()))
    assert ledger.drop_superseded(spark, tables.facts, tables.ledger, "facts") == 1
    assert impressions(spark, tables) == {**expected, ("2024-01-10", "a"): 500}
    assert sorted(map(str, incremental.read_facts(spark, tables).collect())) == sorted(map(str, incremental.read_facts(spark, tables).collect()))


def written(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*.parquet"))


def test_a_batch_that_fails_between_its_writes_changes_nothing(spark, month, tmp_path, monkeypatch):
    tables = incremental.Tables.below(str(tmp_path / "tables"))
    write_lines(tmp_path / "landing" / "date=2024-01-10" / "one.json", [row("a", PAGE, 1)])
    incremental.process_batch(readers.read_search_facts(spark, str(tmp_path / "landing")), tables, dims(month), "s", 0)
    before = impressions(spark, tables)
    write_lines(tmp_path / "next" / "date=2024-01-10" / "two.json", [{**row("a", PAGE, 2), "impressions": 500}, row("b", PAGE, 1)])
    batch = readers.read_search_facts(spark, str(tmp_path / "next"))
    for name in ("score_staged", "weekly_sums"):  # after the facts, and after facts and gaps
        with monkeypatch.context() as patch:
            patch.setattr(incremental, name, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                incremental.process_batch(batch, tables, dims(month), "s", 1)
        assert impressions(spark, tables) == before and incremental.read_facts(spark, tables).count() == 1
    incremental.process_batch(batch, tables, dims(month), "s", 1)
    after = {("2024-01-10", "a"): 500, ("2024-01-10", "b"): 100}
    assert impressions(spark, tables) == after
    files = written(tmp_path / "tables")
    incremental.process_batch(batch, tables, dims(month), "s", 1)  # a finished batch writes nothing
    assert written(tmp_path / "tables") == files and impressions(spark, tables) == after
    incremental.process_batch(batch, tables, dims(month), "other", 1)  # the same id of another stream is another batch
    assert written(tmp_path / "tables") != files and impressions(spark, tables) == after
