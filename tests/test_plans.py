"""Plans keep the shape that holds at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from searchlift.operators import dimensions as dim
from searchlift.operators import filters, gaps, opportunities as O, watchlist as W
from searchlift.plans import scoring as P
from searchlift.sources import store
from searchlift.suite.fixtures import Inputs
from searchlift.suite.queries import dims


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts"))
    store.write_days(Inputs(spark, folder).view("fx_fine"), path)
    return spark.read.parquet(path)


def test_section_filter_reaches_the_scan(stored):
    text = plan(filters.in_section(stored, ".cl/small/").select("query"))
    assert "StringContains(page,.cl/small/)" in text
    assert "impressions" not in text.split("ReadSchema")[1].split("\n")[0]


def test_newest_date_is_a_partition_filter(stored):
    text = plan(dim.snapshot(stored).select("query"))
    assert "PartitionFilters: [isnotnull(date" in text and "Subquery" in text.split("PartitionFilters")[1]


def test_no_file_is_read_for_the_newest_date(stored):
    newest = dim.snapshot(stored).select("query")._jdf.queryExecution().executedPlan().toString()
    assert newest.count("FileScan") == 1 and "LocalTableScan [date" in newest.split("Subquery subquery")[-1]
    assert dim.snapshot(stored).select("date").distinct().collect() == stored.agg(F.max(F.col("date").cast("string")).cast("date").alias("date")).collect()
    # Behind a filter of rows the date depends on what the files hold.
    kept = dim.snapshot(filters.ingest_filter(stored)).select("query")._jdf.queryExecution().executedPlan().toString()
    assert kept.count("FileScan") == 2


def test_explicit_date_prunes(stored):
    assert "PartitionFilters" in plan(dim.snapshot(stored, "2024-01-10"))


def test_scoring_a_stored_table_shuffles_no_facts(spark, folder, stored):
    raw = P.score_raw(filters.ingest_filter(stored), dims(Inputs(spark, folder)))
    text = plan(raw)
    # Curve, params and rates are broadcast; the fact rows themselves are never exchanged.
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    exchanged = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert exchanged and not any("page_url" in line or "query" in line for line in exchanged)


def test_normalise_uses_no_window(spark, stored):
    raw = gaps.seed_rows(stored).withColumn("raw_score", F.col("impressions").cast("decimal(29,4)"))
    text = plan(gaps.normalise(raw))
    assert "Window" not in text and "BroadcastHashJoin" in text and "partial_max" in text


def test_pages_are_top_k(spark, folder, tmp_path):
    i = Inputs(spark, folder)
    scored = P.score_day(i.view("fx_facts"), dims(i), stage=str(tmp_path / "stage"))
    text = plan(O.opportunities(scored))
    assert "TakeOrderedAndProject" in text
    assert "PartitionFilters: [isnotnull(date" in text


def test_watch_report_reads_the_facts_once(spark, folder, stored):
    watch = Inputs(spark, folder).view("fx_watch")
    text = plan(W.position_history(stored, watch, "2024-01-28"))
    facts_scans = [line for line in text.splitlines() if "ReadSchema" in line and "position" in line]
    assert len(facts_scans) == 1


def test_aggregates_combine_before_the_shuffle(stored):
    for df in (W.weekly_position(stored), filters.ingest_report(stored)):
        text = plan(df)
        assert "partial_" in text and "SortAggregate" not in text


def written_plan(spark, run):
    """Physical plans of what `run` executes, from the session's own listener-free log of queries."""
    out = []
    original = type(spark.range(1).write).parquet

    def spy(self, *args, **options):
        out.append(plan(self._df))
        return original(self, *args, **options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1).write), "parquet", spy)
        run()
    return out


def test_staging_a_stored_table_exchanges_no_fact_rows(spark, folder, stored, tmp_path):
    (text,) = written_plan(spark, lambda: P.score_day(stored, dims(Inputs(spark, folder)), stage=str(tmp_path / "stage")))
    exchanged = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert not any("page_url" in line or "query" in line or "date" in line for line in exchanged)


def test_a_batch_is_parsed_and_reduced_once(spark, folder, stored, tmp_path):
    from searchlift.schemas import FACT_KEYS

    updates = filters.ingest_filter(stored).withColumn("ord", F.col("clicks"))
    plans = written_plan(spark, lambda: store.stage_updates(updates, FACT_KEYS, "ord", str(tmp_path / "stage")))
    assert len(plans) == 1 and plans[0].count("Scan parquet") <= 2  # named in the tree and in the details
    fresh = store.read_table(spark, str(tmp_path / "stage"), updates.drop("ord").schema)
    assert "max_by" not in plan(store.put(stored, fresh, FACT_KEYS))


def test_a_landed_batch_is_parsed_once_and_counted(spark, folder, stored, tmp_path):
    from searchlift.streaming import incremental
    from searchlift.sources import readers
    from searchlift.suite.queries import land

    land(stored, str(tmp_path / "landing"))
    batch = readers.read_search_facts(spark, str(tmp_path / "landing"))
    tables = incremental.Tables.below(str(tmp_path / "tables"))
    plans = written_plan(spark, lambda: incremental.process_batch(batch, tables, dims(Inputs(spark, folder)), "s", 0))
    parsed = [text for text in plans if "Scan json" in text]
    assert len(plans) > 3 and len(parsed) == 1 and parsed[0].count("ReadSchema") == 1
    counts = {(r.date, reason): n for r in incremental.accounting(spark, tables).where("table = 'landed'").collect() for reason, n in r.counts.items()}
    assert counts == {(r.date, r.reason): r.n for r in filters.ingest_report(stored).collect()}
    steps = {r.date: r.counts for r in incremental.accounting(spark, tables).where("table = 'gaps'").collect()}
    report = gaps.scoring_report(incremental.read_gaps(spark, tables)).collect()
    assert steps == {r.date: {k: v for k, v in r.asDict().items() if k != "date"} for r in report}


def test_a_report_from_weeks_reads_few_days_of_facts(spark, folder, tmp_path):
    i = Inputs(spark, folder)
    facts = filters.ingest_filter(i.view("fx_fine"))
    store.write_days(facts, str(tmp_path / "facts"))
    store.write_days(W.weekly_sums(facts), str(tmp_path / "weeks"))
    days, weeks = spark.read.parquet(str(tmp_path / "facts")), spark.read.parquet(str(tmp_path / "weeks"))
    text = plan(W.watch_report_of(i.view("fx_watch"), weeks, days, "2024-01-28"))
    details = text.split("(1) ")[-1]
    scans = [part for part in details.split("\n\n") if "Location" in part and str(tmp_path / "facts") in part]
    assert len(scans) == 1 and "(date" in scans[0] and "2024-01-21" in scans[0].split("PartitionFilters")[1]
    sums = W.merged_sums(W.weekly_sums(facts.where("date <= '2024-01-10'")), W.weekly_sums(facts.where("date > '2024-01-10'")))
    assert sorted(map(str, sums.collect())) == sorted(map(str, W.weekly_sums(facts).collect()))


def test_an_upsert_into_buckets_moves_no_row_of_the_target(spark, stored, tmp_path):
    from searchlift.schemas import FACT_KEYS
    from searchlift.sources import bucketed

    conf = {bucketed.CO_LOCATED: "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in conf}
    for name in ("facts_b", "updates_b"):
        bucketed.create_facts_table(spark, name, str(tmp_path / name), 5)
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        days = store.touched_days(stored.where("date > '2024-01-20'"))
        whole = store.on_days(stored, days).withColumn("clicks", F.col("clicks") + 1)
        bucketed.write_bucketed(stored, "facts_b")
        bucketed.write_bucketed(whole, "updates_b")
        assert bucketed.buckets_of(spark, "facts_b") == 5
        text = plan(bucketed.upserted(spark, "facts_b", "updates_b", days))
        assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
        again = whole.withColumn("ord", F.lit(0)).unionByName(whole.withColumn("clicks", F.col("clicks") + 1).withColumn("ord", F.lit(1)))
        bucketed.upsert_table(spark, "facts_b", again, "ord")
        got = sorted(map(str, spark.table("facts_b").collect()))
        want = store.upsert(stored, again, FACT_KEYS, "ord").select(spark.table("facts_b").columns)
        assert got == sorted(map(str, want.collect()))
        assert spark.catalog.listTables(pattern="facts_b_*") == []
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        for name in ("facts_b", "updates_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_share_of_max_uses_no_window(stored):
    rows = stored.select(F.col("clicks").alias("revenue_final"), "query")
    assert "Window" not in plan(O.share_of_max(rows)) and "SinglePartition" not in plan(O.share_of_max(rows)).split("Subquer")[0]


def test_brand_terms_are_looked_up_without_an_exchange_of_rows(spark, stored):
    from searchlift.operators.branding import flag_branded

    terms = spark.createDataFrame([("hot",)], "term string")
    text = plan(flag_branded(stored, terms).select("query", "is_branded"))
    assert "brand_index" not in text.split("Subqueries")[0] and "hashpartitioning(query" not in text


def test_a_bound_on_positions_reaches_the_scan(spark, stored):
    rows = stored.withColumnRenamed("position", "avg_position")
    assert "LessThanOrEqual(position,9.9999" in plan(O.by_max_position(rows, "9.9999 or so"))
