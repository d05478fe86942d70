"""Every registered query against its check SQL on the small tables."""

import glob
import json
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import table
from searchlift.schemas import FACT_KEYS
from searchlift.sources import readers, store
from searchlift.suite import oracles, queries
from searchlift.suite.fixtures import Inputs
from searchlift.suite.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(oracles.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_check_sql(spark, duck, key):
    df = entry.queries()[key](spark, SMALL)
    assert {f.dataType.typeName() for f in df.schema.fields} <= {"long", "double", "date", "string"}
    mine = table(df.collect(), df.columns)
    result = duck.execute(oracles.oracle_sql()[key])
    theirs = table(result.fetchall(), [d[0] for d in result.description])
    assert mine == theirs
    assert mine[0], "the query should return rows"


def test_landed_copies_are_spread_and_stay_together(spark, tmp_path):
    rows = queries._twice(Inputs(spark, SMALL))
    assert "SinglePartition" not in rows._jdf.queryExecution().toString() and "RoundRobin" not in rows._jdf.queryExecution().toString()
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        queries.land(rows, str(tmp_path / "landing"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for day in glob.glob(f"{tmp_path}/landing/date=*"):
        files = glob.glob(f"{day}/*.json")
        assert len(files) > 1
        for path in files:
            with open(path, encoding="utf-8") as lines:
                clicks = {}
                for row in map(json.loads, lines):
                    clicks.setdefault(tuple(row["keys"]), []).append(row["clicks"])
            assert all(len(own) == 2 and own[1] == own[0] + 1 for own in clicks.values())


def test_the_landed_month_broadcasts_no_part(spark):
    i = Inputs(spark, SMALL)
    month = queries._joined_apart(i)
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    assert sorted(map(str, month.collect())) == sorted(map(str, queries.facts(i).collect()))


def test_terms_of_texts_are_cut_without_splitting_the_texts(spark):
    texts = ["", " ", "oneword", "secondword", "a secondword", "a secondword b c", "a  thirdword", " leading word", "a secondword ", "a\nlongline b", None]
    i = Inputs(spark, SMALL)
    i.keep("documents", lambda: spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    _, terms = queries._brand_words(i)
    second = [(t or "").split(" ")[1:2] for t in texts]
    assert sorted(r.term for r in terms.collect()) == sorted(w[0] for w in second if w and len(w[0]) >= 6)
    plan = terms._jdf.queryExecution().optimizedPlan().toString()
    assert "split_part(" not in plan.replace("split_part(substring_index(", "") and "split(text" not in plan
    assert "substring_index(text" in plan


def test_a_day_of_responses_lies_in_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "RESPONSE_ROWS", 50)
    kept = queries.kept(Inputs(spark, SMALL))
    queries.land_responses(kept, str(tmp_path / "landing"))
    assert all(len(glob.glob(f"{day}/*.txt")) > 1 for day in glob.glob(f"{tmp_path}/landing/date=*"))
    landed = readers.read_search_responses(spark, str(tmp_path / "landing"))
    assert landed.count() == 2 * kept.count()
    last = store.last_wins(landed, FACT_KEYS, "landing_order").select("date", "query", "page", "clicks")
    assert sorted(map(str, last.collect())) == sorted(map(str, kept.select("date", "query", "page", (kept.clicks + 2).alias("clicks")).collect()))
