"""Large facts are built in ranges of their first order column, and shuffle files go with their statement."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketloom import session
from marketloom.operators.constraints import findings
from marketloom.operators.surrogate import ROW_NO, numbered
from marketloom.plans import warehouse as plans
from marketloom.plans.runner import Runner
from marketloom.plans.warehouse import DWH_TABLES, MARTS, Warehouse
from marketloom.sources.sample import sample_raw

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def in_parts(monkeypatch):
    monkeypatch.setattr(plans, "ROWS_AT_ONCE", 400)


def content(df):
    return sorted(map(str, df.collect()))


def test_facts_and_marts_built_in_parts_are_those_built_at_once(spark, warehouse, in_parts):
    anew = Warehouse(spark, sample_raw(spark, DATA))
    anew.prepare(DWH_TABLES)
    for fact, staged in plans.IN_PARTS.items():
        parts = anew.rows(fact).select(F.shiftright("__position", 57)).distinct().count()
        assert parts == min(plans.PARTS, -(-anew.table(staged).count() // 400)) > 1, fact
        assert content(anew.table(fact)) == content(warehouse.table(fact)), fact
    for mart in MARTS:
        assert content(anew.table(mart)) == content(warehouse.table(mart)), mart


def test_counts_observed_by_the_writes_of_all_parts_are_added_up(spark, in_parts, tmp_path):
    runner = Runner(spark, str(tmp_path / "wh"), allow_violations=True)
    runner.store.write_layer("raw", sample_raw(spark, DATA))
    for step in ("staging", "dwh"):
        runner.run(step)
    tables, measured = runner.store.read_layer("dwh", DWH_TABLES), runner.store.measured("dwh")
    assert content(findings("dwh", tables, measured)) == content(findings("dwh", tables))
    assert measured["fact_reviews"]["review_score BETWEEN 1 AND 5"] > 1


def shuffle_files(spark):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath()
    return {p.name for p in Path(folder).glob("*/shuffle_*")}


def test_what_a_statement_shuffled_goes_with_it(spark, setting, tmp_path):
    setting(session.CLEANUP_SETTING, "false")
    spark.conf.unset(session.CLEANUP_SETTING)
    Warehouse(spark, {})
    before = shuffle_files(spark)
    spark.range(1000).repartition(4, "id").groupBy("id").count().write.parquet(str(tmp_path / "out"))
    assert shuffle_files(spark) <= before


def test_a_setting_of_the_session_stands(spark, setting):
    setting(session.CLEANUP_SETTING, "false")
    Warehouse(spark, {})
    assert spark.conf.get(session.CLEANUP_SETTING) == "false"


def test_items_are_numbered_without_a_hash(spark, rows):
    assert numbered(rows("a int", (1,)), hashed=False).columns == ["a", ROW_NO]
