import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from marketloom import session
from marketloom.operators.constraints import ViolationError, findings
from marketloom.plans.runner import Runner, main
from marketloom.plans.warehouse import DWH_TABLES, MARTS, STAGING_TABLES
from marketloom.sources import declared, sql_reads
from marketloom.sources.csv_files import FREE_TEXT, file_of, load_all_raw, read_csv
from marketloom.sources.files import path_exists
from marketloom.sources.layers import LayerStore, publish_views
from marketloom.sources.sample import sample_raw
from marketloom.sources.schemas import RAW_TABLES, raw_schema

from .conftest import DATA

HEAD = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_line_breaks_blanks_and_nulls(spark, tmp_path):
    body = 'r1,o1,5,"a ""q"" b\nline2","",2018-01-02 03:04:05,\n"r2",o2,,, pad ,"2018-01-02 00:00:00","2018-01-03 10:00:00.5"\nr3,o3,1,é,"x,y",,\n'
    got = [tuple(r) for r in read_csv(spark, write(tmp_path, "r.csv", HEAD + body), "order_reviews").collect()]
    assert got == [
        ("r1", "o1", 5, 'a "q" b\nline2', "", dt.datetime(2018, 1, 2, 3, 4, 5), None),
        ("r2", "o2", None, None, " pad ", dt.datetime(2018, 1, 2), dt.datetime(2018, 1, 3, 10, 0, 0, 500000)),
        ("r3", "o3", 1, "é", "x,y", None, None),
    ]


def test_csv_columns_go_by_position_and_decimals_are_rounded(spark, tmp_path):
    path = write(tmp_path, "g.csv", "anything,b,c,d,e\n01001,-23.00000005,1.00000005,x,SP\n")
    r = read_csv(spark, path, "geolocation").first()
    assert (r.geolocation_zip_code_prefix, r.geolocation_lng) == ("01001", Decimal("1.0000001"))


@pytest.mark.parametrize("line", ["a,b", "a,b,c,d,e,f,g,h,i", "r,o,five,,,,", "r,o,1,,,yesterday,"])
def test_malformed_rows_abort(spark, tmp_path, line):
    with pytest.raises((PySparkException, Py4JJavaError), match="[Mm]alformed|MALFORMED"):
        read_csv(spark, write(tmp_path, "bad.csv", HEAD + line + "\n"), "order_reviews").collect()


def test_missing_file_is_an_error_and_patterns_name_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_csv(spark, str(tmp_path / "nowhere.csv"), "orders")
    assert file_of("orders", "shop_{table}_dataset.csv") == "shop_orders_dataset.csv"
    assert file_of("orders", names={"orders": "o/*.csv"}) == "o/*.csv"
    write(tmp_path, "p1.csv", HEAD + "r,o,1,,,,\n")
    write(tmp_path, "p2.csv", HEAD + "s,o,1,,,,\n")
    assert read_csv(spark, str(tmp_path / "p*.csv"), "order_reviews").count() == 2
    assert len(RAW_TABLES) == 11


def test_failed_refresh_keeps_the_previous_run(spark, tmp_path, rows):
    store = LayerStore(spark, str(tmp_path / "layers"))
    with pytest.raises(LookupError):
        store.current("staging")
    first = store.write_layer("staging", {"a": rows("v int", (1,)), "b": rows("v int", (1,))})

    def broken():
        raise ValueError("no")

    with pytest.raises(ValueError):
        store.write_layer("staging", {"a": rows("v int", (2,)), "b": broken})
    assert store.current("staging") == first
    assert len(list((tmp_path / "layers" / "staging").iterdir())) == 1  # the partial run is gone

    def refuse(run, measured):
        assert store.read_run(run, ["a"])["a"].count() == 2 and measured == {"a": {"odd": 1, "rows": 2}}
        raise LookupError("refused")

    counts = lambda table: {"odd": F.count_if(F.col("v") % 2 == 1), "rows": F.count("*")}
    with pytest.raises(LookupError, match="refused"):
        store.write_layer("staging", {"a": rows("v int", (2,), (3,))}, refuse, counts)
    assert store.current("staging") == first and len(list((tmp_path / "layers" / "staging").iterdir())) == 1
    assert store.read("staging", "a").first().v == 1
    second = store.write_layer("staging", {"a": rows("v int", (3,)), "b": rows("v int", (3,))})
    assert store.current("staging") == second
    store.write_layer("staging", {"a": rows("v int", (4,))})
    assert store.drop_old_runs("staging", keep=2) == [first]
    assert store.read("staging", "a").first().v == 4 and not path_exists(spark, first)


def test_sql_reads(spark, rows):
    publish_views({"v": rows("a int, b string", (1, "x"), (2, "y"))}, "test")
    assert sql_reads.read_sql(spark, "SELECT b FROM test_v WHERE a = :a", {"a": 2}).first().b == "y"
    assert sql_reads.read_scalar(spark, "SELECT max(a), min(a) FROM test_v") == 2
    assert sql_reads.read_scalar(spark, "SELECT a FROM test_v WHERE a > 9") is None
    empty = sql_reads.read_sql_or_empty(spark, "SELECT * FROM no_such_view", "a int, b string")
    assert empty.dtypes == [("a", "int"), ("b", "string")] and empty.count() == 0
    assert sql_reads.read_sql_or_empty(spark, "SELECT a FROM test_v", "a int").count() == 2
    assert sql_reads.read_sql_or_empty(spark, "SELECT no_column FROM test_v", "a int").count() == 0
    for wrong in ("SELEC * FRM test_v", "SELECT explode(1)"):
        with pytest.raises(AnalysisException):
            sql_reads.read_sql_or_empty(spark, wrong, "a int")


class FakeSpark:
    """Enough of a session to see where the shared folder comes from."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"test-{id(self)}"
        self.folder = folder

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.folder or default


def test_shared_folder_comes_from_the_session():
    assert session.shared_folder(FakeSpark("yarn", "hdfs://x/ck/")) == "hdfs://x/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSpark("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSpark("local-cluster[2,1,1024]"))
    local = FakeSpark("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    assert session.new_work_folder(local, "x") != session.new_work_folder(local, "x")


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    """The sample raw layer as CSV files; order_reviews as a folder of part files."""
    folder = tmp_path_factory.mktemp("csv")
    for table, df in sample_raw(spark, DATA).items():
        df.write.options(
            header="true", escape='"', nullValue="", emptyValue='""', ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
        ).csv(f"{folder}/shop_{table}.csv")
    return str(folder)


def content(df):
    return sorted(map(str, df.collect()))


def test_all_steps_from_csv_to_quality(spark, csv_folder, tmp_path, warehouse):
    runner = Runner(spark, str(tmp_path / "wh"), csv_folder, "shop_{table}.csv", allow_violations=True)
    results = runner.run("all")
    assert [r.check_name for r in results][:2] == ["raw_orders_loaded", "dwh_fact_orders_loaded"]
    assert len(results) == 12
    for t in RAW_TABLES:
        assert runner.store.read("raw", t).schema == raw_schema(t)
    for t in ("stg_reviews", "stg_closed_deals"):
        assert content(runner.store.read("staging", t)) == content(warehouse.table(t))
    for t in ("dim_customer", "fact_orders", "fact_reviews", "fact_closed_deals"):
        assert content(runner.store.read("dwh", t)) == content(warehouse.table(t))
    for m in MARTS:
        assert content(spark.table(f"marts_{m}")) == content(warehouse.table(m))
    assert not path_exists(spark, f"{session.shared_folder(spark)}/none")

    # What the writes counted is what a reading of the tables finds, and a run holds each table once.
    for layer, names in (("raw", RAW_TABLES), ("staging", STAGING_TABLES), ("dwh", DWH_TABLES)):
        tables = runner.store.read_layer(layer, names)
        assert content(findings(layer, tables, runner.store.measured(layer))) == content(findings(layer, tables)), layer
    assert {p.name for p in Path(runner.store.current("dwh")).iterdir() if p.is_dir()} == {*DWH_TABLES, "order_days"}

    # A second run of one step replaces the layer and gives the same keys.
    before = content(runner.store.read("dwh", "fact_order_items").select("order_item_key", "order_id", "order_item_id"))
    runner.run("dwh")
    assert len(runner.store.runs("dwh")) == 2
    after = content(runner.store.read("dwh", "fact_order_items").select("order_item_key", "order_id", "order_item_id"))
    assert before == after


def test_schema_step_gives_an_empty_but_typed_warehouse(spark, tmp_path):
    runner = Runner(spark, str(tmp_path / "wh"))
    for step in ("schema", "staging", "dwh", "marts"):
        assert runner.run(step) is None
    assert runner.store.read_layer("dwh", DWH_TABLES)["fact_orders"].count() == 0
    assert len(runner.store.read_layer("staging", STAGING_TABLES)) == 11
    assert spark.table("marts_sales_overview").count() == 0
    assert [r.passed for r in runner.run("quality")][:3] == [False, False, True]
    with pytest.raises(ValueError, match="source folder"):
        runner.run("raw")
    with pytest.raises(ValueError, match="unknown step"):
        runner.run("everything")


def test_missing_source_keeps_the_raw_layer(spark, csv_folder, tmp_path):
    store = LayerStore(spark, str(tmp_path / "wh"))
    with pytest.raises(FileNotFoundError):
        load_all_raw(spark, csv_folder, store, "{table}.csv")
    assert store.runs("raw") == []


def test_command_line_runs_a_step(spark, tmp_path):
    main(["--root", str(tmp_path / "wh"), "--step", "schema"])
    assert LayerStore(spark, str(tmp_path / "wh")).read("raw", "orders").count() == 0


def test_splittable_files_give_the_same_rows_and_still_refuse_broken_ones(spark, tmp_path):
    good = write(tmp_path, "good.csv", HEAD + 'r,o,1,"a ""q"", b","",,\ns,o,2,,,,\n')
    assert content(read_csv(spark, good, "order_reviews", line_breaks=False)) == content(read_csv(spark, good, "order_reviews"))
    broken = write(tmp_path, "broken.csv", HEAD + 'r,o,1,"a\nb","",,\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_csv(spark, broken, "order_reviews", line_breaks=False).collect()


def test_marts_can_be_stored_as_a_layer(spark, tmp_path):
    runner = Runner(spark, str(tmp_path / "wh"), store_marts=True)
    for step in ("schema", "staging", "dwh", "marts"):
        runner.run(step)
    assert set(MARTS) == set(runner.store.read_layer("marts", MARTS))
    plan = spark.table("marts_sales_overview")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Aggregate" not in plan


def test_a_repeated_order_stops_the_run_and_keeps_the_previous_dwh(spark, tmp_path, rows):
    runner = Runner(spark, str(tmp_path / "wh"))
    for step in ("schema", "staging", "dwh"):
        runner.run(step)
    kept = runner.store.current("dwh")
    raw = runner.store.read_layer("raw", RAW_TABLES)
    order = spark.createDataFrame([("o1", "c1", "delivered", *[None] * 5)], raw_schema("orders"))
    runner.store.write_layer("raw", {**raw, "orders": order.unionAll(order)})
    runner.run("staging")
    with pytest.raises(ViolationError, match=r"orders: unique \(order_id\) \(1\)"):
        runner.run("dwh")
    assert runner.store.current("dwh") == kept
    runner.allow_violations = True
    runner.run("dwh")
    assert runner.store.current("dwh") != kept


def test_rules_of_every_layer_are_known_and_keys_hold_no_null(spark, rows):
    empty = {t: spark.createDataFrame([], raw_schema(t)) for t in RAW_TABLES}
    assert findings("raw", empty).count() == 0
    orders = spark.createDataFrame([(None, "c1", "x", *[None] * 5)], raw_schema("orders"))
    assert [tuple(r) for r in findings("raw", {**empty, "orders": orders}).collect()] == [("orders", "order_id not null", 1)]


def test_command_line_takes_file_names_and_marts_outlive_the_session(spark, csv_folder, tmp_path):
    root = str(tmp_path / "wh")
    named = ["--file-pattern", "none_{table}", *(x for t in RAW_TABLES for x in ("--file-name", f"{t}=shop_{t}.csv"))]
    main(["--root", root, "--source-dir", csv_folder, "--step", "raw", *named])
    with pytest.raises(SystemExit):
        main(["--root", root, "--file-name", "nothing=x"])
    for step in ("staging", "dwh", "marts"):
        main(["--root", root, "--step", step, "--allow-violations", "--catalog", "shop_marts"])
    other = spark.newSession()
    assert other.table("shop_marts.sales_overview").count() == LayerStore(other, root).read("marts", "sales_overview").count()
    assert LayerStore(other, root).read("marts", "sales_overview").count() > 0


def test_a_large_file_is_read_by_more_than_one_task(spark, tmp_path):
    lines = "".join(f"o{i},c{i},delivered,,,,,\n" for i in range(2000))
    path = write(tmp_path, "orders.csv", ",".join(raw_schema("orders").names) + "\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split = read_csv(spark, path, "orders", line_breaks="orders" in FREE_TEXT)
        assert split.rdd.getNumPartitions() > 1 and split.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stored_marts_equal_the_plans(warehouse):
    for m in MARTS:
        assert content(warehouse.mart_table(m)) == content(warehouse.table(m))
        assert warehouse.mart_table(m).dtypes == warehouse.table(m).dtypes


def test_every_table_has_its_declared_type(spark, warehouse):
    assert set(declared.TABLES) == {*STAGING_TABLES, *DWH_TABLES, *MARTS}
    for t in declared.TABLES:
        assert warehouse.table(t).dtypes == [(f.name, f.dataType.simpleString()) for f in declared.schema_of(t)], t
    with pytest.raises(TypeError, match="dim_state: declared .*state_name"):
        declared.conforming("dim_state", warehouse.dim_state.drop("state_name"))
    spark.catalog.dropTempView("marts_marketing_funnel")
    assert sql_reads.read_mart(spark, "marketing_funnel").schema == declared.schema_of("marketing_funnel")
