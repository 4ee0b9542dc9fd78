import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators.surrogate import ROW_HASH, ROW_NO, dense_key, keyed_rows, numbered, ranges, read_keyed, write_keyed
from marketloom.session import new_work_folder


@pytest.fixture
def many_slices(setting):
    """Keep every range partition instead of merging small ones."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_key_is_the_rank_over_several_slices(spark, rows, many_slices):
    keys = [f"k{random.Random(7).random()}{i}" for i in range(3000)]
    df = rows("k string, v int", *[(k, i) for i, k in enumerate(keys)]).repartition(5)
    path = new_work_folder(spark, "test")
    out = dense_key(df, "key", ["k"], path)
    assert len(spark.read.parquet(f"{path}/rows").inputFiles()) > 1
    got = {r.k: r.key for r in out.collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_key_is_the_same_again_and_for_other_partitionings(spark, rows, many_slices):
    df = rows("k int", *[(i * 7 % 1009,) for i in range(1009)])
    runs = [
        sorted((r.k, r.key) for r in dense_key(d, "key", ["k"], new_work_folder(spark, "test")).collect())
        for d in (df, df.repartition(3), df.orderBy("k"))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_nulls_come_last_and_empty_input_works(spark, rows):
    df = rows("k string", ("b",), (None,), ("a",))
    got = {r.k: r.key for r in dense_key(df, "key", ["k"], new_work_folder(spark, "test")).collect()}
    assert got == {"a": 1, "b": 2, None: 3}
    none = dense_key(df.where("false"), "key", ["k"], new_work_folder(spark, "test"))
    assert none.columns == ["key", "k"] and none.count() == 0


def test_hot_natural_key_is_split_by_the_remaining_columns(spark, rows, many_slices):
    df = rows("order_id string, item int", *[("hot", i) for i in range(2000)], *[(f"o{i}", 1) for i in range(1000)])
    path = new_work_folder(spark, "test")
    out = dense_key(df, "key", ["order_id", "item"], path)
    assert sorted(r.key for r in out.select("key").collect()) == list(range(1, 3001))
    hot_files = spark.read.parquet(f"{path}/rows").where("order_id = 'hot'").select("_metadata.file_name").distinct().count()
    assert hot_files > 1


def test_identical_rows_are_all_kept_and_spread(spark, rows, many_slices):
    df = rows("a string, b int", *[("same", 1)] * 9000, ("x", None), ("x", None), ("y", 2)).repartition(4)
    path = new_work_folder(spark, "test")
    keyed = dense_key(numbered(df), "key", ["a", "b"], path)
    assert keyed.columns == ["key", "a", "b"]
    got = sorted(map(tuple, keyed.collect()))
    assert [g[0] for g in got] == list(range(1, 9004))
    assert [g[1:] for g in got] == [("same", 1)] * 9000 + [("x", None)] * 2 + [("y", 2)]
    assert spark.read.parquet(f"{path}/rows").where("a = 'same'").select("_metadata.file_name").distinct().count() > 1


def test_a_broken_key_with_a_third_of_all_rows_is_split_and_ranked_alike_on_reruns(spark, rows, many_slices):
    data = [("hot" if i % 3 == 0 else f"o{i}", 1, i % 7, f"v{i % 50}") for i in range(9000)]
    df = rows("order_id string, seq int, kind int, value string", *data)
    runs = []
    for parts in (3, 8):
        path = new_work_folder(spark, "test")
        out = dense_key(numbered(df.repartition(parts)), "key", ["order_id", "seq"], path)
        runs.append(sorted(map(str, out.collect())))
        slices = [r["count"] for r in keyed_rows(spark, path).groupBy(F.shiftright("__position", 33)).count().collect()]
        assert max(slices) <= 2 * sorted(slices)[len(slices) // 2] and len(slices) == 8
    assert runs[0] == runs[1] and len(runs[0]) == 9000


def test_rows_are_read_without_a_shuffle_and_hidden_columns_only_if_asked(spark, rows, many_slices):
    df = rows("k int, year int", *[(i, 1990 + i % 3) for i in range(500)])
    path = new_work_folder(spark, "test")
    write_keyed(df, "key", ["k"], path, hidden=["year"], split_by="year")
    out = read_keyed(spark, path)
    assert out.columns == ["key", "k"] and [r.key for r in out.orderBy("k").collect()] == list(range(1, 501))
    whole = read_keyed(spark, path, hidden=True)
    assert whole.columns == ["key", "k", "year"]
    one = whole.where("year = 1991")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "PartitionFilters: [isnotnull(year" in plan
    assert sorted(r.key for r in one.collect()) == list(range(2, 501, 3))
    assert {ROW_HASH, ROW_NO}.isdisjoint(whole.columns)


def test_an_empty_split_table_keeps_its_schema(spark, rows):
    path = new_work_folder(spark, "test")
    write_keyed(rows("k int, year int").where("false"), "key", ["k"], path, hidden=["year"], split_by="year")
    assert read_keyed(spark, path).dtypes == [("key", "bigint"), ("k", "int")] and read_keyed(spark, path).count() == 0


def test_parts_written_one_after_the_other_give_the_ranks_of_the_whole(spark, rows, many_slices):
    data = [(f"k{i * 37 % 501}", i % 3) for i in range(2000)] + [("hot", 1)] * 700 + [(None, i) for i in range(5)]
    df = rows("k string, v int", *data).repartition(4)
    parts = ranges(df, "k", 400, 5)
    assert len(parts) == 5 and len(ranges(df, "k", 5000, 5)) == 1
    passed = [part(df).collect() for part in parts]
    assert sorted(map(str, sum(passed, []))) == sorted(map(str, df.collect()))
    heads = [sorted({r.k for r in p if r.k is not None}) for p in passed]
    assert all(a[-1] < b[0] for a, b in zip(heads, heads[1:]) if a and b)
    path = new_work_folder(spark, "test")
    schema = write_keyed([part(df) for part in parts], "key", ["k", "v"], path, hidden=["v"], split_by="v")
    assert keyed_rows(spark, path).select(F.shiftright("__position", 57)).distinct().count() > 2
    got = [tuple(r) for r in read_keyed(spark, path, "key", schema, hidden=True).orderBy("key").collect()]
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    assert got == [(i, *r) for i, r in enumerate(want, 1)]


def test_a_table_without_values_or_rows_is_one_range_or_none_is_lost(spark, rows):
    nulls = rows("k string", *[(None,)] * 30)
    assert sum(part(nulls).count() for part in ranges(nulls, "k", 10, 8)) == 30
    assert [part(nulls.where("false")).count() for part in ranges(nulls.where("false"), "k", 10, 8)] == [0]
