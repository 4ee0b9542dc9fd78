import pytest

from marketloom.operators import constraints as con
from marketloom.operators import quality


@pytest.fixture
def tables(rows):
    return {
        "orders": rows("order_id string", ("a",)),
        "fact_orders": rows("order_key bigint", (1,), (2,)),
        "fact_order_items": rows("order_key bigint, product_key bigint, seller_key bigint", (1, None, None), (None, None, 1)),
        "fact_payments": rows("order_key bigint", (1,)),
        "fact_reviews": rows("order_key bigint, review_score int", (1, 0), (None, None), (1, 5), (1, 6)),
    }


def test_automated_checks_in_order_with_values(tables):
    got = [tuple(r)[1:4] for r in quality.run_checks(tables)]
    assert got == [
        ("raw_orders_loaded", "1", True),
        ("dwh_fact_orders_loaded", "2", True),
        ("fact_order_items_missing_order_key", "1", False),
        ("fact_order_items_missing_product_key", "2", False),
        ("fact_order_items_missing_seller_key", "1", False),
        ("fact_payments_missing_order_key", "0", True),
        ("fact_reviews_missing_order_key", "1", False),
        ("reviews_outside_1_5", "2", False),
    ]


def test_fail_fast_stops_at_the_first_failure(tables):
    later = [t for t in tables if t not in ("orders", "fact_orders", "fact_order_items")]
    for t in later:
        del tables[t]  # what the remaining checks would read
    with pytest.raises(quality.QualityError, match="stopped at fact_order_items_missing_order_key: found 1, wants 0 missing order_key"):
        quality.run_checks(tables, fail_fast=True)
    assert [r.position for r in quality.up_to_first_unmet(tables)] == [1, 2, 3]


def test_empty_load_fails(tables):
    tables["orders"] = tables["orders"].where("false")
    assert quality.run_checks(tables)[0].passed is False


def test_summary_and_text(tables):
    report = quality.check_report(tables, quality.AUTOMATED)
    assert tuple(quality.summary(report).first()) == (8, 3, 5)
    text = quality.report_text(report.orderBy("position").collect())
    assert text.splitlines()[0] == "3 of 8 checks are met"
    assert sum(line.startswith("not met: ") for line in text.splitlines()[1:6]) == 5
    assert "not met: reviews_outside_1_5 found" in text


def test_each_table_is_scanned_once(warehouse):
    names = {c.table for c in quality.AUTOMATED if c.table != "orders"}
    tables = {"orders": warehouse.raw("orders"), **{t: warehouse.rows(t) for t in names}}
    plan = quality.check_report(tables, quality.AUTOMATED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(tables)


def found(df):
    return {(r.table_name, r.rule): r.violations for r in df.collect()}


def test_duplicates_ignore_incomplete_keys(rows):
    t = {"x": rows("a int, b int", (1, 1), (1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (2, 2), (2, 2))}
    assert found(con.duplicate_keys(t, {"x": ["a", "b"]})) == {("x", "unique (a, b)"): 2}


def test_nulls_and_rules(rows):
    t = {"x": rows("a int, b int", (None, -1), (1, None), (6, 3))}
    assert found(con.null_violations(t, {"x": ["a", "b"]})) == {("x", "a not null"): 1, ("x", "b not null"): 1}
    got = found(con.rule_violations(t, {"x": ["a BETWEEN 1 AND 5", "b >= 0"]}))
    assert got == {("x", "a BETWEEN 1 AND 5"): 1, ("x", "b >= 0"): 1}


def test_orphans_count_rows_not_keys(rows):
    t = {"f": rows("k bigint", (1,), (9,), (9,), (None,)), "d": rows("k bigint", (1,), (2,))}
    assert found(con.orphans(t, {"f": {"k": ("d", "k")}})) == {("f", "k -> d"): 2}


def test_declared_columns_exist(warehouse):
    for layer in (con.UNIQUE_KEYS["dwh"], con.UNIQUE_KEYS["staging"], con.NOT_NULL["staging"], con.NOT_NULL["dwh"]):
        for table, columns in layer.items():
            assert set(columns) <= set(warehouse.table(table).columns), table
    for table, references in con.REFERENCES.items():
        for column, (target, key) in references.items():
            assert column in warehouse.table(table).columns and key in warehouse.table(target).columns


def test_references_are_looked_up_in_one_scan_without_text(warehouse):
    tables = {t: warehouse.table(t) for t in con.REFERENCES} | {t: warehouse.table(t) for refs in con.REFERENCES.values() for t, _ in refs.values()}
    one = con.orphans(tables, {"fact_orders": con.REFERENCES["fact_orders"]}, {"fact_orders": warehouse.rows("fact_orders")})
    shown = one._jdf.queryExecution().executedPlan().toString()
    assert shown.count("ReadSchema: struct<customer_key") == 1 and "order_id" not in shown and "order_purchase_ts" not in shown


def test_orphans_after_targets_lost_rows(warehouse):
    tables = {t: warehouse.table(t) for t in {"fact_order_items", "fact_orders", "dim_product", "dim_seller", "dim_date"}}
    tables["dim_product"] = tables["dim_product"].where("product_key % 5 <> 0")
    got = found(con.orphans(tables, {"fact_order_items": con.REFERENCES["fact_order_items"]}))
    expected = tables["fact_order_items"].where("product_key % 5 = 0").count()
    assert got[("fact_order_items", "product_key -> dim_product")] == expected > 0
    assert sum(got.values()) == expected


def test_duplicates_of_all_tables_go_through_one_narrow_shuffle(warehouse):
    keys = {t: con.UNIQUE_KEYS["dwh"][t] for t in ("fact_orders", "fact_payments", "dim_customer")}
    shown = con.duplicate_keys({t: warehouse.rows(t) for t in keys}, keys)._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in shown.splitlines() if "Exchange hashpartitioning" in x]
    assert len(wide) == 2 and all("order_id" not in x and "customer_id" not in x for x in wide)
