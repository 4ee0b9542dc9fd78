"""One order, or the missing one, holds a third of all rows."""

import datetime as dt
from decimal import Decimal

import pytest

from marketloom.operators import facts, marts

N = 30000


@pytest.fixture
def shuffled(setting):
    """Large-table behaviour on small data: no broadcast, and a low bar for calling a partition skewed."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["o7", None])
def test_fact_lookup_splits_a_hot_order(spark, shuffled, hot):
    ids = f"CASE WHEN id % 3 = 0 THEN {repr(hot) if hot else 'NULL'} ELSE concat('o', id % 5000) END"
    stg = spark.range(N, numPartitions=8).selectExpr(
        f"{ids} AS order_id", "CAST(id AS INT) AS payment_sequential", "'card' AS payment_type",
        "CAST(1 AS INT) AS payment_installments", "CAST(id AS DECIMAL(12,2)) AS payment_value",
    )
    orders = spark.range(5000).selectExpr("id AS order_key", "concat('o', id) AS order_id", "20180101 AS purchase_date_key")
    types = spark.range(1).selectExpr("id AS payment_type_key", "'card' AS payment_type")
    rows, plan = final_plan(facts.measure_payments(facts.resolve_payments(stg, orders, types)))
    assert "skew=true" in plan
    assert len(rows) == N
    assert all((None if r.order_key is None else f"o{r.order_key}") == r.order_id for r in rows)


def test_a_hot_order_is_no_hot_task_of_the_sales_mart(spark, shuffled):
    items = spark.range(N, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS order_key", "20180101 AS order_purchase_date_key", "1L AS order_status_key",
        "CAST(1 AS DECIMAL(12,2)) AS item_price", "CAST(2 AS DECIMAL(12,2)) AS freight_value",
    )
    orders = spark.range(N).selectExpr(
        "id AS order_key", "20180101 AS purchase_date_key", "1L AS order_status_key", "timestamp_ntz '2018-01-01' AS order_purchase_ts",
        "timestamp_ntz '2018-01-03' AS order_delivered_customer_ts", "timestamp_ntz '2018-01-04' AS order_estimated_delivery_ts", "true AS is_delivered_on_time",
    )
    dates = spark.createDataFrame([(20180101, 2018, 1, "January")], "date_key int, year_number int, month_number int, month_name string")
    statuses = spark.createDataFrame([(1, "x")], "order_status_key bigint, order_status string")
    days = marts.order_days(orders, items)
    assert "order_key" not in "".join(x for x in days._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)
    r = marts.sales_overview(days, dates, statuses).collect()
    assert [tuple(x)[4:] for x in r] == [(N, N, Decimal(N), Decimal(2 * N), Decimal(3 * N))]
    assert [tuple(x)[4:] for x in marts.delivery_performance(days, dates, statuses).collect()] == [(N, 2.0, -1.0, 1.0)]


def test_no_plan_crosses_or_collects(warehouse):
    for name in ("sales_overview", "sales_by_category", "payment_analysis", "marketing_funnel", "delivery_performance"):
        plan = warehouse.table(name)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "collect_list"):
            assert word not in plan, (name, word)
        assert plan.count("SinglePartition") == 0, name
