"""Load checks: twelve named measures with an expectation each.

All measures of one table come from one aggregate, so a table is read once however many
checks it has, and only one row per table leaves the executors.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    expectation: str
    measure: str  # SQL aggregate over the table
    wants_rows: bool  # passes when positive, otherwise when zero


def _loaded(name: str, table: str) -> Check:
    return Check(name, table, "> 0 rows", "count(*)", True)


def _missing(name: str, table: str, key: str) -> Check:
    return Check(name, table, f"0 missing {key}", f"count_if({key} IS NULL)", False)


# Names and order of the checks. A NULL score is neither inside nor outside the range.
CHECKS = [
    _loaded("raw_orders_loaded", "orders"),
    _loaded("dwh_fact_orders_loaded", "fact_orders"),
    _missing("fact_order_items_missing_order_key", "fact_order_items", "order_key"),
    _missing("fact_order_items_missing_product_key", "fact_order_items", "product_key"),
    _missing("fact_order_items_missing_seller_key", "fact_order_items", "seller_key"),
    _missing("fact_payments_missing_order_key", "fact_payments", "order_key"),
    _missing("fact_reviews_missing_order_key", "fact_reviews", "order_key"),
    Check(
        "reviews_outside_1_5",
        "fact_reviews",
        "0 reviews outside 1..5",
        "count_if(review_score NOT BETWEEN 1 AND 5)",
        False,
    ),
    _loaded("marts_sales_overview_loaded", "sales_overview"),
    _loaded("marts_payment_analysis_loaded", "payment_analysis"),
    _loaded("marts_customer_satisfaction_loaded", "customer_satisfaction"),
    _loaded("marts_sales_by_category_loaded", "sales_by_category"),
]
# The automated run uses the first eight; the remaining ones look at the marts.
AUTOMATED = CHECKS[:8]


def measure(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Rows (name, value bigint) from a single aggregate over `df`."""
    pairs = [F.struct(F.lit(n).alias("name"), m.cast("bigint").alias("value")) for n, m in measures.items()]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def check_report(tables: dict[str, DataFrame], checks: list[Check] = CHECKS) -> DataFrame:
    """Rows (position, check_name, value as text, passed, expectation), unordered."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = {c.name: F.expr(c.measure) for c in checks if c.table == table}
        parts.append(measure(tables[table], mine))
    facts = F.create_map(
        *[
            x
            for i, c in enumerate(checks)
            for x in (
                F.lit(c.name),
                F.struct(
                    F.lit(i + 1).alias("position"),
                    F.lit(c.wants_rows).alias("wants_rows"),
                    F.lit(c.expectation).alias("expectation"),
                ),
            )
        ]
    )
    about = facts[F.col("name")]
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("about", about)
        .select(
            "about.position",
            F.col("name").alias("check_name"),
            F.col("value").cast("string").alias("value"),
            (F.col("about.wants_rows") == (F.col("value") > 0)).alias("passed"),
            "about.expectation",
        )
    )


def summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


class QualityError(RuntimeError):
    """A check failed and the run was asked to stop at the first failure."""


def up_to_first_unmet(tables: dict[str, DataFrame], checks: list[Check] = AUTOMATED) -> list:
    """Rows of the checks in list order, ending with the first that is not met; tables of later ones are not read."""
    results = []
    for position, check in enumerate(checks, 1):
        results += check_report(tables, [check]).withColumn("position", F.lit(position)).collect()
        if not results[-1].passed:
            break
    return results


def run_checks(tables: dict[str, DataFrame], fail_fast: bool = False, checks: list[Check] = AUTOMATED) -> list:
    """Evaluate the checks, log them in list order and return their rows (one per check).

    With `fail_fast` each check is evaluated by itself, and the first one that is not met ends the run before the rest is.
    """
    results = up_to_first_unmet(tables, checks) if fail_fast else check_report(tables, checks).orderBy("position").collect()
    for r in results:
        logger.info("%s found %s, wants %s: %s", r.check_name, r.value, r.expectation, "ok" if r.passed else "not met")
    if fail_fast and not results[-1].passed:
        r = results[-1]
        raise QualityError(f"stopped at {r.check_name}: found {r.value}, wants {r.expectation}")
    return results


def report_text(results: list) -> str:
    """Totals first, then the checks that are not met with what they want, then the names of those that are."""
    unmet = [r for r in results if not r.passed]
    lines = [f"{len(results) - len(unmet)} of {len(results)} checks are met"]
    lines += [f"not met: {r.check_name} found {r.value}, wants {r.expectation}" for r in unmet]
    lines += [f"met: {r.check_name} ({r.value})" for r in results if r.passed]
    return "\n".join(lines)
