"""Every registered query against its DuckDB answer, types included."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from marketloom.checks import oracle, queries as registry

from .conftest import DATA

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return (type(v).__name__, v)


def test_every_query_has_an_answer():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry_module.queries())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_duckdb(spark, duck, name):
    df = entry_module.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = Counter(tuple(cell(r[c]) for c in columns) for r in df.collect())
    answer = duck.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert ours == Counter(tuple(cell(r[i]) for i in places) for r in answer.fetchall())
