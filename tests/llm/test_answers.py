"""Queries with SQL of their own, over the small tables, types included."""

from collections import Counter

import duckdb
import pytest

from marketloom.llm.answers import ANSWERS
from marketloom.llm.queries import queries

TABLES = ["documents", "embeddings", "pages"]


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_query_matches_duckdb(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    answer = con.execute(ANSWERS[name])
    names = [d[0] for d in answer.description]
    df = queries()[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    typed = lambda rows: Counter(tuple((type(v).__name__, v) for v in r) for r in rows)
    assert typed(map(tuple, df.select(*names).collect())) == typed(answer.fetchall())
