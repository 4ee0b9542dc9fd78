import math

import pytest

from marketloom.llm.queries import op1_topk
from marketloom.llm.topk import Tiles, quantised, top_k

from ..conftest import DATA


def brute(rows, k=5):
    """Best k by integer product for ids divisible by 50."""
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fit.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = set()
    for q in fit:
        if q % 50:
            continue
        best = []
        for c, vectors in fit.items():
            scores = [sum(a * b for a, b in zip(x, y)) for x in fit[q] for y in vectors if len(x) == len(y)]
            if c != q and scores:
                best.append((-max(scores), c))
        out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(best)[:k])}
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_whole_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    got = op1_topk(spark, DATA)
    assert rows_of(got) == brute([(r["vec_id"], r["embedding"]) for r in table.collect()])
    assert got.schema["rank"].dataType.simpleString() == "int"


@pytest.mark.parametrize("tiles", [Tiles(), Tiles(3, 7, 2, 2)])
def test_odd_vectors(spark, tiles):
    data = [(i, [0.5, -0.25, (i % 7) / 7.0]) for i in range(120)]
    data += [(i, [0.5, 0.5, 0.5]) for i in range(200, 240)]  # ties
    data += [(50, None), (100, [None, 1.0, 1.0]), (101, [float("nan")] * 3), (102, [float("inf")] * 3), (None, [1.0, 1.0, 1.0])]
    data += [(0, [0.9, 0.9, 0.9]), (7, [2.0, 2.0, 2.0]), (7, [2.0, 2.0, 2.0]), (150, [1.0, 1.0]), (151, [1.0, 2.0]), (250, [])]
    data += [(300, [3e12, 1.0, 1.0]), (301, [2.0, 1.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = quantised(df)
    assert rows_of(top_k(vectors.where("id % 50 = 0"), vectors, tiles=tiles)) == brute(data)


def test_empty(spark):
    df = quantised(spark.createDataFrame([], "vec_id long, embedding array<float>, block int"))
    assert top_k(df, df).count() == 0
