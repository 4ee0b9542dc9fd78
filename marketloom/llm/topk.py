"""Exact top-k search by inner product: tiles of queries and candidates, partial selection, tree merging."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LISTS = "query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Tiles:
    """Rows of a query block and of a candidate shard, rows multiplied at once, and lists merged in one step."""

    queries: int = 8192
    candidates: int = 32768
    step: int = 512
    fan_in: int = 32


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """id and v (floor(scale * x) of each component); vectors that are null or hold null or non-finite components go."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * float(scale)))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), scaled.alias("v")
    )


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids ascending, matrix) of the vectors of each length."""
    vectors = table.column("v").combine_chunks()
    ids = table.column("id").to_numpy()
    starts = vectors.offsets.to_numpy()
    flat = vectors.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(starts)
    out = {}
    for n in np.unique(lengths):
        rows = np.nonzero(lengths == n)[0]
        rows = rows[np.argsort(ids[rows], kind="stable")]
        out[int(n)] = (ids[rows], flat[starts[rows][:, None] + np.arange(n)[None, :]].astype(np.int64))
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; floating point only where it is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def tile_lists(queries: pa.Table, candidates: pa.Table, k: int, step: int = 512) -> pa.Table:
    """The best k candidates of each query of one tile, ties to the smaller id; an id counts once, the query's own never."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if queries.num_rows and candidates.num_rows:
        own, other = _by_length(queries), _by_length(candidates)
        for n in own.keys() & other.keys():
            (q_ids, q), (c_ids, c) = own[n], other[n]
            for at in range(0, len(q_ids), step):
                found += _block_lists(q_ids[at : at + step], q[at : at + step], c_ids, c, k, step)
    parts = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("query_id", "vec_id", "score"), parts, strict=True)})


def _block_lists(q_ids, q, c_ids, c, k, step) -> list:
    kept: tuple[np.ndarray, ...] | None = None
    for at in range(0, len(c_ids), 8 * step):
        ids = c_ids[at : at + 8 * step]
        scores = _products(q, c[at : at + 8 * step])
        # More than k may be needed where an id repeats or is the query's own: those go first.
        scores[q_ids[:, None] == ids[None, :]] = np.iinfo(np.int64).min
        same = np.nonzero(ids[1:] == ids[:-1])[0] + 1
        for j in same:  # sorted by id: hand the better score on, leave the earlier place
            scores[:, j] = np.maximum(scores[:, j], scores[:, j - 1])
            scores[:, j - 1] = np.iinfo(np.int64).min
        if len(ids) > k:
            limit = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            rows, cols = np.nonzero((scores >= limit[:, None]) & (scores > np.iinfo(np.int64).min))
        else:
            rows, cols = np.nonzero(scores > np.iinfo(np.int64).min)
        new = (rows, ids[cols], scores[rows, cols])
        kept = _best(*(new if kept is None else (np.concatenate(x) for x in zip(kept, new, strict=True))), k)
    rows, ids, scores = kept
    return [(q_ids[rows], ids, scores)]


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    if len(rows) > 1:  # an id may come from two steps
        by_id = np.lexsort((-scores, ids, rows))
        r, i = rows[by_id], ids[by_id]
        again = np.zeros(len(rows), bool)
        again[by_id[1:]] = (r[1:] == r[:-1]) & (i[1:] == i[:-1])
        rows, ids, scores = rows[~again], ids[~again], scores[~again]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], ids[keep], scores[keep]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, tiles: Tiles = Tiles()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of every query, exactly.

    Both sides are (id long, v array<long>). Queries are dealt to R blocks and candidates to C shards of
    about the rows in `tiles`; tile (r, c) gets block r and shard c, so candidates move R times and queries
    C times and no task holds more than one tile, however large either side is. Rows are dealt by position,
    so a repeated id or vector is no hot tile. A tile selects per query its k best; lists of `fan_in`
    shards are then merged at a time, level by level, until one is left per query.

    Empty sides give no rows; an id that occurs more than once counts once with its best score; vectors of
    different lengths never meet; fewer than k candidates give fewer ranks.
    """
    blocks = max(1, math.ceil(queries.count() / tiles.queries))
    shards = max(1, math.ceil(candidates.count() / tiles.candidates))
    deal = F.xxhash64(F.monotonically_increasing_id())

    def laid_out(df: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        dealt = df.withColumn(own, F.pmod(deal, F.lit(own_n)).cast("int"))
        # Columns anew: both sides may come from one table, whose columns a cogroup would take for the same.
        columns = [F.col(c).alias(c) for c in ("id", "v")]
        return dealt.select(*columns, own, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))).alias(other))

    left = laid_out(queries, "block", blocks, "shard", shards)
    right = laid_out(candidates, "shard", shards, "block", blocks)

    def multiply(key: tuple, own: pa.Table, other: pa.Table) -> pa.Table:
        out = tile_lists(own, other, k, tiles.step)
        return out.append_column("shard", pa.array([key[1].as_py()] * out.num_rows, pa.int32()))

    tile = ["block", "shard"]
    lists = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(multiply, f"{LISTS}, shard int")
    while True:
        shards = math.ceil(shards / tiles.fan_in)
        lists = lists.withColumn("shard", F.floor(F.col("shard") / tiles.fan_in).cast("int"))
        lists = lists.groupBy("query_id", "shard", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if shards <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
