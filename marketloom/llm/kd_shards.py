"""K-d tree sharding: split at weighted medians along the widest dimension until the leaves have their size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import stored

#: A coordinate has VALUE_BITS for the dimension and TIE_BITS that order equal values.
VALUE_BITS, TIE_BITS = 20, 40
_TOP = 1 << (VALUE_BITS + TIE_BITS)


@dataclass(frozen=True)
class Limits:
    """`bins` per step of a median search, fewer where so many nodes are open that the driver would get more than `rows`
    sums; a search ends at `tolerance` of a shard's target. Slots are dealt in parts of some `part` rows."""

    bins: int = 4096
    rows: int = 1 << 20
    tolerance: float = 0.002
    part: int = 20_000


@dataclass
class Tree:
    """Nodes by number, the root first. A split node sends what lies below `cut` in `dim` to `left`, the rest to the next
    number; an open node or leaf has left -1. `leaves` and `first` say which shards a node ends in."""

    leaves: list[int]
    first: list[int]
    dim: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])

    def split(self, node: int, dim: int, cut: int) -> list[int]:
        """Split `node` and return its two new nodes."""
        at, half = len(self.left), self.leaves[node] // 2
        self.dim[node], self.cut[node], self.left[node] = dim, cut, at
        self.leaves += [half, self.leaves[node] - half]
        self.first += [self.first[node], self.first[node] + half]
        for values, new in ((self.dim, 0), (self.cut, 0), (self.left, -1)):
            values += [new, new]
        return [at, at + 1]

    def place(self, x: np.ndarray) -> np.ndarray:
        """Node of each column of `x` (dims, points)."""
        dim, cut, left = (np.array(v) for v in (self.dim, self.cut, self.left))
        node, points = np.zeros(x.shape[1], np.int64), np.arange(x.shape[1])
        while (left[node] >= 0).any():
            node = np.where(left[node] >= 0, left[node] + (x[dim[node], points] >= cut[node]), node)
        return node


def _points(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.stack([batch.column(i).to_numpy() for i in range(dims)]), batch.column(dims).to_numpy()


def coordinates(points: DataFrame, dims: list[str], tie: str) -> DataFrame:
    """`points` with x0, x1, ...: each dimension scaled to its whole range, equal values ordered by `tie`.

    One row of minima and maxima is read. A null coordinate is the lowest; so is every one of a constant dimension.
    """
    ends = points.agg(*(f(F.col(d).cast("double")).alias(f"{n}{i}") for i, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out = {}
    for i, d in enumerate(dims):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        span = (high - low) if low is not None and high > low else 1.0
        level = F.floor((F.col(d).cast("double") - (low or 0.0)) / span * ((1 << VALUE_BITS) - 1)).cast("long")
        out[f"x{i}"] = F.coalesce(level, F.lit(0).cast("long")) * (1 << TIE_BITS) + F.shiftrightunsigned(tie, 64 - TIE_BITS)
    return points.withColumns(out)


def build_tree(points: DataFrame, dims: int, leaves: int, how: Limits = Limits()) -> Tree:
    """The tree over `points` (x0 .., weight). Tasks send sums by open node and bin, added up before and after the shuffle, so that
    each pass brings one row per open node and bin to the driver at most; all nodes of one level are split in the same passes."""
    tree = Tree([leaves], [0])
    own = points.select(*(f"x{d}" for d in range(dims)), "weight")
    total = own.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    enough = max(1.0, how.tolerance * total / leaves)
    level = [0] if leaves > 1 else []
    while level:
        spans = _spans(own, tree, dims, level)
        found = {}
        searches = {}
        for n in level:
            if n in spans:
                weight, low, high = spans[n]
                widest = max(range(dims), key=lambda d: (high[d] - low[d], -d))
                searches[n] = (widest, low[widest], high[widest] + 1, weight * (tree.leaves[n] // 2) / tree.leaves[n])
            else:
                found[n] = (0, 0)  # no point: any cut will do
        while searches:
            searches = _refine(own, tree, dims, searches, found, enough, max(16, min(how.bins, how.rows // len(searches))))
        level = [kid for n in level for kid in tree.split(n, *found[n]) if tree.leaves[kid] > 1]
    return tree


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, where each one's stretch begins in order, and that order."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    cuts = np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0] if len(keys) else order
    return ordered[cuts], cuts, order


def _spans(points: DataFrame, tree: Tree, dims: int, level: list[int]) -> dict[int, tuple[int, list[int], list[int]]]:
    """Weight, minima and maxima of each node of `level` that has points."""

    active = np.zeros(len(tree.left), bool)
    active[level] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, weight = _points(batch, dims)
            node = tree.place(x)
            mine = np.nonzero(active[node])[0]
            key, cuts, order = _grouped(node[mine])
            columns = [key]
            if len(key):
                x, weight = x[:, mine[order]], weight[mine[order]]
                columns += [np.add.reduceat(weight, cuts), *(np.minimum.reduceat(v, cuts) for v in x), *(np.maximum.reduceat(v, cuts) for v in x)]
            else:
                columns += [key] * (1 + 2 * dims)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["node", "w", *(f"lo{d}" for d in range(dims)), *(f"hi{d}" for d in range(dims))]
    parts = points.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    ends = [f(f"{n}{d}").alias(f"{n}{d}") for n, f in (("lo", F.min), ("hi", F.max)) for d in range(dims)]
    rows = parts.groupBy("node").agg(F.sum("w").alias("w"), *ends).collect()
    return {r["node"]: (r["w"], [r[f"lo{d}"] for d in range(dims)], [r[f"hi{d}"] for d in range(dims)]) for r in rows}


def _refine(points: DataFrame, tree: Tree, dims: int, searches: dict, found: dict, enough: float, bins: int) -> dict:
    """One pass of all median searches {node: (dim, low, high, goal)}: settle a cut in `found` or narrow to one bin."""
    at = np.zeros((4, len(tree.left)), np.int64)  # dimension, low, high and step of each node; high 0 where none is searched
    for n, (dim, low, high, _) in searches.items():
        at[:, n] = dim, low, high, max(1, -(-(high - low) // bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, weight = _points(batch, dims)
            node = tree.place(x)
            dim, low, high, step = at[:, node]
            value = x[dim, np.arange(len(node))]
            mine = np.nonzero((value >= low) & (value < high))[0]
            node, value, weight = node[mine], value[mine], weight[mine]
            key, cuts, order = _grouped(node * bins + (value - low[mine]) // np.maximum(step[mine], 1))
            columns = [key // bins, key % bins]
            if len(key):
                value = value[order]
                columns += [np.add.reduceat(weight[order], cuts), np.minimum.reduceat(value, cuts), np.maximum.reduceat(value, cuts)]
            else:
                columns += [key] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "bin", "w", "lo", "hi"])

    parts = points.mapInArrow(run, "node long, bin long, w long, lo long, hi long").groupBy("node", "bin")
    sums: dict[int, list[tuple[int, int, int, int]]] = {}
    for r in parts.agg(F.sum("w").alias("w"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        sums.setdefault(r["node"], []).append((r["bin"], r["w"], r["lo"], r["hi"]))
    still = {}
    for n, (dim, _, _, goal) in searches.items():
        for _, w, lowest, highest in sorted(sums.get(n, [])):
            if w >= goal:
                if w <= enough or lowest == highest:  # what is left weighs little or can't be cut
                    found[n] = (dim, lowest if goal <= w - goal else highest + 1)
                else:
                    still[n] = (dim, lowest, highest + 1, goal)
                break
            goal -= w
    return still


def shards(points: DataFrame, dims: list[str], tie: str, unit: str, leaves: int, how: Limits = Limits()) -> DataFrame:
    """`points` (the dims, tie long, unit long, weight long) with shard and slot.

    Points that agree in all dims and `tie` share a shard, unless they weigh more than a whole shard's target. The rows
    of such a group, of which there can only be as many as shards, are ordered by `unit`: it is cut, but as they
    stay next to each other, into no more shards than its weight asks for. `unit` must be another one for each row. Slots count the rows of
    a shard without gap.
    """
    sums = points.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("w"), F.count("*").alias("n")).first()
    total, rows = sums["w"], sums["n"]
    groups = points.groupBy(F.col(tie).alias("__tie")).agg(F.sum("weight").alias("w"))
    heavy = stored(groups.where(F.col("w") > max(1.0, total / leaves)).select("__tie"), "heavy")
    # Bounded: each of them holds more than one shard.
    loose = points.join(F.broadcast(heavy), F.col(tie) == F.col("__tie"), "left")
    low = (1 << (64 - TIE_BITS // 2)) - 1
    inside = F.col(tie).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(F.col(unit)).bitwiseAND(F.lit(low)))
    loose = loose.withColumn("__order", F.when(F.col("__tie").isNull(), F.col(tie)).otherwise(inside)).drop("__tie")
    placed = stored(coordinates(loose, dims, "__order"), "points")
    tree = build_tree(placed, len(dims), leaves, how)
    dealt = stored(_leaves(placed, tree, len(dims), points.columns), "dealt")
    return with_slots(dealt, unit, max(1, -(-4 * rows // (leaves * how.part))))


def _leaves(placed: DataFrame, tree: Tree, dims: int, keep: list[str]) -> DataFrame:
    first = np.array(tree.first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _points(batch, dims)
            shard = pa.array(first[tree.place(x)], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[dims + 1 :], shard], names=[*keep, "shard"])

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    named = placed.select(*(f"x{d}" for d in range(dims)), F.col("weight").alias("w"), *keep)
    return named.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in keep), "shard int"]))


def with_slots(dealt: DataFrame, unit: str, buckets: int) -> DataFrame:
    """`dealt` (shard, ...) with slot, gapless from 0 in each shard: parts are numbered on their own and moved by the
    rows of the parts before them, of which there is one small row each."""
    parted = dealt.withColumn("__part", F.pmod(F.xxhash64(F.lit(3), F.col(unit)), F.lit(buckets)))
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy(F.col("shard").alias("s"), F.col("__part").alias("p")).agg(F.count("*").alias("n"))
    moved = stored(sizes.select("s", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "slots")
    inner = F.row_number().over(Window.partitionBy("shard", "__part").orderBy(unit)) - 1
    joined = parted.withColumn("__inner", inner).join(moved, (F.col("shard") == F.col("s")) & (F.col("__part") == F.col("p")))
    return joined.select(*dealt.columns, (F.col("base") + F.col("__inner")).cast("long").alias("slot"))


def document_shards(docs: DataFrame, leaves: int = 24, how: Limits = Limits()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of `docs`.

    The dimensions are those that a text has whoever holds it: bytes, and bytes per code point (which
    tells scripts apart), equal ones ordered by a hash of the text. So equal texts share a shard, unless a group of
    copies is larger than one. Null text: size 8 and the crc32 of no bytes. Rows are told apart by a number that they
    are stored with: repeated rows and rows that share or lack an id are rows of their own. With fewer rows
    than shards some shards are empty; no rows, no shards.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(raw) + 8).cast("long")
    points = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.log2(F.octet_length(raw) + F.lit(1)).alias("bytes"),
        (F.octet_length(raw) / F.greatest(F.length(raw), F.lit(1))).alias("per_char"),
        F.xxhash64(raw).alias("tie"),
        F.monotonically_increasing_id().alias("unit"),
        size.alias("weight"),
    )
    placed = shards(stored(points, "texts"), ["bytes", "per_char"], "tie", "unit", leaves, how)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
