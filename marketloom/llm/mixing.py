"""Mixing sources to target weights: fixed-length blocks of tokens, multinomial draws, pseudorandom permutations.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import WORD, packed, stored


@dataclass(frozen=True)
class Mix:
    """`block` words per block, `slots` blocks per output shard, at most `repeats` times the words of a source.

    `weights` go to the sources by code point, null last, over and over. The words of one source are counted up in
    parts of some `part` rows, 64 at least, so that a hot source is no hot task.
    """

    block: int = 64
    slots: int = 4096
    repeats: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    part: int = 500_000
    rounds: int = 24
    seed: int = 7


def text_size(column: str = "text") -> Column:
    """Words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """source, source_size and target: one row per source.

    The share of all words by weight, cut at `repeats` times the source's own words, the excess shared
    again by weight. A source is cut exactly if its ratio limit / weight lies below the level at which
    all shares add up; so the sources are put in order of that ratio and the level follows from running
    sums. Works on one row per source.
    """
    one = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.select(
        "source",
        "source_size",
        weights[(F.row_number().over(one) - 1) % len(mix.weights)].alias("weight"),
        (F.col("source_size") * float(mix.repeats)).alias("limit"),
    ).withColumn("ratio", F.col("limit") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    rising = everything.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    stepped = ranked.select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("budget"),
        F.coalesce(F.sum("limit").over(rising), F.lit(0.0)).alias("cut"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))).alias("open"),
    ).withColumn("level", (F.col("budget") - F.col("cut")) / F.col("open"))
    free = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    levelled = stepped.withColumn("final", F.max(free).over(everything))
    return levelled.select(
        "source", "source_size", F.least("limit", F.col("weight") * F.coalesce("final", F.lit(0.0))).alias("target")
    )


def _share_of(seed: int, *parts) -> Column:
    """Pseudorandom number in [0, 1) from `parts`."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11).cast("double") / float(1 << 53)


def shard_draws(goals: DataFrame, mix: Mix) -> DataFrame:
    """source, shard, first and count: blocks of a source in each output shard, `first` counting over shards.

    A shard of n slots has floor(n * p) slots of a source with share p; the slots that remain are drawn
    from the multinomial distribution of the remaining fractions. The counts are multinomial draws with
    the least variance, so totals stay near their targets.

    There is a row for each source and shard. Within a shard the fractions are added up in order of the sources, and
    a draw falls to the last source whose running sum it reaches: draws and sums are put in one order and read
    along it, so that no row and no task holds more than the sources and draws of one shard.
    """
    one = Window.partitionBy(F.lit(0))
    shares = goals.withColumn("goal", F.col("target") / mix.block).withColumn("all", F.sum("goal").over(one)).where("all > 0")
    total = F.ceil("all").cast("long")
    last_shard = F.floor((total - 1) / mix.slots).cast("long")
    grid = shares.select("source", (F.col("goal") / F.col("all")).alias("p"), total.alias("total"), F.explode(F.sequence(F.lit(0).cast("long"), last_shard)).alias("shard"))
    want = F.least(F.lit(mix.slots).cast("long"), F.col("total") - F.col("shard") * mix.slots) * F.col("p")
    grid = grid.select("source", "shard", "total", F.floor(want).alias("fixed"), (want - F.floor(want)).alias("rest"))
    whole = Window.partitionBy("shard")
    order = whole.orderBy(F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select(
        "source", "shard", "fixed", "total",
        F.coalesce(F.sum("rest").over(before), F.lit(0.0)).alias("low"),
        F.sum("rest").over(whole).alias("mass"),
        F.sum("fixed").over(whole).alias("given"),
        F.row_number().over(order).alias("n"),
    )
    size = F.least(F.lit(mix.slots).cast("long"), F.col("total") - F.col("shard") * mix.slots)
    draws = grid.where("n = 1").select("shard", "mass", (size - F.col("given")).alias("left")).where(F.col("left") > 0)
    draws = draws.select("shard", "mass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("left"))).alias("k"))
    drawn_at = (_share_of(mix.seed, F.col("shard"), F.col("k")) * F.col("mass")).alias("low")
    line = grid.select("shard", "low", F.lit(0).alias("kind"), "n").unionByName(draws.select("shard", drawn_at, F.lit(1).alias("kind"), F.lit(None).cast("int").alias("n")))
    owner = F.last("n", True).over(whole.orderBy("low", "kind", "n"))
    hits = line.withColumn("owner", owner).where("kind = 1").groupBy(F.col("shard").alias("of"), "owner").agg(F.count("*").alias("hits"))
    met = grid.join(hits, (F.col("shard") == F.col("of")) & (F.col("n") == F.col("owner")), "left")
    counts = met.select("source", "shard", (F.col("fixed") + F.coalesce("hits", F.lit(0))).cast("long").alias("count"))
    running = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("count").over(running), F.lit(0).cast("long")))


def permuted(position: Column, size: Column, key: Column, rounds: int, seed: int) -> Column:
    """Pseudorandom permutation of 0 .. size - 1 by swap-or-not rounds: each round swaps a position with its mirror
    image about a keyed point if a hash of the pair says so. Any size works, without cycle-walking."""

    def swap(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, size, r), size) + size - x, size)
        return F.when(F.xxhash64(F.lit(seed + 1), key, r, F.greatest(x, mirror)) >= 0, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), position, swap)


def _offsets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """`sizes` with `start`, the words of the same source before the row, and `source_size`; no task sees a whole source.

    The order goes by a hash of key and size, so that rows which share or lack a key are spread by their sizes.
    """
    buckets = max(64, -(-sizes.count() // mix.part))
    spread = sizes.withColumn("place", F.xxhash64(F.lit(mix.seed), "key", "size"))
    spread = spread.withColumn("bucket", F.pmod("place", F.lit(buckets)))
    of_bucket = Window.partitionBy("source", "bucket").orderBy("place", "key", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    inner = spread.withColumn("inner", F.coalesce(F.sum("size").over(of_bucket), F.lit(0).cast("long")))
    sums = spread.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")).alias("base")),
        "mix-bases",
    )
    placed = inner.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return placed.withColumn("start", F.col("base") + F.col("inner"))


def mix_sizes(sizes: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """(goals, taken): targets by source, and for each `row` (unique long) of `sizes` (row, key, source, size) its words taken.

    The words of a source, in a keyed order of its rows (`row` only splits ties), are cut into blocks of `block` words. Slots of all
    output shards are numbered per source; slot k takes the block to which pass k div n of the source's
    permutations sends k mod n, so no block is taken once more before all are taken as often. How often a
    block is taken is counted before it meets the documents it overlaps.
    """
    goals = stored(targets(sizes, mix), "mix-goals")
    block = F.lit(mix.block).cast("long")
    blocks = F.ceil(F.col("source_size") / mix.block).cast("long")
    supply = goals.select(F.col("source").alias("s"), blocks.alias("n"))
    slots = stored(shard_draws(goals, mix), "mix-draws").where("count > 0").join(supply, F.col("source").eqNullSafe(F.col("s")))
    # Draws may pass the limit of a source by a few blocks; those slots stay empty.
    slots = slots.withColumn("end", F.least(F.col("first") + F.col("count"), F.col("n") * mix.repeats)).where("first < end")
    # A stated number of partitions: few rows become many slots here, so tasks are not to be merged by bytes.
    parts = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = slots.repartition(parts, "source", "shard").select("source", "n", F.explode(F.sequence(F.col("first"), F.col("end") - 1)).alias("slot"))
    epoch = F.floor(F.col("slot") / F.col("n"))
    index = permuted(F.col("slot") % F.col("n"), F.col("n"), F.struct("source", epoch.alias("e")), mix.rounds, mix.seed)
    times = slots.select("source", index.alias("block")).groupBy("source", "block").agg(F.count("*").alias("times"))
    times = stored(times.select(F.col("source").alias("s"), F.col("block").alias("taken_block"), "times"), "mix-times")
    rows = _offsets(sizes, mix).where("size > 0").select("row", "source", "size", "start")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = rows.select("row", "source", F.col("start"), "size", F.explode(F.sequence(first, last)).alias("block"))
    inside = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - F.greatest(F.col("block") * block, F.col("start"))
    met = pieces.select("row", "source", "block", inside.alias("words")).join(
        times, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("taken_block"))
    )
    taken = met.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return goals, taken


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of `docs`.

    Null, empty and blank texts have size 0 and nothing taken. Repeated rows are rows of their own.
    A null source is a source, the last one. If all sizes are 0, all targets are 0. Only ids, sources
    and sizes move, never texts; only one row per source meets in one task.
    """
    sizes = stored(_sizes(docs, ["doc_id"]), "mix-sizes")
    goals, taken = mix_sizes(sizes.select("row", F.col("doc_id").alias("key"), "source", "size"), mix)
    own = goals.select(F.col("source").alias("s"), "source_size", "target")
    return (
        sizes.join(own, F.col("source").eqNullSafe(F.col("s")), "left")
        .join(stored(taken, "mix-taken"), "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )


def _sizes(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`row` tells repeated rows apart; it is written once with the sizes, so every reader sees the same numbers."""
    return docs.select(*keep, F.col("source"), text_size().alias("size"), F.monotonically_increasing_id().alias("row"))


def repeated(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, all columns unchanged.

    A document taken x times its size (0 to `repeats`) is returned floor(x) times, and once more if its
    keyed draw lies below the rest; so the words of a source still come near its target. Documents without
    words are not taken. Rows that share a doc_id share their x. Texts move once, to meet their counts.
    """
    taken = mixed(docs, mix).groupBy("doc_id").agg(F.sum("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    share = F.col("taken") / F.col("size")
    times = F.floor(share) + (_share_of(mix.seed + 1, F.col("doc_id")) < share - F.floor(share)).cast("long")
    counts = stored(taken.select(F.col("doc_id").alias("id"), times.alias("times")).where("times > 0"), "mix-counts")
    joined = packed(docs).join(counts, F.col("doc_id").eqNullSafe(F.col("id")))
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")).select("row.*")
