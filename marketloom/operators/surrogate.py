"""Dense surrogate keys without funnelling a table through one task, each table written once.

A keyed table is a folder: `rows`, the table in key order with each row's position, `slices`, the
number of rows before each written slice, and `schema.json`. Its key is
`rows before the slice + position + 1`, read with one small lookup and no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marketloom.sources.files import path_exists, read_text, write_text

POSITION = "__position"
ROW_HASH = "__row_hash"
ROW_NO = "__row_no"
_SLICE_BITS = 33
#: Bits of a position below the number of the part that wrote it: 2**24 slices a part, 64 parts.
_PART_BITS = _SLICE_BITS + 24
_ROW_MASK = (1 << _SLICE_BITS) - 1
_SLICE = "__slice"
#: Field metadata of columns that are stored for the library's own plans and not part of the declared table.
HIDDEN = "hidden"


def numbered(df: DataFrame, hashed: bool = True) -> DataFrame:
    """Add ROW_HASH (of all columns) and ROW_NO, which tell rows apart that share every declared ordering column.

    `df` must come straight from a scan, so that a task that is run again numbers its rows alike. Rows
    that differ are ordered by their hash, whatever task they come from; only rows alike in all columns are
    told apart by number, and which of them gets which key is of no consequence. Without `hashed` there is the number
    alone, for tables whose order has all columns that are kept: the hash would only widen what is shuffled.
    """
    own = [F.xxhash64(*df.columns).alias(ROW_HASH)] if hashed else []
    return df.select("*", *own, F.monotonically_increasing_id().alias(ROW_NO))


def ranges(df: DataFrame, column: str, rows_at_once: int, most: int) -> list[Callable[[DataFrame], DataFrame]]:
    """Filters on `column` that split tables into ascending ranges of it, NULLs in the last: each row passes exactly one.

    There is one for every `rows_at_once` rows of `df`, `most` of them at most, about even by a sample of its values. Where the
    bounds fall has no bearing on what comes out; rows that share a value stay together.
    """
    n = df.count()
    wanted = min(most, -(-n // rows_at_once))
    if wanted < 2:
        return [lambda part: part]
    some = df.select(column).dropna().sample(min(1.0, 1000 * wanted / n), 42).collect()
    values = sorted(r[0] for r in some)
    bounds = sorted({values[len(values) * i // wanted] for i in range(1, wanted)} if values else ())
    c = F.col(column)

    def between(low: str | None, high: str | None) -> Callable[[DataFrame], DataFrame]:
        from_low = F.lit(True) if low is None else c >= F.lit(low)
        inside = from_low & (c < F.lit(high)) if high is not None else from_low | c.isNull()
        return lambda part: part.where(inside)

    return [between(low, high) for low, high in zip([None, *bounds], [*bounds, None], strict=True)]


def write_keyed(
    df: DataFrame | list[DataFrame],
    key_name: str,
    order_by: list[str],
    path: str,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    hidden: list[str] | None = None,
    split_by: str | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> StructType:
    """Write `df` below `path` so that `key_name` = 1..n is the rank of each row in ascending `order_by` (NULLs last).

    Rows are range-partitioned, sorted inside each partition and written together with their position, so
    the ranges can never be drawn anew and a lost executor only means reading files. Where `df` is `numbered`, rows that
    share all of `order_by` follow by hash and number: a key that a third of all rows share is spread
    over tasks, and its rows have the same ranks on every run.

    `derive` is a row-by-row projection to the final columns; it runs after the shuffle, so that neither the shuffle nor
    the sampling for its ranges carries derived columns. `hidden` columns are stored but not part of the table;
    `split_by`, one of them, also splits the files into folders, which a filter on it prunes. `observe` may attach metrics to
    each write. `df` may be a list of parts in ascending order of the first of `order_by` (see `ranges`): they are written one after
    the other, so that the shuffles of one part take disk at a time. Returns the schema of the stored rows.
    """
    parts = df if isinstance(df, list) else [df]
    total = [*order_by, *(c for c in (ROW_HASH, ROW_NO) if c in parts[0].columns)]
    order = [F.col(c).asc_nulls_last() for c in total]
    for number, part in enumerate(parts):
        ranged = part.repartitionByRange(*order).sortWithinPartitions(*order)
        final = derive(ranged) if derive else ranged.drop(ROW_HASH, ROW_NO)
        placed = final.withColumn(POSITION, F.monotonically_increasing_id() + F.lit(number << _PART_BITS))
        writer = (observe(placed) if observe else placed).write.mode("append" if number else "errorifexists")
        (writer.partitionBy(split_by) if split_by else writer).parquet(f"{path}/rows", compression="zstd")
    spark = parts[0].sparkSession
    schema = StructType([*(f for f in placed.schema if f.name != split_by), *(f for f in placed.schema if f.name == split_by)])
    _slices(spark.read.schema(schema).parquet(f"{path}/rows"), key_name).write.parquet(f"{path}/slices")
    for f in schema:
        f.metadata = {HIDDEN: True} if f.name in (hidden or ()) else {}
    write_text(spark, f"{path}/schema.json", schema.json())
    return schema


def _slices(rows: DataFrame, key_name: str) -> DataFrame:
    """One row per written slice: the number of rows before it, named like the key. The window runs over these rows alone."""
    sizes = rows.groupBy(F.shiftright(POSITION, _SLICE_BITS).alias(_SLICE)).count()
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_SLICE, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(key_name)).coalesce(1)


def is_keyed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/schema.json")


def read_keyed(
    spark: SparkSession, path: str, key_name: str | None = None, schema: StructType | None = None, hidden: bool = False
) -> DataFrame:
    """The keyed table below `path`, key first; with `hidden` also its hidden columns."""
    schema = schema or StructType.fromJson(json.loads(read_text(spark, f"{path}/schema.json")))
    slices = spark.read.parquet(f"{path}/slices") if key_name is None else spark.read.schema(
        StructType([StructField(_SLICE, LongType()), StructField(key_name, LongType())])
    ).parquet(f"{path}/slices")
    key_name = slices.columns[1]
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    columns = [f.name for f in schema if f.name != POSITION and (hidden or not f.metadata.get(HIDDEN))]
    before = slices.select(F.col(_SLICE).alias("__of"), F.col(key_name).alias("__before"))
    placed = rows.join(before, F.shiftright(POSITION, _SLICE_BITS) == F.col("__of"))
    rank = F.col("__before") + F.col(POSITION).bitwiseAND(F.lit(_ROW_MASK)) + 1
    return placed.select(rank.alias(key_name), *columns)


def keyed_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All stored columns of the keyed table below `path` but its key, without the lookup."""
    schema = schema or StructType.fromJson(json.loads(read_text(spark, f"{path}/schema.json")))
    return spark.read.schema(schema).parquet(f"{path}/rows")


def dense_key(df: DataFrame, key_name: str, order_by: list[str], path: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`df` with its dense key, written below `path` and read back."""
    return read_keyed(df.sparkSession, path, key_name, write_keyed(df, key_name, order_by, path, derive))
