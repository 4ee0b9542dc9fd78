"""What the corpus operators share: table access, stored steps, components of a link table."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import new_work_folder
from marketloom.sources.files import delete_folder

#: A word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: The bytes of A-Z in lower case, all others as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that Spark hands to a Python worker at once, and its setting.
BATCH_ROWS, BATCH_SETTING = 2048, "spark.sql.execution.arrow.maxRecordsPerBatch"

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextlib.contextmanager
def written_folders() -> Iterator[list[str]]:
    """Collects the folders that `stored` writes inside the block, in order."""
    folders: list[str] = []
    token = _written.set(folders)
    try:
        yield folders
    finally:
        _written.reset(token)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what `stored` writes inside the block, but for the last folder, when the block ends without an error."""
    with written_folders() as folders:
        yield
    for folder in folders[:-1]:
        delete_folder(spark, folder)
    if (outer := _written.get()) is not None:
        outer += folders[-1:]


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """`df` written once below the shared folder and read back: cuts lineage, survives lost executors."""
    path = new_work_folder(df.sparkSession, purpose)
    if (folders := _written.get()) is not None:
        folders.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """doc_id and row, a struct of all columns: whatever they are called, no name can clash in a join."""
    return docs.select(F.col("doc_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def release_memory() -> None:
    """Give freed memory back to the system: worker processes are used again, and would keep the most they ever held."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library offers it
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands BATCH_ROWS rows at once to workers, unless the session itself says otherwise.

    Its usual ten thousand are some 50 MB of whole texts, of which the JVM and the worker hold two each, beside the heap.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


#: What a worker process keeps from task to task, by name: a function that gives it up.
kept_by_worker: dict[str, Callable[[], None]] = {}


def give_up_others(keep: str | None) -> None:
    """A worker is used again for other work: what its earlier tasks kept goes, but for `keep`."""
    for name, give_up in kept_by_worker.items():
        if name != keep:
            give_up()
            release_memory()


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keep: str | None = None
) -> DataFrame:
    """mapInArrow whose tasks give back the memory they no longer need, and what other work than `keep` left in the worker."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_up_others(keep)
        yield from run(batches)
        release_memory()

    return df.mapInArrow(tidy, schema)


def map_text(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    rows_at_once: int = 1024,
    keep: str | None = None,
) -> DataFrame:
    """Apply `work` to slices of at most `rows_at_once` rows of small batches, so that memory follows a slice and not a batch."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows_at_once):
                yield work(batch.slice(start, rows_at_once))

    return map_batches(df, run, schema, keep)


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of `links` (a, b long): one row (node, component), the smallest node reachable.

    Every link points from its larger to its smaller node. Two steps alternate until each node has one link, to a
    node that has none: a link is moved on to the smallest neighbour of its lower end, then all lower ends of a
    node are linked to the smallest of them. Links never grow in number; rounds grow with the logarithm of a
    component's diameter. Every step is written to the shared folder, so that a lost executor costs one
    step, and each join reads two plain tables, so that adaptive execution splits a node that holds a
    third of all links. No link reaches the driver, only whether any was left to move.
    """
    edges = stored(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        purpose,
    )
    while True:
        low = _lowest(edges, purpose)
        onward = edges.join(low, F.col("v") == F.col("node"), "left").select(
            "u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("went")
        )
        moved = stored(onward.groupBy("u", "v").agg(F.bool_or("went").alias("went")), purpose)
        if moved.where("went").isEmpty() and low.where("m <> high").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        pairs = moved.join(_lowest(moved, purpose), F.col("u") == F.col("node"))
        both = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(pairs.select(F.explode(both).alias("e")).select("e.u", "e.v").where("u <> v").distinct(), purpose)


def _lowest(edges: DataFrame, purpose: str) -> DataFrame:
    """node with m and high, its smallest and its largest lower neighbour."""
    return stored(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"), F.max("v").alias("high")), purpose)
