"""Layer folders: each refresh goes to a new run folder and becomes current only when complete."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from marketloom.operators.surrogate import is_keyed, keyed_rows, read_keyed
from marketloom.sources.files import delete_folder, names_below, path_exists, read_text, write_text

LAYERS = ["raw", "staging", "dwh"]
_DONE = "_COMPLETE"
_MEASURED = "_measured.json"

#: What to count of a table while it is written: name -> aggregate.
Measures = dict[str, Column]


class Observed:
    """Counts taken by the writes of a layer's tables, so that checks need not read them again."""

    def __init__(self, measures: Callable[[str], Measures] | None):
        self.measures = measures or (lambda table: {})
        self.open: dict[str, list[tuple[list[str], Observation]]] = {}

    def attach(self, table: str, df: DataFrame) -> DataFrame:
        wanted = self.measures(table)
        if not wanted:
            return df
        seen = Observation(f"{table}-{uuid.uuid4().hex}")
        self.open.setdefault(table, []).append((list(wanted), seen))
        return df.observe(seen, *(c.alias(f"m{i}") for i, c in enumerate(wanted.values())))

    def counts(self) -> dict[str, dict[str, int]]:
        """Counts by table and name of the writes that have ended, added up where a table was written in parts."""
        out: dict[str, dict[str, int]] = {}
        for table, writes in self.open.items():
            counted = out.setdefault(table, {})
            for names, seen in writes:
                found = seen.get
                for i, name in enumerate(names):
                    counted[name] = counted.get(name, 0) + int(found.get(f"m{i}") or 0)
        return out


class LayerStore:
    """Parquet tables under `<root>/<layer>/run=<id>/<table>`.

    Readers use the newest run that carries a completion marker. A failed refresh leaves no
    marker, so the last good run stays readable, and all tables of a layer switch together.
    """

    def __init__(self, spark: SparkSession, root: str, concurrent_writes: int = 6):
        self.spark = spark
        self.root = root.rstrip("/")
        self.concurrent_writes = concurrent_writes

    def begin(self, layer: str) -> str:
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        return f"{self.root}/{layer}/run={stamp}-{uuid.uuid4().hex[:8]}"

    def complete(self, run: str) -> None:
        write_text(self.spark, f"{run}/{_DONE}", "")

    def write_layer(
        self,
        layer: str,
        tables: dict[str, DataFrame | Callable[[], DataFrame]],
        accept: Callable[[str, dict[str, dict[str, int]]], None] | None = None,
        measures: Callable[[str], Measures] | None = None,
    ) -> str:
        """Write all tables, several at a time, then switch readers to the new run (see `build_layer`)."""

        def build(run: str, observed: Observed) -> None:
            tag = run.rsplit("=", 1)[1]
            context = self.spark.sparkContext

            def write(name: str) -> None:
                context.addJobTag(tag)
                df = tables[name]
                try:
                    observed.attach(name, df() if callable(df) else df).write.parquet(f"{run}/{name}")
                finally:
                    context.removeJobTag(tag)

            with ThreadPoolExecutor(self.concurrent_writes) as pool:
                writes = [pool.submit(write, name) for name in tables]
                try:
                    for done in as_completed(writes):
                        done.result()
                except BaseException:
                    for waiting in writes:
                        waiting.cancel()
                    context.cancelJobsWithTag(tag)
                    raise

        return self.build_layer(layer, build, accept, measures)

    def build_layer(
        self,
        layer: str,
        build: Callable[[str, Observed], None],
        accept: Callable[[str, dict[str, dict[str, int]]], None] | None = None,
        measures: Callable[[str], Measures] | None = None,
    ) -> str:
        """A new run whose folder `build` fills; readers switch to it when it is complete.

        `accept` sees the run and what its writes counted before the switch and may raise. Any failure
        ends the other writes, deletes the partial run, is raised and leaves the previous run current.
        """
        run, observed = self.begin(layer), Observed(measures)
        try:
            build(run, observed)
            counts = observed.counts()
            if measures:
                write_text(self.spark, f"{run}/{_MEASURED}", json.dumps(counts))
            if accept:
                accept(run, counts)
            self.complete(run)
        except BaseException:
            delete_folder(self.spark, run)
            raise
        return run

    def measured(self, layer: str) -> dict[str, dict[str, int]] | None:
        """What the writes of the current run counted; None if they counted nothing."""
        path = f"{self.current(layer)}/{_MEASURED}"
        return json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else None

    def runs(self, layer: str) -> list[str]:
        """Completed runs, oldest first."""
        found = names_below(self.spark, f"{self.root}/{layer}/run=*/{_DONE}")
        return [f"{self.root}/{layer}/{path.split('/')[-2]}" for path in found]

    def current(self, layer: str) -> str:
        runs = self.runs(layer)
        if not runs:
            raise LookupError(f"layer {layer} has not been loaded under {self.root}")
        return runs[-1]

    def read(self, layer: str, table: str) -> DataFrame:
        return self.read_run(self.current(layer), [table])[table]

    def read_layer(self, layer: str, tables: list[str]) -> dict[str, DataFrame]:
        return self.read_run(self.current(layer), tables)

    def read_rows(self, run: str, tables: list[str]) -> dict[str, DataFrame]:
        """Stored columns of the keyed tables of one run, without their own keys."""
        return {t: keyed_rows(self.spark, f"{run}/{t}") for t in tables if is_keyed(self.spark, f"{run}/{t}")}

    def read_run(self, run: str, tables: list[str], hidden: bool = False) -> dict[str, DataFrame]:
        """Tables of one run; keyed ones get their key, and their hidden columns if asked for."""

        def read(path: str) -> DataFrame:
            keyed = is_keyed(self.spark, path)
            return read_keyed(self.spark, path, hidden=hidden) if keyed else self.spark.read.parquet(path)

        return {t: read(f"{run}/{t}") for t in tables}

    def drop_old_runs(self, layer: str, keep: int = 2) -> list[str]:
        """Delete completed runs older than the `keep` newest ones and return their paths."""
        old = self.runs(layer)[: -max(keep, 1)]
        for run in old:
            delete_folder(self.spark, run)
        return old


def publish_views(views: dict[str, DataFrame], prefix: str) -> None:
    """Create or replace one temporary view per frame, named `<prefix>_<name>`; nothing is computed."""
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}_{name}")


def publish_catalog(spark: SparkSession, run: str, names: list[str], database: str, folder: str) -> None:
    """Catalog views `<database>.<name>` over the tables of a complete run, found by name in every session of the catalog.

    Each view is replaced as a whole, so a reader sees one run or the next and never a part; the views of a layer
    are replaced one after the other. With Spark's own catalog they last as long as the application, with a metastore
    for good. `folder` is where the catalog keeps the database, which holds no data of its own.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{folder}'")
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{run}/{name}`")
