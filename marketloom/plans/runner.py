"""Step runner: schema, raw, staging, dwh, marts, quality, or all of them in turn."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators import constraints, quality
from marketloom.plans.warehouse import DWH_TABLES, MARTS, ROLLUP, STAGING_TABLES, Warehouse
from marketloom.session import build_session
from marketloom.sources.csv_files import FREE_TEXT, load_all_raw
from marketloom.sources.layers import LayerStore, Observed, publish_catalog, publish_views
from marketloom.sources.schemas import RAW_TABLES, raw_schema

logger = logging.getLogger(__name__)

STEPS = ["schema", "raw", "staging", "dwh", "marts", "quality"]


class Runner:
    """Runs layer refreshes against the Parquet tables under `root`, one writer at a time.

    The newest `keep_runs` complete runs of a layer are kept, so readers of the previous one can
    finish; `multiline` names the sources whose fields may hold line breaks. A layer that breaks a declared
    key or rule stops the dwh step unless `allow_violations` is set, which only logs what is broken. `catalog` names a
    database whose views are pointed at the stored marts of the newest run.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        source_dir: str | None = None,
        file_pattern: str = "{table}.csv",
        file_names: dict[str, str] | None = None,
        multiline: frozenset[str] = FREE_TEXT,
        keep_runs: int = 2,
        store_marts: bool = True,
        allow_violations: bool = False,
        catalog: str | None = None,
    ):
        self.spark = spark
        self.store = LayerStore(spark, root)
        self.source_dir = source_dir
        self.file_pattern = file_pattern
        self.file_names = file_names
        self.multiline = multiline
        self.keep_runs = keep_runs
        self.store_marts = store_marts
        self.allow_violations = allow_violations
        self.catalog = catalog

    def schema(self) -> None:
        """Make an empty raw layer when none was ever loaded, so that later steps have typed inputs."""
        if not self.store.runs("raw"):
            self.store.write_layer("raw", {t: self.spark.createDataFrame([], raw_schema(t)) for t in RAW_TABLES})

    def raw(self) -> None:
        if not self.source_dir:
            raise ValueError("the raw step needs a source folder")
        measures = lambda table: constraints.measures("raw", table)
        load_all_raw(
            self.spark, self.source_dir, self.store, self.file_pattern, self.file_names, self.multiline, measures
        )
        self.store.drop_old_runs("raw", self.keep_runs)

    def staging(self) -> None:
        raw = self.store.read_layer("raw", RAW_TABLES)
        measures = lambda table: constraints.measures("staging", table)
        self.store.write_layer("staging", Warehouse(self.spark, raw).staging_layer(), measures=measures)
        self.store.drop_old_runs("staging", self.keep_runs)

    def gate(self, layer: str, run: str, names: list[str], measured: dict[str, dict[str, int]] | None) -> None:
        """Stop with table, rule and count when the tables of `run` break what is declared for `layer`."""
        tables, rows = self.store.read_run(run, names), self.store.read_rows(run, names)
        broken = constraints.findings(layer, tables, measured, rows).orderBy("table_name", "rule").collect()
        texts = [f"{r.table_name}: {r.rule} ({r.violations})" for r in broken]
        for text in texts:
            logger.warning("%s breaks a declared rule, %s", layer, text)
        if texts and not self.allow_violations:
            raise constraints.ViolationError(f"layer {layer} breaks declared rules: {'; '.join(texts)}")

    def dwh(self) -> None:
        """Build dimensions and facts from a staging layer that keeps its rules; a dwh that breaks its own is not kept.

        Each table is written once, into the run's folder, and its NULLs and value rules are counted by that write.
        """
        staging = self.store.read_layer("staging", STAGING_TABLES)
        for layer, names in (("raw", RAW_TABLES), ("staging", STAGING_TABLES)):
            self.gate(layer, self.store.current(layer), names, self.store.measured(layer))

        def build(run: str, observed: Observed) -> None:
            warehouse = Warehouse(self.spark, ready=staging, run_folder=run, observe=observed.attach)
            try:
                warehouse.prepare([*DWH_TABLES, ROLLUP])
            finally:
                warehouse.drop_work_files()

        self.store.build_layer(
            "dwh",
            build,
            accept=lambda run, measured: self.gate("dwh", run, DWH_TABLES, measured),
            measures=lambda table: constraints.measures("dwh", table),
        )
        self.store.drop_old_runs("dwh", self.keep_runs)

    def _warehouse(self) -> Warehouse:
        """The current dwh tables as the marts' plans need them: with hidden columns and the rollup."""
        run, names = self.store.current("dwh"), [*DWH_TABLES, ROLLUP]
        return Warehouse(self.spark, ready=self.store.read_run(run, names, hidden=True), ready_rows=self.store.read_rows(run, names))

    def marts(self) -> dict[str, DataFrame]:
        """Write the marts as a layer and publish them as views `marts_<name>`.

        Without `store_marts` they are only views of this session, evaluated when read.
        """
        warehouse = self._warehouse()
        views = {m: warehouse.mart(m) for m in MARTS}
        if self.store_marts:
            self.store.write_layer("marts", views)
            self.store.drop_old_runs("marts", self.keep_runs)
            views = self.store.read_layer("marts", MARTS)
            if self.catalog:
                publish_catalog(self.spark, self.store.current("marts"), MARTS, self.catalog, f"{self.store.root}/catalog")
        publish_views(views, "marts")
        return views

    def quality(self, fail_fast: bool = False) -> list:
        """All checks; those on marts read the stored ones, or evaluate them from dwh when none are stored."""
        dwh = self.store.read_layer("dwh", DWH_TABLES)
        if self.store.runs("marts"):
            marts = self.store.read_layer("marts", MARTS)
        else:
            warehouse = self._warehouse()
            marts = {m: warehouse.mart(m) for m in MARTS}
        tables = {"orders": self.store.read("raw", "orders"), **dwh, **marts}
        return quality.run_checks(tables, fail_fast, quality.CHECKS)

    def run(self, step: str = "all", fail_fast: bool = False) -> list | None:
        """Run one step, or all of them; returns the quality rows when they were computed."""
        results = None
        for name in STEPS if step == "all" else [step]:
            if name not in STEPS:
                raise ValueError(f"unknown step {name!r}, expected one of {STEPS} or 'all'")
            logger.info("step %s", name)
            results = self.quality(fail_fast) if name == "quality" else getattr(self, name)()
        return results if step in ("all", "quality") else None


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Refresh the commerce warehouse.")
    parser.add_argument("--step", choices=[*STEPS, "all"], default="all")
    parser.add_argument("--root", required=True, help="folder of the layers, on shared storage")
    parser.add_argument("--source-dir", help="folder of the source CSV files")
    parser.add_argument("--file-pattern", default="{table}.csv", help="file name of a table")
    parser.add_argument(
        "--file-name", action="append", default=[], metavar="TABLE=NAME", help="file of one table, before the pattern"
    )
    parser.add_argument(
        "--multiline", default=",".join(sorted(FREE_TEXT)), help="comma-separated tables with line breaks in fields"
    )
    parser.add_argument("--keep-runs", type=int, default=2, help="complete runs to keep per layer")
    parser.add_argument("--mart-views", action="store_true", help="leave the marts as views of the session")
    parser.add_argument("--catalog", metavar="DATABASE", help="point the views of a catalog database at the stored marts")
    parser.add_argument("--allow-violations", action="store_true", help="log broken keys and rules and go on")
    parser.add_argument("--fail-fast-quality", action="store_true")
    args = parser.parse_args(argv)
    file_names = dict(entry.partition("=")[::2] for entry in args.file_name)
    if unknown := {*file_names, *filter(None, args.multiline.split(","))} - set(RAW_TABLES):
        parser.error(f"no such tables: {', '.join(sorted(unknown))}")
    logging.basicConfig(level=logging.INFO)
    runner = Runner(
        build_session(),
        args.root,
        args.source_dir,
        args.file_pattern,
        file_names,
        multiline=frozenset(filter(None, args.multiline.split(","))),
        keep_runs=args.keep_runs,
        store_marts=not args.mart_views,
        allow_violations=args.allow_violations,
        catalog=args.catalog,
    )
    results = runner.run(args.step, args.fail_fast_quality)
    if results:
        print(quality.report_text(results))


if __name__ == "__main__":
    main()
