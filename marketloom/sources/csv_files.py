"""CSV sources with database bulk-load semantics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.sources.files import path_exists
from marketloom.sources.layers import LayerStore, Measures
from marketloom.sources.schemas import RAW_TABLES, raw_schema

# An unquoted empty field is NULL and a quoted one is an empty text. Spark makes both NULL
# unless NULL is spelled as something that cannot occur in the file.
_NO_SUCH_TEXT = "\u0001"

#: Sources with free text, whose quoted fields may hold line breaks; all others are split over tasks.
FREE_TEXT = frozenset({"order_reviews"})


def file_of(table: str, pattern: str = "{table}.csv", names: dict[str, str] | None = None) -> str:
    """File (or folder of part files, or glob) holding a table; `names` overrides the pattern."""
    return (names or {}).get(table) or pattern.format(table=table)


def read_csv(spark: SparkSession, path: str, table: str, line_breaks: bool = True) -> DataFrame:
    """Rows of one source: header skipped, columns by position, any malformed row aborts the job.

    Quoted fields may contain line breaks, so one file is read by one task; a large source is
    meant to be a folder or glob of part files. `line_breaks=False` states that no field holds
    one, and lets Spark split large files; each file still starts with a header.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source file not found: {path}")
    return (
        spark.read.schema(raw_schema(table))
        .options(
            header="true",
            enforceSchema="true",
            multiLine=str(line_breaks).lower(),
            quote='"',
            escape='"',
            nullValue=_NO_SUCH_TEXT,
            emptyValue="",
            encoding="UTF-8",
            mode="FAILFAST",
        )
        .csv(path)
    )


def load_all_raw(
    spark: SparkSession,
    source_dir: str,
    store: LayerStore,
    pattern: str = "{table}.csv",
    names: dict[str, str] | None = None,
    multiline: frozenset[str] = FREE_TEXT,
    measures: Callable[[str], Measures] | None = None,
) -> str:
    """Full refresh of the raw layer; the previous one stays current if any file fails.

    Only the files of `multiline` may hold line breaks in fields; a break in any other aborts the load. `measures` names what to count of a table while it is written.
    """
    folder = source_dir.rstrip("/")
    frames = {
        t: read_csv(spark, f"{folder}/{file_of(t, pattern, names)}", t, t in multiline) for t in RAW_TABLES
    }
    return store.write_layer("raw", frames, measures=measures)
