"""Ad-hoc SQL over published views."""

from __future__ import annotations

import logging
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marketloom.sources.declared import schema_of

logger = logging.getLogger(__name__)

#: Error conditions of a mart that is not there yet; every other problem of a query is raised.
MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "UNRESOLVED_COLUMN")


def read_sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Query with named `:parameters`; list values bind as arrays."""
    return spark.sql(text, args=args or {})


def read_scalar(spark: SparkSession, text: str, args: dict[str, Any] | None = None) -> Any:
    """First column of the first row, None when there is no row."""
    row = read_sql(spark, text, args).first()
    return None if row is None else row[0]


def read_sql_or_empty(
    spark: SparkSession, text: str, schema: StructType | str, args: dict[str, Any] | None = None
) -> DataFrame:
    """As `read_sql`, but a missing view or column is reported and gives an empty frame of `schema`.

    Syntax, type and other errors are raised.
    """
    try:
        return read_sql(spark, text, args)
    except AnalysisException as problem:
        if not (problem.getCondition() or "").startswith(MISSING):
            raise
        logger.error("query could not be read: %s", problem)
        return spark.createDataFrame([], schema)


def read_mart(spark: SparkSession, mart: str) -> DataFrame:
    """A published mart, or an empty frame of its declared type where it is not published."""
    return read_sql_or_empty(spark, f"SELECT * FROM marts_{mart}", schema_of(mart))
