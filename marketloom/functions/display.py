"""Text forms of figures for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _grouped(c: Column, decimals: int) -> Column:
    return F.replace(F.format_number(c, decimals), F.lit(","), F.lit(" "))


def as_brl(c: Column) -> Column:
    """Amount in reais without cents, thousands split by a space."""
    return F.concat(F.lit("R$ "), _grouped(F.coalesce(c.cast("double"), F.lit(0.0)), 0))


def as_percent(c: Column) -> Column:
    """Share as a percentage with one decimal."""
    share = F.format_number(F.coalesce(c.cast("double"), F.lit(0.0)) * 100, 1)
    return F.concat(F.replace(share, F.lit(","), F.lit("")), F.lit(" %"))


def as_count(c: Column) -> Column:
    """Whole number, fraction cut off, thousands split by a space."""
    return _grouped(F.coalesce(c, F.lit(0)).cast("bigint"), 0)


def as_fixed(c: Column, decimals: int, unit: str = "") -> Column:
    """Number with so many decimals, no grouping, and its unit."""
    shown = F.replace(F.format_number(F.coalesce(c.cast("double"), F.lit(0.0)), decimals), F.lit(","), F.lit(""))
    return F.concat(shown, F.lit(f" {unit}")) if unit else shown
