"""Cleaning rules for text columns (spaces only are trimmed, NULL always stays NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Spellings accepted for yes / no answers, compared after trim and lower.
TRUE_WORDS = ["true", "1", "yes", "y", "sim"]
FALSE_WORDS = ["false", "0", "no", "n", "nao", "não"]

ZIP_WIDTH = 5


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zip_prefix(c: Column | str) -> Column:
    """Five characters, zero-filled on the left; longer input is cut, blank becomes all zeros."""
    return F.lpad(F.trim(_col(c)), ZIP_WIDTH, "0")


def lower_text(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def upper_code(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def blank_to_unknown(c: Column | str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(UNKNOWN))


def blank_to_unknown_lower(c: Column | str) -> Column:
    return blank_to_unknown(F.lower(_col(c)))


def yes_no(c: Column | str) -> Column:
    """Three-valued: unrecognised answers and NULL give NULL."""
    word = lower_text(c)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def has_content(c: Column | str) -> Column:
    return F.length(F.trim(F.coalesce(_col(c), F.lit("")))) > 0


def label_or_unknown(c: Column | str) -> Column:
    """Label stored in a dimension: an empty or missing value is the `unknown` member."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(UNKNOWN))
