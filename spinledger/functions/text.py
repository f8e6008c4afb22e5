"""Dates, ranks and numbers as the text the KPI tables and reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of keys and reports.
MANIFEST_KEY_FORMAT = "manifests/%s.json"
RANK_LABEL_FORMAT = "#%02d"
RANK_WIDTH = 2
MAX_RANK = 99
MS_PER_MINUTE = 60000
# Digits of decimals before and after the point: 20 and 18.
DECIMAL_SCALE = 18


def date_text(day: Column) -> Column:
    """A date as ``YYYY-MM-DD``."""
    return day.cast("string")


def padded_rank(rank: Column) -> Column:
    """``1`` as ``01``, so that ranks sort as text."""
    return F.lpad(rank.cast("string"), RANK_WIDTH, "0")


def date_rank(day: Column, rank: Column) -> Column:
    """The sort key ``2024-06-25#01``."""
    return F.concat(date_text(day), F.lit("#"), padded_rank(rank))


def exact_decimal(value: Column, scale: int = DECIMAL_SCALE) -> Column:
    """A number as decimal by way of its shortest text, never its binary value.

    Every digit of that text is kept. A number that needs more places than the type has,
    such as one below 0.1 with 17 digits, raises instead of being rounded.
    """
    exact = value.cast("string").cast(f"decimal(38,{scale})")
    lost = F.raise_error(F.concat(F.lit("no exact decimal for "), value.cast("string")))
    return F.when(exact.cast("double") == value.cast("double"), exact).when(value.isNotNull(), lost.cast(f"decimal(38,{scale})"))


def plain_number(value: Column) -> Column:
    """A decimal as text without trailing zeros: ``5``, ``233333.33333333334``."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def manifest_key(object_key: Column) -> Column:
    """The manifest that belongs to an input key."""
    return F.format_string(MANIFEST_KEY_FORMAT, object_key)


def minutes(milliseconds: Column, digits: int = 1) -> Column:
    """Milliseconds as minutes, rounded for a report."""
    return F.round(milliseconds / F.lit(MS_PER_MINUTE), digits)


def rank_label(rank: Column) -> Column:
    """``1`` as ``#01``."""
    return F.format_string(RANK_LABEL_FORMAT, rank.cast("int"))
