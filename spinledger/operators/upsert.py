"""Keyed items: projection, key check and overwrite by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import exact_decimal, plain_number


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with every key of ``new`` replaced. ``new`` must be unique by key.

    Rows with a null in their key cannot be stored and are left out on both sides.
    """
    existing, new = with_complete_key(existing, keys), with_complete_key(new, keys)
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def to_items(rows: DataFrame, attributes: dict[str, str]) -> DataFrame:
    """Rows as store items: the named attributes only, text or exact decimal."""
    return rows.select(
        [
            (exact_decimal(F.col(name)) if kind == "number" else F.col(name).cast("string")).alias(name)
            for name, kind in attributes.items()
        ]
    )


def items_json(items: DataFrame) -> DataFrame:
    """Items as JSON text (item); a null attribute is left out of its item.

    A decimal is a number with all its digits and no trailing zeros.
    """
    parts = []
    for name, kind in items.dtypes:
        if kind.startswith("decimal"):
            value = plain_number(F.col(name))
        else:
            # An array of one text is written with its quotes and escapes.
            value = F.regexp_extract(F.to_json(F.array(F.col(name))), r"(?s)^\[(.*)\]$", 1)
        parts.append(F.when(F.col(name).isNotNull(), F.concat(F.lit(f'"{name}":'), value)))
    return items.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("item"))


def with_complete_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that can be stored: no key attribute is null."""
    return rows.dropna("any", subset=keys)


def with_incomplete_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The complement of ``with_complete_key``, with the reason."""
    missing = F.concat_ws(",", *[F.when(F.col(key).isNull(), F.lit(key)) for key in keys])
    return rows.where(missing != "").withColumn("reason", F.concat(F.lit("null key: "), missing))
