"""ISO 8601 listen times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: date, then optionally a time of growing precision, then an offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([ T]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?([+-]\d{2}:\d{2})?)?$"
)
# Hours alone, and an offset without seconds, are valid ISO but not Spark literals.
_NO_MINUTES = r"^(.{10}[ T]\d{2})($|[+-])"
_OFFSET = r"^(.*)([+-])(\d{2}):(\d{2})$"
_FAR_OFFSET = r"[+-](1[89]|2\d):\d{2}$"
_NO_SECONDS = r"^(.{10}[ T]\d{2}:\d{2})($|[+-])"


def iso_timestamp(text: Column) -> Column:
    """The instant an ISO text names, or null. Text without an offset is UTC."""
    minutes = F.regexp_replace(text, _NO_MINUTES, "$1:00$2")
    widened = F.regexp_replace(minutes, _NO_SECONDS, "$1:00$2")
    # Nearly all text has its seconds and skips the rewriting.
    has_seconds = (F.substring(text, 14, 1) == ":") & (F.substring(text, 17, 1) == ":")
    complete = F.when(has_seconds, text).otherwise(widened)
    # The pattern alone lets 2024-02-30 pass and the cast alone lets 2024 pass.
    return F.when(
        text.rlike(ISO_PATTERN) & ~text.startswith("0000"),
        F.when(text.rlike(_FAR_OFFSET), _with_far_offset(complete)).otherwise(complete.try_cast("timestamp")),
    )


def _with_far_offset(complete: Column) -> Column:
    """The cast takes offsets of up to 18 hours; larger ones, below 24, are taken off by hand."""
    local = F.regexp_replace(complete, _OFFSET, "$1").try_cast("timestamp")
    hours, minutes = (F.regexp_extract(complete, _OFFSET, group).try_cast("int") for group in (3, 4))
    seconds = hours * 3600 + minutes * 60
    signed = F.when(F.regexp_extract(complete, _OFFSET, 2) == "-", -seconds).otherwise(seconds)
    return F.when((hours < 24) & (minutes < 60), F.timestamp_add("SECOND", -signed, local))
