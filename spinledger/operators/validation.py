"""Rules for stream files, row by row and file by file.

Input everywhere is a frame of lines (file, block, pos, value), see
``sources.lines``. A file is judged by its header and its first bad record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.iso import iso_timestamp
from ..schemas import CORRUPT_COLUMN, STREAM_COLUMNS, STREAM_RECORD
from .records import opens_quote

# Reasons, and the wording reports use for them.
WIDTH = "column count mismatch"
EMPTY = "empty value in required field"
NOT_ISO = "is not ISO datetime"
NOT_UTF8 = "not valid utf-8"
BAD_HEADER = "header mismatch"
EMPTY_FILE = "file is empty"
HEADER_ONLY = "file contains only a header, no data rows"
PASSED = "PASSED"

_RECORD_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    # A quote inside a quoted field is written twice.
    "escape": '"',
}
_INSTANT = "_instant"
# Below the parser's limit of 20,480 columns.
_MANY_COMMAS = 20_000
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_THREE_FIELDS = f"(?s)^{_FIELD}(?:,{_FIELD}){{{len(STREAM_COLUMNS) - 1}}}$"
_RECORD_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STREAM_RECORD.fields)


def judge_lines(lines: DataFrame) -> DataFrame:
    """Add the parsed fields, the instant of ``listen_time`` and ``reason``, the first
    rule a line breaks or null.

    Rules apply in the order width, empty field, timestamp. The header line is a
    line like any other here, so its reason is never null.
    """
    # Generators of one row instead of plain columns: filters on what was parsed then
    # stay above the parse, which Catalyst would otherwise repeat in them once per use.
    record = F.inline(F.array(F.from_csv(_parsable(F.col("value")), _RECORD_DDL, _RECORD_OPTIONS)))
    instant = F.explode(F.array(iso_timestamp(F.col("listen_time")))).alias(_INSTANT)
    return lines.select("*", record).select("*", instant).withColumn("reason", _reason())


def _parsable(value: Column) -> Column:
    """The line, or for one of far too many fields a short line that is just as malformed.

    The parser fails on records beyond its limit of columns. Commas are counted by length;
    only where they are many does it matter whether quotes hold them together.
    """
    commas = F.length(value) - F.length(F.replace(value, F.lit(",")))
    return F.when((commas > _MANY_COMMAS) & ~value.rlike(_THREE_FIELDS), F.lit("," * len(STREAM_COLUMNS))).otherwise(value)


def _reason() -> Column:
    empty = F.lit(False)
    for name in STREAM_COLUMNS:
        # The parser turns both ,, and "" into null. Blanks are a value.
        empty = empty | F.col(name).isNull() | (F.col(name) == "")
    return (
        F.when(~F.is_valid_utf8("value"), NOT_UTF8)
        # The parser skips a blank line and would end a record at a carriage return.
        .when(
            (F.col("value") == "") | F.col("value").contains("\r") | F.col(CORRUPT_COLUMN).isNotNull(),
            WIDTH,
        )
        .when(empty, EMPTY)
        .when(F.col(_INSTANT).isNull(), NOT_ISO)
    )


def _is_header() -> Column:
    """Exactly the expected names, in order and case, and nothing else."""
    same = F.col(CORRUPT_COLUMN).isNull()
    for name in STREAM_COLUMNS:
        same = same & F.col(name).eqNullSafe(F.lit(name))
    return same


def good_plays(judged: DataFrame) -> DataFrame:
    """Typed plays of the lines that break no rule. Headers drop out with the rest."""
    return judged.where(F.col("reason").isNull()).select(
        "file", "user_id", "track_id", F.col(_INSTANT).alias("listen_time")
    )


def line_message(line_no: Column, reason: Column, value: Column, listen_time: Column) -> Column:
    """What a person reads about one bad line."""
    where = F.concat(F.lit("line "), line_no.cast("string"), F.lit(": "))
    return F.when(
        reason == NOT_ISO,
        F.concat(where, F.lit("listen_time '"), listen_time, F.lit("' "), reason),
    ).otherwise(F.concat(where, reason, F.lit(" — "), value))


def split_summary(lines: DataFrame) -> DataFrame:
    """One row per split: how many lines, where it starts, its first bad line.

    All lines of a split come from one task, so this shrinks the data to one row
    per split before anything is shuffled. ``headers`` holds the first two positions of
    lines that read exactly like the header; a sound file has one such line. It stays
    apart from ``bad`` because only the position in the file tells whether such a line is
    the header or a bad record. ``opens`` says whether a line leaves quotes open.
    """
    judged = judge_lines(lines)
    bad = F.struct("pos", "reason", "value", "listen_time")
    header = _is_header()
    return judged.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("pos").alias("first_pos"),
        F.min_by(F.struct("value", header.alias("ok")), "pos").alias("first_line"),
        F.min(F.when(F.col("reason").isNotNull() & ~header, bad)).alias("bad"),
        F.slice(F.array_sort(F.collect_list(F.when(header, F.col("pos")))), 1, 2).alias("headers"),
        F.bool_or(opens_quote(F.col("value"))).alias("opens"),
    )


def _with_offsets(blocks: DataFrame) -> DataFrame:
    """Add the number of lines of the same file before each block."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("offset", F.coalesce(F.sum("lines").over(before), F.lit(0)))


def file_verdicts(lines: DataFrame) -> DataFrame:
    """``verdicts_of`` the splits of ``lines``."""
    return verdicts_of(split_summary(lines))


def verdicts_of(splits: DataFrame) -> DataFrame:
    """(file, ok, reason, line_no, message, row_count, data_rows) per file with content.

    ``row_count`` is the number of data rows before the first bad one, or all of
    them; ``data_rows`` is always all of them.
    """
    blocks = _with_offsets(splits)
    # A second line that reads like the header is a bad record of its own.
    repeated = F.array_min(
        F.when(
            F.col("offset") == 0,
            F.filter("headers", lambda pos: pos > F.col("first_pos")),
        ).otherwise(F.col("headers"))
    )
    header_text = F.lit(",".join(STREAM_COLUMNS))
    again = F.when(
        repeated.isNotNull(),
        F.struct(
            repeated.alias("pos"),
            F.lit(NOT_ISO).alias("reason"),
            header_text.alias("value"),
            F.lit(STREAM_COLUMNS[2]).alias("listen_time"),
        ),
    )
    # The first line of a file is the header whatever it holds; it is judged below.
    bad = F.when(~((F.col("offset") == 0) & (F.col("bad.pos") == F.col("first_pos"))), F.col("bad"))
    first = F.least(bad, again)
    numbered = blocks.withColumn("first", first).select(
        "file",
        "block",
        "lines",
        "first_line",
        F.when(
            F.col("first").isNotNull(),
            F.struct(
                (F.col("first.pos") - F.col("first_pos") + F.col("offset") + 1).alias("line_no"),
                F.col("first.reason").alias("reason"),
                F.col("first.value").alias("value"),
                F.col("first.listen_time").alias("listen_time"),
            ),
        ).alias("first"),
    )
    files = numbered.groupBy("file").agg(
        F.sum("lines").alias("lines"),
        F.min_by("first_line", "block").alias("header"),
        F.min("first").alias("first"),
    )
    header_ok = F.col("header.ok")
    bad_line = F.col("first").isNotNull()
    return files.select(
        "file",
        (header_ok & ~bad_line & (F.col("lines") > 1)).alias("ok"),
        F.when(~header_ok, BAD_HEADER)
        .when(bad_line, F.col("first.reason"))
        .when(F.col("lines") == 1, HEADER_ONLY)
        .alias("reason"),
        F.when(~header_ok, F.lit(1).cast("bigint")).when(bad_line, F.col("first.line_no")).alias("line_no"),
        F.when(
            ~header_ok,
            F.concat(
                F.lit(f"{BAD_HEADER}: expected "), header_text, F.lit(", got "), F.col("header.value")
            ),
        )
        .when(
            bad_line,
            line_message(
                F.col("first.line_no"), F.col("first.reason"), F.col("first.value"), F.col("first.listen_time")
            ),
        )
        .when(F.col("lines") == 1, F.lit(HEADER_ONLY))
        .otherwise(
            F.concat(F.lit(f"{PASSED} — "), (F.col("lines") - 1).cast("string"), F.lit(" rows checked"))
        )
        .alias("message"),
        F.when(~header_ok, F.lit(0).cast("bigint"))
        .when(bad_line, F.col("first.line_no") - 2)
        .otherwise(F.col("lines") - 1)
        .alias("row_count"),
        (F.col("lines") - 1).alias("data_rows"),
    )


def empty_file_verdicts(files: DataFrame) -> DataFrame:
    """Verdicts for files without any content."""
    return files.select(
        "file",
        F.lit(False).alias("ok"),
        F.lit(EMPTY_FILE).alias("reason"),
        F.lit(None).cast("bigint").alias("line_no"),
        F.lit(EMPTY_FILE).alias("message"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(0).cast("bigint").alias("data_rows"),
    )


def bad_lines(lines: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """(file, line_no, reason, value, message) for every bad line; headers left out.

    ``splits`` is a stored ``split_summary`` of the same lines, which saves a scan of them.

    Only bad lines are shuffled. They meet their split's offset on (file, block), a
    key that no hot file can concentrate beyond the size of one split.
    """
    judged = judge_lines(lines)
    if splits is None:
        splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("pos").alias("first_pos"))
    offsets = _with_offsets(splits.select("file", "block", "lines", "first_pos")).select("file", "block", "first_pos", "offset")
    line_no = F.col("pos") - F.col("first_pos") + F.col("offset") + 1
    return (
        judged.where(F.col("reason").isNotNull())
        .join(offsets, ["file", "block"], "left")
        .select("file", line_no.alias("line_no"), "reason", "value", "listen_time")
        # Line 1 is judged as the header by the file's verdict, not as a record.
        .where(F.col("line_no").isNull() | (F.col("line_no") > 1))
        .select(
            "file",
            "line_no",
            "reason",
            "value",
            line_message(
                F.col("line_no"), F.col("reason"), F.col("value"), F.col("listen_time")
            ).alias("message"),
        )
    )
