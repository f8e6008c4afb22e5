"""Records that span lines, put together without gathering a file.

A line break inside quotes belongs to its field. Whether a line begins inside quotes
depends on all lines before it, also in other splits. So every line, and then every split,
is judged for both cases: a pair of bits says whether quotes are open after it if they
were closed, or open, before it. Pairs are composed by running windows, within a split over its
lines and within a file over one row per split. Only lines of files in which some line leaves
quotes open are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A longer record is malformed and is not put together; a quote that is never closed would
# make one record of the rest of its file.
RECORD_CHARS = 1 << 20
# What a report shows of such a record.
_SHOWN = 200


def opens_quote(value: Column) -> Column:
    """Whether quotes are open after a line that begins outside them."""
    return value.contains('"') & _open_after(_single_quotes(value))


def _single_quotes(value: Column) -> Column:
    # Two quotes side by side change nothing wherever they stand: empty quotes, or a quote as text.
    return F.replace(value, F.lit('""'), F.lit(""))


def _open_after(value: Column) -> Column:
    # Fields that close their quotes go; text after a closing quote runs to the comma.
    rest = F.regexp_replace(value, r'(?s)(^|,)"[^"]*+"[^,]*+', "$1")
    return rest.startswith('"') | rest.contains(',"')


def spanning_files(splits: DataFrame) -> DataFrame:
    """Names of the files in which a line leaves quotes open, of a ``split_summary``."""
    return splits.where("opens").select("file").distinct()


def with_records(lines: DataFrame, files: DataFrame) -> DataFrame:
    """The lines, those of ``files`` put together to records; the others are not shuffled
    while the names are few."""
    return lines.join(files, "file", "left_anti").unionByName(join_records(lines.join(files, "file", "left_semi")))


def join_records(lines: DataFrame) -> DataFrame:
    """(file, block, pos, value) of the records in ``lines``.

    A record lies in the block where it begins and ``pos`` counts the records of a block from
    1. A break inside quotes is a line feed, whatever ends the lines of the file. Quotes that are
    open at the end of a file end with it. A record of more than ``RECORD_CHARS`` characters comes as
    the beginning of its first line with more fields than any sound record.
    """
    placed = _placed(lines)
    blocks = _blocks(placed)
    # One row per split on one side.
    joined = placed.join(blocks, ["file", "block"])
    inside = F.when(F.col("begins_inside"), F.col("in1")).otherwise(F.col("in0"))
    in_block = Window.partitionBy("file", "block").orderBy("pos")
    numbered = joined.withColumn("number", F.sum(F.when(inside, 0).otherwise(1)).over(in_block))
    in_record = Window.partitionBy("file", "block", "number").orderBy("pos")
    carried = F.when(F.col("number") == 0, F.col("carried")).otherwise(F.lit(0))
    sized = numbered.withColumn("running", carried + F.sum("size").over(in_record))
    own = F.col("number") > 0
    part = F.struct(F.col("block").alias("at"), "pos", "value")
    records = sized.groupBy(
        "file",
        F.when(own, F.col("block")).otherwise(F.col("owner.block")).alias("begin"),
        F.when(own, F.col("number")).otherwise(F.col("owner.number")).alias("record"),
    ).agg(
        F.sort_array(F.collect_list(F.when(F.col("running") <= RECORD_CHARS, part))).alias("parts"),
        F.min_by(F.left("value", F.lit(_SHOWN)), F.struct("block", "pos")).alias("beginning"),
        F.max("running").alias("chars"),
    )
    text = F.array_join(F.transform("parts", lambda each: each["value"]), "\n")
    too_wide = F.concat(F.replace(F.col("beginning"), F.lit('"'), F.lit("")), F.lit(",,,"))
    return records.select(
        "file",
        F.col("begin").alias("block"),
        F.col("record").alias("pos"),
        F.when(F.col("chars") <= RECORD_CHARS, text).otherwise(too_wide).alias("value"),
    )


def _placed(lines: DataFrame) -> DataFrame:
    """The lines with whether they begin inside quotes, for a split that begins outside (``in0``) or inside (``in1``)."""
    single = _single_quotes(F.col("value"))
    quoted = F.col("value").contains('"')
    turned = lines.withColumn("after0", quoted & _open_after(single)).withColumn(
        "after1", ~quoted | _open_after(F.concat(F.lit('"'), single))
    )
    before = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = _composed(turned, before).withColumns(
        {
            "in0": _state(F.lit(False)),
            "in1": _state(F.lit(True)),
            # The line feed counts.
            "size": F.length("value") + 1,
        }
    )
    return placed.drop("swaps", "set")


def _composed(rows: DataFrame, before) -> DataFrame:
    """The turns of all rows before: the last one that sets the state, and the swaps counted since."""
    swap = (F.col("after0") & ~F.col("after1")).cast("bigint")
    counted = rows.withColumn("swaps", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    sets = F.when(F.col("after0") == F.col("after1"), F.struct(F.col("after0").alias("value"), F.col("swaps")))
    return counted.withColumn("set", F.last(sets, ignorenulls=True).over(before))


def _state(first: Column) -> Column:
    since = F.col("swaps") - F.coalesce(F.col("set.swaps"), F.lit(0))
    return F.coalesce(F.col("set.value"), first) != (since % 2 == 1)


def _blocks(placed: DataFrame) -> DataFrame:
    """Per split: whether it begins inside quotes, which record that is, and how long it is by then."""
    sides = {}
    for side in ("0", "1"):
        inside = F.col(f"in{side}")
        sides[side] = F.struct(
            F.max_by(F.when(inside, F.col("after1")).otherwise(F.col("after0")), "pos").alias("after"),
            F.count_if(~inside).alias("starts"),
            F.max(F.when(~inside, F.col("pos"))).alias("last_start"),
            F.min(F.when(~inside, F.col("pos"))).alias("first_start"),
        )
    ends = placed.groupBy("file", "block").agg(*[column.alias(f"side{side}") for side, column in sides.items()])
    chain = ends.withColumns({"after0": F.col("side0.after"), "after1": F.col("side1.after")})
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = _composed(chain, before).withColumn("begins_inside", _state(F.lit(False)))
    side = F.when(F.col("begins_inside"), F.col("side1")).otherwise(F.col("side0"))
    begun = begun.withColumn("side", side).select("file", "block", "begins_inside", "side")
    # Characters before the first and from the last record that begins in the split.
    first, last = F.col("side.first_start"), F.col("side.last_start")
    sizes = (
        placed.select("file", "block", "pos", "size")
        .join(begun, ["file", "block"])
        .groupBy("file", "block")
        .agg(
            F.first("begins_inside").alias("begins_inside"),
            F.first("side.starts").alias("starts"),
            F.coalesce(F.sum(F.when(first.isNull() | (F.col("pos") < first), F.col("size"))), F.lit(0)).alias("head"),
            F.coalesce(F.sum(F.when(F.col("pos") >= last, F.col("size"))), F.lit(0)).alias("tail"),
        )
    )
    heads = F.coalesce(F.sum("head").over(before), F.lit(0))
    summed = sizes.withColumn("heads", heads)
    owner = F.when(
        F.col("starts") > 0,
        F.struct("block", F.col("starts").alias("number"), "tail", (F.col("heads") + F.col("head")).alias("heads")),
    )
    owned = summed.withColumn("owner", F.last(owner, ignorenulls=True).over(before))
    carried = F.col("owner.tail") + F.col("heads") - F.col("owner.heads")
    return owned.select("file", "block", "begins_inside", "owner", F.coalesce(carried, F.lit(0)).alias("carried"))
