"""Trailing-frame measures whose cost does not grow with the frame.

A frame ``(t - frame, t]`` is cut at block limits: the rows of the current
block up to ``t``, whole blocks in between, and the tail of the block the
frame starts in. Each row is placed in its own block and, as an expiring
copy, in the block its influence ends in. Both ends are then running
aggregates over one exchange on (keys, block). A key with a large share of
all rows is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.moments import (
    merged_deviation,
    merged_deviation_of_array,
    sample_stddev,
    squared_deviation,
)

# Frames of up to so many blocks send a row to the blocks of its frame inside a task; a stretch has this many frames.
FEW_BLOCKS = 4
STRETCH_FRAMES = 2


def block_index(position: Column, size: int) -> Column:
    """Index of the block of ``size`` that holds an integer position."""
    return ((position - F.pmod(position, F.lit(size))) / size).cast("long")


def trailing_stats(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    frame: int,
    value: str,
    names: dict[str, str],
    block: int | None = None,
    place: tuple[str, int] | None = None,
) -> DataFrame:
    """Adds statistics of ``value`` over ``(position - frame, position]``.

    ``position`` is an integer expression such as epoch microseconds or a row
    index; rows with equal keys and position see each other. ``names`` maps
    some of ``count, sum, avg, stddev, max`` to output columns. ``frame`` must
    be a multiple of ``block`` (default: equal); smaller blocks spread a heavy
    key further. ``place = (name, size)`` adds the index of the position's
    stretch of ``size`` (a multiple of ``block``) and exchanges on (keys, that
    column), so later steps grouped on it need no exchange of their own.
    Frames of a few blocks are exchanged by stretches of ``STRETCH_FRAMES``
    frames, which spreads a heavy key by stretches.
    """
    block = block or frame
    if frame % block:
        raise ValueError("frame must be a multiple of block")
    span = frame // block
    deviation = "stddev" in names
    keys = list(keys)

    own = rows.withColumn("_pos", position).withColumn("_block", block_index(F.col("_pos"), block))
    carried = [c for c in rows.columns if c not in keys]
    visiting = not place and 1 < span <= FEW_BLOCKS
    if visiting:
        both, where = _visits(own, keys, carried, value, frame, span)
    else:
        # Copies carry the value only; making them here joins nothing; more
        # than one block a frame reads the input again for the block summaries.
        both = own.withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False)))).withColumns(
            {
                **{c: F.when(F.col("_own"), F.col(c)) for c in carried},
                "_leaving": F.when(~F.col("_own"), F.col(value)),
                "_pos": F.when(F.col("_own"), F.col("_pos")).otherwise(F.col("_pos") + frame),
                "_block": F.when(F.col("_own"), F.col("_block")).otherwise(F.col("_block") + span),
            }
        )
        where = [*keys, "_block"]
        if place:
            stretch = block_index(F.col("_block") * block, place[1])
            both = both.withColumn(place[0], stretch).repartition(*keys, place[0])
            where = [*keys, place[0], "_block"]

    up_to_now = (
        Window.partitionBy(*where)
        .orderBy("_pos")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Own rows sort ahead of copies that expire at the same position, so the
    # running aggregate holds exactly the copies still inside the frame.
    still_inside = (
        Window.partitionBy(*where)
        .orderBy(F.col("_pos").desc(), F.col("_own").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = {}
    measures = [("_new", F.col(value), up_to_now), ("_old", F.col("_leaving"), still_inside)]
    if visiting:
        measures.append(("_mid", F.col("_staying"), Window.partitionBy(*where)))
    for side, part, over in measures:
        ends[f"{side}_n"] = F.count(part).over(over)
        ends[f"{side}_s"] = F.sum(part).over(over)
        ends[f"{side}_hi"] = F.max(part).over(over)
        if deviation:
            ends[f"{side}_m2"] = F.var_pop(part).over(over) * F.count(part).over(over)
    measured = both.withColumns(ends).filter("_own")

    sides = ["_new", "_old"]
    if visiting:
        sides.append("_mid")
    elif span > 1:
        middle = _middle_blocks(own, keys, value, span, deviation)
        measured = measured.join(middle, [*keys, "_block"], "left")
        sides.append("_mid")

    def summed(field: str) -> Column:
        total = F.coalesce(F.col(f"{sides[0]}_{field}"), F.lit(0))
        for side in sides[1:]:
            total = total + F.coalesce(F.col(f"{side}_{field}"), F.lit(0))
        return total

    count, total = summed("n"), summed("s").cast("double")
    results = {
        "count": count,
        "sum": F.when(count > 0, total),
        "avg": F.try_divide(total, count),
        "max": F.greatest(*[F.col(f"{side}_hi") for side in sides]),
    }
    if deviation:
        parts = [(F.col(f"{s}_n"), F.col(f"{s}_s"), F.col(f"{s}_m2")) for s in sides]
        results["stddev"] = sample_stddev(count, merged_deviation(parts))
    kept = [F.col(c) for c in rows.columns]
    extra = [F.col(place[0])] if place else []
    return measured.select(*kept, *extra, *[_if_keyed(keys, results[stat]).alias(out) for stat, out in names.items()])


def _if_keyed(keys: Sequence[str], value: Column) -> Column:
    """``value``, or null for rows without a key: they belong to nobody's history.

    All frames apply it, so the answer does not depend on how blocks are cut.
    """
    return F.when(reduce(and_, [F.col(key).isNotNull() for key in keys]), value)


def _visits(
    own: DataFrame, keys: list[str], carried: list[str], value: str, frame: int, span: int
) -> tuple[DataFrame, list[str]]:
    """Rows in their own block, and their values in the later blocks of their frame.

    In the last of these a value leaves, in those between it stays throughout.
    Rows are exchanged by stretches of ``STRETCH_FRAMES`` frames and sent on to
    blocks after that, so only values whose frame goes on in the next stretch
    are exchanged twice, and the input is read once.
    """
    many = STRETCH_FRAMES * span
    here, last = block_index(F.col("_block"), many), block_index(F.col("_block") + span, many)
    sent = own.withColumn("_stretch", F.explode(F.when(here.eqNullSafe(last), F.array(here)).otherwise(F.array(here, last))))
    sent = sent.withColumns(
        {c: F.when(F.col("_stretch").eqNullSafe(here), F.col(c)) for c in carried if c != value}
    ).repartition(*keys, "_stretch")
    # rows without a position are in nobody's frame but each other's
    steps = F.when(F.col("_pos").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(span)))
    visits = (
        sent.withColumn("_step", F.explode(steps))
        .withColumn("_block", F.col("_block") + F.col("_step"))
        .filter(block_index(F.col("_block"), many).eqNullSafe(F.col("_stretch")))
    )
    first, leaves = F.col("_step") == 0, F.col("_step") == span
    return visits.withColumns(
        {
            **{c: F.when(first, F.col(c)) for c in carried},
            "_own": first,
            "_leaving": F.when(leaves, F.col(value)),
            "_staying": F.when(~first & ~leaves, F.col(value)),
            "_pos": F.when(leaves, F.col("_pos") + frame).otherwise(F.col("_pos")),
        }
    ), [*keys, "_stretch", "_block"]


def _middle_blocks(own: DataFrame, keys: list[str], value: str, span: int, deviation: bool) -> DataFrame:
    """Per block, the merged summary of the ``span - 1`` blocks before it."""
    per_block = own.groupBy(*keys, "_block").agg(
        F.count(value).alias("n"),
        F.sum(value).alias("s"),
        F.max(value).alias("hi"),
        squared_deviation(F.col(value)).alias("m2"),
    )
    before = Window.partitionBy(*keys).orderBy("_block").rangeBetween(-(span - 1), -1)
    measures = {
        "_mid_n": F.sum("n").over(before),
        "_mid_s": F.sum("s").over(before),
        "_mid_hi": F.max("hi").over(before),
    }
    if deviation:
        parts = F.collect_list(F.struct("n", "s", "m2")).over(before)
        mean = F.try_divide(F.sum("s").over(before), F.sum("n").over(before))
        measures["_mid_m2"] = merged_deviation_of_array(parts, mean)
    return per_block.select(*keys, "_block", *[c.alias(name) for name, c in measures.items()])


def rows_in_earlier_blocks(blocks: DataFrame, keys: Sequence[str], block: str, rows: str) -> Column:
    """Rows of the key before this block, over a table with one row per block."""
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(rows).over(before), F.lit(0))


def row_positions(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    tie_break: str,
    out: str,
    block: int | None = None,
    known: tuple[str, str] | None = None,
) -> DataFrame:
    """Zero-based index of each row within its keys by (position, tie break).

    Rows are numbered inside blocks of ``position`` and shifted by the number
    of rows in the key's earlier blocks. ``known`` names a block column the
    rows are placed by and a column with that number, where both are present.
    """
    keys = list(keys)
    placed = rows.withColumn("_pos", position)
    if known:
        placed = placed.withColumns({"_block": F.col(known[0]), "_earlier": F.col(known[1])})
    else:
        placed = placed.withColumn("_block", block_index(F.col("_pos"), block))
        counts = placed.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
        earlier = rows_in_earlier_blocks(counts, keys, "_block", "_rows")
        placed = placed.join(counts.select(*keys, "_block", earlier.alias("_earlier")), [*keys, "_block"], "left")
    inside = Window.partitionBy(*keys, "_block").orderBy("_pos", tie_break)
    return placed.withColumn(out, _if_keyed(keys, F.row_number().over(inside) - 1 + F.col("_earlier"))).select(*rows.columns, out)


def previous_values(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    block: int,
    tie_break: str,
    columns: dict[str, str],
) -> DataFrame:
    """Adds values of the key's previous row by (position, tie break).

    Inside a block this is ``lag``; the first row of a block takes the last
    row of the key's latest earlier block.
    """
    keys = list(keys)
    placed = rows.withColumn("_pos", position).withColumn("_block", block_index(F.col("_pos"), block))
    held = F.struct(*columns)
    in_order = Window.partitionBy(*keys).orderBy("_block")
    carried = (
        placed.groupBy(*keys, "_block")
        .agg(F.max_by(held, F.struct("_pos", tie_break)).alias("_last"))
        .select(*keys, "_block", F.lag("_last").over(in_order).alias("_carried"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy("_pos", tie_break)
    return (
        placed.withColumn("_previous", F.lag(held).over(inside))
        .withColumn("_is_first", F.row_number().over(inside) == 1)
        .join(carried, [*keys, "_block"], "left")
        .withColumn("_previous", F.when(F.col("_is_first"), F.col("_carried")).otherwise(F.col("_previous")))
        .select(*rows.columns, *[_if_keyed(keys, F.col(f"_previous.{c}")).alias(out) for c, out in columns.items()])
    )


def trailing_distinct(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    frame: int,
    value: str,
    out: str,
    block: int | None = None,
) -> DataFrame:
    """Adds the number of distinct non-null ``value`` in ``(position - frame, position]``.

    A value counts from each occurrence until one frame later. These spans are
    merged per (keys, value) from one summary row per block, so the count at a
    row is the number of spans open there: spans started less spans ended.
    No set of values is ever held.
    """
    block = block or frame
    if block > frame:
        raise ValueError("block must not exceed frame")
    keys = list(keys)
    placed = rows.withColumn("_pos", position).withColumn("_block", block_index(F.col("_pos"), block))

    per_block = placed.groupBy(*keys, value, "_block").agg(
        F.min("_pos").alias("_from"), (F.max("_pos") + frame).alias("_until")
    )
    earlier = (
        Window.partitionBy(*keys, value).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    in_order = Window.partitionBy(*keys, value).orderBy("_block")
    spans = (
        per_block.filter(F.col(value).isNotNull())
        .withColumn("_reached", F.max("_until").over(earlier))
        .withColumn("_starts", F.col("_reached").isNull() | (F.col("_from") > F.col("_reached")))
        .withColumn("_span", F.sum(F.col("_starts").cast("int")).over(in_order))
        .groupBy(*keys, value, "_span")
        .agg(F.min("_from").alias("_from"), F.max("_until").alias("_until"))
    )
    steps = (
        spans.select(
            *keys,
            F.explode(
                F.array(
                    F.struct(F.col("_from").alias("_pos"), F.lit(1).alias("_step")),
                    F.struct(F.col("_until").alias("_pos"), F.lit(-1).alias("_step")),
                )
            ).alias("_e"),
        )
        .select(*keys, "_e.*")
        .withColumn("_block", block_index(F.col("_pos"), block))
        .groupBy(*keys, "_block", "_pos")
        .agg(F.sum("_step").alias("_step"))
    )
    # Spans already open when a block begins.
    open_before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = (
        steps.groupBy(*keys, "_block")
        .agg(F.sum("_step").alias("_net"))
        .unionByName(per_block.select(*keys, "_block", F.lit(0).cast("long").alias("_net")))
        .groupBy(*keys, "_block")
        .agg(F.sum("_net").alias("_net"))
        .select(
            *keys,
            "_block",
            (F.col("_block") * block).alias("_pos"),
            F.coalesce(F.sum("_net").over(open_before), F.lit(0)).alias("_step"),
        )
    )
    events = steps.unionByName(opened).withColumn("_own", F.lit(False))
    until_here = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_pos")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_own", F.lit(True))
        .unionByName(events, allowMissingColumns=True)
        .withColumn(out, _if_keyed(keys, F.coalesce(F.sum("_step").over(until_here), F.lit(0))))
        .filter("_own")
        .select(*rows.columns, out)
    )
