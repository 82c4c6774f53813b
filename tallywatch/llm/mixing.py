"""Mixing sources to target weights by balanced sampling with the cube method.

Every source gets a share of all words by its weight, capped at
``max_epochs`` times its own words; what a cap leaves over is shared among
the others by weight again. With ``r`` the target over the source's words, a
document is taken ``floor(r)`` times for sure and once more with inclusion
probability ``r - floor(r)``.

Those probabilities are settled by the flight phase of the cube method: three
documents at a time move along the null space of the two balancing
constraints (words, documents) until one of them reaches 0 or 1, so both
totals stay as they were. Sources are cut into blocks of bounded size; each
block leaves at most two open probabilities, and the leftovers of a source
are gathered into blocks again until one block remains. In that last block the
landing picks the outcome whose word total is nearest to the balance. Large
documents are settled first, so the landing is among small ones.

Defined results: a null text has size 0; null is a source of its own, last in
order; repeated rows are separate documents; a table without words has target
0 everywhere. Random numbers come from hashes of source, round and block, so
reruns agree under any partitioning. Columns whose names clash with the
operator's pass through ``mix_documents`` untouched.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.common import WORD, fresh, save_and_reload

BLOCK_ROWS = 1000
MAX_EPOCHS = 3
CYCLE = (1, 2, 3)
EPS = 1e-9


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def row_key() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def ranked_sources(sources: DataFrame) -> DataFrame:
    """``source`` and ``place``, from 1 in code point order, null last.

    Ranks are counted inside range partitions and offset by the counts of the
    partitions before, so no task sees all sources.
    """
    order = [F.col("source").isNull(), F.col("source")]
    dealt = sources.select("source").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = save_and_reload(dealt, "sources")
    counts = {row.part: row["count"] for row in dealt.groupBy("part").count().collect()}
    offset, total = F.lit(0), 0
    for part in sorted(counts):
        offset = F.when(F.col("part") == part, F.lit(total)).otherwise(offset)
        total += counts[part]
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.select("source", (within + offset).alias("place"))


def source_targets(
    sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: float = MAX_EPOCHS, share: float = 1.0
) -> DataFrame:
    """Per source: ``source_size``, ``target`` and ``rows``, from rows of ``source`` and ``size``.

    Only sums reach the driver: each step finds the level at which the open
    sources share what the capped ones leave, until no more are capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    totals = save_and_reload(totals, "source-sizes")
    place = ranked_sources(totals)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(F.col("place") - 1, F.lit(len(cycle))) + 1).cast("int"))
    weighted = place.withColumn("weight", weight).withColumnRenamed("source", "place_source")
    joined = totals.join(weighted, F.col("source").eqNullSafe(F.col("place_source"))).drop("place_source", "place")
    joined = save_and_reload(joined, "source-weights")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    wanted = (joined.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped_before = 0.0, None
    while True:
        capped = cap <= F.lit(level) * F.col("weight")
        row = joined.agg(
            F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight"))), F.count(F.when(capped, F.lit(1)))
        ).first()
        if row[2] == capped_before or not row[1]:
            break
        capped_before, level = row[2], (wanted - (row[0] or 0.0)) / row[1]
    target = F.when(cap <= F.lit(level) * F.col("weight"), cap).otherwise(F.lit(level) * F.col("weight"))
    return joined.select("source", "source_size", "rows", target.alias("target"))


def flight(sizes: np.ndarray, chances: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Settle all but at most two chances, keeping their sum and the sum weighted by size."""
    chances = chances.tolist()
    sizes = sizes.tolist()
    draws = iter(draw.random(len(chances) + 8).tolist())
    trio: list[int] = []
    upcoming = iter(range(len(chances)))
    while True:
        while len(trio) < 3:
            k = next(upcoming, None)
            if k is None:
                return np.array(chances)
            if EPS < chances[k] < 1 - EPS:
                trio.append(k)
        a, b, c = trio
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        ahead = min(((1 - chances[k]) / v if v > 0 else -chances[k] / v) for k, v in zip(trio, u) if v)
        back = min((chances[k] / v if v > 0 else (chances[k] - 1) / v) for k, v in zip(trio, u) if v)
        step = ahead if next(draws) * (ahead + back) < back else -back
        for k, v in zip(trio, u):
            moved = chances[k] + step * v
            chances[k] = 0.0 if moved < EPS else 1.0 if moved > 1 - EPS else moved
        trio = [k for k in trio if 0 < chances[k] < 1]


def landing(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Round the few open chances to the outcome nearest in words, then in documents."""
    open_ = np.flatnonzero((chances > 0) & (chances < 1))
    settled = chances.copy()
    if len(open_):
        best = min(
            product((0.0, 1.0), repeat=len(open_)),
            key=lambda x: (
                round(abs(float(((np.array(x) - chances[open_]) * sizes[open_]).sum())), 6),
                abs(sum(x) - float(chances[open_].sum())),
                x,
            ),
        )
        settled[open_] = best
    return settled


def _settle(units: pa.Table, last: bool, turn: int) -> pa.Table:
    sizes = units.column("size").to_numpy().astype(float)
    chances = units.column("chance").to_numpy()
    order = np.lexsort((units.column("key").to_numpy(), -sizes))
    name = f"{units.column('source')[0].as_py()}|{units.column('block')[0].as_py()}|{turn}|{units.num_rows}"
    draw = np.random.default_rng(zlib.crc32(name.encode()))
    settled = flight(sizes[order], chances[order], draw)
    # what is open after the flight stays open for the next round, or lands
    chances = np.empty(len(order))
    chances[order] = landing(sizes[order], settled) if last else settled
    return units.set_column(units.schema.get_field_index("chance"), "chance", pa.array(chances))


def _settler(last: bool, turn: int) -> Callable[[pa.Table], pa.Table]:
    def settle(units: pa.Table) -> pa.Table:
        return _settle(units, last, turn)

    return settle


def balanced_sample(units: DataFrame, largest: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``units`` with each ``chance`` settled to 0 or 1, balanced within every source.

    ``units`` has source, key, size and chance, and may have more columns;
    ``largest`` bounds the rows of a source. The first round cuts into blocks
    by the hash of ``key``; each later round has ``block_rows / 2`` times fewer
    blocks, until a source is one block.
    """
    blocks = math.ceil(max(largest, 1) / block_rows)
    own_blocks = F.ceil(F.col("rows") / F.lit(float(block_rows)))
    units = save_and_reload(units, "units")
    settled = units.where("chance IN (0, 1)")
    pending = units.where("chance NOT IN (0, 1)")
    turn = 0
    while True:
        last = blocks == 1
        place = F.pmod(F.xxhash64("key", F.lit(turn)), own_blocks.cast("long")).cast("int")
        dealt = pending.withColumn("block", place)
        done = dealt.groupBy("source", "block").applyInArrow(_settler(last, turn), dealt.schema).drop("block")
        done = save_and_reload(done, "flight")
        settled = settled.unionByName(done.where("chance IN (0, 1)"))
        if last:
            return settled
        pending = done.where("chance NOT IN (0, 1)")
        blocks = math.ceil(blocks * 2 / block_rows)
        own_blocks = F.ceil(own_blocks * 2 / F.lit(float(block_rows)))
        turn += 1


def mix(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: ``doc_id``, ``key``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    sizes = docs.select("doc_id", row_key().alias("key"), "source", word_count().alias("size"))
    sizes = save_and_reload(sizes, "sizes")
    targets = save_and_reload(source_targets(sizes, cycle, max_epochs), "targets")
    largest = targets.agg(F.max("rows")).first()[0] or 1
    renamed = targets.withColumnRenamed("source", "target_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sizes.join(renamed, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    ratio = F.least(F.round(ratio, 12), F.lit(float(max_epochs)))
    units = joined.withColumn("whole", F.floor(ratio).cast("long")).withColumn("chance", ratio - F.floor(ratio))
    near = F.when(F.col("chance") < EPS, 0.0).when(F.col("chance") > 1 - EPS, 1.0).otherwise(F.col("chance"))
    chosen = balanced_sample(units.withColumn("chance", near), largest, block_rows)
    copies = (F.col("whole") + F.col("chance").cast("long")).alias("copies")
    return chosen.select("doc_id", "key", "source", "size", "source_size", "target", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def mix_documents(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of ``docs`` with their columns, each as often as the mix takes it."""
    own_key, key, copies, rows = fresh("own_key", "key", "copies", "rows")
    mixed = mix(docs, cycle, max_epochs)
    each = mixed.groupBy("key").agg(F.sum("copies").alias(copies), F.count("*").alias(rows)).withColumnRenamed("key", key)
    each = save_and_reload(each.where(F.col(copies) > 0), "copies")
    taken = docs.withColumn(own_key, row_key()).join(each, F.col(own_key) == F.col(key))
    columns = [F.col(f"`{name}`") for name in docs.columns]
    if each.where(F.col(rows) > 1).limit(1).count():
        # rows equal in id, source and text: one stands for all, with their copies together
        single = taken.where(F.col(rows) == 1)
        taken = single.unionByName(taken.where(F.col(rows) > 1).dropDuplicates([own_key]))
    return taken.withColumn(rows, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*columns)
