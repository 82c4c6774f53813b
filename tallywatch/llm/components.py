"""Connected components of a link table, by alternating star contractions.

Each round replaces links by links to the smallest neighbour, first for
larger neighbours, then for smaller ones (large star, small star). Only
minima are aggregated, so a node with very many links is combined on the map
side and its join partition can be split; links never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import save_and_reload


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all linked nodes.

    ``links`` has ``a`` and ``b``; self-links, repeated links, links with a
    null end and either order are fine.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current = ends.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    current = save_and_reload(current, "links")
    before = _signature(current)
    for _ in range(rounds):
        if not before[0]:
            break
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(current.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m").distinct()
        floor = large.groupBy("u").agg(F.min("m").alias("root"))
        moved = large.join(floor, "u").where("m <> root").select(F.col("m").alias("u"), "root")
        current = floor.union(moved).distinct().select(F.col("u").alias("hi"), F.col("root").alias("lo"))
        current = save_and_reload(current, "links")
        after = _signature(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        current.select("lo", "lo").distinct()
    )


def _signature(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("hi", "lo") % 1_000_000_007), F.lit(0))).first()
    return row[0], row[1]
