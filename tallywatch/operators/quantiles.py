"""Exact interpolated quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(value: Column, resolution: int) -> Column:
    """A non-decreasing bucket number; buckets widen with magnitude."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * resolution).cast("long")


def grouped_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    resolution: int = 256,
) -> DataFrame:
    """One row per non-null key with linearly interpolated quantiles of ``value``.

    Bucket counts locate the bucket that holds each wanted rank, and only
    values of those buckets are ranked, each bucket apart. Where the wanted
    buckets are few enough to be broadcast, other values are not exchanged and
    equal ones are counted first, so copies of one value cost one row.
    """
    keys = list(keys)
    valued = rows.dropna(subset=[*keys, value]).select(
        *keys, F.col(value).alias("_value"), _bucket(F.col(value), resolution).alias("_bucket")
    )
    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    whole_key = Window.partitionBy(*keys)
    histogram = (
        valued.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            "_bucket",
            F.coalesce(
                F.sum("_n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.col("_n").alias("_inside"),
            F.sum("_n").over(whole_key).alias("_total"),
        )
    )

    def rank(q: float) -> Column:
        return F.lit(q) * (F.col("_total") - 1)

    def ranks(q: float) -> tuple[Column, Column]:
        return F.floor(rank(q)).cast("long"), F.ceil(rank(q)).cast("long")

    def holds(target: Column, first: Column, count: Column) -> Column:
        return (target >= first) & (target < first + count)

    wanted = reduce(
        or_, [holds(r, F.col("_before"), F.col("_inside")) for q in quantiles.values() for r in ranks(q)]
    )
    targets = histogram.filter(wanted).select(*keys, "_bucket", "_before", "_total")
    # values of other buckets are not exchanged where the targets are few enough to be broadcast
    in_targets = valued.join(targets.select(*keys, "_bucket"), [*keys, "_bucket"], "left_semi")
    frequencies = in_targets.groupBy(*keys, "_bucket", "_value").agg(F.count(F.lit(1)).alias("_n"))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    ranked = frequencies.join(targets, [*keys, "_bucket"]).withColumn(
        "_first",
        F.col("_before")
        + F.coalesce(F.sum("_n").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    picked = []
    for name, q in quantiles.items():
        for end, target in zip(("lo", "hi"), ranks(q)):
            hit = F.when(holds(target, F.col("_first"), F.col("_n")), F.col("_value"))
            picked.append(F.max(hit).alias(f"_{end}_{name}"))
    found = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picked)

    def interpolated(name: str, q: float) -> Column:
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (rank(q) - F.floor(rank(q)))).alias(name)

    return found.select(*keys, *[interpolated(name, q) for name, q in quantiles.items()])
