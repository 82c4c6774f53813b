"""Mergeable sketches with a stated error: distinct counts and quantiles.

A distinct sketch holds at most 2^``LG_K`` cells, however many values it saw;
three standard errors of its estimate are ``distinct_error()``. A quantile
sketch holds some multiples of ``KLL_K`` values; the value it gives for a rank
has a rank at most ``RANK_ERROR`` away (with 99 % confidence).
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 200
# Fixed value: normalised rank error of a quantile sketch with KLL_K = 200.
RANK_ERROR = 0.0165


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error of three standard deviations."""
    return 3 * 1.04 / sqrt(1 << lg_k)


def distinct_sketch(value: Column, lg_k: int = LG_K) -> Column:
    """Aggregate: a sketch of the distinct values; null counts as none."""
    return F.hll_sketch_agg(value, lg_k)


def merged_distincts(sketch: Column) -> Column:
    """Aggregate: the sketch of all values that the sketches saw."""
    return F.hll_union_agg(sketch)


def distinct_estimate(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long")


def quantile_sketch(value: Column, k: int = KLL_K) -> Column:
    """Aggregate: a sketch of the values' order; null counts as none."""
    return F.kll_sketch_agg_double(value, F.lit(k))


def merged_quantiles(sketch: Column) -> Column:
    """Aggregate: the sketch of all values that the sketches saw."""
    return F.kll_merge_agg_double(sketch)


def sketched_quantile(sketch: Column, rank: float) -> Column:
    """A value of about this rank; null where no value was seen."""
    seen = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(seen, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))
