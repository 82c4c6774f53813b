"""Repeatable pseudo-random numbers drawn from an id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 8
_RANGE = float(16**_DIGITS)
HASH_BITS = 60


def hash_number(identity: Column, seed: int) -> Column:
    """A whole number of ``HASH_BITS`` bits that depends only on id and seed."""
    text = F.concat_ws(":", F.lit(str(seed)), identity.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def uniform(identity: Column, seed: int, draw: int) -> Column:
    """A number in [0, 1) that depends only on id, seed and draw.

    Each digest supplies four draws.
    """
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(str(draw // 4)), identity.cast("string"))
    digits = F.substring(F.md5(text.cast("binary")), 1 + _DIGITS * (draw % 4), _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / _RANGE


def whole_number(u: Column, low: int, high: int) -> Column:
    """A whole number from ``low`` to ``high``, both included."""
    return (F.floor(u * (high - low + 1)) + low).cast("long")


def choice(u: Column, values: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """One of ``values``, by weight when weights are given."""
    weights = list(weights or [1] * len(values))
    total, reached = float(sum(weights)), 0.0
    limits = []
    for weight in weights:
        reached += weight
        limits.append(reached / total)
    picked = F.lit(values[-1])
    for value, limit in reversed(list(zip(values, limits))[:-1]):
        picked = F.when(u < limit, value).otherwise(picked)
    return picked


def normal(u1: Column, u2: Column) -> Column:
    """A standard normal value from two uniforms (Box-Muller)."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0) * F.pi() * u2)
