"""Mergeable count / mean / squared-deviation summaries.

Windows and panes are summarised in parts and the parts merged, so no
squared sums are subtracted and no precision is lost on large amounts.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_deviation(value: Column) -> Column:
    """Aggregate: sum of squared deviations from the group's mean."""
    return F.var_pop(value) * F.count(value)


def sample_stddev(count: Column, deviation: Column) -> Column:
    """Sample standard deviation; null below two values."""
    return F.when(count > 1, F.sqrt(deviation / (count - 1)))


def merged_deviation(parts: list[tuple[Column, Column, Column]]) -> Column:
    """Squared deviation of the union of parts ``(count, sum, deviation)``.

    Two-pass form: the merged mean first, then each part's shift from it.
    Parts without values may carry nulls.
    """
    counts = [F.coalesce(n, F.lit(0)) for n, _, _ in parts]
    sums = [F.coalesce(s, F.lit(0.0)) for _, s, _ in parts]
    mean = F.try_divide(reduce(add, sums), reduce(add, counts))

    def shifted(n: Column, s: Column, deviation: Column) -> Column:
        gap = F.try_divide(s, n) - mean
        return F.when(n > 0, deviation + n * gap * gap).otherwise(0.0)

    return reduce(add, [shifted(n, s, m2) for n, s, (_, _, m2) in zip(counts, sums, parts)])


def merged_deviation_of_array(parts: Column, mean: Column) -> Column:
    """The same merge over ``array<struct<n, s, m2>>`` with a known mean."""
    zero = F.lit(0.0)

    def shifted(acc: Column, part: Column) -> Column:
        gap = F.try_divide(part["s"], part["n"]) - mean
        return acc + F.coalesce(part["m2"] + part["n"] * gap * gap, zero)

    return F.aggregate(parts, zero, shifted)


def safe_percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` per hundred of ``whole``; null when ``whole`` is zero."""
    share = F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))
    return F.round(share, digits)


def count_where(flag: Column) -> Column:
    """Rows with ``flag``; null (not zero) over an empty input."""
    return F.sum(F.when(flag, 1).otherwise(0))


def sum_where(flag: Column, value: Column) -> Column:
    return F.sum(F.when(flag, value).otherwise(0.0))
