from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywatch.operators.ranking_quality import ranking_quality


def by_hand(rows, share):
    rows = [(s, a) for s, a in rows if s is not None and a is not None]
    hits = [s for s, a in rows if a]
    misses = [s for s, a in rows if not a]
    wins = sum((h > m) + 0.5 * (h == m) for h in hits for m in misses)
    ranked = sorted((s for s, _ in rows), reverse=True)
    limit = ranked[math.ceil(share * len(rows)) - 1]
    flagged = [a for s, a in rows if s >= limit]
    f1 = {t: 2 * sum(h >= t for h in hits) / (sum(s >= t for s in ranked) + len(hits)) for t in ranked}
    best = max(f1.values())
    return {
        "n_rows": len(rows), "positives": len(hits), "auc": wins / (len(hits) * len(misses)), "score_limit": limit,
        "flagged": len(flagged), "precision": sum(flagged) / len(flagged), "recall": sum(flagged) / len(hits),
        "best_f1": best, "best_f1_score": max(t for t, v in f1.items() if v == best),
    }


@pytest.mark.parametrize("resolution", [1, 8192])
@pytest.mark.parametrize("share", [0.02, 0.3])
def test_against_pairs(spark, resolution, share):
    draw = random.Random(5)
    rows = [(None, True), (0.5, None)]
    for _ in range(600):
        hit = draw.random() < 0.1
        # few values, so that many tie, on both sides of zero
        rows.append((round(draw.gauss(1.5 if hit else 0.0, 1.0), 1), hit))
    frame = spark.createDataFrame(rows, "s double, a boolean")
    got = ranking_quality(frame, F.col("s"), F.col("a"), share, resolution).first().asDict()
    assert got == pytest.approx(by_hand(rows, share))


def test_no_rows_and_one_class(spark):
    frame = spark.createDataFrame([(1.0, False), (2.0, False)], "s double, a boolean")
    row = ranking_quality(frame, F.col("s"), F.col("a"), 0.5).first()
    assert (row.n_rows, row.positives, row.auc, row.flagged, row.precision, row.recall) == (2, 0, None, 1, 0.0, None)
    empty = ranking_quality(frame.limit(0), F.col("s"), F.col("a"), 0.5).first()
    assert (empty.n_rows, empty.positives, empty.auc, empty.flagged, empty.best_f1) == (0, 0, None, None, None)


def test_rows_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(score):
        read.add(1)
        return score

    frame = spark.createDataFrame([(float(i), i % 9 == 0) for i in range(100)], "s double, a boolean")
    rows = frame.select(counted.asNondeterministic()("s").alias("s"), "a")
    assert ranking_quality(rows, F.col("s"), F.col("a"), 0.5).first().n_rows == 100
    assert read.value == 100
