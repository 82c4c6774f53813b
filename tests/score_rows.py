"""Random score rows for tests of stores and views."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from tallywatch.schema import SCORE_SCHEMA

NOW = datetime(2024, 3, 10, 12, 17, 30)


def random_scores(spark, count, seed=0, days=3, users=12):
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        processed = NOW - timedelta(seconds=draw.randint(0, days * 86_400))
        start = (processed - timedelta(hours=1)).replace(minute=5 * draw.randrange(12), second=0)
        flags = [draw.random() < 0.3 for _ in range(4)]
        amount = None if draw.random() < 0.05 else round(draw.lognormvariate(4, 1), 2)
        rows.append(
            (
                None if draw.random() < 0.03 else f"u{draw.randrange(users)}", start, start + timedelta(hours=1), draw.randint(1, 30),
                amount, None if amount is None else amount / 3, None, amount, draw.randint(1, 6), draw.random() * 4, *flags, any(flags),
                sum((w for f, w in zip(flags, (0.4, 0.2, 0.25, 0.15)) if f), 0.0), None if draw.random() < 0.02 else processed,
            )
        )
    return spark.createDataFrame(rows, SCORE_SCHEMA)


def rounded(df):
    """Rows as a sorted list, doubles to nine digits."""
    names = sorted(df.columns)
    rows = [tuple(round(v, 9) if isinstance(v, float) else v for v in (row[n] for n in names)) for row in df.collect()]
    return sorted(rows, key=repr)
