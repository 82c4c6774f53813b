from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.operators.quantiles import grouped_quantiles
from tallywatch.operators.trailing import previous_values, row_positions, trailing_distinct, trailing_stats

SCHEMA = "id string, k string, t long, x double, c string"
NAMES = {"count": "n", "sum": "s", "avg": "m", "stddev": "d", "max": "h"}


def heavy_rows(seed: int, count: int = 400, spread: int = 300):
    """A third of all rows share one key; times repeat; some values are null."""
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "id": [f"r{i:04d}" for i in range(count)],
            "k": np.where(rng.random(count) < 0.34, "hot", [f"k{i}" for i in rng.integers(0, 12, count)]),
            "t": rng.integers(-spread, spread, count),
            "x": np.where(rng.random(count) < 0.05, np.nan, rng.lognormal(3, 1, count).round(2)),
            "c": rng.choice(["US", "UK", "DE", "FR", None], count),
        }
    )


def to_spark(spark, rows):
    values = [
        (r.id, r.k, int(r.t), None if pd.isna(r.x) else float(r.x), r.c if isinstance(r.c, str) else None)
        for r in rows.itertuples()
    ]
    return spark.createDataFrame(values, SCHEMA)


def brute_force(rows, frame):
    out = []
    for r in rows.itertuples():
        inside = rows[(rows.k == r.k) & (rows.t > r.t - frame) & (rows.t <= r.t)]
        x = inside.x.dropna()
        out.append((r.id, len(x), x.sum() if len(x) else np.nan, x.mean(), x.std(), x.max(), inside.c.nunique()))
    return pd.DataFrame(out, columns=["id", "n", "s", "m", "d", "h", "distinct"]).sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("frame, block", [(40, None), (40, 10), (7, 1), (1000, None), (60, 20)])
def test_stats_equal_brute_force(spark, frame, block):
    rows = heavy_rows(frame)
    got = trailing_stats(to_spark(spark, rows), ["k"], F.col("t"), frame, "x", NAMES, block=block)
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    wanted = brute_force(rows, frame)
    pd.testing.assert_frame_equal(got[["id", *NAMES.values()]], wanted[["id", *NAMES.values()]], check_dtype=False, rtol=1e-9)


@pytest.mark.parametrize("frame, block", [(40, None), (40, 10), (40, 7), (5, 1), (1000, 100)])
def test_distinct_equals_brute_force(spark, frame, block):
    rows = heavy_rows(frame + 1)
    got = trailing_distinct(to_spark(spark, rows), ["k"], F.col("t"), frame, "c", "distinct", block=block)
    got = got.toPandas().sort_values("id").reset_index(drop=True)
    assert got["distinct"].tolist() == brute_force(rows, frame)["distinct"].tolist()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-20, 20), st.sampled_from(["US", "UK", None])), min_size=1, max_size=30))
def test_small_cases(spark, cases):
    rows = pd.DataFrame([(f"r{i:03d}", k, t, float(i), c) for i, (k, t, c) in enumerate(cases)], columns=["id", "k", "t", "x", "c"])
    data = to_spark(spark, rows)
    wanted = brute_force(rows, 6)
    got = trailing_stats(data, ["k"], F.col("t"), 6, "x", {"count": "n", "max": "h"}, block=3)
    got = trailing_distinct(got, ["k"], F.col("t"), 6, "c", "distinct", block=4).toPandas().sort_values("id")
    for name in ("n", "h", "distinct"):
        assert got[name].tolist() == wanted[name].tolist()


def test_left_edge_is_open(spark):
    rows = pd.DataFrame([("a", "k", 0, 1.0, "US"), ("b", "k", 10, 2.0, "UK"), ("c", "k", 19, 4.0, "DE")], columns=["id", "k", "t", "x", "c"])
    got = trailing_stats(to_spark(spark, rows), ["k"], F.col("t"), 10, "x", {"sum": "s"}).toPandas().set_index("id")
    assert got["s"].to_dict() == {"a": 1.0, "b": 2.0, "c": 6.0}


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_positions_and_previous_rows(spark, block):
    rows = heavy_rows(block)
    data = to_spark(spark, rows)
    ordered = rows.sort_values(["k", "t", "id"])
    wanted = pd.DataFrame(
        {"id": ordered.id, "i": ordered.groupby("k").cumcount(), "p": ordered.groupby("k").id.shift()}
    ).sort_values("id")
    got = row_positions(data, ["k"], F.col("t"), "id", "i", block=block).toPandas().sort_values("id")
    assert got["i"].tolist() == wanted["i"].tolist()
    got = previous_values(data, ["k"], F.col("t"), block, "id", {"id": "p"}).toPandas().sort_values("id")
    assert got["p"].fillna("-").tolist() == wanted["p"].fillna("-").tolist()


def test_heavy_key_is_spread(spark):
    """No task holds more than a small part of a key with a third of all rows."""
    rows = heavy_rows(3, count=3000, spread=5000)
    data = to_spark(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = trailing_stats(data, ["k"], F.col("t"), 100, "x", {"count": "n"})
        sizes = got.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert sizes.max() < 0.25 * sizes.sum()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("resolution", [1, 64, 4096])
def test_quantiles_equal_numpy(spark, resolution):
    rows = heavy_rows(11)
    rows["x"] = rows["x"] - 20
    probabilities = {"q0": 0.0, "q02": 0.02, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q1": 1.0}
    got = grouped_quantiles(to_spark(spark, rows), ["k"], "x", probabilities, resolution).toPandas().set_index("k")
    for key, values in rows.dropna(subset="x").groupby("k").x:
        for name, p in probabilities.items():
            assert got.loc[key, name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("block", [5, 10, 50])
def test_rows_without_key_have_no_values(spark, block):
    rows = spark.createDataFrame([(f"r{i}", None if i % 3 == 0 else "a", i * 7, 1.0, "c") for i in range(30)], SCHEMA)
    stats = trailing_stats(rows, ["k"], F.col("t"), 50, "x", {"count": "n"}, block=block)
    stats = row_positions(stats, ["k"], F.col("t"), "id", "p", block=block)
    stats = previous_values(stats, ["k"], F.col("t"), block, "id", {"id": "before"})
    stats = trailing_distinct(stats, ["k"], F.col("t"), 50, "c", "d", block=block)
    got = stats.orderBy("t").collect()
    assert len(got) == 30
    keyed = [r for r in got if r["k"]]
    assert all(r["n"] is r["p"] is r["before"] is r["d"] is None for r in got if not r["k"])
    assert [r["n"] for r in keyed] == [sum(r["t"] - 50 < o["t"] <= r["t"] for o in keyed) for r in keyed]
    assert [r["p"] for r in keyed] == list(range(20)) and all(r["d"] == 1 for r in keyed)
    assert [r["before"] for r in keyed[1:]] == [r["id"] for r in keyed[:-1]]


def test_few_blocks_read_the_input_once(spark):
    data = to_spark(spark, heavy_rows(3))
    plan = trailing_stats(data, ["k"], F.col("t"), 60, "x", NAMES, block=20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("block", [20, 15])
def test_rows_without_position_or_key_in_few_blocks(spark, block):
    rows = [("a", "u", None, 1.0, None), ("b", "u", None, 2.0, None), ("c", "u", 5, 4.0, None), ("d", "u", -54, None, None), ("e", None, 5, 8.0, None)]
    rows += [("f", "u", -54, 16.0, None), ("g", "u", -55, 32.0, None)]
    got = trailing_stats(spark.createDataFrame(rows, SCHEMA), ["k"], F.col("t"), 60, "x", NAMES, block=block).collect()
    assert {r.id: (r.n, r.s, r.h) for r in got} == {
        "a": (2, 3.0, 2.0),
        "b": (2, 3.0, 2.0),
        "c": (2, 20.0, 16.0),
        "d": (2, 48.0, 32.0),
        "e": (None, None, None),
        "f": (2, 48.0, 32.0),
        "g": (1, 32.0, 32.0),
    }
