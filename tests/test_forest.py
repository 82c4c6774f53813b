from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywatch.config import ForestConfig
from tallywatch.operators import isolation_forest
from tallywatch.operators.isolation_forest import (
    IsolationForest,
    apply_scaler,
    average_path,
    draw_samples,
    fit_scaler,
    grow_forest,
    mean_paths,
    packed_nodes,
    train_isolation_forest,
)

CONFIG = ForestConfig(trees=60)
NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 3)) * [1.0, 20.0, 0.1]
    x[:20] += [8.0, 160.0, 0.8]
    return x


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(f"p{i:04d}", [float(v) for v in x], i < 20) for i, x in enumerate(points)]
    return spark.createDataFrame(rows, "id string, features array<double>, is_injected boolean").cache()


def walk(nodes, tree, x):
    node, depth = nodes[(tree, 0)], 0
    while node.feature >= 0:
        node = nodes[(tree, node.left if x[node.feature] <= node.threshold else node.right)]
        depth += 1
    return node.path, depth


def test_average_path():
    assert [average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert average_path(256) == pytest.approx(10.2448, abs=1e-3)


def number(text):
    """The draw in [0, 1) of a node: ``text`` names tree and node; two digests of 32 bits."""
    digest = hashlib.md5(f"42:0:{text}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) / 2**32 for i in (0, 1)]


def grown_by_hand(tree, points, depth=0, node=0, max_depth=8):
    """One tree, node by node: ``{node: (feature, threshold, path)}``."""
    lo, hi = points.min(axis=0), points.max(axis=0)
    usable = np.flatnonzero(hi > lo)
    if depth == max_depth or not usable.size:
        return {node: (-1, 0.0, depth + average_path(len(points)))}
    which, where = number(f"{tree}/{node}")
    feature = int(usable[int(which * len(usable))])
    threshold = lo[feature] + where * (hi[feature] - lo[feature])
    goes_left = points[:, feature] <= threshold
    return (
        {node: (feature, threshold, 0.0)}
        | grown_by_hand(tree, points[goes_left], depth + 1, 2 * node + 1)
        | grown_by_hand(tree, points[~goes_left], depth + 1, 2 * node + 2)
    )


def test_trees_equal_trees_grown_by_hand(spark, vectors):
    sampled, size = draw_samples(vectors, "id", "features", ForestConfig(trees=3))
    rows = sampled.toPandas()
    nodes = grow_forest(sampled, size, ForestConfig(trees=3)).toPandas()
    for tree, own in nodes.groupby("tree_id"):
        wanted = grown_by_hand(tree, np.stack(rows.loc[rows["tree_id"] == tree, "x"]))
        got = {n.node_id: (n.feature, n.threshold, n.path) for n in own.itertuples()}
        assert got.keys() == wanted.keys()
        assert all(got[node] == pytest.approx(wanted[node]) for node in wanted)
        split = own["feature"] >= 0
        assert len(own) == 2 * (~split).sum() - 1
        assert set(own.loc[split, "left"]) | set(own.loc[split, "right"]) | {0} == set(own["node_id"])


@pytest.mark.parametrize("points, leaves", [([[1.0, 1.0]] * 10, 1), ([[1.0, 2.0]], 1), ([[0.0], [float("nan")]], 2), ([[1.0], [np.nextafter(1.0, 2)]], 2), ([], 0)])
def test_small_trees(spark, points, leaves):
    """Same rows, one row, values that are no numbers or differ by one step only, no rows."""
    rows = spark.createDataFrame([(0, [float(v) for v in x]) for x in points], "tree_id int, x array<double>")
    nodes = grow_forest(rows, max(len(points), 1), ForestConfig()).toPandas()
    assert (nodes["feature"] < 0).sum() == leaves
    assert len(nodes) == max(2 * leaves - 1, 0)


def test_draws_do_not_depend_on_partitioning(spark, vectors):
    def drawn(rows):
        sampled, size = draw_samples(rows, "id", "features", CONFIG)
        assert size == 256
        return sorted((r["tree_id"], r["id"]) for r in sampled.select("tree_id", "id").collect())

    first = drawn(vectors)
    assert len(first) == 60 * 256
    assert first == drawn(vectors.repartition(7, "features")) == drawn(vectors.orderBy(F.desc("id")))
    counts = pd.Series([i for _, i in first]).value_counts()
    assert len(counts) == 1000 and counts.mean() == pytest.approx(15.36, rel=0.01)
    assert counts.std() == pytest.approx(np.sqrt(15.36), rel=0.2)


def test_draws_do_not_depend_on_the_levels(spark, vectors, monkeypatch):
    """However few rows a drawn prefix may hold, the same rows are drawn."""
    few = ForestConfig(trees=3)

    def drawn():
        return sorted(tuple(r) for r in draw_samples(vectors, "id", "features", few)[0].select("tree_id", "id").collect())

    by_one_level = drawn()
    monkeypatch.setattr(isolation_forest, "RANKED_ROWS", 4)
    monkeypatch.setattr(isolation_forest, "LEVEL_BITS", 3)
    assert drawn() == by_one_level


def test_number_of_draws_is_bounded(vectors):
    with pytest.raises(ValueError):
        draw_samples(vectors, "id", "features", ForestConfig(trees=1 << 14))


def test_copies_are_drawn_by_their_share(spark):
    """A third of the rows are copies of one row."""
    rows = spark.range(900).select(
        F.when(F.col("id") < 300, "copy").otherwise(F.concat(F.lit("r"), "id")).alias("id"),
        F.array(F.when(F.col("id") < 300, 0.0).otherwise(F.col("id").cast("double"))).alias("features"),
    )
    sampled, _ = draw_samples(rows, "id", "features", CONFIG)
    share = sampled.agg(F.avg((F.col("id") == "copy").cast("double"))).first()[0]
    assert share == pytest.approx(1 / 3, abs=0.02)


def test_scaler_uses_population_deviation(spark, vectors, points):
    scaler = {r["feature"]: r for r in fit_scaler(vectors, NAMES).collect()}
    for i, name in enumerate(NAMES):
        assert scaler[name]["mean"] == pytest.approx(points[:, i].mean())
        assert scaler[name]["scale"] == pytest.approx(points[:, i].std())
    constant = spark.createDataFrame([([1.0],), ([1.0],)], "features array<double>")
    fitted = fit_scaler(constant, ("only",))
    assert fitted.first()["scale"] == 1.0
    assert apply_scaler(constant, fitted).first()["scaled"] == [0.0]


def test_paths_equal_a_walk_by_hand(spark, vectors, points):
    sampled, size = draw_samples(vectors, "id", "features", ForestConfig(trees=5))
    nodes = grow_forest(sampled, size, ForestConfig(trees=5))
    table = {(r.tree_id, r.node_id): r for r in nodes.toPandas().itertuples()}
    got = mean_paths(points[:50], packed_nodes(nodes))
    for x, path in zip(points[:50], got):
        walks = [walk(table, tree, x) for tree in range(5)]
        assert path == pytest.approx(np.mean([p for p, _ in walks]))
        assert max(d for _, d in walks) <= 8


def test_paths_at_thresholds_and_of_values_that_are_no_numbers(spark):
    """Trees of different depth, one of them a single leaf; a value on a threshold goes left, NaN right."""
    nodes = spark.createDataFrame(
        [(3, 0, 1, 2.0, 1, 2, 0.0), (3, 1, -1, 0.0, -1, -1, 1.0), (3, 2, 0, -1.0, 5, 6, 0.0), (3, 5, -1, 0.0, -1, -1, 20.0),
         (3, 6, 1, 4.0, 13, 14, 0.0), (3, 13, -1, 0.0, -1, -1, 300.0), (3, 14, -1, 0.0, -1, -1, 4000.0), (7, 0, -1, 0.0, -1, -1, 0.5)],
        "tree_id int, node_id int, feature int, threshold double, left int, right int, path double",
    )
    nan, inf = float("nan"), float("inf")
    points = np.array([[9, 2], [-1, 2.5], [0, 4], [0, 5], [nan, nan], [-inf, inf], [inf, -inf], [nan, 3]])
    wanted = [1, 20, 300, 4000, 4000, 20, 1, 300]
    assert mean_paths(points, packed_nodes(nodes)).tolist() == [(path + 0.5) / 2 for path in wanted]
    assert mean_paths(points, packed_nodes(nodes.filter("tree_id = 7"))).tolist() == [0.5] * 8


def test_a_filter_on_the_score_scores_no_row_twice(spark, vectors):
    forest = train_isolation_forest(vectors.select("id", "features"), "id", cfg=ForestConfig(trees=3))
    scored = forest.score(vectors.select("id", "features")).join(vectors.select("id", "is_injected"), "id")
    for rows in (scored.select((-F.col("isolation_score")).alias("score"), "is_injected").dropna(), scored.filter("isolation_score < 0")):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
        assert rows.count() == 1000


def test_draws_read_the_rows_twice(spark, vectors, monkeypatch):
    """Once to count them, whatever two levels ask for, once to rank the drawn ones."""
    monkeypatch.setattr(isolation_forest, "RANKED_ROWS", 100)
    monkeypatch.setattr(isolation_forest, "LEVEL_BITS", 3)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(identity):
        read.add(1)
        return identity

    rows = vectors.select(counted.asNondeterministic()("id").alias("id"), "features")
    sampled, _ = draw_samples(rows, "id", "features", ForestConfig(trees=3))
    assert len(sampled.select("id").collect()) == 3 * 256
    assert read.value == 2 * 1000


def test_forest_finds_injected_rows(spark, vectors, tmp_path):
    forest = train_isolation_forest(vectors.select("id", "features"), "id", cfg=CONFIG)
    scored = forest.score(vectors).toPandas()
    assert scored["isolation_score"].between(-1, 0, inclusive="left").all()
    assert scored["is_anomaly_ml"].mean() == pytest.approx(0.02, abs=0.005)
    by_label = scored.groupby("is_injected")["isolation_score"].mean()
    assert by_label[True] < by_label[False] - 0.1
    assert scored.loc[scored["is_injected"], "is_anomaly_ml"].mean() > 0.8
    assert forest.offset == pytest.approx(np.percentile(scored["isolation_score"], 2))

    forest.save(str(tmp_path / "model"))
    loaded = IsolationForest.load(spark, str(tmp_path / "model"))
    again = loaded.score(vectors.repartition(5)).toPandas().sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(again, scored.sort_values("id").reset_index(drop=True))


def test_training_twice_gives_the_same_nodes(spark, vectors):
    small = ForestConfig(trees=10)

    def nodes(rows):
        forest = train_isolation_forest(rows.select("id", "features"), "id", cfg=small)
        return forest.nodes.toPandas().sort_values(["tree_id", "node_id"]).reset_index(drop=True), forest.offset

    (first, limit), (second, other) = nodes(vectors), nodes(vectors.repartition(9))
    pd.testing.assert_frame_equal(first, second, rtol=1e-9)
    assert limit == pytest.approx(other)
