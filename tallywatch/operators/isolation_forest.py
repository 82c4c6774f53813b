"""Isolation Forest (Liu, Ting and Zhou, ICDM 2008) over a feature array."""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.config import ForestConfig
from tallywatch.functions.uniforms import HASH_BITS, hash_number, uniform
from tallywatch.operators.quantiles import grouped_quantiles
from tallywatch.schema import MODEL_FEATURES
from tallywatch.session import save_and_reload

# Workers get these functions by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329
# Bits of the row hash that one level of draws looks at, and the rows a drawn bucket may hold before they are ranked.
LEVEL_BITS = 10
RANKED_ROWS = 4096
# Bounds the draws of a forest, hence its nodes and what is broadcast.
MAX_DRAWS = 1 << 20
# Buckets a unit of log score is cut into to find the limit; their number bounds what one task sees of them.
LIMIT_RESOLUTION = 1 << 18


def average_path(size: int) -> float:
    """Mean depth of an unsuccessful search among ``size`` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (np.log(size - 1.0) + EULER_GAMMA) - 2.0 * (size - 1.0) / size


# -- scaling -----------------------------------------------------------------


def fit_scaler(vectors: DataFrame, names: tuple[str, ...] = MODEL_FEATURES, column: str = "features") -> DataFrame:
    """Mean and population deviation of every feature, one row per feature.

    One aggregate reads the data once; its single row is then unfolded.
    """
    element = [F.get(column, F.lit(i)) for i in range(len(names))]
    wide = vectors.agg(
        *[F.avg(e).alias(f"m{i}") for i, e in enumerate(element)],
        *[F.stddev_pop(e).alias(f"s{i}") for i, e in enumerate(element)],
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(name).alias("feature"),
                        F.col(f"m{i}").alias("mean"),
                        F.when(F.col(f"s{i}") > 0, F.col(f"s{i}")).otherwise(1.0).alias("scale"),
                    )
                    for i, name in enumerate(names)
                ]
            )
        )
    )


def apply_scaler(vectors: DataFrame, scaler: DataFrame, column: str = "features", out: str = "scaled") -> DataFrame:
    """``(x - mean) / scale`` per feature; the scaler has a row per feature."""
    return vectors.withColumn(out, scaled_column(scaler, column))


def scaled_column(scaler: DataFrame, column: str = "features") -> Column:
    stats = scaler.orderBy("position").collect()
    return F.array(*[(F.get(column, F.lit(i)) - F.lit(row["mean"])) / F.lit(row["scale"]) for i, row in enumerate(stats)])


# -- drawing the training samples ----------------------------------------------


def _last_start(starts: DataFrame, draws: DataFrame, within: str) -> DataFrame:
    """Gives every draw the ``_at`` of the last start not above its rank."""
    by_rank = Window.partitionBy(within).orderBy("_rank", F.col("tree_id").asc_nulls_first())
    seen = by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        starts.unionByName(draws, allowMissingColumns=True)
        .withColumn("_at", F.last("_at", ignorenulls=True).over(seen))
        .filter(F.col("tree_id").isNotNull())
    )


def _prefix(bits: int) -> Column:
    """The leading bits of the row hash; they sort as it does."""
    return F.shiftright("_h", HASH_BITS - bits) if bits else F.lit(0).cast("long")


def draw_samples(rows: DataFrame, identity: str, vector: str, cfg: ForestConfig) -> tuple[DataFrame, int]:
    """``trees * sample_size`` rows drawn with replacement, and the draw size.

    Rows are ordered by a hash of their id and drawn by rank. Each level
    counts the rows below the drawn hash prefixes by ``LEVEL_BITS`` further
    bits, which turns a rank into a longer prefix and a rank inside it. Levels
    follow until no drawn prefix holds more than ``RANKED_ROWS`` rows; only
    those rows are ranked, the rest of the table is counted, not moved. One
    reading of the table counts its rows, by prefixes that serve the first two
    levels, and one gives those to rank; more levels read it again. The order, and so what is drawn, does not depend on the number of levels.
    Copies of a row are ranked as one entry with a count; different rows that
    share an id cannot be told apart by further bits and are ranked together.
    """
    if cfg.trees * cfg.sample_size > MAX_DRAWS:
        raise ValueError(f"trees * sample_size may be {MAX_DRAWS} at most")
    spark = rows.sparkSession
    hashed = rows.select(
        F.col(identity).alias("_id"),
        F.col(vector).alias("_x"),
        hash_number(F.col(identity), cfg.seed).alias("_h"),
        F.lit(1).alias("_n"),
    )
    counted = 2 * LEVEL_BITS
    lowest = F.shiftleft(_prefix(counted), HASH_BITS - counted)
    prefixes = save_and_reload(hashed.groupBy(lowest.alias("_h")).agg(F.sum("_n").alias("_n")), "prefixes")
    total = prefixes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    size = min(cfg.sample_size, total)
    located = spark.range(cfg.trees * size).select(
        (F.col("id") / size).cast("int").alias("tree_id"),
        F.lit(0).cast("long").alias("_bucket"),
        F.pmod(hash_number(F.concat(F.lit("draw:"), F.col("id")), cfg.seed), F.lit(total)).alias("_rank"),
    )
    bits, largest = 0, total
    while largest > RANKED_ROWS and bits + LEVEL_BITS < HASH_BITS:
        # a window sees the 2^LEVEL_BITS counts below one prefix and the draws there, never rows
        counts = (
            _drawn_rows(prefixes if bits + LEVEL_BITS <= counted else hashed, located, bits)
            .groupBy("_bucket", _prefix(bits + LEVEL_BITS).alias("_next"))
            .agg(F.sum("_n").alias("_n"))
        )
        earlier = Window.partitionBy("_bucket").orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.withColumn("_rank", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).select(
            "_bucket", "_rank", F.struct("_next", "_rank", "_n").alias("_at")
        )
        found = _last_start(starts, located, "_bucket").select(
            "tree_id", F.col("_at._next").alias("_bucket"), (F.col("_rank") - F.col("_at._rank")).alias("_rank"), F.col("_at._n").alias("_n")
        )
        found = save_and_reload(found, "draws")
        largest = found.agg(F.max("_n")).first()[0]
        located, bits = found.drop("_n"), bits + LEVEL_BITS

    in_bucket = Window.partitionBy("_bucket").orderBy("_h", "_id", "_x").rowsBetween(Window.unboundedPreceding, -1)
    row_starts = (
        _drawn_rows(hashed, located, bits)
        .groupBy("_bucket", "_h", "_id", "_x")
        .agg(F.sum("_n").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(in_bucket), F.lit(0)).alias("_rank"), F.struct("_id", "_x").alias("_at"))
    )
    sampled = _last_start(row_starts, located, "_bucket")
    return sampled.select("tree_id", F.col("_at._id").alias("id"), F.col("_at._x").alias("x")), size


def _drawn_rows(hashed: DataFrame, located: DataFrame, bits: int) -> DataFrame:
    """The rows below the drawn prefixes; there are at most ``MAX_DRAWS`` of those, so they are broadcast."""
    drawn = F.broadcast(located.select("_bucket").distinct())
    return hashed.withColumn("_bucket", _prefix(bits)).join(drawn, "_bucket", "left_semi")


# -- growing -------------------------------------------------------------------


def path_length(depth: Column, rows: Column) -> Column:
    """Depth of a leaf plus the mean depth that a tree over its rows would add."""
    n = rows.cast("double")
    added = F.lit(2.0) * (F.log(n - 1.0) + EULER_GAMMA) - F.lit(2.0) * (n - 1.0) / n
    return depth.cast("double") + F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(added)


def _splits(rows: DataFrame, width: int, seed: int, depth: int, last: bool) -> DataFrame:
    """One row per node that holds rows: feature (-1: a leaf), threshold and path.

    The feature is drawn among those whose values differ there, the threshold
    between its limits, both by the node's place alone. A threshold that
    rounding puts on the upper limit, or a limit that is not a number, falls
    back to the lower limit, so both sides always hold rows.
    """
    element = [F.get("x", F.lit(i)) for i in range(width)]
    limits = rows.groupBy("tree_id", "node_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(
            *[F.struct(F.lit(i).alias("at"), F.min(e).alias("lo"), F.max(e).alias("hi")) for i, e in enumerate(element)]
        ).alias("_limits"),
    )
    place = F.concat_ws("/", "tree_id", "node_id")
    usable = F.lit(not last) & (F.size("_usable") > 0)
    chosen, drawn = F.col("_chosen"), F.col("_drawn")
    return (
        limits.withColumn("_usable", F.filter("_limits", lambda limit: limit["hi"] > limit["lo"]))
        .withColumn("_chosen", F.when(usable, F.get("_usable", F.floor(uniform(place, seed, 0) * F.size("_usable")).cast("int"))))
        .withColumn("_drawn", chosen["lo"] + uniform(place, seed, 1) * (chosen["hi"] - chosen["lo"]))
        .select(
            "tree_id",
            "node_id",
            F.coalesce(chosen["at"], F.lit(-1)).alias("feature"),
            F.coalesce(F.when(drawn >= chosen["hi"], chosen["lo"]).otherwise(drawn), F.lit(0.0)).alias("threshold"),
            F.when(chosen.isNull(), path_length(F.lit(depth), F.col("_n"))).otherwise(0.0).alias("path"),
        )
    )


def grow_forest(sampled: DataFrame, size: int, cfg: ForestConfig) -> DataFrame:
    """All trees at once, level by level, from the drawn rows ``(tree_id, x)``.

    A level aggregates the limits of every node's rows, with partial results
    where the rows are, so no task holds a tree. Splits are stored; there are
    at most as many as ``MAX_DRAWS``, so they are broadcast. The children of node ``k`` are
    ``2k + 1`` and ``2k + 2``. Splits depend on the rows of a node and its
    place, not on the order of rows or their partitions. No rows give no nodes.
    """
    max_depth = int(np.ceil(np.log2(max(size, 2))))
    rows = save_and_reload(sampled.select("tree_id", F.lit(0).alias("node_id"), "x"), "forest-rows")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 1
    goes_left = F.get("x", F.col("feature")) <= F.col("threshold")
    levels = []
    for depth in range(max_depth + 1):
        # rows are moved to their nodes anew from the stored splits of the levels above
        levels.append(save_and_reload(_splits(rows, width, cfg.seed, depth, depth == max_depth), "forest-level"))
        above = F.broadcast(levels[-1].filter("feature >= 0").select("tree_id", "node_id", "feature", "threshold"))
        rows = rows.join(above, ["tree_id", "node_id"]).select(
            "tree_id", (2 * F.col("node_id") + F.when(goes_left, 1).otherwise(2)).alias("node_id"), "x"
        )
    child = F.when(F.col("feature") >= 0, 2 * F.col("node_id"))
    return reduce(DataFrame.unionByName, levels).select(
        "tree_id",
        "node_id",
        "feature",
        "threshold",
        F.coalesce(child + 1, F.lit(-1)).alias("left"),
        F.coalesce(child + 2, F.lit(-1)).alias("right"),
        "path",
    )


# -- scoring -------------------------------------------------------------------


@dataclass
class IsolationForest:
    """A trained forest: nodes, scaler, flagging limit and draw size.

    ``nodes`` has at most ``trees * (2 * sample_size - 1)`` rows, which bounds
    what scoring sends to every executor.
    """

    nodes: DataFrame
    scaler: DataFrame
    sample_size: int
    offset: float

    def scorer(self, column: str = "features") -> Callable[[DataFrame], DataFrame]:
        """What ``score`` does, with the model read and broadcast once, here."""
        value = score_column(self.nodes, self.sample_size, scaled_column(self.scaler, column))

        def add(vectors: DataFrame) -> DataFrame:
            scored = vectors.withColumn("isolation_score", value)
            return scored.withColumn("is_anomaly_ml", F.col("isolation_score") < self.offset)

        return add

    def score(self, vectors: DataFrame, column: str = "features") -> DataFrame:
        """Adds ``isolation_score`` (lower is stranger) and ``is_anomaly_ml``."""
        return self.scorer(column)(vectors)

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
        settings = spark.createDataFrame([(self.sample_size, self.offset)], "sample_size int, offset double")
        settings.write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        settings = spark.read.parquet(f"{path}/settings").first()
        return IsolationForest(
            spark.read.parquet(f"{path}/nodes"),
            spark.read.parquet(f"{path}/scaler"),
            settings["sample_size"],
            settings["offset"],
        )


def packed_nodes(nodes: DataFrame) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The trees as full ones of equal depth: thresholds by feature, splits by level, paths by last place.

    A split holds its feature and the rank of its threshold among all thresholds of that feature.
    Places below a leaf, and those no split leads to, send every row to the left. There are at most
    four places a draw.
    """
    table = nodes.toPandas()
    trees, tree = np.unique(table["tree_id"].to_numpy(), return_inverse=True)
    number, feature = table["node_id"].to_numpy().astype("int64") + 1, table["feature"].to_numpy()
    threshold, leaf = table["threshold"].to_numpy(), feature < 0
    depth = np.frexp(number.astype("float64"))[1].astype("int64") - 1
    deepest = depth.max(initial=0)
    limits = [np.unique(threshold[feature == i]) for i in range(feature.max(initial=-1) + 1)]
    # places of a level are numbered through all trees, so the children of place p are 2p and 2p + 1
    place = number + ((tree - 1) << depth)
    levels = []
    for level in range(deepest):
        asked = np.zeros(len(trees) << level, dtype="int64")
        rank = np.full(len(asked), np.iinfo("int32").max, dtype="int32")
        here = ~leaf & (depth == level)
        asked[place[here]] = feature[here]
        for i, known in enumerate(limits):
            own = here & (feature == i)
            rank[place[own]] = np.searchsorted(known, threshold[own])
        levels.append((asked.reshape(len(trees), -1), rank.reshape(len(trees), -1)))
    path = np.zeros(len(trees) << deepest)
    path[place[leaf] << (deepest - depth[leaf])] = table["path"].to_numpy()[leaf]
    return limits, levels, path.reshape(len(trees), -1)


def mean_paths(points: np.ndarray, packed: tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]], np.ndarray]) -> np.ndarray:
    """Mean path length of each point over all trees.

    A value is at most a threshold where its rank among the thresholds is at most the threshold's;
    values that are no numbers rank above all. Rows take one step a level, whatever leaf they end in.
    """
    limits, levels, path = packed
    total = np.zeros(len(points))
    ranks = np.array([np.searchsorted(known, points[:, i]) for i, known in enumerate(limits)], dtype="int32").ravel()
    rows = np.arange(len(points))
    for tree, paths in enumerate(path):
        at = np.zeros(len(points), dtype="int64")
        for asked, rank in levels:
            # every place is known to exist: clipping only spares numpy the check
            value = (asked[tree] * len(points)).take(at, mode="clip")
            value += rows
            goes_right = ranks.take(value, mode="clip") > rank[tree].take(at, mode="clip")
            at += at
            at += goes_right
        total += paths.take(at)
    return total / len(path)


def score_column(nodes: DataFrame, sample_size: int, vector: Column) -> Column:
    packed = packed_nodes(nodes)
    shared = nodes.sparkSession.sparkContext.broadcast(packed)
    normaliser = average_path(sample_size)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="float64")
        points = np.stack(vectors.to_numpy())
        return pd.Series(-np.power(2.0, -mean_paths(points, shared.value) / normaliser))

    # else a filter on the score, such as a join or an aggregate of non-null ones adds, scores all rows once more
    return score.asNondeterministic()(vector)


def train_isolation_forest(
    vectors: DataFrame, identity: str, column: str = "features", cfg: ForestConfig = ForestConfig()
) -> IsolationForest:
    """Scale, draw, grow, and set the limit that flags ``contamination``.

    ``vectors`` is read several times: pass a stored table, not a long plan.
    The limit is the exact quantile of the training scores.
    """
    if vectors.limit(1).count() == 0:
        raise ValueError("no rows to train the forest on")
    scaler = save_and_reload(fit_scaler(vectors, column=column), "scaler")
    scaled = apply_scaler(vectors, scaler, column, "_scaled").select(identity, "_scaled")
    sampled, size = draw_samples(scaled, identity, "_scaled", cfg)
    nodes = save_and_reload(grow_forest(sampled, size, cfg), "forest")
    scores = scaled.select(score_column(nodes, size, F.col("_scaled")).alias("score"))
    limit = grouped_quantiles(
        save_and_reload(scores, "training-scores").withColumn("_all", F.lit(1)),
        ["_all"],
        "score",
        {"limit": cfg.contamination},
        resolution=LIMIT_RESOLUTION,
    )
    return IsolationForest(nodes, scaler, size, limit.first()["limit"])
