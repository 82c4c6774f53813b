"""How well a score ranks labelled rows, over all thresholds at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.session import save_and_reload


def threshold_sweep(rows: DataFrame, score: Column, actual: Column, resolution: int = 8192) -> DataFrame:
    """One row per distinct score: rows and positives at or above it, and in all.

    Rows with a null score or label take no part. Equal scores are counted before they are
    exchanged; whole buckets are added up first and scores are then summed within their bucket,
    so that no task ranks all scores. The counts are stored, as both steps read them: ``rows`` are
    read once.
    """
    s = F.col("score")
    counts = (
        rows.select(score.cast("double").alias("score"), actual.alias("actual"))
        .dropna()
        .groupBy(F.floor(F.signum(s) * F.log1p(F.abs(s)) * resolution).cast("long").alias("bucket"), "score")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("actual").alias("hits"))
    )
    counts = save_and_reload(counts, "score-counts")
    # rows of this window are buckets, whose number the resolution bounds
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    buckets = (
        counts.groupBy("bucket")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
        .select(
            "bucket",
            *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_over") for c in ("n", "hits")],
            *[F.sum(c).over(everything).alias(f"{c}_all") for c in ("n", "hits")],
        )
    )
    within = Window.partitionBy("bucket").orderBy(F.desc("score"))
    return counts.join(buckets, "bucket").select(
        "score",
        "n",
        "hits",
        (F.col("n_over") + F.sum("n").over(within)).alias("flagged"),
        (F.col("hits_over") + F.sum("hits").over(within)).alias("caught"),
        "n_all",
        "hits_all",
    )


def ranking_quality(
    rows: DataFrame, score: Column, actual: Column, contamination: float, resolution: int = 8192
) -> DataFrame:
    """One row: area under the ROC curve (ties count half), what flagging the highest
    ``contamination`` of the rows catches (ties at the limit are flagged too), and the limit of the
    best F1 (the highest one). Rates without a denominator are null.
    """
    n, hits, flagged, caught = (F.col(c) for c in ("n", "hits", "flagged", "caught"))
    n_all, hits_all = F.col("n_all"), F.col("hits_all")
    far_enough = flagged >= F.ceil(n_all * F.lit(contamination))
    # negatives at a score, times the positives above it and half of those at it
    area = (n - hits) * (caught - hits / F.lit(2.0))
    f1 = F.lit(2.0) * caught / (flagged + hits_all)
    found = threshold_sweep(rows, score, actual, resolution).agg(
        F.coalesce(F.max("n_all"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max("hits_all"), F.lit(0)).alias("positives"),
        F.sum(area).alias("area"),
        F.max(F.when(far_enough, F.struct("score", "flagged", "caught"))).alias("limit"),
        F.max(F.struct(f1.alias("f1"), F.col("score"))).alias("best"),
    )
    pairs = F.col("positives").cast("double") * (F.col("n_rows") - F.col("positives"))
    return found.select(
        "n_rows",
        "positives",
        F.try_divide("area", pairs).alias("auc"),
        F.col("limit.score").alias("score_limit"),
        F.col("limit.flagged").alias("flagged"),
        F.try_divide(F.col("limit.caught").cast("double"), F.col("limit.flagged")).alias("precision"),
        F.try_divide(F.col("limit.caught").cast("double"), F.col("positives")).alias("recall"),
        F.col("best.f1").alias("best_f1"),
        F.col("best.score").alias("best_f1_score"),
    )
