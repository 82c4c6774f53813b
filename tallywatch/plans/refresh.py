"""Materialised views and their refresh."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.config import ViewConfig
from tallywatch.plans.views import (
    dashboard_kpi,
    fraud_alerts,
    fraud_feed,
    fraud_summary_by_minute,
    user_risk_profile,
)
from tallywatch.sources import folders
from tallywatch.sources.score_store import read_scores

# How stale each view may be.
TARGET_LAG = {
    "fraud_summary_1min": "1 minute",
    "user_risk_profile": "2 minutes",
    "fraud_alerts": "30 seconds",
    "dashboard_kpi": "1 minute",
}

_VERSIONS = T.StructType(
    [T.StructField("view", T.StringType()), T.StructField("version", T.StringType()),
     T.StructField("as_of", T.TimestampType()), T.StructField("finished", T.TimestampType())]
)


def build_views(scores: DataFrame, as_of, cfg: ViewConfig = ViewConfig()) -> dict[str, DataFrame]:
    return {
        "fraud_summary_1min": fraud_summary_by_minute(scores),
        "user_risk_profile": user_risk_profile(scores, as_of, cfg.profile_lookback),
        "fraud_alerts": fraud_alerts(scores, as_of, cfg.alert_lookback),
        "dashboard_kpi": dashboard_kpi(scores, as_of, cfg.kpi_lookback),
    }


def refresh_views(
    spark: SparkSession,
    scores_path: str,
    views_path: str,
    as_of=None,
    cfg: ViewConfig = ViewConfig(),
    only: Iterable[str] = tuple(TARGET_LAG),
) -> str:
    """Recompute the named views into a new version and publish it.

    Each version has its own folder and is listed only after it is complete,
    so readers never see half a view and a failed refresh changes nothing. The
    version with the latest ``as_of`` is current, so a slow refresh does not
    replace a newer one; between equal times the one that finished last.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    views = build_views(read_scores(spark, scores_path), stamp, cfg)
    return publish_views(spark, {name: views[name] for name in only}, views_path, stamp)


def publish_views(spark: SparkSession, views: dict[str, DataFrame], views_path: str, stamp: Column) -> str:
    """Write views as a new version, then list it."""
    version = uuid.uuid4().hex
    for name, rows in views.items():
        rows.write.parquet(f"{views_path}/{name}/{version}")
    (
        spark.range(1)
        .select(
            F.explode(F.array(*[F.lit(n) for n in views])).alias("view"),
            F.lit(version).alias("version"),
            stamp.cast("timestamp").alias("as_of"),
            F.current_timestamp().alias("finished"),
        )
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{views_path}/versions")
    )
    return version


def _versions(spark: SparkSession, views_path: str) -> DataFrame:
    path = f"{views_path}/versions"
    return spark.read.schema(_VERSIONS).parquet(path) if folders.exists(spark, path) else spark.createDataFrame([], _VERSIONS)


def last_refreshed(spark: SparkSession, views_path: str) -> dict[str, datetime]:
    """The as-of time of each view's current version."""
    latest = _versions(spark, views_path).groupBy("view").agg(F.max("as_of").alias("as_of"))
    return {row.view: row.as_of for row in latest.collect()}


def drop_old_versions(spark: SparkSession, views_path: str, keep: int = 3) -> int:
    """Remove all but the latest ``keep`` versions of each view; returns how many went.

    The list of versions is rewritten in one file, entered before the old
    ones go, so it stays short and complete.
    """
    log = spark.read.schema(_VERSIONS).parquet(f"{views_path}/versions")
    order = Window.partitionBy("view").orderBy(F.desc("as_of"), F.desc("finished"))
    ranked = log.distinct().withColumn("place", F.row_number().over(order))
    files = [row[0] for row in log.select(F.col("_metadata.file_path")).distinct().collect()]
    old = [f"{views_path}/{row.view}/{row.version}" for row in ranked.where(F.col("place") > keep).collect()]
    ranked.where(F.col("place") <= keep).drop("place").coalesce(1).write.mode("append").parquet(f"{views_path}/versions")
    folders.remove(spark, files + old)
    return len(old)


def current_version(spark: SparkSession, views_path: str, name: str) -> str:
    log = _versions(spark, views_path)
    latest = log.filter(F.col("view") == name).agg(F.max_by("version", F.struct("as_of", "finished"))).first()
    return latest[0]


def read_view(spark: SparkSession, views_path: str, name: str) -> DataFrame:
    version = current_version(spark, views_path, name)
    return spark.read.parquet(f"{views_path}/{name}/{version}")


def read_feed(spark: SparkSession, views_path: str) -> DataFrame:
    """The feed joins the published alerts and profile when it is read."""
    return fraud_feed(
        read_view(spark, views_path, "fraud_alerts"),
        read_view(spark, views_path, "user_risk_profile"),
        ordered=True,
    )
