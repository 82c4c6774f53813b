"""Health reports kept in a table, one per check interval, and the alerts they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.config import HealthConfig
from tallywatch.functions.times import epoch_micros
from tallywatch.operators.health import evaluate_thresholds, health_report, offset_lag
from tallywatch.sources import folders
from tallywatch.streaming.monitor import ProgressLog

REPORT_COLUMNS = ("report_time", "kafka_lag", "dlq_count")


def store_report(report: DataFrame, path: str, interval_sec: float = HealthConfig.check_interval_sec) -> None:
    """Add a report to the table at ``path``; it replaces an earlier one of the same interval.

    Reports lie in one folder per date and interval, so other intervals are not touched.
    """
    interval = F.floor(epoch_micros(F.col("report_time")) / F.lit(interval_sec * 1e6)).cast("long")
    placed = report.select(
        *REPORT_COLUMNS, F.col("report_time").cast("date").alias("report_date"), interval.alias("check_id")
    )
    (
        placed.write.partitionBy("report_date", "check_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def read_reports(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Stored reports, those of ``since`` (a date) and later if given; older dates are not read."""
    schema = "report_time timestamp_ntz, kafka_lag long, dlq_count long, report_date date, check_id long"
    if not folders.exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    return rows if since is None else rows.filter(F.col("report_date") >= F.lit(since).cast("date"))


def report_alerts(reports: DataFrame, rules: DataFrame) -> DataFrame:
    """One alert per stored report and broken rule."""
    pairs = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in REPORT_COLUMNS[1:]]
    metrics = reports.select("report_time", F.inline(F.array(*pairs)))
    return evaluate_thresholds(metrics, rules, keep=("report_time",))


def check_health(
    progress: ProgressLog,
    tagged: DataFrame,
    path: str,
    at: Column | None = None,
    interval_sec: float = HealthConfig.check_interval_sec,
) -> None:
    """One check: lag from the queries' latest offsets, rejects of the interval, stored.

    ``tagged`` are stored messages with ``kafka_timestamp`` and ``error``.
    """
    at = F.current_timestamp().cast("timestamp_ntz") if at is None else at
    lag = offset_lag(progress.offset_table(tagged.sparkSession))
    store_report(health_report(lag, tagged, at, interval_sec), path, interval_sec)
