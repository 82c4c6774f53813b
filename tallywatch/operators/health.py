"""Pipeline health: lag, cost, latency, counters, threshold alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.config import HealthConfig
from tallywatch.functions.times import recent

# Upper bounds of the latency histogram, in seconds.
LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)

RULE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)


def offset_lag(offsets: DataFrame) -> DataFrame:
    """Messages behind per group and topic.

    Partitions without a commit and partitions ahead of their end add nothing.
    """
    behind = F.greatest(F.lit(0), F.col("high") - F.col("committed"))
    return (
        offsets.groupBy("group", "topic")
        .agg(F.sum(F.when(F.col("committed") >= 0, behind).otherwise(0)).alias("lag"))
    )


def query_cost_summary(history: DataFrame, user: str, as_of: Column, lookback: str = "1 hour") -> DataFrame:
    """One row of query count, credits, elapsed times and gigabytes scanned."""

    def tidy(value: Column, digits: int) -> Column:
        return F.round(F.coalesce(value, F.lit(0.0)), digits)

    mine = history.filter((F.col("user_name") == user) & recent(F.col("start_time"), as_of, lookback))
    return mine.agg(
        F.count(F.lit(1)).alias("query_count"),
        tidy(F.sum("credits"), 4).alias("credits_used"),
        tidy(F.avg("elapsed_ms"), 1).alias("avg_elapsed_ms"),
        tidy(F.max("elapsed_ms"), 1).alias("max_elapsed_ms"),
        tidy(F.sum("bytes_scanned") / 1e9, 3).alias("gb_scanned"),
    )


def latency_histogram(rows: DataFrame, seconds: Column, bounds: tuple[float, ...] = LATENCY_BOUNDS) -> DataFrame:
    """Cumulative counts: rows not above each bound, and all rows last.

    One pass counts every bound; the single result row is then unfolded.
    """
    limits = [*bounds, float("inf")]
    counts = rows.agg(*[F.count_if(seconds <= limit).alias(f"b{i}") for i, limit in enumerate(limits)])
    buckets = F.array(
        *[
            F.struct(F.lit(str(limit) if limit != limits[-1] else "+Inf").alias("le"), F.col(f"b{i}").alias("cumulative_count"))
            for i, limit in enumerate(limits)
        ]
    )
    return counts.select(F.inline(buckets))


def delivery_counts(tagged: DataFrame) -> DataFrame:
    """Accepted and rejected messages of a tagged message table."""
    return tagged.agg(
        F.count_if(F.col("error").isNull()).alias("messages_sent"),
        F.count_if(F.col("error").isNotNull()).alias("messages_failed"),
    )


def dead_letters_by_minute(rejected: DataFrame, at: str) -> DataFrame:
    return rejected.groupBy(F.date_trunc("minute", at).cast("timestamp_ntz").alias("minute_bucket")).agg(
        F.count(F.lit(1)).alias("dlq_count")
    )


def unpivot_metrics(row: DataFrame, names: list[str] | None = None) -> DataFrame:
    """A one-row table as (name, value) metrics."""
    names = names or row.columns
    pairs = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names]
    )
    return row.select(F.inline(pairs))


def monitor_rules(spark: SparkSession, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    """The health checks' own limits. The dead-letter limit is per check."""
    per_check = cfg.dlq_per_minute_above * cfg.check_interval_sec / 60
    return spark.createDataFrame(
        [
            ("kafka_lag", ">", float(cfg.lag_above), "critical"),
            ("dlq_count", ">", float(per_check), "critical"),
            ("avg_detection_latency_ms", ">", float(cfg.latency_ms_above), "warning"),
            ("fraud_rate", "<", float(cfg.fraud_rate_below), "warning"),
            ("fraud_rate", ">", float(cfg.fraud_rate_above), "warning"),
        ],
        RULE_SCHEMA,
    )


def dashboard_rules(spark: SparkSession, cfg: HealthConfig = HealthConfig()) -> DataFrame:
    return spark.createDataFrame(
        [
            ("fraud_rate_pct", ">", float(cfg.dashboard_fraud_rate_pct_above), "warning"),
            ("critical_users", ">", float(cfg.critical_users_above), "critical"),
            ("avg_detection_latency_ms", ">", float(cfg.latency_ms_above), "warning"),
        ],
        RULE_SCHEMA,
    )


def evaluate_thresholds(metrics: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One alert row for every metric that breaks a rule of its name, with the columns ``keep`` of the metric."""
    broken = ((F.col("op") == ">") & (F.col("value") > F.col("threshold"))) | (
        (F.col("op") == "<") & (F.col("value") < F.col("threshold"))
    )
    message = F.concat(
        F.upper("name"),
        F.lit(" ALERT: "),
        F.format_number("value", 3),
        F.lit(" is "),
        F.when(F.col("op") == ">", "above").otherwise("below"),
        F.lit(" the limit "),
        F.format_number("threshold", 3),
    )
    return (
        metrics.join(rules, "name")
        .filter(broken)
        .select(*keep, "name", "value", "op", "threshold", "severity", message.alias("message"))
    )


def health_report(
    lag: DataFrame,
    tagged: DataFrame,
    at: Column | None = None,
    interval_sec: float = HealthConfig.check_interval_sec,
    group: str | None = None,
) -> DataFrame:
    """One row: report time, lag, and messages rejected in the last check interval.

    ``tagged`` are messages with ``kafka_timestamp`` and ``error``. With
    ``group`` only that group's lag counts. A lag nobody reported is -1, which
    is not the same as being up to date.
    """
    at = F.current_timestamp() if at is None else at
    since = at - F.make_dt_interval(secs=F.lit(interval_sec))
    stamp = F.col("kafka_timestamp")
    rejected = tagged.filter(F.col("error").isNotNull() & (stamp > since) & (stamp <= at))
    mine = lag if group is None else lag.filter(F.col("group") == group)
    both = mine.select("lag", F.lit(0).alias("_rejected")).unionByName(
        rejected.select(F.lit(None).cast("long").alias("lag"), F.lit(1).alias("_rejected"))
    )
    return both.agg(
        F.coalesce(F.sum("lag"), F.lit(-1)).alias("kafka_lag"),
        F.coalesce(F.sum("_rejected"), F.lit(0)).alias("dlq_count"),
    ).select(at.alias("report_time"), "kafka_lag", "dlq_count")


def fraud_rate_metrics(kpi: DataFrame) -> DataFrame:
    """The health checks' ``fraud_rate`` (a share) and mean latency, from a KPI row with its rate."""
    shares = kpi.select((F.col("fraud_rate_pct") / 100).alias("fraud_rate"), "avg_detection_latency_ms")
    return unpivot_metrics(shares)
