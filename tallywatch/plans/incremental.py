"""Views kept up to date from new batches only.

Every intake (a take) aggregates the rows of batches not seen before into
mergeable parts: per minute of window start, per user and hour of processing,
per hour with sketches of the users seen, and the rows that alert. A ledger names the batches of each take; views merge
the parts of the takes that count. Of older rows only the hour in which a
lookback begins is read again, as it lies on both sides of the limit.

A take counts as long as all its batches stand as they were taken in. If one
was written again, its take is dropped and its batches are taken in anew.
Folding merges many takes into one. A take without a ledger entry, left by a
failure, is never read.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.config import ViewConfig
from tallywatch.functions.labels import is_critical, risk_tier
from tallywatch.functions.moments import count_where, safe_percentage, sum_where
from tallywatch.functions.sketches import distinct_estimate, distinct_sketch, merged_distincts
from tallywatch.functions.times import epoch_micros, epoch_millis, interval, recent
from tallywatch.plans.refresh import TARGET_LAG, last_refreshed, publish_views
from tallywatch.plans.views import alert_rows
from tallywatch.sources import folders
from tallywatch.sources.score_store import DATE_COLUMN
from tallywatch.sources.snapshots import BATCH, Snapshot, open_snapshot

SLOT = "hour"
FOLD_AT = 16

_LEDGER = T.StructType(
    [*[T.StructField(name, kind) for name, kind in zip(BATCH, (T.StringType(), T.LongType()))],
     T.StructField("attempt", T.LongType()), T.StructField("take", T.StringType()), T.StructField("taken", T.LongType())]
)


@dataclass(frozen=True)
class Part:
    """How rows of a mergeable part with equal ``keys`` are put together."""

    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    maxima: tuple[str, ...] = ()
    distincts: tuple[str, ...] = ()

    def merging(self) -> list[Column]:
        return [
            *[F.sum(c).alias(c) for c in self.sums],
            *[F.max(c).alias(c) for c in self.maxima],
            *[merged_distincts(F.col(c)).alias(c) for c in self.distincts],
        ]

    def merged(self, rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*(keys or self.keys)).agg(*self.merging())


MINUTES = Part(
    ("minute_bucket",),
    ("total_users_flagged", "fraud_count", "fraud_amount_at_risk", "score_sum", "score_count", "total_txn_volume"),
    ("max_fraud_score",),
)
USERS = Part(
    ("user_id", "slot"),
    (
        "total_windows",
        "total_txn",
        "total_amount",
        "average_sum",
        "average_count",
        "fraud_flags_count",
        "score_sum",
        "score_count",
        "zscore_flags",
        "velocity_flags",
        "geo_flags",
        "large_txn_flags",
        "at_risk",
        "latency_sum",
        "latency_count",
    ),
    ("last_seen_at", "max_single_txn", "max_country_velocity", "peak_fraud_score"),
)
HOURS = Part(
    ("slot",),
    ("total_txn", "total_amount", "fraud_flags_count", "at_risk", "latency_sum", "latency_count"),
    distincts=("users", "critical_users"),
)
PARTS = ("minutes", "users", "hours", "alerts")


def _slot(ts: Column) -> Column:
    return F.date_trunc(SLOT, ts).cast("timestamp_ntz")


def minute_parts(rows: DataFrame) -> DataFrame:
    suspected = F.col("is_fraud_suspected")
    return rows.groupBy(F.date_trunc("minute", "window_start").cast("timestamp_ntz").alias("minute_bucket")).agg(
        F.count(F.lit(1)).alias("total_users_flagged"),
        count_where(suspected).alias("fraud_count"),
        sum_where(suspected, F.col("total_amount_1h")).alias("fraud_amount_at_risk"),
        F.sum("fraud_score").alias("score_sum"),
        F.count("fraud_score").alias("score_count"),
        F.sum("txn_count_1h").alias("total_txn_volume"),
        F.max("fraud_score").alias("max_fraud_score"),
    )


def user_parts(rows: DataFrame) -> DataFrame:
    suspected = F.col("is_fraud_suspected")
    latency = epoch_millis(F.col("processed_at")) - epoch_millis(F.col("window_start"))
    return rows.groupBy("user_id", _slot(F.col("processed_at")).alias("slot")).agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.sum("txn_count_1h").alias("total_txn"),
        F.sum("total_amount_1h").alias("total_amount"),
        F.sum("avg_amount_1h").alias("average_sum"),
        F.count("avg_amount_1h").alias("average_count"),
        count_where(suspected).alias("fraud_flags_count"),
        F.sum("fraud_score").alias("score_sum"),
        F.count("fraud_score").alias("score_count"),
        count_where(F.col("zscore_fraud_flag")).alias("zscore_flags"),
        count_where(F.col("rule_high_velocity")).alias("velocity_flags"),
        count_where(F.col("rule_country_velocity")).alias("geo_flags"),
        count_where(F.col("rule_large_amount")).alias("large_txn_flags"),
        sum_where(suspected, F.col("total_amount_1h")).alias("at_risk"),
        F.sum(latency).alias("latency_sum"),
        F.count(latency).alias("latency_count"),
        F.max("processed_at").alias("last_seen_at"),
        F.max("max_amount_1h").alias("max_single_txn"),
        F.max("country_count_1h").alias("max_country_velocity"),
        F.max("fraud_score").alias("peak_fraud_score"),
    )


def hour_parts(rows: DataFrame) -> DataFrame:
    """A row an hour, however many users there are."""
    suspected = F.col("is_fraud_suspected")
    latency = epoch_millis(F.col("processed_at")) - epoch_millis(F.col("window_start"))
    return rows.groupBy(_slot(F.col("processed_at")).alias("slot")).agg(
        F.sum("txn_count_1h").alias("total_txn"),
        F.sum("total_amount_1h").alias("total_amount"),
        count_where(suspected).alias("fraud_flags_count"),
        sum_where(suspected, F.col("total_amount_1h")).alias("at_risk"),
        F.sum(latency).alias("latency_sum"),
        F.count(latency).alias("latency_count"),
        distinct_sketch(F.col("user_id")).alias("users"),
        distinct_sketch(F.when(is_critical(F.col("fraud_score")), F.col("user_id"))).alias("critical_users"),
    )


_BUILD = {"minutes": minute_parts, "users": user_parts, "hours": hour_parts, "alerts": alert_rows}
_MERGE = {"minutes": MINUTES, "users": USERS, "hours": HOURS}


# -- takes ------------------------------------------------------------------------


def _take_path(views_path: str, take: str, part: str) -> str:
    return f"{views_path}/takes/{take}/{part}"


def _ledger(spark: SparkSession, views_path: str) -> DataFrame:
    path = f"{views_path}/ledger"
    return spark.read.schema(_LEDGER).parquet(path) if folders.exists(spark, path) else spark.createDataFrame([], _LEDGER)


def _publish_take(parts: dict[str, DataFrame], batches: DataFrame, views_path: str) -> None:
    """Write the parts, then enter the take; until then nobody reads it."""
    take = uuid.uuid4().hex
    for name, rows in parts.items():
        rows.write.parquet(_take_path(views_path, take, name))
    entered = batches.select(*BATCH, "attempt", F.lit(take).alias("take"), F.lit(time.time_ns()).alias("taken"))
    entered.coalesce(1).write.mode("append").parquet(f"{views_path}/ledger")


def counted_batches(snapshot: Snapshot, views_path: str) -> DataFrame:
    """The batches of the takes that count, each with its take.

    Later takes that fold earlier ones win, so a batch is counted once.
    """
    ledger = _ledger(snapshot.spark, views_path)
    standing = snapshot.entries().select(*BATCH, "attempt").distinct().withColumn("stands", F.lit(True))
    matched = ledger.join(standing, [*BATCH, "attempt"], "left")
    valid = matched.groupBy("take").agg(F.every(F.coalesce("stands", F.lit(False))).alias("valid")).where("valid")
    counted = ledger.join(valid.select("take"), "take")
    return counted.groupBy(*BATCH, "attempt").agg(F.max_by("take", "taken").alias("take"))


def _takes(counted: DataFrame) -> list[str]:
    # bounded by folding, not by the number of batches
    return sorted(row[0] for row in counted.select("take").distinct().collect())


def take_in(snapshot: Snapshot, views_path: str) -> int:
    """Aggregate the rows of batches not counted yet; returns how many batches there were."""
    counted = counted_batches(snapshot, views_path)
    new = snapshot.entries().join(counted, [*BATCH, "attempt"], "left_anti")
    batches = new.select(*BATCH, "attempt").distinct()
    many = batches.count()
    if many:
        rows = snapshot.rows(new)
        _publish_take({name: _BUILD[name](rows) for name in PARTS}, batches, views_path)
    return many


def fold(snapshot: Snapshot, views_path: str, at: int = FOLD_AT) -> bool:
    """Merge the takes that count into one, if there are ``at`` or more."""
    counted = counted_batches(snapshot, views_path)
    takes = _takes(counted)
    if len(takes) < at:
        return False
    read = {name: _read_part(snapshot.spark, views_path, takes, name) for name in PARTS}
    folded = {name: _MERGE[name].merged(rows) if name in _MERGE else rows for name, rows in read.items()}
    _publish_take(folded, counted, views_path)
    return True


def drop_folded(snapshot: Snapshot, views_path: str) -> int:
    """Remove the files of takes that do not count any more; returns how many there were.

    For times when no reader of an older state is left. The ledger keeps their
    entries, without files they are only known to be over.
    """
    kept = set(_takes(counted_batches(snapshot, views_path)))
    known = {row[0] for row in _ledger(snapshot.spark, views_path).select("take").distinct().collect()}
    gone = [take for take in known - kept if folders.exists(snapshot.spark, f"{views_path}/takes/{take}")]
    folders.remove(snapshot.spark, [f"{views_path}/takes/{take}" for take in gone])
    return len(gone)


def _read_part(spark: SparkSession, views_path: str, takes: list[str], name: str) -> DataFrame:
    return spark.read.parquet(*[_take_path(views_path, take, name) for take in takes])


# -- views ------------------------------------------------------------------------


def _recent_parts(snapshot: Snapshot, name: str, parts: DataFrame, as_of: Column, lookback: str) -> DataFrame:
    """Parts of the lookback: whole slots, and the rows of the slot it begins in."""
    begin = as_of - interval(lookback)
    whole = parts.filter(F.col("slot") >= begin)
    rows = snapshot.rows().filter(
        recent(F.col("processed_at"), as_of, lookback)
        & (_slot(F.col("processed_at")) < begin)
        # the slot ends on the same day: older and newer files are not listed
        & (F.col(DATE_COLUMN) == F.to_date(begin))
    )
    return whole.unionByName(_BUILD[name](rows))


def incremental_summary(parts: DataFrame) -> DataFrame:
    merged = MINUTES.merged(parts)
    return merged.select(
        "minute_bucket",
        "total_users_flagged",
        "fraud_count",
        "fraud_amount_at_risk",
        F.try_divide("score_sum", "score_count").alias("avg_fraud_score"),
        "max_fraud_score",
        "total_txn_volume",
        safe_percentage(F.col("fraud_count"), F.col("total_users_flagged")).alias("fraud_rate_pct"),
    )


def incremental_profile(parts: DataFrame) -> DataFrame:
    """The user risk profile from user parts of its lookback."""
    merged = USERS.merged(parts, "user_id")
    return merged.select(
        "user_id",
        "last_seen_at",
        "total_windows",
        F.col("total_txn").alias("total_txn_24h"),
        F.col("total_amount").alias("total_amount_24h"),
        F.try_divide("average_sum", "average_count").alias("avg_txn_amount_24h"),
        F.col("max_single_txn").alias("max_single_txn_24h"),
        "max_country_velocity",
        "fraud_flags_count",
        "peak_fraud_score",
        F.try_divide("score_sum", "score_count").alias("avg_fraud_score"),
        risk_tier(F.col("peak_fraud_score")).alias("risk_tier"),
        "zscore_flags",
        "velocity_flags",
        "geo_flags",
        "large_txn_flags",
    )


def incremental_kpi(parts: DataFrame, as_of: Column) -> DataFrame:
    """The KPI row from user parts of its lookback; distinct users are exact, as users are a key."""
    merged = USERS.merged(parts, "user_id")
    return merged.agg(
        F.count("user_id").alias("active_users_1h"),
        F.sum("total_txn").alias("total_transactions_1h"),
        F.sum("total_amount").alias("total_volume_usd_1h"),
        F.sum("fraud_flags_count").alias("fraud_alerts_1h"),
        F.sum("at_risk").alias("at_risk_usd_1h"),
        F.round(F.try_divide(F.sum("latency_sum"), F.sum("latency_count")), 0).alias("avg_detection_latency_ms"),
        F.count(F.when(is_critical(F.col("peak_fraud_score")), F.col("user_id"))).alias("critical_users"),
    ).select(as_of.alias("refreshed_at"), "*")


def sketched_kpi(parts: DataFrame, as_of: Column) -> DataFrame:
    """The KPI row from hour parts: a row an hour is read, distinct users are estimates."""
    return parts.agg(*HOURS.merging()).select(
        as_of.alias("refreshed_at"),
        distinct_estimate(F.col("users")).alias("active_users_1h"),
        F.col("total_txn").alias("total_transactions_1h"),
        F.col("total_amount").alias("total_volume_usd_1h"),
        F.col("fraud_flags_count").alias("fraud_alerts_1h"),
        F.col("at_risk").alias("at_risk_usd_1h"),
        F.round(F.try_divide("latency_sum", "latency_count"), 0).alias("avg_detection_latency_ms"),
        distinct_estimate(F.col("critical_users")).alias("critical_users"),
    )


def incremental_views(
    snapshot: Snapshot, views_path: str, as_of: Column, cfg: ViewConfig = ViewConfig(), approximate: bool = False
) -> dict[str, DataFrame]:
    """The four views as of a time, from the takes that count.

    ``approximate`` takes the KPI row from hours and their sketches instead of
    from users and hours.
    """
    takes = _takes(counted_batches(snapshot, views_path))
    if not takes:
        none = snapshot.rows()
        read = {name: _BUILD[name](none) for name in PARTS}
    else:
        read = {name: _read_part(snapshot.spark, views_path, takes, name) for name in PARTS}

    def part(name: str, lookback: str) -> DataFrame:
        return _recent_parts(snapshot, name, read[name], as_of, lookback)

    kpi = sketched_kpi(part("hours", cfg.kpi_lookback), as_of) if approximate else incremental_kpi(part("users", cfg.kpi_lookback), as_of)
    return {
        "fraud_summary_1min": incremental_summary(read["minutes"]),
        "user_risk_profile": incremental_profile(part("users", cfg.profile_lookback)),
        "fraud_alerts": read["alerts"].filter(recent(F.col("alert_generated_at"), as_of, cfg.alert_lookback)),
        "dashboard_kpi": kpi,
    }


# -- refresh ----------------------------------------------------------------------


def due_views(spark: SparkSession, views_path: str, as_of: Column, lags: dict[str, str] = TARGET_LAG) -> list[str]:
    """The views whose published state is older than their target lag, or that have none."""
    published = last_refreshed(spark, views_path)
    late = spark.range(1).select(
        *[
            F.coalesce(F.lit(published.get(name)).cast("timestamp") <= as_of.cast("timestamp") - interval(lag), F.lit(True)).alias(name)
            for name, lag in lags.items()
        ]
    )
    return [name for name, is_late in late.first().asDict().items() if is_late]


def _known_time(spark: SparkSession, as_of: Column) -> Column:
    """``as_of`` as a literal, so that a time found by a query is looked up once and not by every view."""
    one = spark.range(1)
    kind = one.select(as_of).schema[0].dataType
    return F.timestamp_micros(F.lit(one.select(epoch_micros(as_of)).first()[0]).cast("long")).cast(kind)


def refresh_due(
    spark: SparkSession,
    scores_path: str,
    views_path: str,
    as_of: Column | None = None,
    cfg: ViewConfig = ViewConfig(),
    lags: dict[str, str] = TARGET_LAG,
    approximate: bool = False,
) -> list[str]:
    """Take in new batches and publish the views that are due; returns their names.

    Without a due view nothing is read. All views of one refresh describe the
    same snapshot of the score table.
    """
    stamp = _known_time(spark, F.current_timestamp() if as_of is None else as_of)
    names = due_views(spark, views_path, stamp, lags)
    if names:
        snapshot = open_snapshot(spark, scores_path)
        take_in(snapshot, views_path)
        fold(snapshot, views_path)
        views = incremental_views(snapshot, views_path, stamp, cfg, approximate)
        publish_views(spark, {name: views[name] for name in names}, views_path, stamp)
    return names
