"""One query per operator, each over whole driver tables.

The tables are sparse (a user has a few transactions a day), so windows are a
week long and the amount limit is lower than in production. Processing time is
the end of the window, which makes every view repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.config import DetectionConfig, ForestConfig, ScoreConfig, ViewConfig, WindowConfig
from tallywatch.functions.sketches import RANK_ERROR, distinct_error
from tallywatch.functions.times import epoch_micros, micros_of
from tallywatch.operators import health, measures, transaction_features as tf, transaction_rules as rules
from tallywatch.operators.isolation_forest import (
    apply_scaler,
    draw_samples,
    fit_scaler,
    train_isolation_forest,
)
from tallywatch.operators.ranking_quality import ranking_quality
from tallywatch.operators.scoring import rule_flags, zscore_flags
from tallywatch.operators.trailing import trailing_stats
from tallywatch.operators.window_features import non_overlapping, window_features
from tallywatch.plans import views
from tallywatch.plans.detection import last_window_end, scored_windows, valid_amounts
from tallywatch.plans.incremental import refresh_due
from tallywatch.plans.refresh import read_feed, read_view, refresh_views
from tallywatch.session import save_and_reload, shared_dir, stream_settings
from tallywatch.sources.messages import (
    dead_letters,
    encode,
    parse_transactions,
    valid_transactions,
    with_rejection,
)
from tallywatch.sources.score_store import read_scores, write_scores
from tallywatch.sources.snapshots import append_batch, compact, expire, open_snapshot
from tallywatch.sources.synthetic import synthetic_from_ids
from tallywatch.sources.tables import (
    offsets_from_events,
    query_history_from_orders,
    read_table,
    transactions_from_events,
    transactions_from_order_lines,
)
from tallywatch.streaming.control import BatchGate, run_until
from tallywatch.streaming.detection import start, start_dead_letters, start_detection
from tallywatch.streaming.publishing import Target, publish_batch
from tallywatch.streaming.quartiles import quartile_bounds, quartile_writer, sketches_upto
from tallywatch.streaming.reports import read_reports, report_alerts, store_report
from tallywatch.streaming.sinks import batch_folder_writer, score_writer, with_fallback
from tallywatch.streaming.stateful import trailing_stream_features

CONFIG = DetectionConfig(
    window=WindowConfig(length="7 days", slide="1 day"),
    score=ScoreConfig(amount_above=200.0),
    views=ViewConfig(profile_lookback="30 days", alert_lookback="30 days", kpi_lookback="30 days"),
)
LINE_WINDOW = WindowConfig(length="90 days", slide="30 days")
FLAG_AMOUNT = 200.0
Query = Callable[[SparkSession, str], DataFrame]


def settled(value: Column, digits: int = 4) -> Column:
    """Rounding whose limits no short decimal falls on, so that engines that
    add in different orders agree."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.37) / scale


def settle(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: settled(F.col(c), digits) for c in columns})


# -- inputs -------------------------------------------------------------------


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return valid_amounts(transactions_from_events(read_table(spark, sf, "events")))


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return transactions_from_order_lines(
        *[read_table(spark, sf, t) for t in ("lineitem", "orders", "supplier", "nation")]
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Events as messages, 4 in 50 of them damaged in a known way."""
    spoiled = F.col("event_id") % 50
    rows = (
        transactions_from_events(events)
        .withColumn("event_id", F.expr("cast(substring(transaction_id, 5) as bigint)"))
        .withColumn("amount", F.when(spoiled == 1, -F.col("amount")).otherwise(F.col("amount")))
        .withColumn("transaction_id", F.when(spoiled != 2, F.col("transaction_id")))
        .withColumn("timestamp", F.when(spoiled == 3, "junk").otherwise(F.col("timestamp")))
    )
    body = F.struct(*[c for c in rows.columns if c not in ("event_id", "event_time")])
    text = F.to_json(body, {"ignoreNullFields": "false"})
    return rows.select(
        F.col("user_id").cast("binary").alias("key"),
        F.when(spoiled == 0, F.substring(text, 1, 20)).otherwise(text).cast("binary").alias("value"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return envelopes(read_table(spark, sf, "events"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = read_table(spark, sf, "events").schema
    # the pattern finds the table whether it is one file or a folder of part files
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")


def windows(spark: SparkSession, sf: str) -> DataFrame:
    return window_features(transactions(spark, sf), CONFIG.window)


def scores(spark: SparkSession, sf: str) -> DataFrame:
    tx = transactions_from_events(read_table(spark, sf, "events"))
    return scored_windows(tx, CONFIG, processed_at=F.col("window_end"))


def as_of(spark: SparkSession, sf: str) -> Column:
    return last_window_end(transactions_from_events(read_table(spark, sf, "events")), CONFIG.window)


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return views.fraud_alerts(scores(spark, sf), as_of(spark, sf), CONFIG.views.alert_lookback)


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return views.user_risk_profile(scores(spark, sf), as_of(spark, sf), CONFIG.views.profile_lookback)


def kpi(spark: SparkSession, sf: str, with_rate: bool = False) -> DataFrame:
    return views.dashboard_kpi(scores(spark, sf), as_of(spark, sf), CONFIG.views.kpi_lookback, with_rate)


WINDOW_SUMS = ("total_amount_1h", "avg_amount_1h", "stddev_amount_1h")
HOUR_SUMS = ("total_amount_1h", "avg_amount_1h", "stddev_amount_1h")


# -- messages -------------------------------------------------------------------


def parse_valid(spark: SparkSession, sf: str) -> DataFrame:
    rows = valid_transactions(with_rejection(messages(spark, sf)))
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("kafka_timestamp", "event_time")}
    )


def parse_lenient(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse_transactions(messages(spark, sf))
    return rows.select("transaction_id", "user_id", "amount", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


def dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    rejected = dead_letters(with_rejection(messages(spark, sf)))
    return rejected.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def delivery_counts(spark: SparkSession, sf: str) -> DataFrame:
    return health.delivery_counts(with_rejection(messages(spark, sf)))


def dead_letters_by_minute(spark: SparkSession, sf: str) -> DataFrame:
    tagged = with_rejection(messages(spark, sf)).filter(F.col("error").isNotNull())
    return health.dead_letters_by_minute(tagged, "kafka_timestamp")


def encoded_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = encode(transactions(spark, sf))
    return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# -- windows and scores ----------------------------------------------------------


def window_feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    return settle(windows(spark, sf), *WINDOW_SUMS)


def zscore_flag_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = zscore_flags(windows(spark, sf), CONFIG.score)
    return settle(rows.select("user_id", "window_start", "zscore_amount", "zscore_fraud_flag"), "zscore_amount")


def rule_flag_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rule_flags(windows(spark, sf), CONFIG.score).select(
        "user_id", "window_start", "rule_high_velocity", "rule_country_velocity", "rule_large_amount"
    )


def score_rows(spark: SparkSession, sf: str) -> DataFrame:
    return settle(scores(spark, sf), *WINDOW_SUMS, "zscore_amount", "fraud_score")


def non_overlapping_totals(spark: SparkSession, sf: str) -> DataFrame:
    kept = non_overlapping(scores(spark, sf), CONFIG.window)
    totals = kept.groupBy("user_id").agg(
        F.sum("txn_count_1h").alias("txn_total"), F.sum("total_amount_1h").alias("amount_total")
    )
    return settle(totals, "amount_total")


def order_line_windows(spark: SparkSession, sf: str) -> DataFrame:
    return settle(window_features(order_lines(spark, sf), LINE_WINDOW), *WINDOW_SUMS, digits=2)


def order_line_trailing(spark: SparkSession, sf: str) -> DataFrame:
    rows = order_lines(spark, sf).select("transaction_id", "user_id", "event_time", "amount")
    names = {"count": "line_count", "sum": "amount_sum", "stddev": "amount_stddev", "max": "amount_max"}
    measured = trailing_stats(
        rows,
        ["user_id"],
        epoch_micros(F.col("event_time")),
        micros_of("90 days"),
        "amount",
        names,
        block=micros_of("30 days"),
    )
    return settle(measured, "amount_sum", "amount_stddev", digits=2)


# -- views ------------------------------------------------------------------------


def fraud_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.fraud_summary_by_minute(scores(spark, sf))
    return settle(rows, "fraud_amount_at_risk", "avg_fraud_score", "max_fraud_score")


def user_profile(spark: SparkSession, sf: str) -> DataFrame:
    return settle(
        profile(spark, sf), "total_amount_24h", "avg_txn_amount_24h", "peak_fraud_score", "avg_fraud_score"
    )


def alert_rows(spark: SparkSession, sf: str) -> DataFrame:
    return settle(alerts(spark, sf), "fraud_score")


def kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    return settle(kpi(spark, sf), "total_volume_usd_1h", "at_risk_usd_1h")


def stored_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores as a table, for queries that read them more than once."""
    return save_and_reload(scores(spark, sf), "scores")


def fraud_feed(spark: SparkSession, sf: str) -> DataFrame:
    stored, at = stored_scores(spark, sf), as_of(spark, sf)
    feed = views.fraud_feed(
        views.fraud_alerts(stored, at, CONFIG.views.alert_lookback),
        views.user_risk_profile(stored, at, CONFIG.views.profile_lookback),
        ordered=True,
    )
    return settle(feed, "fraud_score", "avg_fraud_score", "total_amount_24h")


def refreshed_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Scores written to the store, views refreshed, feed read back."""
    path = shared_dir(spark, "store")
    write_scores(scores(spark, sf), f"{path}/scores", 0)
    refresh_views(spark, f"{path}/scores", f"{path}/views", as_of(spark, sf), CONFIG.views)
    feed = read_feed(spark, f"{path}/views")
    return settle(feed, "fraud_score", "avg_fraud_score", "total_amount_24h")


def score_batches(spark: SparkSession, sf: str, many: int) -> list[DataFrame]:
    """The score rows in batches by user."""
    rows = save_and_reload(scores(spark, sf), "scores")
    return [rows.filter(F.pmod(F.xxhash64("user_id"), F.lit(many)) == i) for i in range(many)]


def refreshed_in_steps(spark: SparkSession, sf: str, approximate: bool = False) -> str:
    """Three batches, each followed by a refresh from new batches only; returns where the views are."""
    path = shared_dir(spark, "store")
    latest = as_of(spark, sf)
    never_fresh = {name: "0 seconds" for name in ("fraud_summary_1min", "user_risk_profile", "fraud_alerts", "dashboard_kpi")}
    for number, batch in enumerate(score_batches(spark, sf, 3)):
        append_batch(batch, f"{path}/scores", number)
        refresh_due(spark, f"{path}/scores", f"{path}/views", latest, CONFIG.views, never_fresh, approximate)
    return f"{path}/views"


def refreshed_incremental(spark: SparkSession, sf: str) -> DataFrame:
    feed = read_feed(spark, refreshed_in_steps(spark, sf))
    return settle(feed, "fraud_score", "avg_fraud_score", "total_amount_24h")


def incremental_kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    row = read_view(spark, refreshed_in_steps(spark, sf), "dashboard_kpi")
    return settle(row, "total_volume_usd_1h", "at_risk_usd_1h")


def sketched_kpi_error(spark: SparkSession, sf: str) -> DataFrame:
    """Exact distinct users of the KPI row, and whether the sketches' estimates are within their error."""
    estimates = read_view(spark, refreshed_in_steps(spark, sf, approximate=True), "dashboard_kpi").first()
    exact = kpi(spark, sf).select("active_users_1h", "critical_users")
    near = [
        (F.abs(F.lit(estimates[name]) - F.col(name)) <= distinct_error() * F.col(name)).alias(f"{name}_near")
        for name in exact.columns
    ]
    return exact.select("*", *near)


def sketched_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Window features with sketches of countries; a few countries are counted exactly by a sketch, too."""
    return settle(window_features(transactions(spark, sf), CONFIG.window, approximate=True), *WINDOW_SUMS)


def stream_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles from the sketches a stream leaves, by whether their ranks among all amounts are within the error."""
    path = shared_dir(spark, "stream")
    stream = valid_amounts(transactions_from_events(event_stream(spark, sf))).select("transaction_id", "user_id", "amount")
    writer = quartile_writer(batch_folder_writer(f"{path}/rows"), f"{path}/state")
    query = start(stream, writer, f"{path}/checkpoint", available_now=True)
    query.awaitTermination()
    flagged = spark.read.parquet(f"{path}/rows")
    last = flagged.agg(F.max("batch_id")).first()[0]
    bounds = quartile_bounds(sketches_upto(spark, f"{path}/state", str(query.id), last))
    judged = flagged.join(bounds, "user_id").groupBy("user_id")
    n = F.count(F.lit(1))

    def near(quartile: str, rank: float) -> Column:
        below = F.count_if(F.col("amount") < F.col(quartile)) / n
        upto = F.count_if(F.col("amount") <= F.col(quartile)) / n
        return (below <= rank + RANK_ERROR) & (upto >= rank - RANK_ERROR)

    return judged.agg(n.alias("amounts"), near("q1", 0.25).alias("q1_near"), near("q3", 0.75).alias("q3_near"))


def incremental_summary_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_view(spark, refreshed_in_steps(spark, sf), "fraud_summary_1min")
    return settle(rows, "fraud_amount_at_risk", "avg_fraud_score", "max_fraud_score")


def compacted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score rows appended in twelve batches, one of them twice, then compacted, replaced files removed."""
    path = shared_dir(spark, "snapshots")
    batches = score_batches(spark, sf, 12)
    for number, batch in enumerate(batches):
        append_batch(batch.limit(0) if number == 5 else batch, path, number)
    compact(spark, path)
    append_batch(batches[5], path, 5)
    compact(spark, path, crowded=2)
    expire(spark, path, keep_seconds=0)
    rows = open_snapshot(spark, path).rows().drop("processed_date", "run_id", "batch_id")
    return settle(rows, *WINDOW_SUMS, "zscore_amount", "fraud_score")


class _FailsOnce(Target):
    """A target whose first append of a batch reports a failure after some or all rows are there."""

    def append(self, rows: DataFrame) -> None:
        share = {0: 1.0, 1: 0.5, 2: 0.0}[rows.select("batch_id").first()[0]]
        super().append(rows.filter(F.pmod(F.col("row_id"), F.lit(100)) < share * 100))
        raise OSError("connection lost")


def replayed_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Every batch fails in its first append, is repeated, and then once more after it is done."""
    path = shared_dir(spark, "published")
    options = {"path": f"{path}/table"}
    for number, batch in enumerate(score_batches(spark, sf, 3)):
        try:
            publish_batch(batch, number, "run", _FailsOnce("parquet", options), path)
        except OSError:
            pass
        for _ in range(2):
            publish_batch(batch, number, "run", Target("parquet", options), path)
    rows = Target("parquet", options).read(spark).drop("run_id", "batch_id", "row_id")
    return settle(rows, *WINDOW_SUMS, "zscore_amount", "fraud_score")


# -- transaction features -----------------------------------------------------------


def time_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = tf.flag_features(tf.time_features(transactions(spark, sf)))
    return settle(
        rows.select(
            "transaction_id",
            "hour_of_day",
            "day_of_week",
            "is_weekend",
            "is_night",
            "log_amount",
            "is_high_risk_merchant_int",
            "is_card_not_present",
        ),
        "log_amount",
    )


def row_zscores(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "amount")
    return settle(tf.row_zscore(rows).select("transaction_id", "zscore_amount"), "zscore_amount")


def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "amount")
    return tf.iqr_outliers(rows).select("transaction_id", "iqr_outlier")


def trailing_hour(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "amount")
    return settle(tf.trailing_hour_features(rows), *HOUR_SUMS)


def trailing_day(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "amount")
    return tf.trailing_count(rows).select("transaction_id", "txn_count_24h")


def daily_countries(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "merchant_country")
    return tf.daily_countries(rows).select("transaction_id", "country_count_1h")


def behavioral_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = tf.behavioral_features(transactions(spark, sf)).drop("timestamp", "ip_address", "device_fingerprint")
    return settle(rows, *HOUR_SUMS, "log_amount", "zscore_amount")


def merchant_frequency(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "merchant_id")
    return tf.merchant_frequency(rows)


# -- transaction rules --------------------------------------------------------------


def burst_amount(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "amount")
    return settle(
        rules.burst_amount_rule(rows).select("transaction_id", "burst_amount", "rule_burst_amount"), "burst_amount"
    )


def country_spread(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "merchant_country")
    return rules.country_spread_rule(rows).select("transaction_id", "country_count_24h", "rule_country_spread")


def card_not_present(spark: SparkSession, sf: str) -> DataFrame:
    return rules.card_not_present_rule(transactions(spark, sf)).select("transaction_id", "rule_cnp_high_risk")


def geo_velocity(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "event_time", "merchant_country")
    return settle(
        rules.geo_velocity(rows).select(
            "transaction_id", "previous_country", "country_changed", "hours_since_previous"
        ),
        "hours_since_previous",
    )


def historical_zscore(spark: SparkSession, sf: str) -> DataFrame:
    rows = transactions(spark, sf).select("transaction_id", "user_id", "amount")
    return settle(
        rules.historical_zscore(rows).select("transaction_id", "historical_zscore", "rule_historical_zscore"),
        "historical_zscore",
    )


# -- measures -------------------------------------------------------------------------


def merchant_fraud_rate(spark: SparkSession, sf: str) -> DataFrame:
    return measures.merchant_fraud_rate(transactions(spark, sf), F.col("amount") > FLAG_AMOUNT)


def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return measures.distribution(profile(spark, sf), "risk_tier")


def alert_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return measures.distribution(alerts(spark, sf), "alert_type")


def country_distribution(spark: SparkSession, sf: str) -> DataFrame:
    flagged = transactions(spark, sf).filter(F.col("amount") > FLAG_AMOUNT)
    return measures.distribution(flagged, "merchant_country")


def fraud_rate_measure(spark: SparkSession, sf: str) -> DataFrame:
    stored = stored_scores(spark, sf)
    recent = views.fraud_alerts(stored, as_of(spark, sf), CONFIG.views.alert_lookback)
    return settle(measures.fraud_rate_measure(recent, stored), "fraud_rate_pct")


def at_risk_usd(spark: SparkSession, sf: str) -> DataFrame:
    return settle(measures.at_risk_usd(profile(spark, sf)), "at_risk_usd")


def avg_latency(spark: SparkSession, sf: str) -> DataFrame:
    return measures.average_latency(kpi(spark, sf))


def top_risky_users(spark: SparkSession, sf: str) -> DataFrame:
    return settle(measures.top_risky_users(profile(spark, sf), 20), "peak_fraud_score")


def tier_slicer(spark: SparkSession, sf: str) -> DataFrame:
    rows = measures.with_tiers(profile(spark, sf), ["CRITICAL", "HIGH"])
    return rows.select("user_id", "risk_tier")


def volume_against_flags(spark: SparkSession, sf: str) -> DataFrame:
    return settle(measures.volume_against_flags(profile(spark, sf)), "total_amount_24h")


def fraud_trend(spark: SparkSession, sf: str) -> DataFrame:
    return measures.fraud_trend(views.fraud_summary_by_minute(scores(spark, sf)))


def high_score_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return measures.high_score_alerts(alerts(spark, sf)).select("user_id", "window_start", "alert_type")


def kpi_cards(spark: SparkSession, sf: str) -> DataFrame:
    return settle(measures.kpi_cards(kpi(spark, sf, with_rate=True)), "at_risk_usd_1h")


def detection_metrics(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    suspicious = F.get_json_object("props", "$.k").cast("int") >= 97
    rows = measures.detection_metrics(events, F.col("value") > 150, suspicious)
    return settle(rows, "precision", "recall", "false_positive_rate")


def score_quality(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").filter("value > 0")
    suspicious = F.get_json_object("props", "$.k").cast("int") >= 97
    rows = ranking_quality(events, F.col("value"), suspicious, ForestConfig().contamination)
    return settle(rows, "auc", "precision", "recall", "best_f1")


# -- health -----------------------------------------------------------------------------


def offset_lag(spark: SparkSession, sf: str) -> DataFrame:
    return health.offset_lag(offsets_from_events(read_table(spark, sf, "events")))


def query_cost_summary(spark: SparkSession, sf: str) -> DataFrame:
    history = query_history_from_orders(read_table(spark, sf, "orders"))
    latest = history.agg(F.max("start_time").alias("at")).scalar()
    return health.query_cost_summary(history, "1-URGENT", latest, "365 days")


def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return health.latency_histogram(read_table(spark, sf, "events"), F.col("value") / 500)


def threshold_alerts(spark: SparkSession, sf: str) -> DataFrame:
    metrics = health.unpivot_metrics(
        kpi(spark, sf, with_rate=True), ["fraud_rate_pct", "critical_users", "avg_detection_latency_ms"]
    )
    return health.evaluate_thresholds(metrics, health.dashboard_rules(spark))


def monitor_alerts(spark: SparkSession, sf: str) -> DataFrame:
    row = monitor_report(spark, sf)
    metrics = health.unpivot_metrics(row, ["kafka_lag", "dlq_count"])
    metrics = metrics.unionByName(health.fraud_rate_metrics(kpi(spark, sf, with_rate=True)))
    return health.evaluate_thresholds(metrics, health.monitor_rules(spark))


def monitor_report(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    tagged = with_rejection(envelopes(events))
    latest = events.agg(F.max("ts").alias("at")).scalar()
    # the test events are days apart, so a check looks back a day
    return health.health_report(health.offset_lag(offsets_from_events(events)), tagged, latest, interval_sec=86_400.0)


def stored_reports(spark: SparkSession, sf: str) -> DataFrame:
    """A check for each of the last seven days; two of them are repeated."""
    path = shared_dir(spark, "reports")
    events = read_table(spark, sf, "events")
    tagged = save_and_reload(with_rejection(envelopes(events)).select("kafka_timestamp", "error"), "tagged")
    lag = save_and_reload(health.offset_lag(offsets_from_events(events)), "lag")
    latest, day = events.agg(F.max("ts")).first()[0], 86_400.0
    for back in (*range(7), 0, 3):
        at = F.lit(latest) - F.make_dt_interval(days=F.lit(back))
        store_report(health.health_report(lag, tagged, at, day), path, day)
    reports = read_reports(spark, path).select("report_time", "kafka_lag", "dlq_count")
    broken = report_alerts(reports, health.monitor_rules(spark)).groupBy("report_time")
    alerts = broken.agg(F.count(F.lit(1)).alias("alerts"))
    return reports.join(alerts, "report_time", "left").fillna(0, ["alerts"])


# -- model ------------------------------------------------------------------------------


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    features = tf.feature_vector(tf.behavioral_features(transactions(spark, sf)))
    return features.select("transaction_id", "features")


def scaler_fit(spark: SparkSession, sf: str) -> DataFrame:
    return settle(fit_scaler(vectors(spark, sf)), "mean", "scale")


def scaler_apply(spark: SparkSession, sf: str) -> DataFrame:
    stored = save_and_reload(vectors(spark, sf), "features")
    scaled = apply_scaler(stored, fit_scaler(stored))
    return settle(
        scaled.select("transaction_id", F.posexplode("scaled").alias("position", "scaled")), "scaled", digits=3
    )


def isolation_forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    stored = save_and_reload(vectors(spark, sf), "features")
    forest = train_isolation_forest(stored, "transaction_id", cfg=ForestConfig())
    return settle(forest.score(stored).select("transaction_id", "isolation_score", "is_anomaly_ml"), "isolation_score", digits=9)


def forest_quality(spark: SparkSession, sf: str) -> DataFrame:
    """How the forest ranks the test events' marks, which its features only partly show."""
    stored = save_and_reload(vectors(spark, sf), "features")
    forest = train_isolation_forest(stored, "transaction_id", cfg=ForestConfig())
    marks = read_table(spark, sf, "events").select(
        F.concat(F.lit("txn_"), "event_id").alias("transaction_id"),
        (F.get_json_object("props", "$.k").cast("int") >= 97).alias("suspicious"),
    )
    rows = forest.score(stored).select("transaction_id", "isolation_score").join(marks, "transaction_id")
    quality = ranking_quality(rows, -settled(F.col("isolation_score"), 9), F.col("suspicious"), ForestConfig().contamination)
    return settle(quality, "auc", "precision", "recall", "best_f1")


def forest_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Draws per tree of the bootstrap sample: always the sample size."""
    rows = transactions(spark, sf).select("transaction_id", F.array("amount").alias("x"))
    sampled, _ = draw_samples(rows, "transaction_id", "x", ForestConfig())
    return sampled.groupBy("tree_id").agg(F.count(F.lit(1)).alias("draws"))


def synthetic(spark: SparkSession, sf: str) -> DataFrame:
    rows = synthetic_from_ids(read_table(spark, sf, "events"), "event_id", F.col("ts"))
    return rows.drop("timestamp")


# -- streams ------------------------------------------------------------------------------


def stream_window_features(spark: SparkSession, sf: str) -> DataFrame:
    """Messages through decode, watermark, windows and scores to the store."""
    path = shared_dir(spark, "stream")
    stream = envelopes(event_stream(spark, sf))
    writer = with_fallback(score_writer(f"{path}/scores"), f"{path}/fallback")
    with stream_settings(spark):
        start_detection(stream, writer, f"{path}/checkpoint", CONFIG, available_now=True).awaitTermination()
    rows = read_scores(spark, f"{path}/scores").drop("processed_at", "processed_date", "run_id", "batch_id")
    return settle(rows, *WINDOW_SUMS, "zscore_amount", "fraud_score")


def stream_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "stream")
    stream = envelopes(event_stream(spark, sf))
    writer = batch_folder_writer(f"{path}/rejected")
    start_dead_letters(stream, writer, f"{path}/checkpoint", CONFIG, available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{path}/rejected")
    return rows.groupBy("error", "original_topic").agg(F.count(F.lit(1)).alias("message_count"))


def stream_transaction_features(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "stream")
    stream = valid_amounts(transactions_from_events(event_stream(spark, sf)))
    stream = stream.withColumn("event_time", F.col("event_time").cast("timestamp"))
    writer = batch_folder_writer(f"{path}/rows")
    with stream_settings(spark):
        start(
            trailing_stream_features(stream), writer, f"{path}/checkpoint", available_now=True
        ).awaitTermination()
    rows = spark.read.parquet(f"{path}/rows")
    return settle(
        rows.drop("run_id", "batch_id", "event_time", "merchant_country", "card_present", "is_high_risk_merchant"),
        *HOUR_SUMS,
        "burst_amount",
        "zscore_amount",
    )


def stopped_and_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A stream is stopped after its second batch and resumed; its sink appends what it gets."""
    path = shared_dir(spark, "stopped")
    events = read_table(spark, sf, "events")
    events.repartitionByRange(6, "event_id").write.parquet(f"{path}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
    rows = valid_amounts(transactions_from_events(stream)).select("transaction_id", "user_id", "amount")

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").parquet(f"{path}/table")

    for last in (1, None):
        gate = BatchGate()
        query = start(rows, gate.guard(append), f"{path}/checkpoint", CONFIG, available_now=True)
        run_until(query, gate, lambda: last is not None and (gate.last or 0) >= last, poll_sec=0.05)
    sums = spark.read.parquet(f"{path}/table").groupBy("user_id")
    return settle(sums.agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount")), "total_amount")


QUERIES: dict[str, Query] = {
    "parse_valid": parse_valid,
    "parse_lenient": parse_lenient,
    "dead_letter": dead_letter,
    "delivery_counts": delivery_counts,
    "dead_letters_by_minute": dead_letters_by_minute,
    "encoded_messages": encoded_messages,
    "window_features": window_feature_rows,
    "zscore_flags": zscore_flag_rows,
    "rule_flags": rule_flag_rows,
    "fraud_score": score_rows,
    "non_overlapping_totals": non_overlapping_totals,
    "order_line_windows": order_line_windows,
    "order_line_trailing": order_line_trailing,
    "fraud_summary_1min": fraud_summary,
    "user_risk_profile": user_profile,
    "fraud_alerts": alert_rows,
    "dashboard_kpi": kpi_row,
    "fraud_feed": fraud_feed,
    "refreshed_feed": refreshed_feed,
    "refreshed_incremental": refreshed_incremental,
    "incremental_kpi": incremental_kpi_row,
    "incremental_summary": incremental_summary_rows,
    "sketched_kpi_error": sketched_kpi_error,
    "sketched_windows": sketched_windows,
    "stream_quartiles": stream_quartiles,
    "compacted_scores": compacted_scores,
    "replayed_sink": replayed_sink,
    "txn_time_features": time_features,
    "txn_zscore_rows": row_zscores,
    "txn_iqr_outlier": iqr_outliers,
    "txn_trailing_1h": trailing_hour,
    "txn_trailing_24h": trailing_day,
    "daily_countries": daily_countries,
    "behavioral_features": behavioral_features,
    "merchant_frequency": merchant_frequency,
    "rule_burst_amount": burst_amount,
    "rule_countries_24h": country_spread,
    "rule_cnp_high_risk": card_not_present,
    "geo_velocity": geo_velocity,
    "historical_zscore": historical_zscore,
    "merchant_fraud_rate": merchant_fraud_rate,
    "tier_distribution": tier_distribution,
    "alert_distribution": alert_distribution,
    "country_distribution": country_distribution,
    "fraud_rate_measure": fraud_rate_measure,
    "at_risk_usd": at_risk_usd,
    "avg_latency": avg_latency,
    "top_risky_users": top_risky_users,
    "tier_slicer": tier_slicer,
    "volume_against_flags": volume_against_flags,
    "fraud_trend": fraud_trend,
    "high_score_alerts": high_score_alerts,
    "kpi_cards": kpi_cards,
    "detection_metrics": detection_metrics,
    "score_quality": score_quality,
    "offset_lag": offset_lag,
    "query_cost_summary": query_cost_summary,
    "latency_histogram": latency_histogram,
    "threshold_alerts": threshold_alerts,
    "monitor_report": monitor_report,
    "stored_reports": stored_reports,
    "monitor_alerts": monitor_alerts,
    "scaler_fit": scaler_fit,
    "scaler_apply": scaler_apply,
    "forest_sample": forest_sample,
    "isolation_forest_scores": isolation_forest_scores,
    "forest_quality": forest_quality,
    "stopped_and_resumed": stopped_and_resumed,
    "synthetic_transactions": synthetic,
    "stream_window_features": stream_window_features,
    "stream_dead_letters": stream_dead_letters,
    "stream_txn_features": stream_transaction_features,
}
