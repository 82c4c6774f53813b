from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.functions.times import is_night, is_weekend, weekday_from_monday
from tallywatch.operators import measures
from tallywatch.plans import views
from tallywatch.plans.refresh import current_version, read_feed, read_view, refresh_views
from tallywatch.schema import SCORE_SCHEMA
from tallywatch.sources.score_store import read_scores, write_scores

NOW = datetime(2024, 3, 10, 12, 0)


def score(user="u", minutes_ago=1, points=0.0, suspected=False, amount=10.0, **flags):
    start = NOW - timedelta(hours=1, minutes=minutes_ago)
    return {
        "user_id": user,
        "window_start": start,
        "window_end": start + timedelta(hours=1),
        "txn_count_1h": 2,
        "total_amount_1h": amount,
        "avg_amount_1h": amount / 2,
        "stddev_amount_1h": None,
        "max_amount_1h": amount,
        "country_count_1h": 1,
        "zscore_amount": 0.0,
        "zscore_fraud_flag": flags.get("z", False),
        "rule_high_velocity": flags.get("velocity", False),
        "rule_country_velocity": flags.get("country", False),
        "rule_large_amount": flags.get("large", False),
        "is_fraud_suspected": suspected,
        "fraud_score": points,
        "processed_at": NOW - timedelta(minutes=minutes_ago),
    }


def table(spark, *rows):
    return spark.createDataFrame([tuple(r[f.name] for f in SCORE_SCHEMA.fields) for r in rows], SCORE_SCHEMA)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@pytest.mark.parametrize("hour, night", [(5, 1), (6, 0), (21, 0), (22, 1), (0, 1)])
def test_night(spark, hour, night):
    frame = spark.range(1).select(F.lit(datetime(2024, 1, 1, hour)).alias("t"))
    assert frame.select(is_night(F.col("t"))).first()[0] == night


def test_weekdays(spark):
    days = [datetime(2024, 1, d) for d in (5, 6, 7, 8)]
    frame = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    got = [tuple(r) for r in frame.select(weekday_from_monday(F.col("t")), is_weekend(F.col("t"))).collect()]
    assert got == [(4, 0), (5, 1), (6, 1), (0, 0)]


def test_kpi_of_nothing_is_one_row(spark):
    row = views.dashboard_kpi(table(spark), now()).first()
    assert row["active_users_1h"] == 0 and row["critical_users"] == 0
    assert row["total_transactions_1h"] is None and row["fraud_alerts_1h"] is None
    assert row["at_risk_usd_1h"] is None and row["avg_detection_latency_ms"] is None


def test_kpi(spark):
    rows = table(
        spark,
        score("a", 1, 0.8, True, 100.0),
        score("a", 2, 1.0, True, 50.0),
        score("b", 60, 0.0),
        score("c", 61, 1.0, True),
    )
    row = views.dashboard_kpi(rows, now()).first()
    assert (row["active_users_1h"], row["critical_users"], row["fraud_alerts_1h"]) == (2, 1, 2)
    assert row["at_risk_usd_1h"] == 150.0
    assert row["avg_detection_latency_ms"] == 3_600_000


def test_alerts_keep_five_minutes(spark):
    rows = table(spark, score("a", 5, 0.4, True, z=True), score("b", 6, 0.4, True, z=True), score("c", 1, 0.0))
    got = views.fraud_alerts(rows, now(), ordered=True).collect()
    assert [(r["user_id"], r["alert_type"]) for r in got] == [("a", "STATISTICAL_ANOMALY")]


def test_feed_keeps_unmatched_alerts(spark):
    rows = table(spark, score("a", 1, 0.8, True), score("b", 1, 0.4, True))
    alerts = views.fraud_alerts(rows, now())
    profile = views.user_risk_profile(rows.filter("user_id = 'a'"), now())
    got = {r["user_id"]: r["risk_tier"] for r in views.fraud_feed(alerts, profile).collect()}
    assert got == {"a": "CRITICAL", "b": None}


def test_summary_rate(spark):
    rows = table(spark, score("a", 1, 0.5, True), score("b", 1), score("c", 1))
    row = views.fraud_summary_by_minute(rows).first()
    assert (row["total_users_flagged"], row["fraud_count"], row["fraud_rate_pct"]) == (3, 1, 33.33)


def test_rate_measure_without_scores(spark):
    empty = table(spark)
    assert measures.fraud_rate_measure(views.fraud_alerts(empty, now()), empty).first()[0] == 0.0


def test_rate_measure_is_strict(spark):
    rows = table(spark, score("a", 1, 0.5, True), score("b", 1, 0.55, True), score("c", 1), score("d", 1))
    assert measures.fraud_rate_measure(views.fraud_alerts(rows, now()), rows).first()[0] == 25.0


def test_top_users_break_ties_by_name(spark):
    rows = table(spark, score("b", 1, 0.5), score("a", 1, 0.5), score("c", 1, 0.9), score("d", 1, 0.1))
    top = measures.top_risky_users(views.user_risk_profile(rows, now()), 3).collect()
    assert [(r["user_id"], r["risk_rank"]) for r in top] == [("c", 1), ("a", 2), ("b", 3)]


def test_detection_metrics(spark):
    pairs = [(True, True)] * 3 + [(True, False)] + [(False, True)] * 2 + [(False, False)] * 4
    row = measures.detection_metrics(spark.createDataFrame(pairs, "p boolean, a boolean"), F.col("p"), F.col("a")).first()
    assert (row["precision"], row["recall"], row["false_positive_rate"]) == (0.75, 0.6, 0.2)
    none = spark.createDataFrame([(False, False)], "p boolean, a boolean")
    row = measures.detection_metrics(none, F.col("p"), F.col("a")).first()
    assert row["precision"] is None and row["recall"] is None


def test_store_replaces_a_batch_and_prunes_dates(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_scores(table(spark, score("a", 1), score("b", 60 * 48)), path, 1)
    write_scores(table(spark, score("a", 1), score("b", 60 * 48)), path, 1)
    write_scores(table(spark, score("c", 1)), path, 2)
    stored = read_scores(spark, path)
    assert sorted(r["user_id"] for r in stored.collect()) == ["a", "b", "c"]
    recent = views.recent_scores(stored, now(), "24 hours")
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processed_date" in plan


def test_refresh_publishes_whole_versions(spark, tmp_path):
    scores_path, views_path = str(tmp_path / "scores"), str(tmp_path / "views")
    write_scores(table(spark, score("a", 1, 0.8, True)), scores_path, 1)
    first = refresh_views(spark, scores_path, views_path, now())
    assert current_version(spark, views_path, "fraud_alerts") == first
    assert read_view(spark, views_path, "fraud_alerts").count() == 1
    write_scores(table(spark, score("b", 1, 0.4, True)), scores_path, 2)
    second = refresh_views(spark, scores_path, views_path, now(), only=["fraud_alerts"])
    assert current_version(spark, views_path, "fraud_alerts") == second
    assert current_version(spark, views_path, "user_risk_profile") == first
    feed = {r["user_id"]: r["risk_tier"] for r in read_feed(spark, views_path).collect()}
    assert feed == {"a": "CRITICAL", "b": None}
    # a refresh as of an earlier time that ends later does not replace a newer one
    refresh_views(spark, scores_path, views_path, now() - F.expr("INTERVAL 1 HOUR"), only=["fraud_alerts"])
    assert current_version(spark, views_path, "fraud_alerts") == second
