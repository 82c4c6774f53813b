from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tallywatch.config import ViewConfig
from tallywatch.plans import incremental
from tallywatch.plans.incremental import counted_batches, drop_folded, due_views, fold, refresh_due, take_in
from tallywatch.plans.refresh import TARGET_LAG, build_views, drop_old_versions, last_refreshed, read_feed, read_view
from tallywatch.sources.snapshots import Snapshot, append_batch, compact, open_snapshot
from tests.score_rows import NOW, random_scores, rounded

NEVER_FRESH = {name: "0 seconds" for name in TARGET_LAG}
CONFIG = ViewConfig(profile_lookback="24 hours", alert_lookback="7 hours", kpi_lookback="1 hour")


def at(moment=NOW):
    return F.lit(moment).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def parts(spark):
    return random_scores(spark, 300, seed=5).cache().randomSplit([1.0] * 5, seed=2)


def refreshed(spark, root, moment=NOW, cfg=CONFIG):
    refresh_due(spark, f"{root}/scores", f"{root}/views", at(moment), cfg, NEVER_FRESH)
    return {name: rounded(read_view(spark, f"{root}/views", name)) for name in TARGET_LAG}


def recomputed(spark, root, moment=NOW, cfg=CONFIG):
    views = build_views(open_snapshot(spark, f"{root}/scores").rows(), at(moment), cfg)
    return {name: rounded(rows) for name, rows in views.items()}


def test_three_batches_equal_the_full_recompute(spark, tmp_path, parts):
    for number in range(3):
        append_batch(parts[number], f"{tmp_path}/scores", number)
        moment = NOW - timedelta(minutes=30 - 10 * number)
        assert refreshed(spark, tmp_path, moment) == recomputed(spark, tmp_path, moment)
    assert read_feed(spark, f"{tmp_path}/views").count() > 0


@pytest.mark.parametrize("lookback", ["17 minutes", "36 hours"])
def test_lookbacks_that_begin_inside_an_hour(spark, tmp_path, parts, lookback):
    cfg = ViewConfig(lookback, lookback, lookback)
    for number in range(2):
        append_batch(parts[number], f"{tmp_path}/scores", number)
    assert refreshed(spark, tmp_path, cfg=cfg) == recomputed(spark, tmp_path, cfg=cfg)


def test_only_new_batches_are_read(spark, tmp_path, parts, monkeypatch):
    asked = []
    rows = Snapshot.rows

    def recorded(self, of=None):
        if of is not None:
            asked.append({r.batch_id for r in of.select("batch_id").collect()})
        return rows(self, of)

    monkeypatch.setattr(Snapshot, "rows", recorded)
    for number in range(3):
        append_batch(parts[number], f"{tmp_path}/scores", number)
        snapshot = open_snapshot(spark, f"{tmp_path}/scores")
        assert take_in(snapshot, f"{tmp_path}/views") == 1
        assert take_in(snapshot, f"{tmp_path}/views") == 0
    assert asked == [{0}, {1}, {2}]
    # compaction moves rows, which makes no batch new
    compact(spark, f"{tmp_path}/scores", crowded=2)
    assert take_in(open_snapshot(spark, f"{tmp_path}/scores"), f"{tmp_path}/views") == 0


def test_a_batch_written_again_is_taken_in_anew(spark, tmp_path, parts):
    for number in range(3):
        append_batch(parts[number], f"{tmp_path}/scores", number)
        take_in(open_snapshot(spark, f"{tmp_path}/scores"), f"{tmp_path}/views")
    append_batch(parts[3], f"{tmp_path}/scores", 1)
    assert refreshed(spark, tmp_path) == recomputed(spark, tmp_path)
    # also out of a fold, whose other batches come in again
    assert fold(open_snapshot(spark, f"{tmp_path}/scores"), f"{tmp_path}/views", at=2)
    append_batch(parts[4], f"{tmp_path}/scores", 0)
    assert refreshed(spark, tmp_path) == recomputed(spark, tmp_path)


def test_folding_keeps_results_and_bounds_takes(spark, tmp_path, parts, monkeypatch):
    monkeypatch.setattr(incremental.fold, "__defaults__", (3,))
    for number in range(5):
        append_batch(parts[number], f"{tmp_path}/scores", number)
        snapshot = open_snapshot(spark, f"{tmp_path}/scores")
        take_in(snapshot, f"{tmp_path}/views")
        fold(snapshot, f"{tmp_path}/views")
    assert refreshed(spark, tmp_path) == recomputed(spark, tmp_path)
    snapshot = open_snapshot(spark, f"{tmp_path}/scores")
    assert counted_batches(snapshot, f"{tmp_path}/views").select("take").distinct().count() < 3
    assert drop_folded(snapshot, f"{tmp_path}/views") > 0
    assert refreshed(spark, tmp_path) == recomputed(spark, tmp_path)


def test_a_take_that_fails_before_its_entry_is_not_counted(spark, tmp_path, parts, monkeypatch):
    append_batch(parts[0], f"{tmp_path}/scores", 0)
    snapshot = open_snapshot(spark, f"{tmp_path}/scores")
    with monkeypatch.context() as patch:
        patch.setattr(incremental.time, "time_ns", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            take_in(snapshot, f"{tmp_path}/views")
    assert refreshed(spark, tmp_path) == recomputed(spark, tmp_path)


def test_only_views_older_than_their_lag_are_due(spark, tmp_path, parts):
    scores, views = f"{tmp_path}/scores", f"{tmp_path}/views"
    append_batch(parts[0], scores, 0)
    assert sorted(refresh_due(spark, scores, views, at(), CONFIG)) == sorted(TARGET_LAG)
    assert refresh_due(spark, scores, views, at(NOW + timedelta(seconds=29)), CONFIG) == []
    assert due_views(spark, views, at(NOW + timedelta(seconds=30))) == ["fraud_alerts"]
    assert sorted(due_views(spark, views, at(NOW + timedelta(seconds=60)))) == ["dashboard_kpi", "fraud_alerts", "fraud_summary_1min"]
    append_batch(parts[1], scores, 1)
    later = NOW + timedelta(seconds=60)
    assert "user_risk_profile" not in refresh_due(spark, scores, views, at(later), CONFIG)
    assert rounded(read_view(spark, views, "fraud_summary_1min")) == recomputed(spark, tmp_path, later)["fraud_summary_1min"]
    assert last_refreshed(spark, views)["user_risk_profile"] < last_refreshed(spark, views)["dashboard_kpi"]


def test_old_versions_go(spark, tmp_path, parts):
    append_batch(parts[0], f"{tmp_path}/scores", 0)
    for minutes in range(3):
        want = refreshed(spark, tmp_path, NOW + timedelta(minutes=minutes))
    assert drop_old_versions(spark, f"{tmp_path}/views", keep=2) == len(TARGET_LAG)
    assert {name: rounded(read_view(spark, f"{tmp_path}/views", name)) for name in TARGET_LAG} == want
    assert drop_old_versions(spark, f"{tmp_path}/views", keep=2) == 0


def test_nothing_stored_yet(spark, tmp_path):
    got = refreshed(spark, tmp_path)
    assert [len(got[name]) for name in ("fraud_summary_1min", "user_risk_profile", "fraud_alerts", "dashboard_kpi")] == [0, 0, 0, 1]


def test_a_time_found_by_a_query_is_looked_up_once(spark, tmp_path, parts, monkeypatch):
    append_batch(parts[0], f"{tmp_path}/scores", 0)
    stamps = []
    monkeypatch.setattr(incremental, "publish_views", lambda spark, views, path, stamp: stamps.append(stamp))
    found = spark.range(3).select(F.max(at()).alias("moment")).scalar()
    refresh_due(spark, f"{tmp_path}/scores", f"{tmp_path}/views", found, CONFIG, NEVER_FRESH)
    row = spark.range(1).select(stamps[0].alias("stamp"), at().alias("moment"))
    assert "scalar-subquery" not in row._jdf.queryExecution().analyzed().toString()
    assert row.first()[0] == row.first()[1] and row.schema[0].dataType == row.schema[1].dataType
