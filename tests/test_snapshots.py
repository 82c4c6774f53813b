from __future__ import annotations

import os

import pytest

from tallywatch.sources import folders, snapshots
from tallywatch.sources.score_store import STORED_SCHEMA
from tallywatch.sources.snapshots import append_batch, compact, expire, open_snapshot
from tests.score_rows import random_scores, rounded


def files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(f"{path}/files") for name in names)


def content(spark, path):
    return rounded(open_snapshot(spark, path).rows().drop("processed_date", "run_id", "batch_id"))


@pytest.fixture(scope="module")
def parts(spark):
    rows = random_scores(spark, 300, seed=1).cache()
    return [rows.limit(0), *rows.randomSplit([1.0] * 11, seed=3)]


def all_rows(parts, *numbers):
    merged = parts[0]
    for i in numbers or range(len(parts)):
        merged = merged.unionByName(parts[i])
    return rounded(merged)


def test_batches_become_few_files_and_nothing_else_changes(spark, tmp_path, parts):
    path = str(tmp_path)
    for number, part in enumerate(parts):
        append_batch(part, path, number)
    before, many = content(spark, path), files(path)
    assert before == all_rows(parts) and many > 40
    reader = open_snapshot(spark, path).rows()
    assert compact(spark, path, crowded=2) == 5  # four days and the rows without one
    assert content(spark, path) == before
    # who opened the table before goes on
    assert rounded(reader.drop("processed_date", "run_id", "batch_id")) == before
    assert compact(spark, path, crowded=2) == 0
    assert expire(spark, path, keep_seconds=3600) == (0, 0)
    sets, logs = expire(spark, path, keep_seconds=0)
    assert sets == 11 and logs == 12
    assert files(path) <= 10 and content(spark, path) == before
    assert open_snapshot(spark, path).rows().schema == STORED_SCHEMA
    days = {r.processed_date for r in open_snapshot(spark, path).rows().select("processed_date", "batch_id").collect()}
    assert None in days and len(days) == 5


def test_a_batch_written_again_replaces_its_first_attempt(spark, tmp_path, parts):
    path = str(tmp_path)
    for number in (1, 2, 3):
        append_batch(parts[number], path, number)
    append_batch(parts[4], path, 2)
    assert content(spark, path) == all_rows(parts, 1, 3, 4)
    assert compact(spark, path, crowded=2) > 0
    # the attempt inside the compacted files no longer counts
    append_batch(parts[5], path, 3)
    assert content(spark, path) == all_rows(parts, 1, 4, 5)
    append_batch(parts[0], path, 1)
    assert content(spark, path) == all_rows(parts, 4, 5)
    compact(spark, path, crowded=2)
    compact(spark, path, crowded=2)
    expire(spark, path, keep_seconds=0)
    assert content(spark, path) == all_rows(parts, 4, 5)
    append_batch(parts[6], path, 1)
    assert content(spark, path) == all_rows(parts, 4, 5, 6)


def test_runs_are_kept_apart(spark, tmp_path, parts):
    append_batch(parts[1], str(tmp_path), 0, "one")
    append_batch(parts[2], str(tmp_path), 0, "two")
    assert content(spark, str(tmp_path)) == all_rows(parts, 1, 2)


def test_a_batch_that_fails_is_not_part_of_the_table(spark, tmp_path, parts, monkeypatch):
    path = str(tmp_path)
    append_batch(parts[1], path, 1)

    def fails(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_enter", fails)
        with pytest.raises(OSError):
            append_batch(parts[2], path, 2)
        with pytest.raises(OSError):
            compact(spark, path, crowded=1)
    assert content(spark, path) == all_rows(parts, 1)
    append_batch(parts[2], path, 2)
    assert content(spark, path) == all_rows(parts, 1, 2)


def test_batches_that_arrive_during_compaction_stay(spark, tmp_path, parts, monkeypatch):
    path = str(tmp_path)
    for number in (1, 2):
        append_batch(parts[number], path, number)
    write = snapshots._write_set

    def arrives(rows, where):
        name = write(rows, where)
        monkeypatch.setattr(snapshots, "_write_set", write)
        append_batch(parts[3], path, 3)
        append_batch(parts[4], path, 2)
        return name

    monkeypatch.setattr(snapshots, "_write_set", arrives)
    compact(spark, path, crowded=2)
    assert content(spark, path) == all_rows(parts, 1, 3, 4)


def test_days_that_were_not_moved_stay_alone(spark, tmp_path, parts):
    path = str(tmp_path)
    append_batch(parts[1].where("processed_at IS NULL OR processed_at >= '2024-03-09'"), path, 1)
    append_batch(parts[2].where("processed_at >= '2024-03-09'"), path, 2)
    append_batch(parts[3].where("processed_at >= '2024-03-10'"), path, 3)
    before = content(spark, path)
    for crowded in (3, 2, 1):
        assert compact(spark, path, crowded) > 0
        assert content(spark, path) == before


def test_empty_store_and_folders(spark, tmp_path):
    assert open_snapshot(spark, f"{tmp_path}/none").rows().isEmpty()
    assert not folders.exists(spark, f"{tmp_path}/none")
    folders.remove(spark, [f"{tmp_path}/none"])
