from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallywatch.sources import folders
from tallywatch.streaming.publishing import Ledger, Target, publish_batch, publishing_writer

COLUMNS = ["id", "text"]


def as_is(batch):
    return batch.select(*COLUMNS)


def batch(spark, first, count=20):
    return spark.range(first, first + count, numPartitions=3).withColumn("text", F.concat(F.lit("t"), "id"))


class Breaks(Target):
    """Fails after it wrote this share of the rows."""

    share = 1.0

    def append(self, rows):
        if self.share is not None:
            kept = rows.sort("id").limit(int(rows.count() * self.share))
            if self.share:
                super().append(kept)
        raise OSError("lost")


def ids(spark, target):
    return Counter(r.id for r in target.read(spark).collect())


@pytest.mark.parametrize("fmt, share", [("parquet", 0.4), ("parquet", 1.0), ("json", 0.4), ("json", None)])
def test_a_batch_that_fails_and_is_repeated_is_there_once(spark, tmp_path, fmt, share):
    options = {"path": f"{tmp_path}/table"}
    target, broken = Target(fmt, options), Breaks(fmt, options)
    object.__setattr__(broken, "share", share)
    publish_batch(batch(spark, 100), 0, "run", target, f"{tmp_path}/book", as_is)
    with pytest.raises(OSError):
        publish_batch(batch(spark, 0), 1, "run", broken, f"{tmp_path}/book", as_is)
    # the repeat computes other rows, as a clock or a shuffle can; what was staged is published
    publish_batch(batch(spark, 0).withColumn("text", F.lit("anew")), 1, "run", target, f"{tmp_path}/book", as_is)
    publish_batch(batch(spark, 0), 1, "run", target, f"{tmp_path}/book", as_is)
    assert ids(spark, target) == Counter([*range(20), *range(100, 120)])
    assert target.read(spark).where("text = 'anew'").isEmpty()
    assert not folders.exists(spark, f"{tmp_path}/book/staged/run/1")


def test_first_batch_fails_before_the_table_is_there(spark, tmp_path):
    options = {"path": f"{tmp_path}/table"}
    broken = Breaks("parquet", options)
    object.__setattr__(broken, "share", None)
    with pytest.raises(OSError):
        publish_batch(batch(spark, 0), 0, "run", broken, f"{tmp_path}/book", as_is)
    publish_batch(batch(spark, 0), 0, "run", Target("parquet", options), f"{tmp_path}/book", as_is)
    assert ids(spark, Target("parquet", options)) == Counter(range(20))


def test_equal_rows_and_equal_numbers_of_other_runs_stay_apart(spark, tmp_path):
    target = Target("parquet", {"path": f"{tmp_path}/table"})
    same = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "id long, text string")
    for run in ("one", "two"):
        publish_batch(same, 0, run, target, f"{tmp_path}/book", as_is)
    assert target.read(spark).count() == 6
    states = Ledger(spark, f"{tmp_path}/book/ledger").read().groupBy("run_id", "batch_id").agg(F.sort_array(F.collect_list("state")).alias("s"))
    assert {tuple(r) [:2] + tuple(r.s) for r in states.collect()} == {(run, 0, "begun", "done", "staged") for run in ("one", "two")}


def test_stream_repeats_a_batch_after_a_failure(spark, tmp_path):
    """A stream that fails between the sink and its own commit repeats the batch on restart."""
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    batch(spark, 0).coalesce(1).write.parquet(source)
    target = Target("parquet", {"path": f"{tmp_path}/table"})
    publish = publishing_writer(target, f"{tmp_path}/book", as_is)
    stream = spark.readStream.schema("id long, text string").parquet(source)

    def run(writer):
        query = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    def fails_after(rows, number):
        publish(rows, number)
        raise OSError("after the sink")

    with pytest.raises(Exception, match="after the sink"):
        run(fails_after)
    batch(spark, 50).coalesce(1).write.mode("append").parquet(source)
    run(publish)
    assert ids(spark, target) == Counter([*range(20), *range(50, 70)])
