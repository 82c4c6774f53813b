"""Quartile bounds per user on a stream, from mergeable quantile sketches.

Each batch adds one sketch per user that it holds, in a part of its own; from
time to time parts are merged into a base. The bounds of a batch's rows come
from the base before it and the parts since, the batch's own included, so a
user's state is a sketch of bounded size and never the user's rows. Parts and
bases are named by run and batch: a batch that is repeated writes the same part
again and reads the same others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.sketches import merged_quantiles, quantile_sketch, sketched_quantile
from tallywatch.sources import folders
from tallywatch.streaming.sinks import BatchWriter, run_of

BASE_EVERY = 16
REACH = 1.5


def _part(path: str, run: str, batch_id: int) -> str:
    return f"{path}/{run}/part={batch_id}"


def _base(path: str, run: str, batch_id: int) -> str:
    return f"{path}/{run}/base={batch_id}"


def sketches_upto(spark: SparkSession, path: str, run: str, batch_id: int, every: int = BASE_EVERY) -> DataFrame:
    """``user_id`` and ``sketch`` of all rows up to and including a batch, one row a user."""
    last = (batch_id // every) * every - 1
    names = [_base(path, run, last)] if last >= 0 else []
    names += [_part(path, run, number) for number in range(last + 1, batch_id + 1)]
    parts = spark.read.schema("user_id string, sketch binary").parquet(*names)
    return parts.groupBy("user_id").agg(merged_quantiles(F.col("sketch")).alias("sketch"))


def quartile_bounds(sketches: DataFrame, reach: float = REACH) -> DataFrame:
    """``user_id``, ``q1``, ``q3`` and the bounds beyond which an amount is an outlier."""
    quartiles = sketches.select(
        "user_id", sketched_quantile(F.col("sketch"), 0.25).alias("q1"), sketched_quantile(F.col("sketch"), 0.75).alias("q3")
    )
    margin = reach * (F.col("q3") - F.col("q1"))
    return quartiles.select("user_id", "q1", "q3", (F.col("q1") - margin).alias("low"), (F.col("q3") + margin).alias("high"))


def add_batch(batch: DataFrame, batch_id: int, run: str, path: str, every: int = BASE_EVERY) -> DataFrame:
    """Store the sketches of a batch; returns its rows with ``iqr_outlier``.

    Rows without user have no past and no flag; a null amount is no outlier.
    """
    spark = batch.sparkSession
    known = batch.where("user_id IS NOT NULL")
    sketches = known.groupBy("user_id").agg(quantile_sketch(F.col("amount").cast("double")).alias("sketch"))
    sketches.write.mode("overwrite").parquet(_part(path, run, batch_id))
    upto = sketches_upto(spark, path, run, batch_id, every)
    if (batch_id + 1) % every == 0:
        upto.write.mode("overwrite").parquet(_base(path, run, batch_id))
        upto = spark.read.parquet(_base(path, run, batch_id))
    own = upto.join(known.select("user_id").distinct(), "user_id", "left_semi")
    bounds = quartile_bounds(own).select("user_id", "low", "high")
    outside = (F.col("amount") < F.col("low")) | (F.col("amount") > F.col("high"))
    flag = F.when(F.col("user_id").isNotNull(), F.coalesce(outside, F.lit(False)))
    return batch.join(bounds, "user_id", "left").withColumn("iqr_outlier", flag).drop("low", "high")


def drop_merged(spark: SparkSession, path: str, run: str, batch_id: int, every: int = BASE_EVERY) -> None:
    """Remove parts and bases that no batch from ``batch_id`` on reads any more."""
    last = (batch_id // every) * every - 1
    old = [_part(path, run, number) for number in range(max(0, last - every + 1), last + 1)]
    folders.remove(spark, old + ([_base(path, run, last - every)] if last - every >= 0 else []))


def quartile_writer(writer: BatchWriter, path: str, every: int = BASE_EVERY) -> BatchWriter:
    """Adds ``iqr_outlier`` to each batch of a stream, then hands it to ``writer``.

    When a batch is written, parts that only earlier batches needed go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        batch = batch.persist()
        try:
            writer(add_batch(batch, batch_id, run, path, every), batch_id)
        finally:
            batch.unpersist()
        if batch_id % every == 0:
            drop_merged(batch.sparkSession, path, run, batch_id, every)

    return write
