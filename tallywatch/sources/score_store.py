"""The stored score table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators.scoring import as_score_table
from tallywatch.schema import SCORE_SCHEMA

DATE_COLUMN = "processed_date"
RUN_COLUMN = "run_id"
BATCH_COLUMN = "batch_id"
NO_RUN = "stored"
SCORE_KEY = ("user_id", "window_start")

STORED_SCHEMA = T.StructType(
    [
        *SCORE_SCHEMA.fields,
        T.StructField(DATE_COLUMN, T.DateType()),
        T.StructField(RUN_COLUMN, T.StringType()),
        T.StructField(BATCH_COLUMN, T.LongType()),
    ]
)


def write_scores(scored: DataFrame, path: str, batch_id: int, run: str = NO_RUN) -> None:
    """Write one batch; writing the same batch of the same run again replaces it.

    A run is a stream with its checkpoint: its batch numbers start at 0, so
    without the run a second stream would replace the first one's batches.

    Files are laid out by processing date and batch, so recency filters read
    only recent dates. Rebalancing gathers a date's rows in few files and
    splits a date too large for one task.
    """
    (
        as_score_table(scored)
        .withColumn(DATE_COLUMN, F.to_date("processed_at"))
        .withColumn(RUN_COLUMN, F.lit(run))
        .withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
        .hint("rebalance", DATE_COLUMN)
        .write.partitionBy(DATE_COLUMN, RUN_COLUMN, BATCH_COLUMN)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path)
