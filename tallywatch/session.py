"""Session settings and durable intermediate storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app: str = "tallywatch",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators expect.

    Event times are compared as UTC, so the session time zone is UTC. AQE
    coalesces small shuffle partitions and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query keeps from its first start on.

    The number of state partitions is fixed in the checkpoint; it defaults to
    the cores at hand, not to the number that suits stored data.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder;
    on a cluster such a folder would be invisible to the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallywatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def save_and_reload(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage of a result that several later steps read; the files
    outlive lost executors.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
