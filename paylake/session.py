"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "paylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the layers rely on. Cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates are UTC dates in every layer, so a session handed in by a caller is pinned to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Bytes of rows that Spark hands to a Python worker at once, where the session does not say. Spark's own limit of 10,000 rows is
#: 25 MB of texts of 2 KB, held several times over by the executor and by each of its workers.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> SparkSession:
    """Rows go to Python workers in batches bounded by bytes, so a worker's memory does not follow the length of the texts. A limit
    that the session was given stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))
    return spark


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="paylake-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by the cluster (spark.checkpoint.dir).

    Only a local session that names none, as in tests, gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_scratch()
    return f"{base.rstrip('/')}/paylake/{purpose}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder and read back: later steps neither compute it again nor depend on the executors that
    made it, and its size is known when they are planned."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
