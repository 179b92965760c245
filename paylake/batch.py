"""The batch run: raw JSON to Bronze, Bronze to Silver, Silver to Gold."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from paylake.config import Settings
from paylake.functions.scalars import event_key
from paylake.operators import bronze
from paylake.session import pin_utc, work_dir
from paylake.sources import files, id_index
from paylake.sources.storage import delete, has_files
from paylake.streaming import refresh


def ingest(
    spark: SparkSession, raw_path: str, bronze_root: str, multi_line: bool = True, batch_id: str | None = None,
    ingested_at: dt.datetime | None = None, log_path: str | None = None,
) -> str:
    """Add one batch of raw events to Bronze, flagged against what is stored. Returns the batch id.

    The flat batch is written to the shared folder first: JSON is parsed once, the id passes of the
    duplicate test read one column, and the batch has a known size. Large inputs should be JSON
    lines (``multi_line=False``), which can be split; one array is one task.
    """
    pin_utc(spark)
    batch_id = batch_id or uuid.uuid4().hex[:8]
    stage = work_dir(spark, "ingest")
    bronze.flatten(files.read_raw(spark, raw_path, multi_line), keep=tuple(files.RAW_ORDER)).write.parquet(stage)
    staged = spark.read.parquet(stage)
    id_index.begin(spark, bronze_root, batch_id)
    entries = id_index.lookup(spark, bronze_root, staged.select(event_key().alias("event_key")), without_batch=batch_id)
    stamped = bronze.add_metadata(staged, raw_path, batch_id, ingested_at)
    flagged = bronze.flag_duplicates(stamped, id_index.first_seen(entries), files.RAW_ORDER).drop(*files.RAW_ORDER)
    files.write_bronze(flagged, bronze_root)
    id_index.finish(spark, bronze_root, batch_id)
    if log_path and has_files(spark, bronze_root):
        files.write_duplicate_log(files.read_bronze(spark, bronze_root, [batch_id]), log_path, batch_id)
    delete(spark, stage)
    return batch_id


def run(
    spark: SparkSession, root: str, settings: Settings, raw_path: str | None = None, ip_geo: DataFrame | None = None,
    from_silver: bool = False, multi_line: bool = True,
) -> dict[str, DataFrame]:
    """All layers below ``root``; ``from_silver`` leaves Bronze as it is. Returns the published Gold tables."""
    base = root.rstrip("/")
    if raw_path and not from_silver:
        ingest(spark, raw_path, f"{base}/bronze/events", multi_line, log_path=f"{base}/logs/duplicates")
    refresh.rebuild(spark, f"{base}/bronze/events", f"{base}/silver/events", f"{base}/gold", settings, ip_geo)
    gold = refresh.read_published_gold(spark, f"{base}/gold")
    files.register_gold(gold)
    return gold
