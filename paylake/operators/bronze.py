"""Bronze steps: flatten nested events, stamp the batch, flag duplicates without dropping any."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import event_key, rows
from paylake.operators.skew import lookup
from paylake.schemas import FLAT_PATHS
from paylake.session import staged

FIRST_SEEN_COLUMNS = ("batch_id", "ingestion_timestamp", "source_file", "bronze_file")


def flatten(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested events to 36 flat columns; an absent part reads as null. ``keep`` carries row-order columns."""
    paths = [F.col(f"detail.{path}").alias(name) for name, path in FLAT_PATHS.items()]
    return raw.select("source", "detailType", *paths, *keep)


def add_metadata(
    events: DataFrame,
    source_file: str,
    batch_id: str | None = None,
    ingested_at: dt.datetime | None = None,
) -> DataFrame:
    """Batch id, time, date and source. Drawn once on the driver, so every row of a batch agrees."""
    at = ingested_at or dt.datetime.now(dt.timezone.utc)
    return events.withColumns({
        "ingestion_timestamp": F.lit(at.isoformat()),
        "source_file": F.lit(source_file),
        "batch_id": F.lit(checked_batch_id(batch_id or uuid.uuid4().hex[:8])),
        "ingestion_date": F.lit(at.strftime("%Y-%m-%d")),
    })


def checked_batch_id(batch_id: str) -> str:
    """Batch ids name folders, so they are plain: letters, digits, dot, dash, underscore."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"not a plain batch id: {batch_id!r}")
    return batch_id


def normalized_ids(events: DataFrame) -> DataFrame:
    return events.select("event_id", event_key().alias("event_key"))


def first_seen(history: DataFrame, order_by: list[str], batch: DataFrame | None = None) -> DataFrame:
    """First known appearance of every event id in Bronze.

    ``batch``, when given, keeps only its ids. Where they are few enough the optimizer broadcasts them, and
    history rows of other ids are dropped inside the scan stage and never shuffled.
    """
    keyed = history.withColumn("event_key", event_key()).filter(F.col("event_key").isNotNull())
    if batch is not None:
        ids = batch.select(event_key().alias("event_key")).distinct()
        keyed = keyed.join(ids, "event_key", "left_semi")
    seen = F.struct(*FIRST_SEEN_COLUMNS)
    return keyed.groupBy("event_key").agg(F.min_by(seen, F.struct(*order_by)).alias("_f")).select("event_key", "_f.*")


def flag_duplicates(batch: DataFrame, known: DataFrame | None, order_by: list[str], **skew) -> DataFrame:
    """Flag missing, repeated and already stored ids; every row stays.

    ``order_by`` orders the batch and must be unique in it. Copies are counted per id before any
    row moves; only ids that are repeated or known are written to the shared folder and looked up there: few, they are
    broadcast and no row moves; many, hot ids are salted.
    """
    if "event_id" not in batch.columns:
        raise ValueError("cannot flag duplicates: no event_id column")
    keyed = batch.withColumns({"_id": event_key(), "_at": F.struct(*order_by)})
    audit = (
        keyed.filter(F.col("_id").isNotNull()).groupBy("_id")
        .agg(rows().alias("_n"), F.min("_at").alias("_first_at"))
    )
    if known is None:
        none = F.lit(None).cast("string")
        audit = audit.withColumns({"_seen": F.lit(False), "_batch": none, "_file": none})
    else:
        stored = known.select(
            F.col("event_key").alias("_id"), F.lit(True).alias("_seen"),
            F.col("batch_id").alias("_batch"), F.col("bronze_file").alias("_file"),
        )
        audit = audit.join(stored, "_id", "left").withColumn("_seen", F.coalesce("_seen", F.lit(False)))
    audit = staged(audit.filter(F.col("_seen") | (F.col("_n") > 1)), "bronze-audit")
    found = lookup(keyed, audit, "_id", salt_on=order_by, weight="_n", written=True, **skew)
    reason = (
        F.when(F.col("_seen"), fv.SEEN_IN_BRONZE)
        .when(F.col("_first_at") != F.col("_at"), fv.REPEATED_IN_BATCH)
        .when(F.col("_id").isNull(), fv.MISSING_EVENT_ID)
    )
    return _audited(found, reason, F.col("_batch"), F.col("_file")).drop(
        "_id", "_at", "_n", "_first_at", "_seen", "_batch", "_file"
    )


def _audited(df: DataFrame, reason: Column, batch: Column, file: Column) -> DataFrame:
    return df.withColumns({
        "duplicate_reason": reason,
        "duplicate_first_seen_batch_id": batch,
        "duplicate_first_seen_file": file,
    }).withColumn("is_duplicate", F.col("duplicate_reason").isNotNull())


def repair_flags(bronze: DataFrame, order_by: list[str], file: str = "bronze_file", **skew) -> DataFrame:
    """Recompute the flags over all of Bronze: earliest ingestion first, then ``order_by`` (unique)."""
    if "event_id" not in bronze.columns:
        raise ValueError("cannot repair Bronze: no event_id column")
    at = F.col("ingestion_timestamp").try_cast("timestamp")
    keyed = bronze.withColumns({"_id": event_key(), "_at": F.struct(at.isNull(), at, *order_by)})
    first = F.struct(F.col("batch_id").alias("batch"), F.col(file).alias("file"))
    audit = (
        keyed.filter(F.col("_id").isNotNull()).groupBy("_id")
        .agg(rows().alias("_n"), F.min("_at").alias("_first_at"), F.min_by(first, "_at").alias("_first"))
        .filter(F.col("_n") > 1)
    )
    found = lookup(keyed, staged(audit, "bronze-audit"), "_id", salt_on=order_by, weight="_n", written=True, **skew)
    later = F.coalesce(F.col("_first_at") != F.col("_at"), F.lit(False))
    same_batch = F.col("batch_id").eqNullSafe(F.col("_first.batch"))
    reason = (
        F.when(F.col("_id").isNull(), fv.MISSING_EVENT_ID)
        .when(later & same_batch, fv.REPEATED_IN_BATCH)
        .when(later, fv.SEEN_IN_BRONZE)
    )
    return _audited(
        found, reason, F.when(later, F.col("_first.batch")), F.when(later, F.col("_first.file"))
    ).drop("_id", "_at", "_n", "_first_at", "_first")


def repair_summary(repaired: DataFrame, file: str = "bronze_file", dry_run: bool = True) -> DataFrame:
    return repaired.agg(
        F.countDistinct(file).alias("files"),
        rows().alias("rows"),
        F.countDistinct(event_key()).alias("distinct_event_ids"),
        F.count_if("is_duplicate").alias("flagged"),
        F.lit(dry_run).alias("dry_run"),
    )


def duplicate_log(flagged: DataFrame) -> DataFrame:
    """Flagged rows with the log columns that exist."""
    present = [c for c in fv.DUPLICATE_LOG_COLUMNS if c in flagged.columns]
    return flagged.filter("is_duplicate").select(*present)
