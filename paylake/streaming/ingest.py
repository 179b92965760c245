"""Message stream into Bronze: each micro-batch is classified, flattened, flagged and stored once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake import fixed_values as fv
from paylake.functions.scalars import event_key
from paylake.operators import bronze, messages
from paylake.schemas import CORRUPT, DETAIL, MESSAGE
from paylake.session import pin_utc, work_dir
from paylake.sources import id_index
from paylake.sources.files import placed, write_bronze
from paylake.sources.storage import delete

STREAM_ORDER = ["in_file", "in_block", "in_row"]


def read_messages(
    spark: SparkSession, path: str | None = None, files_per_trigger: int | None = None, source: str = "json",
    **options: str,
) -> DataFrame:
    """Streaming messages from JSON-lines files, or from Kafka (``source='kafka'`` and its options).

    The rate limits of the source are the backpressure; the backlog stays in the source.
    """
    pin_utc(spark)
    if source == "kafka":
        records = spark.readStream.format("kafka").options(**options).load()
        return parse_records(records).withColumn("received_at", F.current_timestamp())
    reader = spark.readStream.schema(f"{MESSAGE}, {CORRUPT} string").options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _keep_broken(reader.json(path).select(
        "*",
        F.col("_metadata.file_path").alias("in_file"),
        F.col("_metadata.file_block_start").alias("in_block"),
    )).withColumn("received_at", F.current_timestamp())  # one time per micro-batch, kept on replay


def parse_records(records: DataFrame) -> DataFrame:
    """Messages from ``value``, ``topic``, ``partition`` and ``offset`` of a log."""
    body = F.from_json(F.col("value").cast("string"), f"{MESSAGE}, {CORRUPT} string",
                       {"columnNameOfCorruptRecord": CORRUPT})
    return _keep_broken(records.select(
        body.alias("m"), F.concat_ws("-", "topic", "partition").alias("in_file"), F.col("offset").alias("in_block"),
    ).select("m.*", "in_file", "in_block"))


def _keep_broken(messages: DataFrame) -> DataFrame:
    """A line that is no JSON goes on as a message of unknown type with its whole text as data."""
    whole = F.col(CORRUPT).isNull()
    return messages.withColumns({
        "msg_type": F.when(whole, F.col("msg_type")),
        "detail": F.when(whole, F.col("detail")),
        "data": F.coalesce(CORRUPT, "data"),
    }).drop(CORRUPT)


def _stamp(df: DataFrame, source_file: str | Column, batch_id: str) -> DataFrame:
    """Ingestion columns from the micro-batch itself, so a replayed batch is stamped the same."""
    at = F.col("received_at")
    return df.withColumns({
        "ingestion_timestamp": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"),
        "source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
        "batch_id": F.lit(batch_id),
        "ingestion_date": F.date_format(at, "yyyy-MM-dd"),
    }).drop("received_at")


def bronze_roots(root: str) -> dict[str, str]:
    base = root.rstrip("/")
    return {"events": f"{base}/events", "messages": f"{base}/messages"}


def store_batch(batch: DataFrame, batch_id: str, root: str) -> None:
    """Store one micro-batch. Running it again replaces its own folders, so a replay adds nothing."""
    spark, roots = batch.sparkSession, bronze_roots(root)
    stage = work_dir(spark, "micro-batch")  # shared, so a lost executor does not send the batch back to its source
    messages.classify(batch.withColumn("in_row", F.monotonically_increasing_id())).write.parquet(stage)
    classified = spark.read.parquet(stage)
    events, others = _route_sizes(classified)
    if events:
        _store_events(classified, batch_id, roots["events"], spark)
    if others:
        _store_messages(classified, batch_id, roots["messages"])
    delete(spark, stage)


def _route_sizes(classified: DataFrame) -> tuple[int, int]:
    legacy = F.col("msg_route") == fv.LEGACY_ROUTE
    row = classified.agg(F.count_if(legacy).alias("events"), F.count_if(~legacy).alias("others")).first()
    return row.events, row.others


def _store_events(classified: DataFrame, batch_id: str, root: str, spark: SparkSession) -> None:
    raw = classified.filter(F.col("msg_route") == fv.LEGACY_ROUTE).select(
        "source", "detailType", F.from_json("detail", DETAIL).alias("detail"), "received_at", *STREAM_ORDER
    )
    flat = _stamp(bronze.flatten(raw, keep=("received_at", *STREAM_ORDER)), "bus_stream", batch_id)
    staged = work_dir(spark, "micro-batch-events")
    flat.write.parquet(staged)
    flat = spark.read.parquet(staged)
    id_index.begin(spark, root, batch_id)
    entries = id_index.lookup(spark, root, flat.select(event_key().alias("event_key")), without_batch=batch_id)
    flagged = bronze.flag_duplicates(flat, id_index.first_seen(entries), STREAM_ORDER)
    write_bronze(flagged.drop(*STREAM_ORDER), root)
    id_index.finish(spark, root, batch_id)
    delete(spark, staged)


QUARANTINE = "quarantine"


def quarantined(route: Column) -> Column:
    """The folder of a route. Types are free text: those that are not known share one folder, the type stays a column."""
    return F.when(route.isin(*fv.MESSAGE_TYPES), route).otherwise(QUARANTINE)


def _store_messages(classified: DataFrame, batch_id: str, root: str) -> None:
    """All other types in one write, a folder per known type and one for the rest."""
    others = classified.filter(F.col("msg_route") != fv.LEGACY_ROUTE)
    at = F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    valid = messages.validate(others, at)
    flat = messages.flatten_generic(valid, keep=("is_valid", "msg_route", "received_at"))
    stamped = _stamp(flat, F.concat(F.lit("bus_stream_"), F.col("msg_route")), batch_id)
    (
        placed(stamped).withColumn("in_route", quarantined(F.col("msg_route")))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("in_route", "in_day", "in_batch").parquet(root)
    )


def start(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "bronze",
    every: str | None = None,
    after_batch: Callable[[SparkSession], object] | None = None,
) -> StreamingQuery:
    """Run the stream into Bronze. ``every`` is a processing-time interval; None drains and stops."""
    bronze.checked_batch_id(name)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        store_batch(batch, f"{name}-{_stream_id(batch.sparkSession, checkpoint)}-{epoch:08d}", root)
        if after_batch:
            after_batch(batch.sparkSession)

    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Start of the id that belongs to the checkpoint: a new checkpoint never reuses old batch ids."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first().value
    return json.loads(text)["id"][:8]


def progress(query: StreamingQuery) -> dict[str, int]:
    """Batches and messages stored so far, from the query's own progress records."""
    recent = query.recentProgress
    return {
        "batches": sum(1 for p in recent if p["numInputRows"] > 0),
        "messages": sum(p["numInputRows"] for p in recent),
    }
