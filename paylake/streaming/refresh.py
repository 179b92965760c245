"""Silver and Gold after new Bronze batches: a full rebuild, or only what the batch touched."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake.config import Settings
from paylake.functions.scalars import event_key
from paylake.operators import gold
from paylake.operators.silver import build_silver
from paylake.operators.skew import drop_matching, keep_matching, lookup
from paylake.session import pin_utc
from paylake.sources import dated, files, id_index, snapshots
from paylake.sources.storage import delete, exists
from paylake.streaming import partials

STORED_ORDER = files.BRONZE_ORDER
GOLD_DONE = "gold_done"
# Spreads rows that share a missing or hot key; any columns that differ between such rows do.
_SPREAD = ["timestamp", "event_id", "user_id"]


def build_gold(silver: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    return {
        "gold_user_360": gold.user_360(silver, settings),
        "gold_daily_metrics": gold.daily_metrics(silver),
        "gold_event_summary": gold.event_summary(silver),
    }


def rebuild(
    spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str, settings: Settings,
    ip_geo: DataFrame | None = None,
) -> list[str]:
    """All of Silver and Gold from all of Bronze, published as new versions. Returns the batches taken in.

    Silver is written once and read back for the three Gold builds: the written table cuts the
    lineage, so a lost executor never sends Gold back to raw Bronze.
    """
    id_index.ensure(pin_utc(spark), bronze_root)
    batches = id_index.batches(spark, bronze_root)  # listed before Bronze is read: none is missed later
    stored = files.read_bronze(spark, bronze_root, sorted(row.batch_id for row in batches.collect()))
    silver = build_silver(stored, settings, STORED_ORDER, ip_geo).drop(*STORED_ORDER)
    number = dated.publish(silver, silver_root, batches)
    _publish_all_gold(spark, silver_root, number, gold_root, settings)
    return sorted(row.batch_id for row in batches.collect())


def _publish_all_gold(spark: SparkSession, silver_root: str, number: int, gold_root: str, settings: Settings) -> None:
    silver = dated.read(spark, silver_root)
    publish_gold(silver, gold_root, settings)
    partials.rebuild(silver, partials_root(gold_root), number, settings)
    dated.mark(spark, silver_root, number, GOLD_DONE)


def partials_root(gold_root: str) -> str:
    return f"{gold_root.rstrip('/')}/_partials"


def publish_gold(silver: DataFrame, gold_root: str, settings: Settings) -> dict[str, str]:
    paths = files.gold_paths(gold_root)
    for name, table in build_gold(silver, settings).items():
        snapshots.publish(table, paths[name])
    return paths


def read_published_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    return {name: snapshots.read_latest(spark, path) for name, path in files.gold_paths(gold_root).items()}


def _event_keys(events: DataFrame) -> DataFrame:
    return events.select(event_key().alias("_id")).filter(F.col("_id").isNotNull()).distinct()


def touched_keys(old_rows: DataFrame, new_rows: DataFrame, key: str) -> DataFrame:
    """Keys of the rows that went away or came in, once each."""
    both = old_rows.select(key).unionByName(new_rows.select(key))
    return both.filter(F.col(key).isNotNull()).distinct()


def merge_users(old: DataFrame, fresh: DataFrame, touched: DataFrame, settings: Settings) -> DataFrame:
    """Touched users as they are now; for the others only recency moves, from their last transaction."""
    kept = gold.failure_and_recency(old.join(touched, "user_id", "left_anti"), settings)
    return kept.unionByName(fresh.select(*kept.columns))


def touched_days(*parts: DataFrame) -> list[dt.date | None]:
    """Distinct dates, as a list that prunes folders; days of the calendar, however many rows there are."""
    days = reduce(DataFrame.unionByName, [p.select("date") for p in parts]).distinct()
    return [row.date for row in days.collect()]


def refresh_published(
    spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str, settings: Settings,
    ip_geo: DataFrame | None = None,
) -> list[str]:
    """Bring published Silver and Gold up to date with the Bronze batches not yet in them.

    A batch that is being written is left for the next refresh, so a refresh may run beside ingest. What changes is first written beside Silver: the new events, the rows they replace, and the
    other rows of the touched dates. Only then are those dates published, with the batches taken in, and Gold
    after them. A run that stopped is finished, or begun again if it had published nothing, by the next.
    Returns the batches taken in. The first run, and one on a lake that a batch run made, share one layout.
    """
    pin_utc(spark)
    staging = f"{silver_root.rstrip('/')}_staging"
    newest = dated.latest(spark, silver_root)
    if newest is None:
        return rebuild(spark, bronze_root, silver_root, gold_root, settings, ip_geo)
    if exists(spark, f"{staging}/kept/_SUCCESS"):
        _apply(spark, staging, silver_root, gold_root, settings)
    else:
        if exists(spark, staging):
            delete(spark, staging)
        if not dated.is_marked(spark, silver_root, newest, GOLD_DONE):
            _publish_all_gold(spark, silver_root, newest, gold_root, settings)
    id_index.ensure(spark, bronze_root)
    pending = id_index.batches(spark, bronze_root).join(dated.applied(spark, silver_root), "batch_id", "left_anti")
    batch_ids = sorted(row.batch_id for row in pending.collect())  # batches since the last refresh
    if batch_ids:
        _stage(spark, bronze_root, batch_ids, silver_root, staging, settings, ip_geo)
        _apply(spark, staging, silver_root, gold_root, settings)
    return batch_ids


def _apply(spark: SparkSession, stage: str, silver_root: str, gold_root: str, settings: Settings) -> None:
    """Publish the touched dates, then Gold; doing it twice changes nothing more.

    Gold follows from the rows that went and came, through the partial tables: neither Silver nor Bronze is read.
    """
    new, contested, replaced, kept, batches, target = (
        spark.read.parquet(f"{stage}/{t}") for t in ("new", "contested", "replaced", "kept", "batches", "target")
    )
    rebuilt = new.filter(~F.col("_held")).drop("_held").unionByName(contested)
    number, root, days = target.first().number, partials_root(gold_root), touched_days(replaced, rebuilt)
    if dated.latest(spark, silver_root) < number:
        dated.publish(kept.unionByName(rebuilt), silver_root, batches, days, number=number)
    rows = partials.signed(replaced, rebuilt)
    silver = dated.read(spark, silver_root)
    if partials.follows(spark, root, number):
        partials.apply(spark, root, rows, silver, number, settings)
    else:
        partials.rebuild(silver, root, number, settings)
    old, paths = read_published_gold(spark, gold_root), files.gold_paths(gold_root)
    touched_keys(replaced, rebuilt, "user_id").write.mode("overwrite").parquet(f"{stage}/users")
    users = spark.read.parquet(f"{stage}/users")
    fresh = partials.user_360(spark, root, settings, users)
    snapshots.publish(merge_users(old["gold_user_360"], fresh, users, settings), paths["gold_user_360"])
    days = [d for d in days if d]
    snapshots.publish(partials.daily_metrics(spark, root, old["gold_daily_metrics"], days), paths["gold_daily_metrics"])
    snapshots.publish(partials.event_summary(spark, root), paths["gold_event_summary"])
    dated.mark(spark, silver_root, number, GOLD_DONE)
    delete(spark, stage)


def _stage(
    spark: SparkSession, bronze_root: str, batch_ids: list[str], silver_root: str, stage: str, settings: Settings,
    ip_geo: DataFrame | None,
) -> None:
    """What new batches change in Silver. Reads them, the index entries of their ids, and the dates these name:
    neither the ids of Silver nor those of Bronze. A narrow pass finds the ids that Silver holds already (``held``); whole rows
    are only compared with those, and new rows of other ids stay as they are. Staged tables have a known size, so ids are
    broadcast exactly when they are few.
    """
    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{stage}/{name}")
        return spark.read.parquet(f"{stage}/{name}")

    write(spark.createDataFrame([(b,) for b in batch_ids], "batch_id string"), "batches")
    write(spark.createDataFrame([(dated.latest(spark, silver_root) + 1,)], "number long"), "target")
    batch = files.read_bronze(spark, bronze_root, batch_ids)
    ids = write(_event_keys(batch), "ids")
    entries = write(id_index.lookup(spark, bronze_root, ids.withColumnRenamed("_id", "event_key")), "entries")
    dated_rows = batch.filter(event_key().isNull()).select(F.to_date(F.col("timestamp").try_cast("timestamp")).alias("date"))
    days = touched_days(entries.select(F.explode("dates").alias("date")), dated_rows)
    built = build_silver(batch, settings, STORED_ORDER, ip_geo).drop(*STORED_ORDER)
    old = dated.read(spark, silver_root, only=days, schema=built.schema).withColumn("_id", event_key())
    held = write(old.select("_id").join(ids, "_id", "left_semi").distinct(), "held")
    # Rows without an id are known by their batch alone: a refresh that runs again replaces them.
    again = F.col("_id").isNull() & F.coalesce(F.col("batch_id").isin(batch_ids), F.lit(False))
    matched = keep_matching(old.filter(F.col("_id").isNotNull()), held, "_id", _SPREAD)
    replaced = write(matched.unionByName(old.filter(again)).drop("_id"), "replaced")
    once = held.withColumns({"_held": F.lit(True), "_n": F.lit(1)})   # a batch's Silver has an id once
    marked = lookup(built.withColumn("_id", event_key()), once, "_id", _SPREAD, weight="_n", written=True)
    new = write(marked.withColumn("_held", F.coalesce("_held", F.lit(False))).drop("_id", "_n"), "new")
    copies = entries.join(held.withColumnRenamed("_id", "event_key"), "event_key", "left_semi")
    write(_rebuilt(new.filter("_held").drop("_held"), replaced, copies), "contested")
    write(drop_matching(old.filter(~again), held, "_id", _SPREAD).drop("_id"), "kept")


def _rebuilt(new: DataFrame, replaced: DataFrame, entries: DataFrame) -> DataFrame:
    """Silver rows of events that are new and were there before: the earlier canonical row stays unless there is a better
    one now, with the number of copies added up over the batches that hold the id.
    """
    columns = [c for c in new.columns if c != "bronze_duplicate_count"]
    at = F.col("ingestion_timestamp").try_cast("timestamp")
    order = F.struct(F.coalesce("bronze_is_duplicate", F.lit(False)), at.isNull(), at, "_late")
    both = replaced.withColumn("_late", F.lit(0)).unionByName(new.withColumn("_late", F.lit(1)))
    best = (
        both.withColumn("_id", event_key()).filter(F.col("_id").isNotNull()).groupBy("_id")
        .agg(F.min_by(F.struct(*columns), order).alias("_row"))
    )
    copies = entries.groupBy(F.col("event_key").alias("_id")).agg(F.sum("n").alias("bronze_duplicate_count"))
    return best.join(copies, "_id", "left").select("_row.*", "bronze_duplicate_count")


def refresh_due(last: dt.datetime | None, now: dt.datetime, minimum_seconds: int = 60, force: bool = False) -> bool:
    """A refresh runs at most once per interval, measured from the last success, unless forced."""
    return force or last is None or (now - last).total_seconds() >= minimum_seconds


@dataclass
class Refresher:
    """Bring Silver and Gold up to date, after micro-batches as the stream's ``after_batch`` or as a job of its own (``start``).

    Either way two refreshes never overlap. A failed refresh is counted and does not stop the stream; the next one tries again.
    """

    bronze_root: str
    silver_root: str
    gold_root: str
    settings: Settings
    ip_geo: DataFrame | None = None
    minimum_seconds: int = 60
    last_run: dt.datetime | None = None
    runs: int = 0
    errors: int = 0

    def __call__(self, spark: SparkSession, force: bool = False, stopped: Callable[[], bool] = lambda: False) -> bool:
        now = dt.datetime.now(dt.timezone.utc)
        if not refresh_due(self.last_run, now, self.minimum_seconds, force):
            return False
        try:
            refresh_published(
                spark, self.bronze_root, self.silver_root, self.gold_root, self.settings, self.ip_geo
            )
        except Exception as error:
            if stopped():   # cut short, not failed
                return False
            self.errors += 1
            logging.getLogger(__name__).warning("refresh failed: %s", error)
            return False
        self.last_run, self.runs = now, self.runs + 1
        return True

    def start(self, spark: SparkSession, checkpoint: str, every: str = "1 minute", name: str = "refresh") -> StreamingQuery:
        """A query of its own that refreshes at an interval, so a long refresh does not hold up ingest.

        Its batches are ticks, not data: what is new follows from the index of batches and the newest publication.
        """
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
        query = None

        def tick(batch: DataFrame, _: int) -> None:
            self(batch.sparkSession, force=True, stopped=lambda: query is not None and not query.isActive)

        query = (
            ticks.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(processingTime=every)
            .foreachBatch(tick).start()
        )
        return query
