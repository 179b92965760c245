"""Index of event ids beside Bronze: a row per id and batch, in folders by bucket (hash of the id) and batch.

A row says where the batch has the id first, how many copies it holds and on which dates. A micro-batch or a refresh asks for
its own ids: first only the hashes in the buckets these fall into are read, then the rows of those buckets that do hold one.
Bronze itself is not read.

    rows_<B>/bucket=<n>/in_batch=b_<id>/    the entries, in B buckets
    buckets/<B>/                        how many buckets are in use: a merge makes more of them as the index grows
    batches/b_<id>/                     a batch that is in the index
    open/b_<id>/                        a batch being written: in Bronze, perhaps, and not yet in the index

One writer at a time, as for Bronze. A merge that stopped leaves entries twice; reading counts an id once per batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.functions.scalars import event_key
from paylake.schemas import BRONZE_IDS
from paylake.sources.files import batch_folder, bronze_batches, in_folder
from paylake.sources.storage import create_new, delete, exists, folder_names, has_files

#: Buckets of a new index, and entries per bucket above which a merge doubles them.
FIRST_BUCKETS, BUCKET_ENTRIES = 16, 5_000_000
#: Batches after which the entries of all of them are merged into one file per bucket.
MERGE_AFTER = 64
_KEY = "event_key string, hash long"
_ENTRY = (f"{_KEY}, batch_id string, ingestion_timestamp string, source_file string, bronze_file string, "
          "bronze_row long, n long, dates array<date>")
_PLACE = "bucket int, in_batch string"


def root_of(bronze_root: str) -> str:
    return f"{bronze_root.rstrip('/')}_ids"


def buckets(spark: SparkSession, bronze_root: str) -> int:
    """How many buckets the index has."""
    return max(map(int, folder_names(spark, f"{root_of(bronze_root)}/buckets/*")), default=FIRST_BUCKETS)


def _rows(bronze_root: str, number: int) -> str:
    return f"{root_of(bronze_root)}/rows_{number}"


def _mark(spark: SparkSession, bronze_root: str, kind: str, batch_ids: list[str]) -> None:
    """Note batches: an empty file each, or for very many a folder each, made by tasks."""
    base = f"{root_of(bronze_root)}/{kind}"
    if len(batch_ids) <= 100:
        for batch_id in batch_ids:
            create_new(spark, f"{base}/in_batch=b_{batch_id}", "")
    else:
        named = spark.createDataFrame([(b,) for b in batch_ids], "batch_id string")
        named.select(F.lit("").alias("value"), in_folder("batch_id").alias("in_batch")).write.mode("append") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("in_batch").text(base)


def _marked(spark: SparkSession, bronze_root: str, kind: str) -> set[str]:
    prefix = "in_batch=b_"
    return {name[len(prefix):] for name in folder_names(spark, f"{root_of(bronze_root)}/{kind}/{prefix}*")}


def hash_of(key: str | Column = "event_key") -> Column:
    return F.xxhash64(key)


def bucket_of(number: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(number)).cast("int")


def _entries(spark: SparkSession, bronze_root: str, batch_ids: list[str] | None) -> DataFrame:
    """One row per id and stored batch: its first place, its copies, its dates."""
    paths = [bronze_root] if batch_ids is None else [f"{bronze_root}/in_day=*/in_batch=b_{b}" for b in batch_ids]
    reader = spark.read.schema(f"{BRONZE_IDS}, timestamp string, in_batch string").option("basePath", bronze_root)
    path = F.col("_metadata.file_path")
    keyed = reader.parquet(*paths).select(
        event_key().alias("event_key"), "batch_id", "ingestion_timestamp", "source_file", "in_batch",
        batch_folder(path).alias("bronze_file"), F.struct(path, F.col("_metadata.row_index").alias("row")).alias("at"),
        F.to_date(F.col("timestamp").try_cast("timestamp")).alias("date"),
    ).filter(F.col("event_key").isNotNull())
    first = F.struct("batch_id", "ingestion_timestamp", "source_file", "bronze_file", F.col("at.row").alias("bronze_row"))
    return keyed.groupBy("event_key", "in_batch").agg(
        F.min_by(first, "at").alias("f"), F.count(F.lit(1)).alias("n"),
        F.collect_set(F.struct("date")).alias("dates"),
    ).select("event_key", hash_of().alias("hash"), "f.*", "n", F.transform("dates", lambda d: d["date"]).alias("dates"),
             "in_batch")


def _write(entries: DataFrame, bronze_root: str, number: int) -> None:
    """Writing a batch's entries again replaces them."""
    placed = entries.withColumn("bucket", bucket_of(number))
    placed.repartition("bucket").sortWithinPartitions("bucket", "in_batch", "hash").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "in_batch").parquet(_rows(bronze_root, number))


def _add(spark: SparkSession, bronze_root: str, batch_ids: list[str] | None) -> None:
    _write(_entries(spark, bronze_root, batch_ids), bronze_root, buckets(spark, bronze_root))


def batches(spark: SparkSession, bronze_root: str) -> DataFrame:
    """batch_id of the batches in the index, from folder names."""
    named = sorted(_marked(spark, bronze_root, "batches") - _marked(spark, bronze_root, "open"))
    return spark.createDataFrame([(b,) for b in named], "batch_id string")


def ensure(spark: SparkSession, bronze_root: str) -> None:
    """Take in every stored batch that is not in the index, whoever wrote it, but for those being written. Lists folder names
    of batches."""
    stored = {row.batch_id for row in bronze_batches(spark, bronze_root).collect()}
    if not stored:
        raise FileNotFoundError(f"no Bronze batches in {bronze_root}")
    missing = sorted(stored - _marked(spark, bronze_root, "batches") - _marked(spark, bronze_root, "open"))
    if missing:
        _add(spark, bronze_root, None if len(missing) == len(stored) else missing)
        _mark(spark, bronze_root, "batches", missing)


def begin(spark: SparkSession, bronze_root: str, batch_id: str) -> None:
    """Before a batch is written to Bronze: finish what a stopped one left, and note this one.

    Looks at the open batches only, unless there is no index yet.
    """
    if not exists(spark, f"{root_of(bronze_root)}/batches"):
        if has_files(spark, bronze_root):
            ensure(spark, bronze_root)
    for other in sorted(_marked(spark, bronze_root, "open") - {batch_id}):
        if folder_names(spark, f"{bronze_root}/in_day=*/in_batch=b_{other}"):
            finish(spark, bronze_root, other)
        else:
            delete(spark, f"{root_of(bronze_root)}/open/in_batch=b_{other}")
    _mark(spark, bronze_root, "open", [batch_id])


def finish(spark: SparkSession, bronze_root: str, batch_id: str) -> None:
    """After a batch is in Bronze: take it into the index."""
    if folder_names(spark, f"{bronze_root}/in_day=*/in_batch=b_{batch_id}"):
        _add(spark, bronze_root, [batch_id])
        _mark(spark, bronze_root, "batches", [batch_id])
    delete(spark, f"{root_of(bronze_root)}/open/in_batch=b_{batch_id}")
    if len(set(folder_names(spark, f"{_rows(bronze_root, buckets(spark, bronze_root))}/bucket=*/in_batch=*"))) > MERGE_AFTER:
        merge(spark, bronze_root)


def lookup(spark: SparkSession, bronze_root: str, ids: DataFrame, without_batch: str | None = None) -> DataFrame:
    """The entries of ``ids`` (event_key), read from the buckets that hold any of them.

    The lists of buckets are no longer than the number of buckets. ``without_batch`` leaves one batch out.
    """
    number = buckets(spark, bronze_root)
    if not exists(spark, _rows(bronze_root, number)):
        return spark.createDataFrame([], _ENTRY).drop("hash")
    wanted = ids.select("event_key", hash_of().alias("hash")).filter(F.col("event_key").isNotNull()).distinct()
    asked = [row.bucket for row in wanted.select(bucket_of(number).alias("bucket")).distinct().collect()]
    hashes = _read(spark, bronze_root, number, "hash long", sorted(asked))
    held = hashes.join(wanted.select("hash"), "hash", "left_semi").select("bucket").distinct()
    found = _read(spark, bronze_root, number, _ENTRY, sorted(row.bucket for row in held.collect()) if asked else [])
    if without_batch is not None:
        found = found.filter(F.col("batch_id") != without_batch)
    return found.join(wanted, ["event_key", "hash"], "left_semi").drop("bucket", "in_batch", "hash") \
        .dropDuplicates(["event_key", "batch_id"])


def _read(spark: SparkSession, bronze_root: str, number: int, columns: str, wanted: list[int]) -> DataFrame:
    """Entries of some buckets: only their folders are listed."""
    root, schema = _rows(bronze_root, number), f"{columns}, {_PLACE}"
    there = set(folder_names(spark, f"{root}/bucket=*")) if wanted else set()
    paths = [f"{root}/bucket={b}" for b in wanted if f"bucket={b}" in there]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def first_seen(entries: DataFrame) -> DataFrame:
    """event_key and the batch, time, source and file that had it first, as ``bronze.first_seen`` gives them."""
    seen = F.struct("batch_id", "ingestion_timestamp", "source_file", "bronze_file")
    return entries.groupBy("event_key").agg(F.min_by(seen, F.struct("bronze_file", "bronze_row")).alias("f")) \
        .select("event_key", "f.*")


def merge(spark: SparkSession, bronze_root: str) -> None:
    """One file per bucket instead of one per batch and bucket, in more buckets if these have grown. Entries keep their batch."""
    number = buckets(spark, bronze_root)
    root, files = _rows(bronze_root, number), f"{_rows(bronze_root, number)}/bucket=*/in_batch=*"
    old = sorted(set(folder_names(spark, files)))
    if len(old) < 2:
        return
    entries = spark.read.schema(f"{_ENTRY}, {_PLACE}").parquet(root)
    more, total = number, entries.count()   # from the files' footers
    while total > more * BUCKET_ENTRIES:
        more *= 2
    target = f"m_{len(old)}_{old[-1].removeprefix('in_batch=')}"
    merged = entries.drop("in_batch", "bucket").dropDuplicates(["event_key", "batch_id"]).withColumn("in_batch", F.lit(target))
    if more != number:
        delete(spark, _rows(bronze_root, more))   # of a merge that stopped
    _write(merged, bronze_root, more)
    if more != number:
        spark.range(0).write.mode("overwrite").json(f"{root_of(bronze_root)}/buckets/{more}")
        delete(spark, root)
        return
    for b in range(number):
        for name in folder_names(spark, f"{root}/bucket={b}/in_batch=*"):
            if name != f"in_batch={target}":
                delete(spark, f"{root}/bucket={b}/{name}")
