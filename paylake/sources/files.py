"""Raw, Bronze, Silver and Gold datasets on storage."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paylake import fixed_values as fv
from paylake.operators.bronze import duplicate_log, repair_flags, repair_summary
from paylake.schemas import BRONZE_IDS, CORRUPT, RAW_EVENT
from paylake.session import work_dir
from paylake.sources.storage import create_new, delete, file_names, folder_names, has_files, read_text

RAW_ORDER = ["raw_file", "raw_block", "raw_row"]
BRONZE_ORDER = ["bronze_file", "bronze_row"]
AUDIT = ("is_duplicate", "duplicate_reason", "duplicate_first_seen_batch_id", "duplicate_first_seen_file")
_PLACE = ("in_day", "in_batch")  # folder columns of Bronze; the data columns stay in the files


def in_folder(batch_id: str | Column) -> Column:
    """Folder value of the batch id in a column."""
    return _folder(F.col(batch_id) if isinstance(batch_id, str) else batch_id)


def batch_folder(path: Column) -> Column:
    """Folder of a stored file: its batch's place, which stays when the batch is written again."""
    return F.regexp_replace(path, "/[^/]*$", "")


def _folder(batch_id: str | Column) -> Column:
    """Folder value of a batch. The prefix keeps an id of digits from being read back as a number."""
    return F.concat(F.lit("b_"), F.lit(batch_id) if isinstance(batch_id, str) else batch_id)


def placed(batch: DataFrame) -> DataFrame:
    """With the folder columns of its day and batch."""
    return batch.withColumns({"in_day": F.col("ingestion_date"), "in_batch": _folder(F.col("batch_id"))})


def read_raw(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested events from JSON arrays (``multi_line``) or JSON lines, with their order in the input.

    Input that is no JSON is an error; a value of the wrong type reads as null.
    """
    raw = spark.read.schema(f"{RAW_EVENT}, {CORRUPT} string").option("multiLine", multi_line).json(path)
    broken = F.col(CORRUPT).isNotNull() & F.col("detail").isNull() & F.col("source").isNull()
    complaint = F.raise_error(F.concat(F.lit("not a JSON event: "), F.substring(CORRUPT, 1, 200)))
    return raw.select(
        F.when(broken, complaint.cast("string")).otherwise(F.col("source")).alias("source"),
        "detailType", "detail",
        F.col("_metadata.file_path").alias("raw_file"),
        F.col("_metadata.file_block_start").alias("raw_block"),
        F.monotonically_increasing_id().alias("raw_row"),
    )


def write_bronze(batch: DataFrame, root: str) -> str:
    """Add one batch. A batch has a folder of its own below its day, so writing it again replaces it. Its columns go into
    the schema log first, so that no reader needs a file to know them."""
    _record_schema(batch, root)
    (
        placed(batch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(*_PLACE).parquet(root)
    )
    return root


def _schema_log(root: str) -> str:
    return f"{root.rstrip('/')}_schema"


def _record_schema(batch: DataFrame, root: str) -> None:
    """One small file per different schema, however many batches have it."""
    spark, text = batch.sparkSession, batch.schema.json()
    name, known = hashlib.sha256(text.encode()).hexdigest()[:16], file_names(batch.sparkSession, f"{_schema_log(root)}/s_*.json")
    if not any(n.endswith(f"_{name}.json") for n in known):
        create_new(spark, f"{_schema_log(root)}/s_{len(known):06d}_{name}.json", text)


def stored_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """All columns of Bronze, in the order they first appeared; None without a log. A column of two types is an error."""
    fields: dict[str, T.StructField] = {}
    for name in sorted(file_names(spark, f"{_schema_log(root)}/s_*.json")):
        for f in T.StructType.fromJson(json.loads(read_text(spark, f"{_schema_log(root)}/{name}"))).fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"column {f.name} is {fields[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()]) if fields else None


def read_bronze(spark: SparkSession, root: str, batch_ids: list[str] | None = None) -> DataFrame:
    """Bronze rows with their file and row number; files may differ in columns, a damaged one is an error when it is read.

    ``batch_ids`` lists and reads those batches' folders only. Columns come from the schema log; only a dataset without
    one, not written by ``write_bronze``, is asked for the footers of its files.
    """
    if not has_files(spark, root):
        raise FileNotFoundError(f"no Bronze files in {root}")
    schema = stored_schema(spark, root)
    reader = spark.read.option("basePath", root)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(
        T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in _PLACE)]))
    paths = [root] if batch_ids is None else [f"{root}/in_day=*/in_batch=b_{b}" for b in batch_ids]
    return reader.parquet(*paths).select(
        "*",
        F.col("_metadata.file_path").alias("bronze_file"),
        F.col("_metadata.row_index").alias("bronze_row"),
    ).drop(*_PLACE)


def read_bronze_ids(spark: SparkSession, root: str, without_batch: str | None = None) -> DataFrame:
    """Only what duplicate detection needs, with a fixed schema: no footer is read to plan it.

    A file without an event_id column reads as rows without an id, which no lookup can match.
    """
    schema = f"{BRONZE_IDS}, in_batch string"
    rows = spark.read.schema(schema).parquet(root)
    if without_batch is not None:
        rows = rows.filter(F.col("in_batch") != _folder(without_batch))
    return rows.select(
        "event_id", "batch_id", "ingestion_timestamp", "source_file",
        batch_folder(F.col("_metadata.file_path")).alias("bronze_file"), F.col("_metadata.row_index").alias("bronze_row"),
    )


def repair_bronze(spark: SparkSession, root: str, dry_run: bool = True) -> DataFrame:
    """Recompute the duplicate flags of all of Bronze; unless ``dry_run``, batches whose flags change are written anew.

    A first copy is named by its batch's folder, which stays when the batch is written again. The repaired rows are staged in the
    shared folder first, with their place, and keep their order in a batch. A run that stopped while writing leaves each
    batch either old or new, and running again finishes it. Returns the summary.
    """
    stage = work_dir(spark, "repair")
    stored = read_bronze(spark, root).withColumn("_folder", batch_folder(F.col("bronze_file")))
    was = {f"_was_{c}": F.col(c) if c in stored.columns else F.lit("?") for c in AUDIT}
    repair_flags(stored.withColumns(was), BRONZE_ORDER, "_folder").write.parquet(stage)
    staged = spark.read.parquet(stage)
    summary = spark.createDataFrame(repair_summary(staged, dry_run=dry_run).collect())  # one row
    if not dry_run:
        same = F.lit(True)
        for c in AUDIT:
            same = same & F.col(f"_was_{c}").cast("string").eqNullSafe(F.col(c).cast("string"))
        changed = staged.filter(~same).select("batch_id").distinct()
        ordered = staged.join(changed, "batch_id", "left_semi").repartitionByRange(*BRONZE_ORDER).sortWithinPartitions(*BRONZE_ORDER)
        write_bronze(ordered.drop(*BRONZE_ORDER, "_folder", *was), root)
    delete(spark, stage)
    return summary


def bronze_batches(spark: SparkSession, root: str) -> DataFrame:
    """Ids of the stored batches, from the folder names: no file is opened."""
    prefix = "in_batch=b_"
    names = {name[len(prefix):] for name in folder_names(spark, f"{root}/in_day=*/{prefix}*")}
    return spark.createDataFrame([(name,) for name in sorted(names)], "batch_id string")


def write_silver(silver: DataFrame, root: str) -> str:
    """Silver by event date. The rebalance sizes files: small dates are merged, a hot date is split."""
    (
        silver.hint("rebalance", "date").write.mode("overwrite")
        .option("partitionOverwriteMode", "static").option("compression", "snappy")
        .partitionBy("date").parquet(root)
    )
    return root


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def gold_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in fv.GOLD_TABLES}


def write_gold(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    paths = gold_paths(root)
    for name, path in paths.items():
        tables[name].write.mode("overwrite").option("compression", "snappy").parquet(path)
    return paths


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in gold_paths(root).items()}


def register_gold(tables: dict[str, DataFrame]) -> None:
    """Temporary views under the Gold table names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_duplicate_log(flagged: DataFrame, path: str, batch_id: str | None = None) -> str | None:
    """CSV of the flagged rows, in a folder of its own for each batch; nothing is written when there are none."""
    log = duplicate_log(flagged)
    if log.isEmpty():
        return None
    target = f"{path.rstrip('/')}/batch={batch_id}" if batch_id else path
    (
        log.write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(target)
    )
    return target


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Texts that stand for nothing become NULL in every string column."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({
        c: F.when(~F.lower(c).isin(*fv.NULL_TOKENS), F.col(c)) for c in texts
    })
