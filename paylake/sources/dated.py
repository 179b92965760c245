"""A dataset by date (or another folder column) in versions: a publication names, for every folder, the version that holds it.

Replacing some dates writes only those, beside what readers use; the commit that follows switches all of
them at once. The batches taken in are recorded with it, so both are there or neither. Of two writers that start from the
same publication one wins. The writer deletes what no kept publication names.

    data/version=v_<n>_<id>/date=<day>/   rows of a day
    applied/<id>/                         batches taken in; merged into one after MERGED publications
    _commits/c_<n>.json                   publication n: version by folder (an entry a day or bucket), records of batches
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from paylake.sources import commits
from paylake.sources.storage import delete, exists, folder_names

_UNKNOWN = "__HIVE_DEFAULT_PARTITION__"
#: Publications kept, and records of batches before they are merged.
KEEP, MERGED = 3, 16
_BATCHES = "batch_id string"


def latest(spark: SparkSession, root: str) -> int | None:
    """Number of the newest publication."""
    return commits.latest(spark, root)


def _folders(spark: SparkSession, root: str, number: int | None) -> dict[str, str]:
    """Version by folder: one entry a day of the calendar, or a bucket."""
    return {} if number is None else commits.read(spark, root, number)["folders"]


def _folder(by: str, value) -> str:
    return f"{by}={_UNKNOWN if value is None else value}"


def publish(
    df: DataFrame, root: str, batches: DataFrame | None, touched: list | None = None, by: str = "date",
    number: int | None = None, keep: int = KEEP,
) -> int:
    """Write the rows of ``df`` by folder and publish them: all folders, or the ``touched`` ones beside the others.

    ``batches`` (batch_id), if any, are recorded as taken in. Returns the publication's number. What an attempt that stopped or
    lost against another writer has left goes with the next publication.
    """
    spark, base = df.sparkSession, root.rstrip("/")
    before = latest(spark, base)
    number = number or (before or 0) + 1
    name = f"{number:010d}_{uuid.uuid4().hex[:8]}"
    version = f"v_{name}"
    data = f"{base}/data/version={version}"
    (
        df.hint("rebalance", by).write.mode("overwrite").option("compression", "snappy")
        .partitionBy(by).parquet(data)
    )
    folders = {} if touched is None else _folders(spark, base, before)
    for value in touched or []:
        folders.pop(_folder(by, value), None)
    folders |= dict.fromkeys(folder_names(spark, f"{data}/{by}=*"), version)
    records = [] if before is None else commits.read(spark, base, before)["applied"]
    if batches is not None:
        added = batches.select("batch_id")
        if len(records) >= MERGED:
            records, added = [], added.union(_records(spark, base, records)).distinct()
        added.coalesce(1).write.mode("overwrite").json(f"{base}/applied/{name}")
        records = [*records, name]
    commits.commit(spark, base, before, {"folders": folders, "applied": records}, number)
    expire(spark, base, keep)
    return number


def _records(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    return spark.read.schema(_BATCHES).json([f"{root.rstrip('/')}/applied/{name}" for name in names])


def applied(spark: SparkSession, root: str) -> DataFrame:
    """batch_id of every batch in the newest publication."""
    newest = latest(spark, root)
    if newest is None:
        return spark.createDataFrame([], _BATCHES)
    records = commits.read(spark, root, newest)["applied"]
    return _records(spark, root, records).distinct() if records else spark.createDataFrame([], _BATCHES)


def read(
    spark: SparkSession, root: str, by: str = "date", only: list | None = None, number: int | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A publication, the newest if none is named. A filter on the folder column reads only those folders; ``only`` lists them
    before anything is planned. Without any folder the result is empty if the schema is given."""
    base = root.rstrip("/")
    folders = _folders(spark, base, number or latest(spark, base))
    if only is not None:
        wanted = {_folder(by, value) for value in only}
        folders = {f: v for f, v in folders.items() if f in wanted}
    if not folders:
        if schema is None:
            raise FileNotFoundError(f"nothing is published in {base}")
        return spark.createDataFrame([], schema)
    paths = [f"{base}/data/version={version}/{folder}" for folder, version in folders.items()]
    reader = spark.read.option("basePath", f"{base}/data")
    return (reader.schema(schema) if schema else reader).parquet(*paths).drop("version")


def mark(spark: SparkSession, root: str, number: int, name: str) -> None:
    """Note that something derived from a publication is complete."""
    base = f"{root.rstrip('/')}/{name}"
    spark.range(1).write.mode("overwrite").json(f"{base}/p_{number:010d}")
    for old in folder_names(spark, f"{base}/p_*"):
        if int(old[2:]) < number:
            delete(spark, f"{base}/{old}")


def is_marked(spark: SparkSession, root: str, number: int, name: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/{name}/p_{number:010d}/_SUCCESS")


def expire(spark: SparkSession, root: str, keep: int = KEEP) -> int:
    """Delete publications older than the newest ``keep`` and what none of the kept names; returns how many versions went.

    A version numbered above the newest publication may be another writer's and stays.
    """
    base, numbers = root.rstrip("/"), commits.numbers(spark, root)
    if not numbers:
        return 0
    kept, newest = numbers[:max(keep, 1)], numbers[0]
    entries = [commits.read(spark, base, n) for n in kept]
    used = {version for e in entries for version in e["folders"].values()}
    for n in numbers[len(kept):]:
        commits.forget(spark, base, n)
    old = [name for name in folder_names(spark, f"{base}/data/version=*")
           if name.removeprefix("version=") not in used and int(name.split("_")[1]) <= newest]
    for name in old:
        delete(spark, f"{base}/data/{name}")
    records = {name for e in entries for name in e["applied"]}
    for name in folder_names(spark, f"{base}/applied/*"):
        if name not in records and int(name.split("_")[0]) <= newest:
            delete(spark, f"{base}/applied/{name}")
    return len(old)
