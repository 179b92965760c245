"""Versioned publication: readers follow a log of commits, so replacing a dataset never breaks a read."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from paylake.sources import commits
from paylake.sources.storage import delete, exists

MANIFEST = "canonical_path string, output_path string, rows long, mode string, updated_at_utc string"
#: Versions that stay when another is published.
KEEP = 3


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = KEEP) -> str:
    """Write a new version below ``path``, then commit it; versions beyond the newest ``keep`` go. Rows are counted
    while writing. Of two writers at once one gets commits.Conflict, and its version is deleted."""
    spark, now, base = df.sparkSession, dt.datetime.now(dt.timezone.utc), commits.latest(df.sparkSession, path)
    output = f"{path.rstrip('/')}/_versions/{now.strftime('%Y%m%dT%H%M%S')}_{uuid.uuid4().hex[:8]}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(output)
    entry = {"canonical_path": path, "output_path": output, "rows": seen.get["rows"], "mode": "versioned",
             "updated_at_utc": now.isoformat()}
    try:
        commits.commit(spark, path, base, entry)
    except commits.Conflict:
        delete(spark, output)
        raise
    expire(spark, path, keep)
    return output


def history(spark: SparkSession, path: str) -> DataFrame:
    """Published versions that are kept. An entry that cannot be read is an error."""
    entries = [commits.read(spark, path, n) for n in commits.numbers(spark, path)]
    return spark.createDataFrame([tuple(e[c.split()[0]] for c in MANIFEST.split(", ")) for e in entries], MANIFEST)


def resolve_latest(spark: SparkSession, path: str) -> str:
    """Newest version that exists; the path itself when there is none. Opens the newest entry, and older ones only where
    its version was deleted by hand."""
    for number in commits.numbers(spark, path):
        output = commits.read(spark, path, number)["output_path"]
        if exists(spark, output):
            return output
    return path


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(resolve_latest(spark, path))


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Delete all but the newest ``keep`` versions that exist; returns how many were deleted."""
    gone, held = 0, 0
    for number in commits.numbers(spark, path):
        output = commits.read(spark, path, number)["output_path"]
        there = exists(spark, output)
        held += there
        if held > keep or not there:
            if there:
                delete(spark, output)
                gone += 1
            if held > keep:
                commits.forget(spark, path, number)
    return gone


def export_layer(
    spark: SparkSession, datasets: dict[str, str], layer: str, target: str, layout: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """Copy the newest version of each dataset to ``target/layer/name``; one result row per dataset.

    ``layout`` names the folder columns of a dataset, as in ``{"events": ("date",)}``.
    """
    results = []
    for name, path in datasets.items():
        key = f"{layer}/{name}"
        try:
            seen = Observation()
            copy = read_latest(spark, path).observe(seen, F.count(F.lit(1)).alias("rows"))
            writer = copy.write.mode("overwrite")
            folders = (layout or {}).get(name, ())
            (writer.partitionBy(*folders) if folders else writer).parquet(f"{target.rstrip('/')}/{key}")
            results.append((key, True, seen.get["rows"], None))
        except Exception as error:  # one dataset failing does not stop the others
            results.append((key, False, None, type(error).__name__))
    return spark.createDataFrame(results, "object string, ok boolean, rows long, error string")
