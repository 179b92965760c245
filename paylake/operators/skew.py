"""Row lookup that stays balanced when a few keys, or missing keys, hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HEAVY_ROWS = 1_000_000   # a key with fewer rows fits one task as it is; there are at most rows / HEAVY_ROWS others
SALTS = 256


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the figure Spark itself compares with its broadcast limit."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    text = value.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(text[:-1]) * units[text[-1]] if text[-1] in units else int(text)


def fits_broadcast(df: DataFrame) -> bool:
    return planned_bytes(df) <= broadcast_limit(df)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    salt_on: list[str],
    weight: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
    salts: int = SALTS,
    allow_broadcast: bool = True,
    written: bool = False,
) -> DataFrame:
    """Left join of ``rows`` to ``table``, which has one row per ``key``.

    A table whose checked size is below the session's broadcast limit is broadcast. Otherwise
    both sides are shuffled on (key, salt): rows of the heaviest keys spread over ``salts``
    partitions and only those keys' table rows are copied; rows without a key spread as well
    (they match nothing). Every key with ``heavy_rows`` rows or more is spread; their list, which is
    broadcast, has at most one key per ``heavy_rows`` rows: 1 MB of list stands for terabytes of rows.
    The salt is a hash of ``salt_on``, so a recomputed task sends each row to the same place.
    ``weight`` names a column of ``table`` with the row count per key, when it is known; the size of such a computed
    table is known only at run time and adaptive execution decides, unless the table was ``written`` before.
    """
    if allow_broadcast and (weight is None or written) and fits_broadcast(table):
        return rows.join(F.broadcast(table), key, "left")
    if weight:
        counts = table.select(key, F.col(weight).alias("_n"))
    else:
        counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.filter(F.col("_n") >= heavy_rows).select(key, F.lit(True).alias("_heavy"))
    spread = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
    left = rows.join(F.broadcast(heavy), key, "left").withColumn(
        "_salt", F.when(F.col("_heavy") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(F.broadcast(heavy), key, "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return left.drop("_heavy").join(right, [key, "_salt"], "left").drop("_salt")


def keep_matching(rows: DataFrame, keys: DataFrame, key: str, salt_on: list[str], **skew) -> DataFrame:
    """Rows whose key is in ``keys`` (one row per key), balanced like ``lookup``."""
    marked = lookup(rows, keys.select(key, F.lit(True).alias("_hit")), key, salt_on, **skew)
    return marked.filter(F.col("_hit")).drop("_hit").select(*rows.columns)


def drop_matching(rows: DataFrame, keys: DataFrame, key: str, salt_on: list[str], **skew) -> DataFrame:
    """Rows whose key is not in ``keys``; rows without a key stay."""
    marked = lookup(rows, keys.select(key, F.lit(True).alias("_hit")), key, salt_on, **skew)
    return marked.filter(F.col("_hit").isNull()).drop("_hit").select(*rows.columns)
