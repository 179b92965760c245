"""Helpers shared by the operators: words, tables, staged results, distributed running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylake.session import bounded_batches, work_dir

#: A word is a run of characters other than space and the controls 0x09 to 0x0D. bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
WORD_SQL = r"'[^\x20\x09-\x0D]+'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none of a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder and read back: later steps neither recompute it nor depend on executors
    that made it."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sums(df: DataFrame, order: list[str], sums: dict[str, str], purpose: str) -> DataFrame:
    """df with, for each name of `sums`, the sum of its column over the rows before this one in `order`.

    The rows are sorted by range; each range adds up its own rows, and only the totals of the ranges (as many as
    shuffle partitions) are added up in one place. The order must be total, or ties equal in all columns.
    """
    ranged = staged(df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order])
                    .withColumn("__range", F.spark_partition_id()), purpose)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__total_{n}") for n, c in sums.items()])
               .select("__range", *[F.coalesce(F.sum(f"__total_{n}").over(before), F.lit(0)).alias(f"__offset_{n}")
                                    for n in sums]))
    inside = (Window.partitionBy("__range").orderBy(*[F.col(c).asc_nulls_last() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = ranged.join(offsets, "__range").withColumns(
        {n: F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__offset_{n}") for n, c in sums.items()})
    return summed.select(*df.columns, *sums)
