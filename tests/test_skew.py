import pytest

from paylake.operators.skew import broadcast_limit, drop_matching, fits_broadcast, keep_matching, lookup

SALTED = dict(allow_broadcast=False, heavy_rows=20, salts=8)


@pytest.fixture
def rows(spark):
    keys = ["hot"] * 100 + [None] * 60 + [f"k{i}" for i in range(40)] + ["absent"] * 30
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(50)], "key string, v int")


def as_set(df):
    return {tuple(r) for r in df.select("n", "key", "v").collect()}


def test_salted_lookup_equals_plain_join(rows, table):
    expected = as_set(rows.join(table, "key", "left"))
    for options in (SALTED, {}, {**SALTED, "heavy_rows": 10**9}):
        result = lookup(rows, table, "key", ["n"], **options)
        assert as_set(result) == expected
        assert result.count() == rows.count()


def test_weight_column_replaces_counting(rows, table):
    weighted = table.join(rows.groupBy("key").count().withColumnRenamed("count", "w"), "key", "left")
    result = lookup(rows, weighted, "key", ["n"], weight="w", **SALTED)
    assert as_set(result.drop("w")) == as_set(rows.join(table, "key", "left"))


def test_heavy_and_missing_keys_spread_over_partitions(spark, rows, table):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from pyspark.sql import functions as F

        result = lookup(rows, table, "key", ["n"], **SALTED).withColumn("p", F.spark_partition_id())
        for key in ("hot", None):
            parts = result.filter(F.col("key").eqNullSafe(key)).select("p").distinct().count()
            assert parts > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_keep_and_drop_matching_split_the_rows(rows, table):
    keys = table.select("key")
    for options in (SALTED, {}):
        kept = [r.n for r in keep_matching(rows, keys, "key", ["n"], **options).collect()]
        dropped = [r.n for r in drop_matching(rows, keys, "key", ["n"], **options).collect()]
        assert sorted(kept + dropped) == list(range(230))
        assert len(kept) == 140


def test_size_is_checked_before_broadcast(spark, rows, table):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = spark.sql("SELECT * FROM VALUES ('hot', 1) AS t(key, v)")
    try:
        assert fits_broadcast(small)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert broadcast_limit(small) == -1 and not fits_broadcast(small)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2kb")
        assert broadcast_limit(small) == 2048
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
