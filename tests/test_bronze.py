import pytest
from pyspark.sql import functions as F

from paylake import fixed_values as fv
from paylake.operators import bronze, checks
from paylake.sources import files, tables
from tests.events import raw_event, write_raw

HISTORY = "event_id string, batch_id string, ingestion_timestamp string, source_file string, bronze_file string, seq int"
BATCH = "event_id string, seq int"


def flags(df):
    return [(r.event_id, r.is_duplicate, r.duplicate_reason) for r in df.orderBy("seq").collect()]


def test_flatten_has_36_columns_and_nulls_for_absent_parts(spark, folder):
    import json

    event = raw_event()
    del event["detail"]["payload"]["location"]
    with open(f"{folder}/raw.json", "w") as out:
        json.dump([event], out)
    flat = bronze.flatten(files.read_raw(spark, f"{folder}/raw.json"))
    row = flat.first()
    assert len(flat.columns) == 36
    assert (row.event_id, row.user_id, row.amount, row.channel) == ("evt-1", "user_1", "100000.0", "app")
    assert row.location_city is None and row.updated_city is None


def test_flags_follow_history_and_batch_order(spark):
    history = spark.createDataFrame(
        [("evt-historical", "batch-old", "2026-01-01T00:00:00Z", "old.json", "batch_old.parquet", 1)], HISTORY)
    batch = spark.createDataFrame([("evt-historical", 1), ("evt-batch", 2), (" evt-batch ", 3), (None, 4), (" ", 5)], BATCH)
    known = bronze.first_seen(history, ["bronze_file", "seq"])
    flagged = bronze.flag_duplicates(batch, known, ["seq"])
    assert flags(flagged) == [
        ("evt-historical", True, "seen_in_bronze"),
        ("evt-batch", False, None),
        (" evt-batch ", True, "repeated_in_batch"),
        (None, True, "missing_event_id"),
        (" ", True, "missing_event_id"),
    ]
    first = flagged.orderBy("seq").first()
    assert (first.duplicate_first_seen_batch_id, first.duplicate_first_seen_file) == ("batch-old", "batch_old.parquet")


def test_known_id_repeated_in_batch_counts_as_seen(spark):
    history = spark.createDataFrame([("a", "b0", "t", "s", "f", 1)], HISTORY)
    batch = spark.createDataFrame([("a", 1), ("a", 2)], BATCH)
    for small in (None, batch):  # history filtered by a broadcast of the batch ids, or not
        known = bronze.first_seen(history, ["seq"], small)
        assert [r[2] for r in flags(bronze.flag_duplicates(batch, known, ["seq"]))] == ["seen_in_bronze"] * 2


def test_hot_ids_are_flagged_alike_when_salted(spark):
    rows = [("hot" if i % 3 else None if i % 2 else f"e{i}", i) for i in range(600)]
    batch = spark.createDataFrame(rows, BATCH)
    plain = bronze.flag_duplicates(batch, None, ["seq"])
    salted = bronze.flag_duplicates(batch, None, ["seq"], allow_broadcast=False, heavy_rows=50, salts=8)
    assert flags(plain) == flags(salted)
    assert plain.count() == 600
    assert plain.filter((F.col("event_id") == "hot") & ~F.col("is_duplicate")).count() == 1


def test_missing_event_id_column_is_an_error(spark):
    with pytest.raises(ValueError):
        bronze.flag_duplicates(spark.range(1), None, ["id"])
    with pytest.raises(ValueError):
        bronze.repair_flags(spark.range(1), ["id"])


def test_repair_across_files(spark):
    schema = "event_id string, batch_id string, ingestion_timestamp string, bronze_file string, row int"
    stored = spark.createDataFrame([
        ("evt-1", "batch-1", "2026-01-01T00:00:00Z", "day1", 0),
        (None, "batch-1", "2026-01-01T00:00:01Z", "day1", 1),
        ("evt-1", "batch-2", "2026-01-02T00:00:00Z", "day2", 0),
        ("evt-1", "batch-1", None, "day1", 2),
    ], schema)
    fixed = bronze.repair_flags(stored, ["bronze_file", "row"])
    got = {(r.bronze_file, r.row): (r.duplicate_reason, r.duplicate_first_seen_batch_id) for r in fixed.collect()}
    assert got == {
        ("day1", 0): (None, None), ("day1", 1): ("missing_event_id", None),
        ("day2", 0): ("seen_in_bronze", "batch-1"),
        ("day1", 2): ("repeated_in_batch", "batch-1"),  # unknown time comes last
    }
    summary = bronze.repair_summary(fixed).first()
    assert (summary.files, summary.rows, summary.distinct_event_ids, summary.flagged) == (2, 4, 1, 3)


def test_metadata_is_one_per_batch(spark):
    stamped = bronze.add_metadata(spark.range(5), "a.json")
    assert stamped.select("batch_id", "ingestion_timestamp", "source_file", "ingestion_date").distinct().count() == 1
    assert len(stamped.first().batch_id) == 8
    with pytest.raises(ValueError):
        bronze.add_metadata(spark.range(1), "a.json", "a/b")


def test_end_to_end(spark, folder):
    """Four raw events, one a copy: three Silver rows, two users, one day, three event types."""
    import datetime as dt

    from paylake import batch
    from paylake.config import Settings
    from paylake.plans.answers import for_chart, for_intent
    from paylake.sources import dated

    write_raw(f"{folder}/raw.json")
    settings = Settings(as_of=dt.date(2026, 1, 11), fx_rate=0.00025)
    gold = batch.run(spark, folder, settings, f"{folder}/raw.json")
    stored = files.read_bronze(spark, f"{folder}/bronze/events").drop(*files.BRONZE_ORDER)
    silver = dated.read(spark, f"{folder}/silver/events")
    log = spark.read.option("header", True).csv(f"{folder}/logs/duplicates")
    assert len(stored.columns) == 44 and stored.count() == 4
    assert [r.duplicate_reason for r in log.collect()] == ["repeated_in_batch"]
    assert len(silver.columns) == 40 and silver.count() == 3
    assert silver.select("event_id").distinct().count() == 3
    assert {n: t.count() for n, t in gold.items()} == {
        "gold_user_360": 2, "gold_daily_metrics": 1, "gold_event_summary": 3}
    user = gold["gold_user_360"].filter("user_id = 'user_2'").first()
    assert (user.total_amount_cop, user.total_amount_usd, user.failure_rate, user.days_since_last_tx) == \
        (200000.0, 50.0, 0.5, 10)
    assert spark.sql("SELECT count(*) FROM gold_user_360").first()[0] == 2
    assert for_intent("segment", gold).first().usuarios == 2
    assert for_intent("event", gold).count() == 3 and for_intent("daily", gold).count() == 1
    assert for_intent(None, gold) is None and for_chart("ciudad", None, gold) is None
    assert for_chart("ciudad", "usuarios", gold).first().usuarios == 2

    again = batch.run(spark, folder, settings, f"{folder}/raw.json")  # the same file as a second batch
    assert files.read_bronze(spark, f"{folder}/bronze/events").filter("duplicate_reason = 'seen_in_bronze'").count() == 4
    assert sorted(map(str, again["gold_user_360"].collect())) == sorted(map(str, gold["gold_user_360"].collect()))
    kept = batch.run(spark, folder, settings, f"{folder}/raw.json", from_silver=True)
    assert kept["gold_user_360"].count() == 2 and files.read_bronze(spark, f"{folder}/bronze/events").count() == 8


def test_both_batches_are_written_with_the_columns_that_are_read(spark, folder):
    events = [(n, n % 7, ("signup", "purchase", "click", "view", "error")[n % 5], n / 8, '{"k": %d}' % n) for n in range(300)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.lit("2024-01-05 10:00:00").cast("timestamp")).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(k, f"name{k}", k % 2, 1.5, "seg") for k in range(6)], "c_custkey long, c_name string, "
                          "c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    whole, narrow = tables.bronze_all(spark, folder), tables.bronze_all(spark, folder, fv.BRONZE_REQUIRED)
    flags = ["duplicate_reason", "duplicate_first_seen_batch_id", "duplicate_first_seen_file", "is_duplicate"]
    assert sorted(narrow.columns) == sorted(
        ["event_id", "ingestion_timestamp", "batch_id", "source_file", "bronze_file", "seq", *flags])
    rows = sorted(map(str, narrow.collect()))
    assert rows == sorted(map(str, whole.select(*narrow.columns).collect())) and len(rows) > 300
    assert checks.check_bronze(narrow).collect() == checks.check_bronze(whole).collect()
    assert checks.check_bronze(narrow).first().missing_columns == ""
