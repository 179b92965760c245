import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paylake.config import Settings
from paylake.operators import bronze, silver
from paylake.sources import dated, files
from paylake.streaming import ingest, refresh
from tests.events import RAW_CASES, raw_event

SETTINGS = Settings(as_of=dt.date(2026, 1, 31), fx_rate=0.00025)


def send(path, name, items):
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as out:
        out.writelines(json.dumps(i) + "\n" for i in items)


def drain(spark, folder, name="bronze", per_trigger=1):
    query = ingest.start(ingest.read_messages(spark, f"{folder}/in", per_trigger), f"{folder}/bronze",
                         f"{folder}/checkpoint", name)
    query.awaitTermination()
    return query


def test_mixed_batch_goes_to_one_place_per_type(spark, folder):
    send(f"{folder}/in", "a", [raw_event(), {"msg_type": "metric", "source": "job", "data": {"name": "gmv", "value": 1,
                                                                                          "nested": {"x": 1}}}])
    query = drain(spark, folder)
    roots = ingest.bronze_roots(f"{folder}/bronze")
    events = files.read_bronze(spark, roots["events"])
    metric = spark.read.parquet(roots["messages"]).first()
    assert (events.count(), events.first().event_id, events.first().source_file) == (1, "evt-1", "bus_stream")
    assert (metric.msg_route, metric.data_fields, metric.source_file) == (
        "metric", {"name": "gmv", "value": "1"}, "bus_stream_metric")
    assert json.loads(metric.raw_data)["nested"] == {"x": 1}
    assert ingest.progress(query) == {"batches": 1, "messages": 2}


def test_duplicates_across_micro_batches_and_restarts(spark, folder):
    send(f"{folder}/in", "a", [raw_event("e1"), raw_event("e1"), raw_event(None)])
    drain(spark, folder)
    send(f"{folder}/in", "b", [raw_event("e1"), raw_event("e2")])
    drain(spark, folder)
    stored = files.read_bronze(spark, ingest.bronze_roots(f"{folder}/bronze")["events"])
    got = sorted((str(r.event_id), str(r.duplicate_reason)) for r in stored.collect())
    assert got == [("None", "missing_event_id"), ("e1", "None"), ("e1", "repeated_in_batch"),
                   ("e1", "seen_in_bronze"), ("e2", "None")]


def test_a_replayed_batch_changes_nothing(spark, folder):
    send(f"{folder}/in", "a", [raw_event("e1"), raw_event("e2")])
    batch = spark.read.schema(ingest.MESSAGE).json(f"{folder}/in").select(
        "*", F.lit("f").alias("in_file"), F.lit(0).alias("in_block"),
        F.lit(dt.datetime(2026, 1, 1)).alias("received_at"))
    for _ in range(2):
        ingest.store_batch(batch, "q-00000000", f"{folder}/bronze")
    stored = files.read_bronze(spark, f"{folder}/bronze/events")
    assert [(r.event_id, r.is_duplicate) for r in stored.orderBy("event_id").collect()] == [("e1", False), ("e2", False)]


def test_stream_equals_batch(spark, folder):
    for i, case in enumerate(RAW_CASES):
        send(f"{folder}/in", f"f{i}", [raw_event(*case)])
    drain(spark, folder, per_trigger=2)
    refresh.rebuild(spark, f"{folder}/bronze/events", f"{folder}/silver", f"{folder}/gold", SETTINGS)
    streamed = refresh.read_published_gold(spark, f"{folder}/gold")

    with open(f"{folder}/raw.json", "w") as out:
        json.dump([raw_event(*case) for case in RAW_CASES], out)
    flat = bronze.flatten(files.read_raw(spark, f"{folder}/raw.json"), keep=tuple(files.RAW_ORDER))
    flagged = bronze.flag_duplicates(bronze.add_metadata(flat, "raw.json"), None, files.RAW_ORDER)
    batch = refresh.build_gold(silver.build_silver(flagged, SETTINGS, files.RAW_ORDER), SETTINGS)
    for name, table in batch.items():
        assert {tuple(r) for r in streamed[name].collect()} == {tuple(r) for r in table.collect()}


def test_late_rows_refresh_equals_rebuild(spark, folder, monkeypatch):
    """Late copies, a new user, a row without id, a row without a date, and an older first event."""
    root = f"{folder}/bronze"
    first = [raw_event("e1", "u1"), raw_event("e2", "u2", timestamp="2026-01-02T00:00:00Z"),
             raw_event(None, "u3"), raw_event("e4", "u4", timestamp="bad")]
    late = [raw_event("e1", "u1"), raw_event("e5", "u1", timestamp="2025-12-31T00:00:00Z", city="Cali"),
            raw_event(None, "u3"), raw_event("e6", "u5", timestamp="2026-01-02T05:00:00Z"),
            raw_event("e7", "u4", timestamp="bad")]
    later = [raw_event("e5", "u1"), raw_event("e8", "u1", timestamp="2026-01-09T00:00:00Z")]

    def store(items, batch_id, day):
        send(f"{folder}/{batch_id}", "x", items)
        raw = files.read_raw(spark, f"{folder}/{batch_id}", multi_line=False)
        flat = bronze.add_metadata(bronze.flatten(raw, keep=tuple(files.RAW_ORDER)), "x", batch_id, day)
        known = None
        if batch_id != "b1":
            known = bronze.first_seen(files.read_bronze_ids(spark, root), files.BRONZE_ORDER)
        flagged = bronze.flag_duplicates(flat, known, files.RAW_ORDER)
        files.write_bronze(flagged.drop(*files.RAW_ORDER), root)

    store(first, "b1", dt.datetime(2026, 2, 1, tzinfo=dt.timezone.utc))
    def run():
        return refresh.refresh_published(spark, root, f"{folder}/silver", f"{folder}/gold", SETTINGS)

    assert run() == ["b1"] and run() == []
    store(late, "b2", dt.datetime(2026, 2, 2, tzinfo=dt.timezone.utc))
    with monkeypatch.context() as broken:  # stops before anything is replaced
        broken.setattr(refresh, "_rebuilt", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    with monkeypatch.context() as broken:  # Silver is replaced, then publishing Gold fails
        broken.setattr(refresh.snapshots, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    store(later, "b3", dt.datetime(2026, 2, 3, tzinfo=dt.timezone.utc))
    assert run() == ["b3"]  # b2 is finished first
    with monkeypatch.context() as lost:  # taken in once more, as if its record had been lost: nothing changes
        lost.setattr(refresh.dated, "applied", lambda *_: spark.createDataFrame([("b1",), ("b3",)], "batch_id string"))
        assert run() == ["b2"]
    refreshed = refresh.read_published_gold(spark, f"{folder}/gold")
    stored_silver = dated.read(spark, f"{folder}/silver")

    refresh.rebuild(spark, root, f"{folder}/full_silver", f"{folder}/full_gold", SETTINGS)
    full = refresh.read_published_gold(spark, f"{folder}/full_gold")
    full_silver = dated.read(spark, f"{folder}/full_silver")
    columns = sorted(full_silver.columns)
    assert sorted(map(str, stored_silver.select(columns).collect())) == sorted(map(str, full_silver.select(columns).collect()))
    for name, table in full.items():
        assert sorted(map(str, refreshed[name].select(table.columns).collect())) == sorted(map(str, table.collect()))


@pytest.mark.parametrize("seconds,force,due", [(None, False, True), (59, False, False), (60, False, True), (1, True, True)])
def test_refresh_interval(seconds, force, due):
    now = dt.datetime(2026, 1, 1, 12)
    last = None if seconds is None else now - dt.timedelta(seconds=seconds)
    assert refresh.refresh_due(last, now, 60, force) is due


def test_refresh_after_batches(spark, folder):
    """Two micro-batches inside the interval refresh once; the final forced one sees everything."""
    root = ingest.bronze_roots(f"{folder}/bronze")["events"]
    refresher = refresh.Refresher(root, f"{folder}/silver", f"{folder}/gold", SETTINGS)
    send(f"{folder}/in", "a", [raw_event("e1", "u1")])
    send(f"{folder}/in", "b", [raw_event("e2", "u2")])
    ingest.start(ingest.read_messages(spark, f"{folder}/in", 1), f"{folder}/bronze", f"{folder}/checkpoint",
                 "refreshed", after_batch=refresher).awaitTermination()
    assert (refresher.runs, refresher.errors) == (1, 0)
    assert refresh.read_published_gold(spark, f"{folder}/gold")["gold_user_360"].count() == 1
    assert refresher(spark) is False and refresher(spark, force=True) is True
    assert refresh.read_published_gold(spark, f"{folder}/gold")["gold_user_360"].count() == 2


def test_failed_refresh_is_counted_and_tried_again(spark, folder):
    refresher = refresh.Refresher(f"{folder}/none", f"{folder}/silver", f"{folder}/gold", SETTINGS)
    assert refresher(spark) is False and refresher(spark) is False
    assert (refresher.runs, refresher.errors, refresher.last_run) == (0, 2, None)


def test_a_broken_line_is_kept_as_text(spark, folder):
    send(f"{folder}/in", "a", [raw_event("e1")])
    with open(f"{folder}/in/b.json", "w") as out:
        out.write('{"msg_type": "log", "data": {"a"\nnot json\n')
    drain(spark, folder, per_trigger=2)
    roots = ingest.bronze_roots(f"{folder}/bronze")
    assert files.read_bronze(spark, roots["events"]).count() == 1
    kept = spark.read.parquet(roots["messages"])
    assert sorted(r.raw_data for r in kept.collect()) == ["not json", '{"msg_type": "log", "data": {"a"']
    assert {(r.msg_route, r.is_valid) for r in kept.collect()} == {("unknown", False)}


def test_log_records_are_messages(spark):
    value = json.dumps({"msg_type": "metric", "source": "job", "data": {"value": 1}})
    legacy = json.dumps(raw_event("e1"))
    records = spark.createDataFrame([(value.encode(), "t", 0, 5), (legacy.encode(), "t", 1, 6), (b"oops", "t", 1, 7)],
                                    "value binary, topic string, partition int, offset long")
    a, b, c = ingest.parse_records(records).orderBy("in_block").collect()
    assert (a.msg_type, json.loads(a.data), a.in_file, a.in_block) == ("metric", {"value": 1}, "t-0", 5)
    assert json.loads(b.detail)["id"] == "e1" and c.data == "oops"


def test_a_new_checkpoint_does_not_overwrite_batches(spark, folder):
    send(f"{folder}/in", "a", [raw_event("e1")])
    for checkpoint in ("one", "two"):
        ingest.start(ingest.read_messages(spark, f"{folder}/in"), f"{folder}/bronze", f"{folder}/{checkpoint}",
                     "same").awaitTermination()
    stored = files.read_bronze(spark, f"{folder}/bronze/events")
    assert stored.select("batch_id").distinct().count() == 2
    assert sorted(str(r.duplicate_reason) for r in stored.collect()) == ["None", "seen_in_bronze"]


def test_a_refresh_follows_a_batch_run_and_a_stopped_first_run_resumes(spark, folder, monkeypatch):
    from paylake import batch

    def raw(name, *cases):
        with open(f"{folder}/{name}.json", "w") as out:
            json.dump([raw_event(*case) for case in cases], out)
        return f"{folder}/{name}.json"

    roots = f"{folder}/bronze/events", f"{folder}/silver/events", f"{folder}/gold"
    with monkeypatch.context() as broken:   # Silver is published, Gold is not
        broken.setattr(refresh.snapshots, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            batch.run(spark, folder, SETTINGS, raw("one", ("e1", "u1"), ("e2", "u2")))
    assert refresh.refresh_published(spark, *roots, SETTINGS) == []
    assert refresh.read_published_gold(spark, roots[2])["gold_user_360"].count() == 2
    batch.ingest(spark, raw("two", ("e2", "u2"), ("e3", "u3")), roots[0], batch_id="late")
    assert refresh.refresh_published(spark, *roots, SETTINGS) == ["late"]
    refreshed = refresh.read_published_gold(spark, roots[2])
    refresh.rebuild(spark, roots[0], f"{folder}/s", f"{folder}/g", SETTINGS)
    for name, table in refresh.read_published_gold(spark, f"{folder}/g").items():
        assert sorted(map(str, refreshed[name].select(table.columns).collect())) == sorted(map(str, table.collect()))
    before = sorted(map(str, dated.read(spark, roots[1]).collect()))
    assert dated.expire(spark, roots[1], keep=1) <= 1 and sorted(map(str, dated.read(spark, roots[1]).collect())) == before
