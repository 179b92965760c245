import json
import os

from glob import glob

import pytest
from pyspark.sql import functions as F

from paylake import fixed_values as fv
from paylake.operators import bronze
from paylake.session import work_dir
from paylake.sources import catalog, commits, dated, files, id_index, snapshots, storage
from tests.events import write_raw


def batch(spark, ids, batch_id="b1", day="2026-01-01"):
    rows = [(e, batch_id, f"{day}T00:00:00Z", "f.json", day, i) for i, e in enumerate(ids)]
    return spark.createDataFrame(
        rows, "event_id string, batch_id string, ingestion_timestamp string, source_file string, "
              "ingestion_date string, seq int")


def test_writing_a_batch_again_replaces_it(spark, folder):
    for _ in range(2):
        files.write_bronze(batch(spark, ["a", "b"], "12345678"), f"{folder}/b")
    files.write_bronze(batch(spark, ["c"], "1e5", "2026-01-02"), f"{folder}/b")
    stored = files.read_bronze(spark, f"{folder}/b")
    assert sorted((r.event_id, r.batch_id, r.ingestion_date) for r in stored.collect()) == [
        ("a", "12345678", "2026-01-01"), ("b", "12345678", "2026-01-01"), ("c", "1e5", "2026-01-02")]
    ids = files.read_bronze_ids(spark, f"{folder}/b", without_batch="12345678")
    assert [r.event_id for r in ids.collect()] == ["c"]


def test_batch_ids_of_digits_stay_text(spark, folder):
    for i, name in enumerate(("007", "7", "1e5")):
        files.write_bronze(batch(spark, [f"e{i}"], name), f"{folder}/b")
    assert sorted(r.batch_id for r in files.bronze_batches(spark, f"{folder}/b").collect()) == ["007", "1e5", "7"]
    assert [r.event_id for r in files.read_bronze(spark, f"{folder}/b", ["007"]).collect()] == ["e0"]
    assert files.read_bronze_ids(spark, f"{folder}/b", "7").count() == 2


def test_no_bronze_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.read_bronze(spark, f"{folder}/nothing")


def test_files_without_ids_match_nothing(spark, folder):
    root = f"{folder}/b"
    files.write_bronze(batch(spark, ["a"]), root)
    batch(spark, ["z"]).drop("event_id").write.parquet(f"{root}/in_day=2026-01-03/in_batch=b_x")
    known = bronze.first_seen(files.read_bronze_ids(spark, root), files.BRONZE_ORDER)
    assert [(r.event_key, r.batch_id) for r in known.collect()] == [("a", "b1")]


@pytest.mark.parametrize("read", [files.read_bronze, files.read_bronze_ids])
def test_a_damaged_file_is_an_error(spark, folder, read):
    root = f"{folder}/b"
    files.write_bronze(batch(spark, ["a"]), root)
    os.makedirs(f"{root}/in_day=2026-01-04/in_batch=b_y")
    with open(f"{root}/in_day=2026-01-04/in_batch=b_y/bad.parquet", "w") as out:
        out.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read(spark, root).collect()


def test_columns_of_all_files_are_united(spark, folder):
    files.write_bronze(batch(spark, ["a"]), f"{folder}/b")
    files.write_bronze(batch(spark, ["b"], "b2").selectExpr("*", "'x' AS extra"), f"{folder}/b")
    stored = files.read_bronze(spark, f"{folder}/b")
    assert {r.event_id: r.extra for r in stored.collect()} == {"a": None, "b": "x"}


def test_no_footer_is_opened_to_plan_a_read(spark, folder):
    """Planning does not notice a damaged file, reading does; the log has one entry per schema, not per batch."""
    root = f"{folder}/b"
    for n in range(5):
        files.write_bronze(batch(spark, ["a"], f"b{n}"), root)
    files.write_bronze(batch(spark, ["b"], "b9").selectExpr("*", "1.5D AS extra"), root)
    assert len(os.listdir(f"{folder}/b_schema")) <= 4          # with the file system's checksum files
    os.makedirs(f"{root}/in_day=2026-01-04/in_batch=b_y")
    with open(f"{root}/in_day=2026-01-04/in_batch=b_y/bad.parquet", "w") as out:
        out.write("not parquet")
    planned = files.read_bronze(spark, root)
    assert planned.columns[-3:] == ["extra", "bronze_file", "bronze_row"] and "Scan" in planned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        planned.collect()
    with pytest.raises(ValueError, match="extra"):
        files.write_bronze(batch(spark, ["c"], "b10").selectExpr("*", "'x' AS extra"), root)
        files.read_bronze(spark, root)


def test_raw_order_follows_the_array(spark, folder):
    write_raw(f"{folder}/raw.json", [(f"e{i}",) for i in range(20)])
    raw = files.read_raw(spark, f"{folder}/raw.json").orderBy(*files.RAW_ORDER)
    assert [r.detail.id for r in raw.collect()] == [f"e{i}" for i in range(20)]


def test_duplicate_log(spark, folder):
    clean = bronze.flag_duplicates(batch(spark, ["a"]), None, ["seq"])
    assert files.write_duplicate_log(clean, f"{folder}/log") is None and not os.path.exists(f"{folder}/log")
    dirty = bronze.flag_duplicates(batch(spark, ["a", " a"]), None, ["seq"])
    for name in ("one", "two"):
        files.write_duplicate_log(dirty, f"{folder}/log", name)
    assert sorted(os.listdir(f"{folder}/log")) == ["batch=one", "batch=two"]
    log = spark.read.option("header", True).csv(f"{folder}/log/batch=one")
    assert log.columns == ["event_id", "batch_id", "ingestion_timestamp", "duplicate_reason",
                           "duplicate_first_seen_batch_id", "duplicate_first_seen_file"]
    assert log.first().event_id == " a"


def test_snapshots(spark, folder):
    path = f"{folder}/t"
    assert snapshots.resolve_latest(spark, path) == path
    first = snapshots.publish(spark.range(3), path)
    second = snapshots.publish(spark.range(5), path)
    assert snapshots.resolve_latest(spark, path) == second
    assert snapshots.read_latest(spark, path).count() == 5
    assert sorted(r.rows for r in snapshots.history(spark, path).collect()) == [3, 5]
    from paylake.sources.storage import delete

    delete(spark, second)
    assert snapshots.resolve_latest(spark, path) == first
    assert snapshots.read_latest(spark, path).count() == 3
    snapshots.publish(spark.range(1), path)
    assert snapshots.expire(spark, path, keep=1) == 1
    assert snapshots.read_latest(spark, path).count() == 1
    with open(f"{path}/_commits/c_0000000009.json", "w") as out:   # never an older version in place of one that cannot be read
        out.write("{broken\n")
    with pytest.raises(ValueError, match="unreadable"):
        snapshots.read_latest(spark, path)


def test_old_versions_go_with_new_ones(spark, folder):
    path = f"{folder}/t"
    for n in range(1, 7):
        snapshots.publish(spark.range(n), path)
    assert len(os.listdir(f"{path}/_versions")) == snapshots.KEEP == snapshots.history(spark, path).count()
    assert snapshots.read_latest(spark, path).count() == 6


def test_two_writers_cannot_both_win(spark, folder, monkeypatch):
    """The second one publishes between the first one's start and its commit."""
    path = f"{folder}/t"
    snapshots.publish(spark.range(1), path)
    real, turns = commits.commit, []

    def other_first(session, root, *rest):
        if not turns:
            turns.append(1)
            snapshots.publish(spark.range(2), path)
        return real(session, root, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", other_first)
        with pytest.raises(commits.Conflict):
            snapshots.publish(spark.range(3), path)
    assert snapshots.read_latest(spark, path).count() == 2 and len(os.listdir(f"{path}/_versions")) == 2
    snapshots.publish(spark.range(3), path)
    assert snapshots.read_latest(spark, path).count() == 3
    assert not storage.create_new(spark, f"{path}/_commits/c_0000000003.json", "late")


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "date date, n int")


def test_publications_keep_untouched_days_and_go_when_old(spark, folder):
    import datetime as dt

    root, one, two = f"{folder}/d", dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    taken = lambda n: spark.createDataFrame([(f"b{n}",)], "batch_id string")
    dated.publish(days(spark, (one, 1), (two, 1), (None, 1)), root, taken(0))
    for n in range(1, 20):
        dated.publish(days(spark, (two, n)), root, taken(n), touched=[two])
    got = sorted((str(r.date), r.n) for r in dated.read(spark, root).collect())
    assert got == [("2026-01-01", 1), ("2026-01-02", 19), ("None", 1)]
    assert sorted(r.batch_id for r in dated.applied(spark, root).collect()) == sorted(f"b{n}" for n in range(20))
    assert len(os.listdir(f"{root}/applied")) <= dated.MERGED + 1 + dated.KEEP
    assert len(commits.numbers(spark, root)) == dated.KEEP
    assert len(os.listdir(f"{root}/data")) <= dated.KEEP + 1
    assert [r.n for r in dated.read(spark, root, only=[two]).collect()] == [19]
    assert dated.read(spark, root, only=[], schema="n int, date date").collect() == []
    dated.publish(days(spark), root, taken(20), touched=[one])
    assert sorted(str(r.date) for r in dated.read(spark, root).collect()) == ["2026-01-02", "None"]


def test_a_publication_that_lost_changes_nothing(spark, folder, monkeypatch):
    import datetime as dt

    root, day, none = f"{folder}/d", dt.date(2026, 1, 1), spark.createDataFrame([], "batch_id string")
    dated.publish(days(spark, (day, 1)), root, none)
    real, turns = commits.commit, []

    def other_first(session, base, *rest):
        if not turns:
            turns.append(1)
            dated.publish(days(spark, (day, 2)), root, none, touched=[day])
        return real(session, base, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", other_first)
        with pytest.raises(commits.Conflict):
            dated.publish(days(spark, (day, 3)), root, none, touched=[day])
    assert [r.n for r in dated.read(spark, root).collect()] == [2]


# --- The index of ids --------------------------------------------------------------------------------


def indexed(spark, root, ids, batch_id, day="2026-01-01"):
    id_index.begin(spark, root, batch_id)
    files.write_bronze(batch(spark, ids, batch_id, day).withColumn("timestamp", F.lit("2026-01-05T10:00:00Z")), root)
    id_index.finish(spark, root, batch_id)


def asked(spark, root, ids, **kwargs):
    found = id_index.lookup(spark, root, spark.createDataFrame([(i,) for i in ids], "event_key string"), **kwargs)
    return sorted((r.event_key, r.batch_id, r.n, [str(d) for d in r.dates]) for r in found.collect())


def test_the_index_knows_first_places_copies_and_dates(spark, folder):
    root = f"{folder}/b"
    assert asked(spark, root, ["a"]) == []
    indexed(spark, root, ["a", " a ", "b", None, " "], "b1")
    indexed(spark, root, ["a", "c"], "b2", "2026-01-02")
    assert asked(spark, root, ["a", "c", "z"]) == [
        ("a", "b1", 2, ["2026-01-05"]), ("a", "b2", 1, ["2026-01-05"]), ("c", "b2", 1, ["2026-01-05"])]
    assert asked(spark, root, ["a"], without_batch="b1") == [("a", "b2", 1, ["2026-01-05"])]
    entries = id_index.lookup(spark, root, spark.createDataFrame([("a",)], "event_key string"))
    seen = id_index.first_seen(entries).first()
    assert seen.batch_id == "b1" and seen.bronze_file.endswith("/in_day=2026-01-01/in_batch=b_b1")
    same = bronze.first_seen(files.read_bronze_ids(spark, root), files.BRONZE_ORDER).filter("event_key = 'a'").first()
    assert seen.asDict() == same.asDict()


def test_a_lookup_opens_matching_buckets_only(spark, folder, monkeypatch):
    root = f"{folder}/b"
    indexed(spark, root, [f"e{i}" for i in range(300)], "b1")
    opened, real = [], id_index._read

    def watched(session, base, number, columns, wanted):
        df = real(session, base, number, columns, wanted)
        opened.append((columns, sorted({f.split("bucket=")[1].split("/")[0] for f in df.inputFiles()}, key=int)))
        return df

    monkeypatch.setattr(id_index, "_read", watched)
    assert [r[0] for r in asked(spark, root, ["e7"])] == ["e7"]
    bucket = spark.sql(f"SELECT pmod(xxhash64('e7'), {id_index.FIRST_BUCKETS})").first()[0]
    assert [files_of for _, files_of in opened] == [[str(bucket)]] * 2 and opened[0][0] == "hash long"
    opened.clear()
    assert asked(spark, root, ["new-id"]) == [] and opened[1][1] == []   # no entry is read for an unknown id


def test_the_index_finishes_what_stopped_and_merges(spark, folder, monkeypatch):
    root = f"{folder}/b"
    indexed(spark, root, ["a"], "b1")
    id_index.begin(spark, root, "b2")                       # stopped after Bronze was written
    files.write_bronze(batch(spark, ["a", "x"], "b2"), root)
    id_index.begin(spark, root, "gone")                     # stopped before
    assert [r[:2] for r in asked(spark, root, ["x"])] == [("x", "b2")]
    indexed(spark, root, ["y"], "b3")
    files.write_bronze(batch(spark, ["by-hand"], "b4"), root)
    id_index.ensure(spark, root)
    everything = asked(spark, root, ["a", "x", "y", "by-hand"])
    assert [r[:2] for r in everything] == [("a", "b1"), ("a", "b2"), ("by-hand", "b4"), ("x", "b2"), ("y", "b3")]
    with monkeypatch.context() as stopped:                  # entries are there twice when a merge stops
        stopped.setattr(id_index, "delete", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            id_index.merge(spark, root)
    assert asked(spark, root, ["a", "x", "y", "by-hand"]) == everything
    id_index.merge(spark, root)
    assert asked(spark, root, ["a", "x", "y", "by-hand"]) == everything
    assert all(len(glob(f"{p}/in_batch=*")) == 1 for p in glob(f"{root}_ids/rows_16/bucket=*"))
    monkeypatch.setattr(id_index, "MERGE_AFTER", 0)
    monkeypatch.setattr(id_index, "BUCKET_ENTRIES", 0.1)   # as if the index had outgrown its buckets
    indexed(spark, root, ["z", "a"], "b5")
    assert [r[:2] for r in asked(spark, root, ["a", "z"])] == [("a", "b1"), ("a", "b2"), ("a", "b5"), ("z", "b5")]
    assert id_index.buckets(spark, root) > 16 and not os.path.exists(f"{root}_ids/rows_16")


def test_repair_names_folders_that_exist_and_leaves_untouched_batches(spark, folder):
    root = f"{folder}/b"
    for n, ids in enumerate((["a", "b"], ["c"], ["a", "d", "d"]), 1):
        files.write_bronze(bronze.flag_duplicates(batch(spark, ids, f"b{n}", f"2026-01-0{n}"), None, ["seq"]).drop("seq"), root)
    stamp = lambda n: {p: os.stat(p).st_mtime_ns for p in glob(f"{root}/in_day=2026-01-0{n}/*/*.parquet")}
    before = [stamp(n) for n in (1, 2, 3)]
    files.repair_bronze(spark, root, dry_run=False)
    assert [stamp(n) for n in (1, 2)] == before[:2] and stamp(3) != before[2]
    rows = files.read_bronze(spark, root).collect()
    named = {r.duplicate_first_seen_file for r in rows} - {None}
    assert named and all(os.path.isdir(n.removeprefix("file:")) for n in named)
    assert sorted((r.event_id, r.duplicate_reason) for r in rows if r.is_duplicate) == [
        ("a", "seen_in_bronze"), ("d", "repeated_in_batch")]


def test_replacing_a_table_while_it_is_read(spark, folder):
    path = f"{folder}/t"
    snapshots.publish(spark.range(3), path)
    old = snapshots.read_latest(spark, path)
    snapshots.publish(old.selectExpr("id + 1 AS id"), path)
    assert old.count() == 3 and snapshots.read_latest(spark, path).agg({"id": "sum"}).first()[0] == 6


def test_export_counts_good_and_bad(spark, folder):
    snapshots.publish(spark.range(3), f"{folder}/good")
    got = snapshots.export_layer(spark, {"good": f"{folder}/good", "bad": f"{folder}/none"}, "silver", f"{folder}/out")
    assert {r.object: (r.ok, r.rows) for r in got.collect()} == {"silver/good": (True, 3), "silver/bad": (False, None)}
    assert spark.read.parquet(f"{folder}/out/silver/good").count() == 3


def test_null_tokens(spark):
    df = spark.createDataFrame([("NaN", 1), ("None", 2), ("", 3), ("ok", 4), (None, 5)], "s string, n int")
    assert [r.s for r in files.null_tokens_to_null(df).orderBy("n").collect()] == [None, None, None, "ok", None]


def test_catalog(spark, folder):
    catalog.publish_table(spark.createDataFrame([("nan",), ("x",)], "event string"), "t_events", f"{folder}/c")
    assert sorted(str(r.event) for r in spark.table("t_events").collect()) == ["None", "x"]
    assert catalog.query(spark, "SELECT event FROM t_events", max_rows=1).count() == 1
    ready = {r.table: r for r in catalog.readiness(spark, {"gold_event_summary": "t_events"}).collect()}
    assert ready["gold_event_summary"].present and ready["gold_event_summary"].rows == 2
    assert ready["gold_event_summary"].missing_columns == "count,success_count,failed_count,pct_of_total"
    assert not ready["gold_user_360"].present
    assert ready["gold_user_360"].missing_columns.split(",") == list(fv.USER_360_COLUMNS)


def test_work_dir_is_below_the_named_folder(spark):
    path = work_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and path != work_dir(spark, "x")


def test_raw_input_that_is_no_json_is_an_error(spark, folder):
    from tests.events import raw_event

    wrong_type = raw_event("e1")
    wrong_type["detail"]["payload"]["age"] = "old"
    with open(f"{folder}/raw.json", "w") as out:
        out.write(json.dumps(wrong_type) + "\n")
    flat = bronze.flatten(files.read_raw(spark, f"{folder}/raw.json", multi_line=False))
    assert [(r.event_id, r.user_age, r.amount) for r in flat.collect()] == [("e1", None, "100000.0")]
    with open(f"{folder}/raw.json", "a") as out:
        out.write("{oops\n")
    with pytest.raises(Exception, match="not a JSON event"):
        bronze.flatten(files.read_raw(spark, f"{folder}/raw.json", multi_line=False)).collect()


@pytest.mark.parametrize("master,allowed", [("local[4]", True), ("yarn", False)])
def test_without_a_shared_folder_only_local_sessions_work(master, allowed):
    from types import SimpleNamespace

    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))
    if allowed:
        one, two = work_dir(session, "x"), work_dir(session, "x")
        assert one != two and os.path.dirname(one) == os.path.dirname(two)
    else:
        with pytest.raises(ValueError):
            work_dir(session, "x")
