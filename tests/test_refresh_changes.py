"""Gold by retraction: refreshes after random batches equal a rebuild, and read nothing that the batches do not touch."""

import datetime as dt
import random

from paylake.config import Settings
from paylake.operators import bronze
from paylake.sources import dated, files, id_index, snapshots
from paylake.streaming import partials, refresh
from tests.events import raw_event

SETTINGS = Settings(as_of=dt.date(2026, 1, 31), fx_rate=0.00025)


def store(spark, folder, items, batch_id, day):
    """A batch flagged against nothing, so that a later batch with an earlier time can replace rows."""
    import json
    import os

    os.makedirs(f"{folder}/{batch_id}")
    with open(f"{folder}/{batch_id}/x.json", "w") as out:
        out.writelines(json.dumps(i) + "\n" for i in items)
    raw = files.read_raw(spark, f"{folder}/{batch_id}", multi_line=False)
    at = dt.datetime(2026, 2, day, tzinfo=dt.timezone.utc)
    flat = bronze.add_metadata(bronze.flatten(raw, keep=tuple(files.RAW_ORDER)), "x", batch_id, at)
    files.write_bronze(bronze.flag_duplicates(flat, None, files.RAW_ORDER).drop(*files.RAW_ORDER), f"{folder}/bronze")


def random_events(pick, n):
    out = []
    for _ in range(n):
        stamp = pick.choice(["bad", *(f"2026-01-0{d}T0{h}:00:00Z" for d in range(1, 6) for h in range(4))])
        out.append(raw_event(pick.choice([None, *(f"e{i}" for i in range(20))]), pick.choice([None, "u1", "u2", "u3", "u4"]),
                             pick.choice(["PAYMENT_MADE", "PAYMENT_FAILED", "USER_REGISTERED", "PURCHASE_MADE"]),
                             pick.choice(["SUCCESS", "FAILED"]), pick.choice([1.25, 10.0, None]), stamp, pick.choice(["Cali", "Bogota", None])))
        payload = out[-1]["detail"]["payload"]
        payload |= {"merchant": pick.choice(["A", "B", None]), "name": pick.choice([None, "Ana", "Eva"]),
                    "age": pick.choice([None, 20, 30]), "balanceAfter": pick.choice([None, 5.5, 7.0])}
    return out


def published(spark, root):
    tables = refresh.read_published_gold(spark, root)
    return {name: sorted(map(str, t.select(sorted(t.columns)).collect())) for name, t in tables.items()}


def test_refreshes_after_random_batches_equal_a_rebuild(spark, folder, monkeypatch):
    monkeypatch.setattr(partials, "KEPT", 2)      # withdrawn candidates run out, and Silver is asked
    refills, real = [], partials.refilled
    monkeypatch.setattr(partials, "refilled", lambda *a: refills.append(1) or real(*a))
    pick = random.Random(18)
    roots = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    for n, day in enumerate((20, 10, 15)):        # later batches have earlier times: their rows replace older ones
        store(spark, folder, random_events(pick, 40), f"b{n}", day)
        assert refresh.refresh_published(spark, *roots, SETTINGS) == [f"b{n}"]
    refresh.rebuild(spark, roots[0], f"{folder}/s", f"{folder}/g", SETTINGS)
    columns = sorted(dated.read(spark, roots[1]).columns)
    silver = [sorted(map(str, dated.read(spark, r).select(columns).collect())) for r in (roots[1], f"{folder}/s")]
    assert silver[0] == silver[1]
    assert published(spark, roots[2]) == published(spark, f"{folder}/g")
    assert refills
    for name in partials.TABLES[:-1]:             # the sums equal those of a rebuild as well
        mine, whole = (partials.read(spark, refresh.partials_root(g), name) for g in (roots[2], f"{folder}/g"))
        assert sorted(map(str, mine.collect())) == sorted(map(str, whole.collect())), name


def test_a_refresh_reads_only_what_a_batch_touches(spark, folder, monkeypatch):
    roots = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    store(spark, folder, [raw_event(f"e{i}", f"u{i % 5}", timestamp=f"2026-01-0{i % 8 + 1}T10:00:00Z") for i in range(40)], "b1", 1)
    refresh.refresh_published(spark, *roots, SETTINGS)
    store(spark, folder, [raw_event("e2", "u9", timestamp="2026-01-03T11:00:00Z"), raw_event("new", "u9", timestamp="2026-01-03T12:00:00Z")], "b2", 2)
    read_days, sources = [], {}
    real_read, real_publish, real_snapshot = dated.read, dated.publish, snapshots.publish

    def read(session, root, **kwargs):
        if root == roots[1]:
            read_days.append(kwargs.get("only"))
        return real_read(session, root, **kwargs)

    def publish(df, root, *rest, **kwargs):
        sources[root] = df.inputFiles()
        return real_publish(df, root, *rest, **kwargs)

    def snapshot(df, path, *rest):
        sources[path] = df.inputFiles()
        return real_snapshot(df, path, *rest)

    monkeypatch.setattr(dated, "read", read)
    monkeypatch.setattr(dated, "publish", publish)
    monkeypatch.setattr(snapshots, "publish", snapshot)
    monkeypatch.setattr(files, "read_bronze_ids", lambda *_: 1 / 0)
    asked = []
    real_bronze = files.read_bronze
    monkeypatch.setattr(files, "read_bronze", lambda s, r, batch_ids=None: asked.append(batch_ids) or real_bronze(s, r, batch_ids))
    assert refresh.refresh_published(spark, *roots, SETTINGS) == ["b2"]
    assert asked == [["b2"]] and read_days[0] == [dt.date(2026, 1, 3)]
    assert len(sources) == 1 + len(partials.TABLES) + 3
    for root, paths in sources.items():
        assert not [p for p in paths if "/silver/data/" in p or "/bronze/" in p], root
    monkeypatch.undo()
    assert published(spark, roots[2])["gold_user_360"]
    refresh.rebuild(spark, roots[0], f"{folder}/s", f"{folder}/g", SETTINGS)
    assert published(spark, roots[2]) == published(spark, f"{folder}/g")


def test_whole_rows_meet_only_known_ids_and_only_candidates_inside_the_borders_become_rows(spark, folder, monkeypatch):
    roots = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    store(spark, folder, [raw_event(f"e{i}", f"u{i % 2}", timestamp=f"2026-01-0{i % 8 + 1}T10:00:00Z") for i in range(16)], "b1", 1)
    refresh.refresh_published(spark, *roots, SETTINGS)
    late = [raw_event(f"n{i}", "u0", "USER_REGISTERED", timestamp="2026-01-03T12:00:00Z") for i in range(30)]
    store(spark, folder, [*late, raw_event("e2", "u0", timestamp="2026-01-03T10:00:00Z")], "b2", 2)
    compared, candidates = [], []
    keep, drop, spread = refresh.keep_matching, refresh.drop_matching, partials._candidates
    monkeypatch.setattr(refresh, "keep_matching", lambda rows, keys, *a: compared.append(keys.count()) or keep(rows, keys, *a))
    monkeypatch.setattr(refresh, "drop_matching", lambda rows, keys, *a: compared.append(keys.count()) or drop(rows, keys, *a))

    def counted(*args):
        candidates.append(spread(*args).count())
        return spread(*args)

    monkeypatch.setattr(partials, "_candidates", counted)
    assert refresh.refresh_published(spark, *roots, SETTINGS) == ["b2"]
    assert compared == [1, 1]      # of 31 ids of the batch Silver holds one
    assert candidates == [0]       # none of the 31 rows is earlier than the first one kept, or later than the last
    monkeypatch.undo()
    refresh.rebuild(spark, roots[0], f"{folder}/s", f"{folder}/g", SETTINGS)
    assert published(spark, roots[2]) == published(spark, f"{folder}/g")


def test_a_batch_being_written_waits_for_the_next_refresh(spark, folder):
    roots = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    store(spark, folder, [raw_event("e1", "u1")], "b1", 1)
    refresh.refresh_published(spark, *roots, SETTINGS)
    id_index.begin(spark, roots[0], "b2")
    store(spark, folder, [raw_event("e2", "u2")], "b2", 2)
    assert refresh.refresh_published(spark, *roots, SETTINGS) == []
    id_index.finish(spark, roots[0], "b2")
    assert refresh.refresh_published(spark, *roots, SETTINGS) == ["b2"]


def test_a_refresh_of_its_own_runs_beside_ingest(spark, folder):
    import time

    roots = f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold"
    store(spark, folder, [raw_event("e1", "u1")], "b1", 1)
    refresher = refresh.Refresher(*roots, SETTINGS)
    query = refresher.start(spark, f"{folder}/ticks", every="1 second")
    try:
        end = time.time() + 120
        while refresher.runs == 0 and time.time() < end and query.isActive:
            time.sleep(1)
    finally:
        query.stop()
    assert refresher.runs >= 1 and refresher.errors == 0
    assert refresh.read_published_gold(spark, roots[2])["gold_user_360"].count() == 1


def test_a_refresh_cut_short_by_a_stop_is_not_counted_as_failed(monkeypatch):
    def fails(*_):
        raise RuntimeError("cancelled")

    monkeypatch.setattr(refresh, "refresh_published", fails)
    refresher = refresh.Refresher("b", "s", "g", SETTINGS)
    assert not refresher(None, force=True, stopped=lambda: True) and refresher.errors == refresher.runs == 0
    assert not refresher(None, force=True) and refresher.errors == 1
