"""Mergeable partial tables behind Gold: rows of Silver come in with sign +1 and leave with sign -1.

A refresh reads the rows that went and came, and the partial rows of the users, dates and event types these touch; it reads
no history.

    event_sums   event                               counts
    day_sums     date                                counts, sum of amounts
    day_users    date, user                          events of the user on that date: the day has the user while it is above 0
    user_sums    user                                counts, sums of amounts, known values per ordered attribute
    user_values  user, attribute, value              count: the most frequent value is the mode
    user_kept    user, attribute, place in time      the first (or last) known values, up to KEPT of them

Sums and counts are exact under signs. "First" and "last" are not, so the best few are kept: while one is left it is the
true one, because a row beyond the last kept is never kept unless nothing is missing before it. Only where all kept ones of a user are
withdrawn, and the counts say there are more, are that user's rows read from Silver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from paylake.config import Settings
from paylake.functions.scalars import MONEY, half_up, pct, total_of
from paylake.operators import gold
from paylake.operators.skew import keep_matching, lookup
from paylake.session import work_dir
from paylake.sources import dated
from paylake.sources.storage import delete

KEPT = 8
USER_BUCKETS = 32
#: Parts into which a user's new candidates are split before the best of all parts are taken.
_PARTS = 64
_SPREAD = ["timestamp", "event_id", "user_id"]
_ORDER = ("late", "at", "event_id", "value")
_FIRST, _LAST = "first", "last"
TABLES = ("event_sums", "day_sums", "day_users", "user_sums", "user_values", "user_kept")
_COUNTS = "n long, ids long, "
SCHEMAS = {
    "event_sums": f"event string, {_COUNTS}success long, failed long, part int",
    "day_sums": f"date date, {_COUNTS}transactions long, amount decimal(38,10), failed long, part int",
    "day_users": "user_id string, n long, date date",
    "user_sums": "user_id string, n long, events long, failed long, ok_rows long, transactions long, cop decimal(38,10), "
                 "usd decimal(38,10), amounts long, "
                 + "".join(f"known_{c} long, " for c in (*gold.FIRST_SEEN, "balance_current", "last_event_date", "last_transaction_date"))
                 + "bucket int",
    "user_values": "user_id string, slot string, value string, n long, bucket int",
    "user_kept": "user_id string, slot string, late boolean, at timestamp, event_id string, value string, n long, bucket int",
}
_BY = {"event_sums": "part", "day_sums": "part", "day_users": "date"}   # folder column; others go by bucket


def _ordered(settings: Settings) -> dict[str, tuple[str, Column, Column]]:
    """Ordered attributes: which end of time, the value, and whether the row has one."""
    ok = gold.is_success_tx(settings)
    first = {out: (_FIRST, F.col(src), F.col(src).isNotNull()) for out, src in gold.FIRST_SEEN.items()}
    none = F.lit("")
    return first | {
        "balance_current": (_LAST, F.col("balance_after"), ok & F.col("balance_after").isNotNull()),
        "last_event_date": (_LAST, none, F.col("timestamp").isNotNull()),
        "last_transaction_date": (_LAST, none, ok & F.col("timestamp").isNotNull()),
    }


def signed(went: DataFrame, came: DataFrame) -> DataFrame:
    """Rows of Silver with their sign; rows that only changed what Gold does not use cancel in every sum."""
    return came.withColumn("sign", F.lit(1)).unionByName(went.withColumn("sign", F.lit(-1)))


def _sum(when: Column) -> Column:
    return F.sum(F.when(when, F.col("sign")).otherwise(0)).cast("long")


def _money(c: str, when: Column | None = None) -> Column:
    amount = F.col(c).try_cast(MONEY) * F.col("sign")
    return F.sum(amount if when is None else F.when(when, amount)).cast("decimal(38,10)")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int")


def changes(rows: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The partial tables of signed rows, without user_kept."""
    ok, has_id = gold.is_success_tx(settings), F.col("event_id").isNotNull()
    users = rows.filter(F.col("user_id").isNotNull())
    known = {f"known_{name}": has for name, (_, _, has) in _ordered(settings).items()}
    slots = {"top_merchant": F.when(ok, F.col("merchant")), "top_category": F.when(ok, F.col("category")),
             "preferred_channel": F.col("channel"), "preferred_device": F.col("device")}
    alike = (users.groupBy("user_id", *(v.alias(n) for n, v in slots.items())).agg(F.sum("sign").alias("n"))
             .unpivot(["user_id", "n"], list(slots), "slot", "value").filter(F.col("value").isNotNull()))
    return {
        "event_sums": rows.filter(F.col("event").isNotNull()).groupBy("event").agg(
            F.sum("sign").alias("n"), _sum(has_id).alias("ids"), _sum(~F.col("is_failed")).alias("success"),
            _sum(F.col("is_failed")).alias("failed")),
        "day_sums": rows.filter(F.col("date").isNotNull()).groupBy("date").agg(
            F.sum("sign").alias("n"), _sum(has_id).alias("ids"), _sum(F.col("is_transactional")).alias("transactions"),
            _money("amount_cop").alias("amount"), _sum(F.col("is_failed")).alias("failed")),
        "day_users": rows.filter(F.col("date").isNotNull() & F.col("user_id").isNotNull())
            .groupBy("date", "user_id").agg(F.sum("sign").alias("n")),
        "user_sums": users.groupBy("user_id").agg(
            F.sum("sign").alias("n"), _sum(has_id).alias("events"), _sum(F.col("is_failed")).alias("failed"),
            _sum(ok).alias("ok_rows"), _sum(ok & has_id).alias("transactions"), _money("amount_cop", ok).alias("cop"),
            _money("amount_usd", ok).alias("usd"), _sum(ok & F.col("amount_cop").isNotNull()).alias("amounts"),
            *(_sum(has).alias(name) for name, has in known.items())).withColumn("bucket", _bucket()),
        "user_values": alike.groupBy("user_id", "slot", "value").agg(F.sum("n").alias("n"))
            .withColumn("bucket", _bucket()),
    }


_KEYS = {"event_sums": ["event"], "day_sums": ["date"], "day_users": ["date", "user_id"], "user_sums": ["user_id"],
         "user_values": ["user_id", "slot", "value"]}


def merged(name: str, old: DataFrame, change: DataFrame) -> DataFrame:
    """Old and new partial rows added up; what no row is left of goes."""
    keys = [*_KEYS[name], *(["bucket"] if "bucket" in change.columns else [])]
    sums = [c for c in change.columns if c not in keys]
    both = old.select(*change.columns).unionByName(change)
    kinds = {f.name: f.dataType for f in change.schema.fields}
    return both.groupBy(*keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in sums)).filter("n > 0")


def _candidates(rows: DataFrame, settings: Settings, borders: DataFrame | None = None) -> DataFrame:
    """user_id, slot, late, at, event_id, value, n: every known value of the ordered attributes with its place in time.

    Values beyond a user's ``borders`` are left out while they are columns of their row, before each becomes a row of its own.
    """
    ends = _ordered(settings)
    spread = rows.filter(F.col("user_id").isNotNull()).select(
        *_SPREAD, "sign", *(F.when(has, value.cast("string")).alias(f"v_{name}") for name, (_, value, has) in ends.items()))
    if borders is not None:
        spread = lookup(spread, borders, "user_id", _SPREAD)
    late, parts = F.col("timestamp").isNull(), []
    for name, (end, _, _) in ends.items():
        value = F.col(f"v_{name}")
        wanted = value.isNotNull()
        if borders is not None:
            place, border = F.struct(late.alias("late"), F.col("timestamp").alias("at"), "event_id", value.alias("value")), F.col(f"border.{name}")
            wanted &= border.isNull() | (place <= border if end == _FIRST else place >= border)
        parts.append(F.when(wanted, F.struct(F.lit(name).alias("slot"), value.alias("value"))))
    each = spread.select("user_id", late.alias("late"), F.col("timestamp").alias("at"), "event_id", "sign",
                         F.explode(F.array_compact(F.array(*parts))).alias("c")).select("*", "c.*").drop("c")
    keys = ["user_id", "slot", *_ORDER]
    return each.groupBy(*keys).agg(F.sum("sign").alias("n")).filter("n <> 0").select(*keys, "n")


def first_kept(silver: DataFrame, settings: Settings) -> DataFrame:
    """The single best candidate per user and attribute, from one aggregate over whole Silver."""
    place = F.struct(F.col("timestamp").isNull().alias("late"), F.col("timestamp").alias("at"), F.col("event_id"))
    picks = []
    for name, (end, value, has) in _ordered(settings).items():
        candidate = F.when(has, F.struct(place.alias("p"), value.cast("string").alias("value")))
        picks.append((F.min(candidate) if end == _FIRST else F.max(candidate)).alias(name))
    best = silver.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*picks)
    listed = F.array(*[F.struct(F.lit(name).alias("slot"), F.col(name).alias("c")) for name in _ordered(settings)])
    return best.select("user_id", F.explode(listed).alias("e")).filter(F.col("e.c").isNotNull()).select(
        "user_id", "e.slot", "e.c.p.late", "e.c.p.at", "e.c.p.event_id", "e.c.value", F.lit(1).cast("long").alias("n"),
        _bucket().alias("bucket"))


def _best(rows: DataFrame, settings: Settings) -> DataFrame:
    """The KEPT best per user and attribute: of each part of a user's rows first, so that no task sorts a user's many."""
    ends = _ordered(settings)
    out = None
    for end in (_FIRST, _LAST):
        order = [F.col(c).asc() if end == _FIRST else F.col(c).desc() for c in _ORDER]
        mine = rows.filter(F.col("slot").isin([n for n, (e, _, _) in ends.items() if e == end]))
        mine = mine.withColumn("part", F.pmod(F.xxhash64(*_ORDER), F.lit(_PARTS)))
        for keys in (["user_id", "slot", "part"], ["user_id", "slot"]):
            mine = mine.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
                .filter(F.col("rank") <= KEPT)
        out = mine if out is None else out.unionByName(mine)
    return out.drop("part", "rank")


def kept_borders(old: DataFrame, old_sums: DataFrame, settings: Settings) -> DataFrame:
    """user_id and, for each attribute that has values beyond the kept ones, the worst kept one: the border of what is known."""
    ends, place, mine = _ordered(settings), F.struct(*_ORDER), lambda name, c: F.when(F.col("slot") == name, c)
    held = old.groupBy("user_id").agg(
        *(F.sum(mine(n, F.col("n"))).alias(f"held_{n}") for n in ends),
        *((F.max if end == _FIRST else F.min)(mine(n, place)).alias(f"worst_{n}") for n, (end, _, _) in ends.items()))
    return held.join(old_sums.select("user_id", *(f"known_{n}" for n in ends)), "user_id").select("user_id", F.struct(
        *(F.when(F.col(f"known_{n}") > F.col(f"held_{n}"), F.col(f"worst_{n}")).alias(n) for n in ends)).alias("border"))


def next_kept(old: DataFrame, change: DataFrame) -> DataFrame:
    """The candidates of the touched users after the change, of which the best stay; change: signed candidates inside the borders."""
    keys = ["user_id", "slot", *_ORDER]
    return old.select(*keys, "n").unionByName(change).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 0")


def ran_out(kept: DataFrame, sums: DataFrame, settings: Settings) -> DataFrame:
    """Users who have known values of an attribute, by their user_sums after the change, and none of them kept."""
    known = sums.select("user_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("slot"), F.col(f"known_{n}").alias("known")) for n in _ordered(settings)])).alias("k")).select("user_id", "k.*")
    have = kept.select("user_id", "slot").distinct()
    return known.filter("known > 0").join(have, ["user_id", "slot"], "left_anti").select("user_id").distinct()


def refilled(silver: DataFrame, users: DataFrame, settings: Settings) -> DataFrame:
    """The kept candidates of these users from their rows in Silver."""
    rows = keep_matching(silver.filter(F.col("user_id").isNotNull()), users, "user_id", _SPREAD).withColumn("sign", F.lit(1))
    return _best(_candidates(rows, settings), settings).withColumn("bucket", _bucket())


# --- Stored tables -----------------------------------------------------------------------------------


def path_of(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _by(name: str) -> str:
    return _BY.get(name, "bucket")


def _publish(table: DataFrame, root: str, name: str, number: int, touched: list | None = None) -> None:
    whole = table.withColumn("part", F.lit(0)) if _by(name) == "part" else table
    dated.publish(whole, path_of(root, name), None, touched, by=_by(name), number=number)


def read(spark: SparkSession, root: str, name: str, folders: list | None = None, number: int | None = None) -> DataFrame:
    """A partial table, or its rows in some folders only."""
    return dated.read(spark, path_of(root, name), by=_by(name), only=folders, number=number, schema=SCHEMAS[name])


def follows(spark: SparkSession, root: str, number: int) -> bool:
    """Whether all partial tables belong to this publication of Silver or to the one before it."""
    return all(dated.latest(spark, path_of(root, name)) in (number - 1, number) for name in TABLES)


def rebuild(silver: DataFrame, root: str, number: int, settings: Settings) -> None:
    """All partial tables from all of Silver."""
    tables = changes(silver.withColumn("sign", F.lit(1)), settings) | {"user_kept": first_kept(silver, settings)}
    for name, table in tables.items():
        if (dated.latest(silver.sparkSession, path_of(root, name)) or 0) < number:
            _publish(table, root, name, number)


def apply(spark: SparkSession, root: str, rows: DataFrame, silver: DataFrame, number: int, settings: Settings) -> None:
    """Take signed rows into the partial tables of the publication before this one. Tables that already belong to `number`
    stay, so a run that stopped can be finished. ``silver`` is read for users whose candidates ran out only.
    """
    new = changes(rows, settings)
    users = rows.filter(F.col("user_id").isNotNull())
    folders = {"part": [0], "date": [r.date for r in users.filter(F.col("date").isNotNull()).select("date").distinct().collect()],
               "bucket": [r.bucket for r in users.select(_bucket().alias("bucket")).distinct().collect()]}
    old = lambda name: read(spark, root, name, folders[_by(name)], number - 1)
    todo = [name for name in TABLES if dated.latest(spark, path_of(root, name)) != number]
    stage = work_dir(spark, "partials")

    def written(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{stage}/{name}")
        return spark.read.schema(table.schema).parquet(f"{stage}/{name}")

    if "user_kept" in todo:
        new["user_sums"] = written(new["user_sums"], "user_sums")
        users = new["user_sums"].select("user_id")
        touched = lambda name: old(name).join(users, "user_id", "left_semi")
        borders = written(kept_borders(touched("user_kept"), touched("user_sums"), settings), "borders")
        known = written(next_kept(touched("user_kept"), _candidates(rows, settings, borders)), "known")
        kept = written(_best(known, settings).withColumn("bucket", _bucket()), "kept")
        out_of = written(ran_out(kept, merged("user_sums", touched("user_sums"), new["user_sums"]), settings), "out_of")
        if not out_of.isEmpty():
            kept = kept.join(out_of, "user_id", "left_anti").unionByName(refilled(silver, out_of, settings).select(*kept.columns))
        others = old("user_kept").join(users, "user_id", "left_anti").select(*kept.columns)
        _publish(others.unionByName(kept), root, "user_kept", number, folders["bucket"])
    for name, change in new.items():
        if name in todo:
            _publish(merged(name, old(name), change), root, name, number, folders[_by(name)])
    delete(spark, stage)


# --- Gold from the partial tables ----------------------------------------------------------------------


def user_360(spark: SparkSession, root: str, settings: Settings, touched: DataFrame) -> DataFrame:
    """gold_user_360 of the touched users, from their buckets."""
    buckets = [r.bucket for r in touched.select(_bucket().alias("bucket")).distinct().collect()]
    mine = lambda name: read(spark, root, name, buckets).join(touched, "user_id", "left_semi")
    kept, slots = mine("user_kept"), _ordered(settings)
    place = F.struct(*_ORDER)
    picked = {n: F.min_by(F.struct("at", "value"), F.when(F.col("slot") == n, place)) if end == _FIRST
              else F.max_by(F.struct("at", "value"), F.when(F.col("slot") == n, place)) for n, (end, _, _) in slots.items()}
    ordered = kept.groupBy("user_id").agg(*(c.alias(f"o_{n}") for n, c in picked.items()))
    rank = F.struct(-F.col("n"), F.col("value"))
    modes = mine("user_values").groupBy("user_id").agg(*(
        F.min_by("value", F.when(F.col("slot") == n, rank)).alias(n)
        for n in ("top_merchant", "top_category", "preferred_channel", "preferred_device")))
    has_tx, cop = F.col("ok_rows") > 0, F.col("cop").cast("double")
    money = lambda c: half_up(F.when(has_tx, F.coalesce(F.col(c).cast("double"), F.lit(0.0))), 2)
    base = mine("user_sums").join(ordered, "user_id", "left").join(modes, "user_id", "left").select(
        "user_id", *(F.col(f"o_{n}.value").alias(n) for n in gold.FIRST_SEEN),
        F.col("events").alias("total_events"), F.col("transactions").alias("total_transactions"),
        money("cop").alias("total_amount_cop"), money("usd").alias("total_amount_usd"),
        half_up(F.try_divide(F.when(F.col("amounts") > 0, cop), F.col("amounts")), 2).alias("avg_ticket"),
        F.col("failed").alias("failed_transactions"), half_up(F.col("o_balance_current.value").cast("double"), 2).alias("balance_current"),
        F.col("o_last_transaction_date.at").alias("last_transaction_date"), F.col("o_last_event_date.at").alias("last_event_date"),
        "top_merchant", "top_category", "preferred_channel", "preferred_device")
    return gold.failure_and_recency(base, settings)


def daily_metrics(spark: SparkSession, root: str, old: DataFrame, days: list) -> DataFrame:
    """gold_daily_metrics: the touched days from the partial tables, the others as they were."""
    users = read(spark, root, "day_users", days).groupBy("date").agg(F.count(F.lit(1)).alias("unique_users"))
    fresh = read(spark, root, "day_sums").filter(F.col("date").isin(days)).join(users, "date", "left").select(
        "date", F.col("ids").alias("total_events"), F.col("transactions").alias("total_transactions"),
        half_up(F.coalesce(F.col("amount").cast("double"), F.lit(0.0)), 2).alias("total_amount_cop"),
        F.col("failed").alias("failed_count"), F.coalesce("unique_users", F.lit(0).cast("long")).alias("unique_users"))
    return old.filter(~F.col("date").isin(days)).select(*fresh.columns).unionByName(fresh)


def event_summary(spark: SparkSession, root: str) -> DataFrame:
    counted = read(spark, root, "event_sums").select("event", F.col("ids").alias("count"), F.col("success").alias("success_count"),
                                                     F.col("failed").alias("failed_count"))
    return counted.withColumn("pct_of_total", pct(F.col("count"), total_of(counted, "count"), 2))
