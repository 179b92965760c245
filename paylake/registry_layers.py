"""Named queries over Bronze, Silver, messages, streams, storage, checks and questions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake import fixed_values as fv
from paylake.functions import text
from paylake.operators import bronze, checks, guard, messages as msg, profiling, silver
from paylake.plans import business
from paylake.registry import Query, daily, event_summary, plain, users
from paylake.session import pin_utc, staged, work_dir
from paylake.sources import catalog, files, snapshots, tables
from paylake.sources.questions import questions
from paylake.sources.tables import TABLES_SETTINGS as SETTINGS
from paylake.streaming import ingest, refresh

AUDIT = ("is_duplicate", "duplicate_reason", "duplicate_first_seen_batch_id", "duplicate_first_seen_file")
STORED = ["bronze_file", "seq"]


def _q(build) -> Query:
    return lambda spark, folder: plain(build(pin_utc(spark), folder))


# --- Bronze ------------------------------------------------------------------------------------


def _repaired(spark: SparkSession, folder: str) -> DataFrame:
    stored = tables.bronze_batch(spark, folder, 1).unionByName(tables.bronze_batch(spark, folder, 2))
    return bronze.repair_flags(staged(stored, "bronze"), STORED)


def _stored_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Both batches written one after the other and read back."""
    root = work_dir(spark, "bronze")
    one, two = (tables.bronze_batch(spark, folder, b).drop("bronze_file") for b in (1, 2))
    files.write_bronze(bronze.flag_duplicates(one, None, tables.RAW_ORDER).drop("seq"), root)
    known = bronze.first_seen(files.read_bronze_ids(spark, root), files.BRONZE_ORDER)
    files.write_bronze(bronze.flag_duplicates(two, known, tables.RAW_ORDER).drop("seq"), root)
    return files.read_bronze(spark, root)


def _repair_written(spark: SparkSession, folder: str) -> DataFrame:
    """Both batches stored without flags, repaired in place and read back."""
    root = work_dir(spark, "repair_bronze")
    for batch in (1, 2):
        rows = tables.bronze_batch(spark, folder, batch).drop("bronze_file")
        files.write_bronze(rows, root)
    files.repair_bronze(spark, root, dry_run=False)
    return files.read_bronze(spark, root).select(
        "batch_id", "event_id", "is_duplicate", "duplicate_reason", "duplicate_first_seen_batch_id",
        F.regexp_extract("duplicate_first_seen_file", "in_day=.*$", 0).alias("duplicate_first_seen_file"))


def _duplicate_log(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV log read back."""
    path = files.write_duplicate_log(
        tables.bronze_all(spark, folder, fv.DUPLICATE_LOG_COLUMNS), work_dir(spark, "duplicates"))
    schema = ", ".join(f"{c} string" for c in fv.DUPLICATE_LOG_COLUMNS)
    return spark.read.schema(schema).option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def bronze_queries() -> dict[str, Query]:
    one = lambda s, f: tables.bronze_batch(s, f, 1)
    return {
        "bronze_flatten": _q(lambda s, f: bronze.flatten(tables.raw_events(s, f))),
        "bronze_metadata": _q(lambda s, f: one(s, f).select(
            "event_id", "ingestion_timestamp", "source_file", "batch_id", "ingestion_date")),
        "event_id_normalize": _q(lambda s, f: bronze.normalized_ids(one(s, f))),
        "bronze_first_seen": _q(lambda s, f: bronze.first_seen(
            one(s, f).unionByName(tables.bronze_batch(s, f, 2)), STORED)),
        "bronze_duplicates": _q(lambda s, f: tables.bronze_all(s, f, ["seq", "event_id", "batch_id"]).select(
            "seq", "event_id", "batch_id", *AUDIT)),
        "duplicate_log": _q(_duplicate_log),
        "bronze_scan": _q(lambda s, f: _stored_bronze(s, f).drop("bronze_file", "bronze_row").withColumn(
            "duplicate_first_seen_file", F.regexp_extract("duplicate_first_seen_file", "in_day=.*$", 0))),
        "bronze_write_roundtrip": _q(lambda s, f: _stored_bronze(s, f).select(
            "batch_id", "ingestion_date", "event_id", "user_id", "amount", "is_duplicate", "duplicate_reason")),
        "bronze_repair": _q(lambda s, f: _repaired(s, f).select("batch_id", "seq", "event_id", *AUDIT)),
        "bronze_repair_summary": _q(lambda s, f: bronze.repair_summary(_repaired(s, f))),
        "bronze_repair_roundtrip": _q(_repair_written),
        "raw_event_counts": _q(lambda s, f: checks.raw_event_counts(tables.raw_events(s, f))),
        "raw_distinct_values": _q(lambda s, f: checks.raw_distinct_values(tables.raw_events(s, f))),
        "null_token_cleanup": _q(_null_tokens),
        "dq_bronze": _q(lambda s, f: checks.check_bronze(tables.bronze_all(s, f, fv.BRONZE_REQUIRED))),
    }


def _null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of every fifth event are replaced by the texts to be cleaned."""
    tokens = F.array(*(F.lit(t) for t in ("None", "NaT", "nan", "NULL", "")))
    n = F.col("seq")
    dirty = tables.bronze_batch(spark, folder, 1).withColumn(
        "user_segment",
        F.when(n % 5 == 0, F.element_at(tokens, (n % 25 / 5 + 1).cast("int"))).otherwise(F.col("user_segment")),
    )
    return files.null_tokens_to_null(dirty.select("event_id", "timestamp", "user_segment"))


# --- Silver ------------------------------------------------------------------------------------


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    return silver.deduplicate(silver.clean_types(tables.bronze_all(spark, folder)), STORED)


def _located(spark: SparkSession, folder: str) -> DataFrame:
    return silver.resolve_location(silver.add_flags(_typed(spark, folder), SETTINGS))


def _stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    built = tables.silver_events(spark, folder)
    path = files.write_silver(built, work_dir(spark, "silver"))
    return files.read_silver(spark, path).select(*built.columns)


def silver_queries() -> dict[str, Query]:
    return {
        "silver_types": _q(lambda s, f: silver.clean_types(tables.bronze_batch(s, f, 1)).select(
            "seq", "timestamp", "date", *silver.MONEY_COLUMNS, "installments", "user_email")),
        "silver_dedup": _q(lambda s, f: _typed(s, f).select(
            "event_id", "batch_id", (F.when(F.col("batch_id") == "b1", F.col("seq")).otherwise(
                F.floor(F.col("seq") / 2)) % 10).alias("digit"), "is_duplicate", "bronze_duplicate_count")),
        "silver_flags": _q(lambda s, f: silver.add_flags(_typed(s, f), SETTINGS).select(
            "event_id", "event", "event_status", "is_failed", "is_transactional")),
        "silver_ip_private": _q(lambda s, f: silver.add_flags(_typed(s, f), SETTINGS).select(
            "event_id", "ip", "ip_is_private", "geo_source")),
        "silver_geo": _q(lambda s, f: _located(s, f).select("event_id", "location_city", "location_country")),
        "silver_geo_lookup": _q(lambda s, f: silver.locate_public_ips(
            _located(s, f), tables.ip_geo(s), STORED).select("event_id", "ip", "location_city", "location_country")),
        "silver_fx": _q(lambda s, f: silver.add_usd(_typed(s, f), SETTINGS).select(
            "event_id", F.col("amount").alias("amount_cop"), "amount_usd")),
        "silver_final": _q(tables.silver_events),
        "silver_write_roundtrip": _q(_stored_silver),
        "silver_run_summary": _q(lambda s, f: silver.silver_run_summary(tables.silver_events(s, f))),
        "dq_silver": _q(lambda s, f: checks.check_silver(tables.silver_events(s, f))),
    }


# --- Messages and streams ------------------------------------------------------------------------


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    filled = msg.validate(tables.messages(spark, folder), "2024-03-01T00:00:00Z")
    shown = F.when(F.col("message_id").startswith("msg-"), F.col("message_id")).otherwise("filled")
    return filled.select("seq", "msg_type", "schema_version", shown.alias("message_id"), "timestamp", "metadata",
                         "is_valid")


def _generic(spark: SparkSession, folder: str) -> DataFrame:
    others = tables.messages(spark, folder).filter(~msg.is_legacy())
    flat = msg.promote(msg.flatten_generic(others, keep=("seq",)),
                       {"name": "string", "value": "double", "flag": "string", "d": "string", "e": "string"})
    return flat.withColumn("fields", F.size("data_fields")).drop("data_fields")


def write_message_files(messages: DataFrame, path: str, parts: int) -> None:
    """JSON lines as a producer sends them: data and detail as objects."""
    scalars = F.to_json(F.struct("msg_type", "source", "schema_version", "message_id", "timestamp", "detailType"))

    def part(name: str):
        return F.when(F.col(name).isNotNull(), F.concat(F.lit(f',"{name}":'), F.col(name))).otherwise(F.lit(""))

    opened = F.expr("substring({0}, 1, length({0}) - 1)".format("line"))
    empty = F.col("line") == "{}"
    body = F.concat(part("data"), part("metadata"), part("detail"))
    lines = messages.withColumn("line", scalars).select(
        F.concat(opened, F.when(empty, F.substr(body, F.lit(2))).otherwise(body), F.lit("}")).alias("value")
    )
    lines.repartition(parts, F.xxhash64("value")).write.mode("append").text(path)


def _legacy_lines(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    raw = tables.raw_events(spark, folder, batch)
    none = F.lit(None).cast("string")
    return raw.select(
        none.alias("msg_type"), "source", none.alias("schema_version"), none.alias("message_id"),
        none.alias("timestamp"), "detailType", none.alias("data"), none.alias("metadata"),
        F.to_json("detail").alias("detail"),
    )


def _stream_both(spark: SparkSession, folder: str, base: str, after_batch=None) -> str:
    """Batch 1 in several micro-batches, then batch 2 after a restart from the same checkpoint."""
    for batch, parts, per_trigger in ((1, 4, 2), (2, 2, 2)):
        write_message_files(_legacy_lines(spark, folder, batch), f"{base}/in", parts)
        stream = ingest.read_messages(spark, f"{base}/in", per_trigger)
        ingest.start(stream, f"{base}/bronze", f"{base}/checkpoint", f"bronze_{uuid.uuid4().hex[:8]}",
                     after_batch=after_batch).awaitTermination()
    return base


def _stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    base = _stream_both(spark, folder, work_dir(spark, "stream"))
    stored = files.read_bronze(spark, ingest.bronze_roots(f"{base}/bronze")["events"])
    epoch = F.substring_index("batch_id", "-", -1).cast("int")
    return stored.select("event_id", "event", "amount", "is_duplicate", "duplicate_reason",
                         F.when(epoch < 2, 1).otherwise(2).alias("arrival"))


def _stream_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rows per route after streaming the mixed messages."""
    base = work_dir(spark, "routes")
    write_message_files(tables.messages(spark, folder), f"{base}/in", 4)
    stream = ingest.read_messages(spark, f"{base}/in", 2)
    ingest.start(stream, f"{base}/bronze", f"{base}/checkpoint", f"routes_{uuid.uuid4().hex[:8]}").awaitTermination()
    roots = ingest.bronze_roots(f"{base}/bronze")
    events = files.read_bronze(spark, roots["events"]).select(F.lit(fv.LEGACY_ROUTE).alias("msg_route"))
    others = spark.read.parquet(roots["messages"]).select(F.col("msg_route").cast("string"))
    return events.unionByName(others).groupBy("msg_route").agg(F.count(F.lit(1)).alias("n"))


def gold_rows(gold_tables: dict[str, DataFrame]) -> DataFrame:
    """All columns of the three Gold tables in one shape."""
    def bar(*columns):
        return F.concat_ws("|", *(F.col(c).cast("string") if isinstance(c, str) else c for c in columns))

    money = [F.col(c).cast("decimal(28,4)").cast("string")
             for c in ("total_amount_usd", "avg_ticket", "failure_rate", "balance_current")]
    days = [F.col(c).cast("date").cast("string") for c in ("last_transaction_date", "last_event_date")]
    none = F.lit("")
    parts = {
        "gold_user_360": ("user_id", "total_events", "total_amount_cop",
                          bar("top_merchant", "top_category", "preferred_channel", "preferred_device", "city"), bar(*money),
                          bar("user_name", "user_email", "user_age", "user_segment", "total_transactions",
                              "failed_transactions", "days_since_last_tx", *days)),
        "gold_daily_metrics": ("date", "total_events", "total_amount_cop",
                               bar("total_transactions", "failed_count", "unique_users"), none, none),
        "gold_event_summary": ("event", "count", "pct_of_total", bar("success_count", "failed_count"), none, none),
    }
    return reduce(DataFrame.unionByName, [
        gold_tables[name].select(
            F.lit(name).alias("table"), F.col(key).cast("string").alias("key"), F.col(n).alias("n"),
            F.col(amount).alias("amount"), label.alias("label"), figures.alias("figures"), facts.alias("facts"),
        )
        for name, (key, n, amount, label, figures, facts) in parts.items()
    ])


def _stream_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Stream to Bronze with refreshes of Silver and Gold between batches, then a forced one, read as published."""
    base = work_dir(spark, "stream_gold")
    root = ingest.bronze_roots(f"{base}/bronze")["events"]
    refresher = refresh.Refresher(root, f"{base}/silver", f"{base}/gold", SETTINGS, tables.ip_geo(spark), minimum_seconds=5)
    _stream_both(spark, folder, base, refresher)
    if not refresher(spark, force=True) or refresher.errors:
        raise RuntimeError("a refresh failed")
    return gold_rows(refresh.read_published_gold(spark, f"{base}/gold"))


def _late_data(spark: SparkSession, folder: str) -> DataFrame:
    """Gold of batch 1, brought up to date with the late batch 2 by recomputing only what it touches."""
    base = work_dir(spark, "late")
    root, silver_root, gold_root = f"{base}/bronze", f"{base}/silver", f"{base}/gold"
    one, two = (tables.bronze_batch(spark, folder, b).drop("bronze_file") for b in (1, 2))
    geo = tables.ip_geo(spark)
    files.write_bronze(bronze.flag_duplicates(one, None, tables.RAW_ORDER).drop("seq"), root)
    refresh.refresh_published(spark, root, silver_root, gold_root, SETTINGS, geo)
    known = bronze.first_seen(files.read_bronze_ids(spark, root), files.BRONZE_ORDER)
    files.write_bronze(bronze.flag_duplicates(two, known, tables.RAW_ORDER).drop("seq"), root)
    refresh.refresh_published(spark, root, silver_root, gold_root, SETTINGS, geo)
    return gold_rows(refresh.read_published_gold(spark, gold_root))


def stream_queries() -> dict[str, Query]:
    return {
        "envelope_validate": _q(_validated),
        "message_quarantine": _q(lambda s, f: msg.split_valid(msg.classify(msg.validate(
            tables.messages(s, f), "2026-01-01T00:00:00Z")))[1].select("seq", "msg_kind")),
        "message_classify": _q(lambda s, f: msg.classify(tables.messages(s, f)).select(
            "seq", "msg_kind", "msg_route")),
        "message_stats": _q(lambda s, f: msg.stats(tables.messages(s, f))),
        "generic_flatten": _q(_generic),
        "stream_bronze": _q(_stream_bronze),
        "stream_route_counts": _q(_stream_routes),
        "stream_gold_refresh": _q(_stream_gold),
        "stream_late_data": _q(_late_data),
    }


# --- Storage, catalog and guarded SQL --------------------------------------------------------------


def _gold_of_events(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Gold over stored Silver, so the three builds read a table instead of repeating Bronze."""
    return refresh.build_gold(_stored_silver(spark, folder), SETTINGS)


def _gold_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = work_dir(spark, "gold")
    files.write_gold(_gold_of_events(spark, folder), root)
    return gold_rows(files.read_gold(spark, root))


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """An empty version first, then the real one: readers must get the newest."""
    path = work_dir(spark, "snapshot")
    table = daily(spark, folder)
    snapshots.publish(table.limit(0), path)
    snapshots.publish(table, path)
    return snapshots.read_latest(spark, path)


def _export(spark: SparkSession, folder: str) -> DataFrame:
    base = work_dir(spark, "export")
    paths = files.gold_paths(f"{base}/gold")
    for name, table in _gold_of_events(spark, folder).items():
        snapshots.publish(table, paths[name])
    done = snapshots.export_layer(spark, paths, "gold", f"{base}/target", {"gold_daily_metrics": ("date",)})
    if done.filter("NOT ok").count():
        raise RuntimeError("an export failed")
    return gold_rows({name: spark.read.parquet(f"{base}/target/gold/{name}") for name in paths})


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    name = f"gold_event_summary_{uuid.uuid4().hex[:8]}"
    catalog.publish_table(event_summary(spark, folder), name, work_dir(spark, "catalog"))
    published = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame reads them
    return published


def _catalog_query(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over a published table; an alias of a personal column comes out null."""
    name = f"gold_user_360_{uuid.uuid4().hex[:8]}"
    people = users(spark, folder).select("user_id", "user_segment", "user_email", "total_transactions")
    catalog.publish_table(people, name, work_dir(spark, "catalog"))
    found = catalog.query(spark, f"""SELECT user_segment, max(user_email) AS e, count(*) AS usuarios,
        sum(total_transactions) AS tx FROM {name} GROUP BY user_segment""")
    spark.sql(f"DROP TABLE {name}")
    return found


def _readiness(spark: SparkSession, folder: str) -> DataFrame:
    """Two of three tables published, one of them short of a column."""
    suffix = uuid.uuid4().hex[:8]
    names = {t: f"{t}_{suffix}" for t in fv.GOLD_TABLES}
    days, summary = daily(spark, folder), event_summary(spark, folder)
    catalog.publish_table(days, names["gold_daily_metrics"], work_dir(spark, "catalog"))
    catalog.publish_table(summary.drop("pct_of_total"), names["gold_event_summary"], work_dir(spark, "catalog"))
    found = catalog.readiness(spark, names)
    for table in spark.catalog.listTables():
        if table.name.endswith(suffix):
            spark.sql(f"DROP TABLE {table.name}")
    return found


def _guarded(spark: SparkSession, folder: str) -> DataFrame:
    sql = """SELECT user_segment, max(user_email) AS user_email, count(*) AS usuarios, sum(total_transactions) AS tx
             FROM gold_user_360 GROUP BY user_segment"""
    return guard.run(spark, sql, {"gold_user_360": users(spark, folder)}).rows


def storage_queries() -> dict[str, Query]:
    return {
        "gold_write_roundtrip": _q(_gold_roundtrip),
        "snapshot_roundtrip": _q(_snapshot),
        "layer_export": _q(_export),
        "catalog_publish": _q(_catalog),
        "catalog_readiness": _q(_readiness),
        "catalog_query": _q(_catalog_query),
        "guarded_sql": _q(_guarded),
    }


# --- Checks, profiles, questions ---------------------------------------------------------------------


def _all_gold(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "gold_user_360": users(spark, folder),
        "gold_daily_metrics": daily(spark, folder),
        "gold_event_summary": event_summary(spark, folder),
    }


def check_queries() -> dict[str, Query]:
    extremes = ["usuarios", "revenue_por_usuario", "tasa_fallo_pct"]
    return {
        "profile_columns": _q(lambda s, f: profiling.profile_columns(users(s, f), "gold_user_360")),
        "profile_tables": _q(lambda s, f: profiling.profile_tables(_all_gold(s, f))),
        "metric_extremes": _q(lambda s, f: profiling.metric_extremes(
            business.segments(users(s, f)), "user_segment", extremes)),
        "dq_gold": _q(lambda s, f: checks.check_gold(_all_gold(s, f))),
        "dq_top3": _q(lambda s, f: business.ranked(users(s, f), "total_amount_cop", "user_id", 3).select(
            "user_id", "total_transactions", "total_amount_cop", "top_merchant")),
        "dq_invariants": _q(lambda s, f: checks.check_invariants(
            business.segments(users(s, f)), daily(s, f), event_summary(s, f))),
        "text_is_data_question": _q(lambda s, f: text.tag_questions(questions(s, f)).select(
            "origin", "conv_id", "turn", "is_data_question")),
        "text_intent_counts": _q(lambda s, f: text.intent_counts(questions(s, f))),
        "text_dim_metric": _q(lambda s, f: text.tag_questions(questions(s, f)).select(
            "origin", "conv_id", "turn", "dimension", "metric")),
    }


def layer_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (bronze_queries, silver_queries, stream_queries, storage_queries, check_queries):
        out.update(part())
    return out
