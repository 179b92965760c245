"""Bind the TPC-H-like driver tables to the model: a Silver frame and raw nested events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.config import Settings
from paylake.operators.bronze import FIRST_SEEN_COLUMNS, add_metadata, first_seen, flag_duplicates, flatten
from paylake.operators.silver import add_usd, build_silver, event_flags
from paylake.operators.skew import lookup
from paylake.session import staged

TABLES_SETTINGS = Settings(as_of=dt.date(2001, 8, 2))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _goods(spark: SparkSession, folder: str) -> DataFrame:
    """One merchant and category per order."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return (
        lookup(lines, part, "l_partkey", salt_on=["l_orderkey", "l_linenumber"])
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("p_brand").alias("merchant"), F.min("p_type").alias("category"))
    )


def silver_tx(
    spark: SparkSession, folder: str, settings: Settings = TABLES_SETTINGS, with_user: bool = True
) -> DataFrame:
    """Orders as Silver events. ``with_user=False`` leaves out what only the user table needs."""
    orders = table(spark, folder, "orders")
    if with_user:
        orders = orders.join(_goods(spark, folder), "o_orderkey", "left")
        customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
        nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        orders = lookup(orders, customers, "o_custkey", salt_on=["o_orderkey"])
        orders = lookup(orders, nations, "c_nationkey", salt_on=["o_orderkey"])
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey")
    event = (
        F.when((priority == "1-URGENT") & (F.col("o_orderstatus") == "F"), "PAYMENT_FAILED")
        .when(priority == "1-URGENT", "PAYMENT_MADE")
        .when(priority == "2-HIGH", "PURCHASE_MADE")
        .when(priority == "3-MEDIUM", "TRANSFER_SENT")
        .when(priority == "4-NOT SPECIFIED", "MONEY_ADDED")
        .when(priority == "5-LOW", "USER_REGISTERED")
    )
    events = orders.withColumns({
        "event_id": F.concat(F.lit("evt_"), key.cast("string")),
        "user_id": F.concat(F.lit("user_"), F.col("o_custkey").cast("string")),
        "timestamp": F.col("o_orderdate").cast("timestamp"),
        "event": event,
    }).withColumns({
        "date": F.to_date("timestamp"),
        "event_status": F.when(F.col("event") == "PAYMENT_FAILED", "FAILED").otherwise("SUCCESS"),
        "amount_cop": F.when(F.col("event") != "USER_REGISTERED", F.col("o_totalprice")),
        "channel": F.element_at(F.array(F.lit("app"), F.lit("web"), F.lit("api")), (key % 3 + 1).cast("int")),
        "device": F.when(key % 4 == 0, "mobile").when(key % 4 == 1, "web").when(key % 4 == 2, "tablet"),
    })
    events = add_usd(events.withColumns(event_flags(settings)), settings, "amount_cop")
    columns = [
        "event_id", "user_id", "timestamp", "date", "event", "event_status", "is_failed", "is_transactional",
        "amount_cop", "amount_usd", "channel", "device",
    ]
    if with_user:
        events = events.withColumns({
            "user_name": F.col("c_name"),
            "user_email": F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@mail.test")),
            "user_age": (F.col("o_custkey") % 60 + 18).cast("int"),
            "user_segment": F.col("c_mktsegment"),
            "location_city": F.col("n_name"),
            "balance_after": F.col("c_acctbal") - F.col("o_totalprice"),
        })
        columns += ["user_name", "user_email", "user_age", "user_segment", "location_city", "balance_after",
                    "merchant", "category"]
    return events.select(*columns)


# --- Raw events from the event table ---------------------------------------------------------

RAW_ORDER = ["seq"]  # unique row order inside a batch
BATCHES = {
    1: ("b1", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc), "events_1.json"),
    2: ("b2", dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc), "events_2.json"),
}


def _text(c: Column) -> Column:
    return c.cast("string")


def raw_events(spark: SparkSession, folder: str, batch: int = 1) -> DataFrame:
    """Nested events with the faults the layers must handle: padded, missing and repeated ids, bad
    dates and amounts, private, public and absent addresses. Batch 2 repeats a part of batch 1.
    """
    events = table(spark, folder, "events").withColumnRenamed("user_id", "c_custkey")
    events = lookup(events, table(spark, folder, "customer"), "c_custkey", salt_on=["event_id"])
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    events = lookup(events, nations, "c_nationkey", salt_on=["event_id"])
    n = F.col("event_id")
    if batch == 2:
        copies = F.when((n % 50 == 0) | (n % 90 == 7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        events = events.filter((n % 10 == 0) | (n % 30 == 7)).withColumn("copy", F.explode(copies))
        name, seq = F.when(n % 30 == 7, F.concat(F.lit("late-"), _text(n))), n * 2 + F.col("copy")
    else:
        name, seq = F.lit(None).cast("string"), n
    kind, user = F.col("event_type"), _text(F.col("c_custkey"))
    k = F.get_json_object("props", "$.k").cast("int")
    event = (
        F.when(kind == "signup", "USER_REGISTERED").when(kind == "purchase", "PURCHASE_MADE")
        .when(kind == "click", "PAYMENT_MADE").when(kind == "view", "TRANSFER_SENT")
        .when(kind == "error", "PAYMENT_FAILED")
    )
    registered = kind == "signup"
    amount = F.round(F.col("value") * 1000).cast("long")
    plain_id = F.coalesce(name, F.concat(F.lit("evt-"), _text(n)))
    payload = F.struct(
        F.concat(F.lit("user_"), user).alias("userId"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60 + 18).cast("int").alias("age"),
        F.concat(F.lit(" C"), user, F.lit("@Mail.Test ")).alias("email"),
        F.when(n % 7 != 0, F.col("n_name")).alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.when(n % 101 == 0, "not-a-date")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        F.concat(F.lit("acc_"), user).alias("accountId"),
        F.when(registered, F.lit(None)).when(n % 103 == 0, "n/a").otherwise(_text(amount)).alias("amount"),
        F.lit("COP").alias("currency"),
        F.when(~registered, F.concat(F.lit("merchant_"), _text(k % 12))).alias("merchant"),
        F.when(~registered, F.concat(F.lit("category_"), _text(k % 5))).alias("category"),
        F.when(n % 2 == 0, "card").otherwise("cash").alias("paymentMethod"),
        F.when(n % 4 == 0, F.lit(None)).when(n % 107 == 0, "x").otherwise(_text(n % 12 + 1)).alias("installments"),
        _text(F.round(F.col("c_acctbal") * 1000).cast("long")).alias("balanceBefore"),
        _text(F.round(F.col("c_acctbal") * 1000).cast("long") - amount).alias("balanceAfter"),
        F.when(registered, "0").alias("initialBalance"),
        F.when(registered, "ACTIVE").alias("status"),
        F.lit(None).cast("string").alias("source"),
        F.struct(
            F.when(n % 3 != 0, F.col("n_name")).alias("city"),
            F.when(n % 11 != 0, F.concat(F.lit("country_"), _text(F.col("c_nationkey") % 3))).alias("country"),
        ).alias("location"),
        F.struct(
            F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("segment"),
        ).alias("updatedFields"),
    )
    metadata = F.struct(
        F.when(n % 4 == 0, "mobile").when(n % 4 == 1, "web").when(n % 4 == 2, "tablet").alias("device"),
        F.lit("os").alias("os"),
        F.when(n % 5 == 0, F.concat(F.lit("192.168.1."), _text(n % 250))).when(n % 5 == 1, "8.8.8.8")
        .when(n % 5 == 3, "172.20.0.9").when(n % 5 == 4, "1.1.1.1").alias("ip"),
        F.when(n % 3 == 0, "app").when(n % 3 == 1, "web").otherwise("api").alias("channel"),
    )
    detail = F.struct(
        F.when(n % 97 == 0, F.lit(None)).when(n % 13 == 0, F.concat(F.lit("  "), plain_id, F.lit(" ")))
        .otherwise(plain_id).alias("id"),
        event.alias("event"),
        F.lit("1.0").alias("version"),
        F.lit("business").alias("eventType"),
        kind.alias("transactionType"),
        F.lit("user").alias("eventEntity"),
        F.when(n % 89 == 0, F.lit(None)).when(kind == "error", "FAILED").otherwise("SUCCESS").alias("eventStatus"),
        payload.alias("payload"),
        metadata.alias("metadata"),
    )
    return events.select(
        F.lit("payments.app").alias("source"), F.lit("transaction").alias("detailType"), detail.alias("detail"),
        seq.alias("seq"),
    )


def ip_geo(spark: SparkSession) -> DataFrame:
    """Lookup result for public addresses; an empty part does not override."""
    return spark.sql("""SELECT * FROM VALUES ('8.8.8.8', 'Mountain View', 'United States'),
        ('1.1.1.1', '', 'Australia') AS ip_geo(ip, city, country)""")


def bronze_batch(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """One stamped, unflagged Bronze batch; ``seq`` and ``bronze_file`` stand for its place in storage."""
    batch_id, at, source = BATCHES[batch]
    flat = flatten(raw_events(spark, folder, batch), keep=("seq",))
    return add_metadata(flat, source, batch_id, at).withColumn("bronze_file", F.lit(f"batch_{batch_id}.parquet"))


def bronze_written(spark: SparkSession, folder: str, batch: int, columns: Iterable[str] | None = None) -> DataFrame:
    """A batch derived once from the tables and written: flags, history and rows all read that. With ``columns`` only those that
    it has of them, as a written table keeps the optimizer from leaving out what nobody reads."""
    found = bronze_batch(spark, folder, batch)
    if columns is not None:
        found = found.select(*[c for c in found.columns if c in set(columns)])
    return staged(found, f"batch-{batch}")


def bronze_all(spark: SparkSession, folder: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Both batches as stored: the second flagged against the first. ``columns``, when given, are those that the caller reads
    besides the flags; those that the flags follow from come with them."""
    place = ["bronze_file", "seq"]
    if columns is not None:
        columns = {*columns, "event_id", *FIRST_SEEN_COLUMNS, *place}
    one, two = (bronze_written(spark, folder, batch, columns) for batch in (1, 2))
    flagged = flag_duplicates(two, first_seen(one, place, two), RAW_ORDER)
    return flag_duplicates(one, None, RAW_ORDER).unionByName(flagged)


def silver_events(spark: SparkSession, folder: str, settings: Settings = TABLES_SETTINGS) -> DataFrame:
    """Silver built from both batches through every step."""
    bronze = staged(bronze_all(spark, folder), "bronze")
    return build_silver(bronze, settings, ["bronze_file", "seq"], ip_geo(spark)).drop("bronze_file", "seq")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes and legacy events mixed, one per event row; nested parts are JSON text."""
    n, none = F.col("seq"), F.lit(None).cast("string")
    legacy = raw_events(spark, folder).filter(n % 4 == 0).select(
        "seq", none.alias("msg_type"), "source", none.alias("schema_version"), none.alias("message_id"),
        none.alias("timestamp"), none.alias("data"), none.alias("metadata"), "detailType",
        F.to_json("detail").alias("detail"),
    )
    events = table(spark, folder, "events").withColumnRenamed("event_id", "seq").filter(n % 4 != 0)
    data = F.concat(
        F.lit('{"name":"'), F.col("event_type"), F.lit('","value":'),
        _text(F.round(F.col("value") * 100).cast("long")),
        F.lit(',"nested":'), F.col("props"), F.lit(',"flag":true,"note":null,"list":[1,2]'),
        F.when(n % 8 == 1, F.lit(',"a":1,"b":2,"c":3,"d":4,"e":5,"f":6')).otherwise(F.lit("")), F.lit("}"),
    )
    kind = (
        F.when(n % 41 == 0, "bogus").when(n % 43 == 0, none).when(n % 4 == 1, "metric")
        .when(n % 8 == 2, "log").when(n % 4 == 2, "alert").when(n % 8 == 3, "event").otherwise("record")
    )
    generic = events.select(
        "seq", kind.alias("msg_type"), F.lit("bench").alias("source"),
        F.when(n % 6 == 1, "2.0").alias("schema_version"),
        F.when(n % 9 != 1, F.concat(F.lit("msg-"), _text(n))).alias("message_id"),
        F.when(n % 10 != 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"),
        data.alias("data"), F.when(n % 7 == 0, '{"device":"d"}').alias("metadata"), none.alias("detailType"),
        none.alias("detail"),
    )
    return generic.unionByName(legacy)
