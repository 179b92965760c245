"""Silver steps: Bronze rows in, typed, deduplicated and enriched events out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.config import Settings
from paylake.functions.scalars import MONEY_LIMIT, event_key, half_up, rows
from paylake.operators.skew import lookup
from paylake.session import staged

MONEY_COLUMNS = ("amount", "balance_before", "balance_after", "initial_balance")


def _number(c: str) -> Column:
    """Double, or null for text that is no number, or none that a sum of money can hold."""
    value = F.col(c).cast("string").try_cast("double")
    return F.when(F.abs(value) < F.lit(MONEY_LIMIT), value)


def clean_types(events: DataFrame) -> DataFrame:
    """UTC timestamp and date, numeric money, instalments (default 1), lower-case e-mail.

    A value that cannot be read becomes null; the row stays.
    """
    present = set(events.columns)
    typed: dict[str, Column] = {c: _number(c) for c in MONEY_COLUMNS if c in present}
    if "installments" in present:
        typed["installments"] = F.coalesce(_number("installments").try_cast("int"), F.lit(1))
    if "user_email" in present:
        typed["user_email"] = F.trim(F.lower("user_email"))
    typed["timestamp"] = F.col("timestamp").try_cast("timestamp")
    return events.withColumns(typed).withColumn("date", F.to_date("timestamp"))


def deduplicate(events: DataFrame, order_by: list[str]) -> DataFrame:
    """One canonical row per event id, with the number of copies; rows without an id all stay.

    Canonical: not flagged before flagged, then earliest ingestion (unknown last), then
    ``order_by``, the row's place in Bronze, which must be unique. A narrow pass over ids and places finds the ids that have
    copies, which combine inside each map task, and writes them to the shared folder. Whole rows are then only compared with that
    table: where it is small no row moves, otherwise hot ids are salted.
    """
    if "event_id" not in events.columns:
        raise ValueError("cannot deduplicate: no event_id column")
    flagged = F.coalesce(F.col("is_duplicate"), F.lit(False)) if "is_duplicate" in events.columns else F.lit(False)
    ingested = (
        F.col("ingestion_timestamp").try_cast("timestamp")
        if "ingestion_timestamp" in events.columns
        else F.lit(None).cast("timestamp")
    )
    keyed = events.withColumns({
        "_id": event_key(), "_order": F.struct(flagged.alias("flagged"), ingested.isNull().alias("late"), ingested.alias("at"), *order_by),
    })
    copies = (
        keyed.filter(F.col("_id").isNotNull()).groupBy("_id")
        .agg(rows().alias("_n"), F.min("_order").alias("_first")).filter(F.col("_n") > 1)
    )
    found = lookup(keyed, staged(copies, "silver-copies"), "_id", salt_on=order_by, weight="_n", written=True)
    return (
        found.filter(F.col("_first").isNull() | (F.col("_first") == F.col("_order")))
        .withColumn("bronze_duplicate_count", F.coalesce("_n", F.lit(1).cast("long")))
        .select(*events.columns, "bronze_duplicate_count")
    )


def add_flags(events: DataFrame, settings: Settings) -> DataFrame:
    """Failure, transaction and private-address flags; null input means false."""
    private = F.coalesce(F.col("ip").rlike(fv.PRIVATE_IP_PATTERN), F.lit(False))
    return events.withColumns({**event_flags(settings), "ip_is_private": private}).withColumn(
        "geo_source",
        F.when(F.col("ip_is_private"), fv.GEO_FROM_PAYLOAD).otherwise(fv.GEO_FROM_LOOKUP),
    )


def event_flags(settings: Settings) -> dict[str, Column]:
    return {
        "is_failed": F.col("event_status").eqNullSafe(fv.FAILED_STATUS),
        "is_transactional": F.coalesce(F.col("event").isin(*settings.transactional_events), F.lit(False)),
    }


def resolve_location(events: DataFrame) -> DataFrame:
    """Event city, else user city, else a fixed label; country defaults as well."""
    return events.withColumns({
        "location_city": F.coalesce("location_city", "user_city", F.lit(fv.UNKNOWN_CITY)),
        "location_country": F.coalesce("location_country", F.lit(fv.DEFAULT_COUNTRY)),
    })


def locate_public_ips(events: DataFrame, ip_geo: DataFrame, salt_on: list[str], **skew) -> DataFrame:
    """Override city and country by a non-empty ``ip_geo(ip, city, country)`` entry, public addresses only."""
    place = F.struct(F.nullif(F.col("city"), F.lit("")).alias("city"), F.nullif(F.col("country"), F.lit("")).alias("country"))
    # One entry per address, whatever the lookup holds: the one with a place, the least of several.
    geo = ip_geo.groupBy(F.col("ip").alias("_ip")).agg(
        F.min(F.struct(place["city"].isNull(), place["country"].isNull(), place.alias("place"))).alias("_g")
    ).select("_ip", F.col("_g.place.city").alias("_city"), F.col("_g.place.country").alias("_country"))
    keyed = events.withColumn("_ip", F.when(~F.col("ip_is_private"), F.col("ip")))
    return lookup(keyed, geo, "_ip", salt_on=salt_on, **skew).withColumns({
        "location_city": F.coalesce("_city", "location_city"),
        "location_country": F.coalesce("_country", "location_country"),
    }).drop("_ip", "_city", "_country")


def add_usd(events: DataFrame, settings: Settings, amount: str = "amount") -> DataFrame:
    """Convert with the run's single rate to 4 decimals; no amount, no conversion."""
    return events.withColumn("amount_usd", half_up(F.col(amount) * F.lit(settings.fx_rate), 4))


def final_columns(events: DataFrame) -> DataFrame:
    """Silver names, without the columns that end at Bronze."""
    return events.withColumnsRenamed({"amount": "amount_cop", "is_duplicate": "bronze_is_duplicate"}).drop(
        *fv.SILVER_DROPPED
    )


def build_silver(
    bronze: DataFrame, settings: Settings, order_by: list[str], ip_geo: DataFrame | None = None
) -> DataFrame:
    """All Silver steps over Bronze rows; ``order_by`` is the row order inside Bronze."""
    events = add_flags(deduplicate(clean_types(bronze), order_by), settings)
    events = resolve_location(events)
    if ip_geo is not None:
        events = locate_public_ips(events, ip_geo, salt_on=order_by)
    return final_columns(add_usd(events, settings))


def silver_run_summary(silver: DataFrame) -> DataFrame:
    """Row counts of a Silver build, including what deduplication removed."""
    return silver.agg(
        F.sum("bronze_duplicate_count").cast("long").alias("rows_before_dedup"),
        rows().alias("rows_after_dedup"),
        F.sum(F.col("bronze_duplicate_count") - 1).cast("long").alias("rows_removed"),
        F.count_if(event_key().isNull()).alias("rows_without_id"),
        F.count("amount_cop").alias("rows_with_amount"),
        F.count("amount_usd").alias("rows_converted"),
        F.count_if("is_failed").alias("failed_rows"),
        F.countDistinct("user_id").alias("distinct_users"),
    )
