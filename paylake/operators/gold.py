"""Gold builders: one row per user, per day and per event type.

Every aggregate here combines on the map side first, so a user, day or event type holding a
large part of all rows reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.config import Settings
from paylake.functions.scalars import MONEY, exact_sum, half_up, pct, rows, total_of

FIRST_SEEN = {  # Gold column <- Silver column
    "user_name": "user_name", "user_email": "user_email", "user_age": "user_age",
    "user_segment": "user_segment", "city": "location_city",
}


def is_success_tx(settings: Settings) -> Column:
    """A money movement by the user that did not fail."""
    return F.coalesce(F.col("event").isin(*settings.success_events), F.lit(False)) & ~F.col("is_failed")


def success_transactions(silver: DataFrame, settings: Settings) -> DataFrame:
    return silver.filter(is_success_tx(settings))


def _in_time() -> Column:
    """Time order with unknown times last; the event id breaks ties."""
    return F.struct(F.col("timestamp").isNull(), F.col("timestamp"), F.col("event_id"))


def _first_known(c: str) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _in_time()))


def user_demographics(silver: DataFrame) -> DataFrame:
    """First known attributes, event and failure counts, last event, per user."""
    return silver.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*_demographics())


def _demographics() -> list[Column]:
    return [
        *(_first_known(src).alias(out) for out, src in FIRST_SEEN.items()),
        F.count("event_id").alias("total_events"),
        F.count_if("is_failed").alias("failed_transactions"),
        F.max("timestamp").alias("last_event_date"),
    ]


def _tx_measures(ok: Column) -> list[Column]:
    """Measures over success transactions; money is null for a user who has none."""

    def tx_sum(c: str) -> Column:
        total = F.coalesce(exact_sum(F.when(ok, F.col(c))), F.lit(0.0))
        return half_up(F.when(F.count_if(ok) > 0, total), 2)

    amount = F.when(ok, F.col("amount_cop"))
    last_balance = F.max_by("balance_after", F.when(ok & F.col("balance_after").isNotNull(), _in_time()))
    return [
        F.count(F.when(ok, F.col("event_id"))).alias("total_transactions"),
        tx_sum("amount_cop").alias("total_amount_cop"),
        tx_sum("amount_usd").alias("total_amount_usd"),
        half_up(F.try_divide(exact_sum(amount), F.count(amount)), 2).alias("avg_ticket"),
        half_up(last_balance, 2).alias("balance_current"),
        F.max(F.when(ok, F.col("timestamp"))).alias("last_transaction_date"),
    ]


def user_tx_metrics(silver: DataFrame, settings: Settings) -> DataFrame:
    """Success-transaction measures, only users with at least one."""
    tx = success_transactions(silver, settings).filter(F.col("user_id").isNotNull())
    return tx.groupBy("user_id").agg(*_tx_measures(F.lit(True)))


def user_modes(silver: DataFrame, settings: Settings) -> DataFrame:
    """Most frequent merchant and category (success transactions), channel and device (all events).

    Events alike in all four are counted first, so only the counts are spread over the attributes; then per (user,
    attribute, value): no task ever holds the distinct values of a user, only running counts. The smallest value wins
    a tie.
    """
    ok = is_success_tx(settings)
    slots = {
        "top_merchant": F.when(ok, F.col("merchant")),
        "top_category": F.when(ok, F.col("category")),
        "preferred_channel": F.col("channel"),
        "preferred_device": F.col("device"),
    }
    values = (
        silver.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", *(value.alias(name) for name, value in slots.items())).agg(rows().alias("n"))
        .unpivot(["user_id", "n"], list(slots), "slot", "value")
        .filter(F.col("value").isNotNull())
    )
    counted = values.groupBy("user_id", "slot", "value").agg(F.sum("n").alias("n"))
    rank = F.struct(-F.col("n"), F.col("value"))
    return counted.groupBy("user_id").agg(
        *(F.min_by("value", F.when(F.col("slot") == name, rank)).alias(name) for name in slots)
    )


def failure_and_recency(users: DataFrame, settings: Settings) -> DataFrame:
    """Add the failure rate (0 when nothing was tried) and whole days since the last transaction."""
    failed, done = F.col("failed_transactions"), F.col("total_transactions")
    days = F.datediff(F.lit(settings.as_of), F.to_date("last_transaction_date")).cast("long")
    return users.withColumns({
        "failure_rate": F.coalesce(half_up(F.try_divide(failed, done + failed), 4), F.lit(0.0)),
        "days_since_last_tx": days,
    })


def user_360(silver: DataFrame, settings: Settings) -> DataFrame:
    """One row per user. Unused measures and the mode branch are pruned by the optimizer."""
    known = silver.filter(F.col("user_id").isNotNull())
    base = known.groupBy("user_id").agg(*_demographics(), *_tx_measures(is_success_tx(settings)))
    joined = failure_and_recency(base, settings).join(user_modes(silver, settings), "user_id", "left")
    return joined.select(
        "user_id", *FIRST_SEEN, "total_events", "total_transactions", "total_amount_cop", "total_amount_usd",
        "avg_ticket", "failed_transactions", "failure_rate", "balance_current", "top_merchant", "top_category",
        "preferred_channel", "preferred_device", "last_transaction_date", "last_event_date", "days_since_last_tx",
    )


def daily_metrics(silver: DataFrame) -> DataFrame:
    """One row per event date; amounts and transactions include failed ones."""
    return silver.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.count("event_id").alias("total_events"),
        F.count_if("is_transactional").alias("total_transactions"),
        half_up(F.coalesce(exact_sum("amount_cop", MONEY), F.lit(0.0)), 2).alias("total_amount_cop"),
        F.count_if("is_failed").alias("failed_count"),
        F.countDistinct("user_id").alias("unique_users"),
    )


def event_summary(silver: DataFrame) -> DataFrame:
    """One row per event type with its share of all events."""
    counted = silver.filter(F.col("event").isNotNull()).groupBy("event").agg(
        F.count("event_id").alias("count"),
        F.count_if(~F.col("is_failed")).alias("success_count"),
        F.count_if("is_failed").alias("failed_count"),
    )
    return counted.withColumn("pct_of_total", pct(F.col("count"), total_of(counted, "count"), 2))


def gold_run_summary(users: DataFrame) -> DataFrame:
    """Users, top spender, mean ticket and users with more than three failures, in one pass."""
    spend = F.when(F.col("total_amount_cop").isNotNull(), F.struct(-F.col("total_amount_cop"), F.col("user_id")))
    ticket = F.try_divide(exact_sum("avg_ticket"), F.count("avg_ticket"))
    return users.agg(
        rows().alias("users"),
        F.min_by("user_id", spend).alias("top_user"),
        F.max("total_amount_cop").alias("top_amount_cop"),
        half_up(ticket, 0).alias("mean_ticket"),
        F.count_if(F.col("failed_transactions") > 3).alias("users_over_3_failures"),
    )
