"""Data-quality checks of the three layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import event_key, rows


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> str:
    return ",".join(c for c in required if c not in df.columns)


def check_bronze(bronze: DataFrame) -> DataFrame:
    """Rows, distinct ids, rows that share an id, flagged rows, missing required columns.

    Per-id counts are combined before the shuffle, so a hot id is one partial row per task.
    """
    per_id = bronze.groupBy("event_id").agg(rows().alias("n"), F.count_if("is_duplicate").alias("flagged"))
    return per_id.agg(
        F.sum("n").alias("rows"),
        F.count("event_id").alias("distinct_ids"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).cast("long").alias("rows_sharing_an_id"),
        F.sum("flagged").alias("flagged_rows"),
    ).withColumn("missing_columns", F.lit(missing_columns(bronze, fv.BRONZE_REQUIRED)))


def check_silver(silver: DataFrame) -> DataFrame:
    """Like Bronze, plus counts of failures and amounts; known ids must not repeat."""
    per_id = silver.groupBy(event_key().alias("event_id")).agg(
        rows().alias("n"), F.count_if("is_failed").alias("failed"),
        F.count("amount_cop").alias("cop"), F.count("amount_usd").alias("usd"),
    )
    repeated = F.col("event_id").isNotNull() & (F.col("n") > 1)
    return per_id.agg(
        F.sum("n").alias("rows"),
        F.count("event_id").alias("distinct_ids"),
        F.count_if(repeated).alias("repeated_ids"),
        F.sum("failed").alias("failed_rows"),
        F.sum("cop").alias("rows_with_cop"),
        F.sum("usd").alias("rows_with_usd"),
    ).withColumn("missing_columns", F.lit(missing_columns(silver, fv.SILVER_REQUIRED)))


def check_gold(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and missing columns per Gold table."""
    required = {
        "gold_user_360": fv.USER_360_COLUMNS, "gold_daily_metrics": fv.DAILY_COLUMNS,
        "gold_event_summary": fv.EVENT_SUMMARY_COLUMNS,
    }
    return reduce(DataFrame.unionByName, [
        df.agg(rows().alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(missing_columns(df, required[name])).alias("missing_columns")
        )
        for name, df in tables.items()
    ])


def check_invariants(segments: DataFrame, daily: DataFrame, events: DataFrame) -> DataFrame:
    """Rows breaking each rule, 0 when it holds. ``segments`` has revenue_por_usuario and tasa_fallo_pct."""
    def broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        one_row = df.agg(*(
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()
        ))
        return one_row.unpivot([], list(rules), "rule", "broken_rows")

    return reduce(DataFrame.unionByName, [
        broken(segments, {
            "segment_named": F.col("user_segment").isNotNull(),
            "segment_revenue_positive": F.col("revenue_por_usuario") > 0,
            "segment_failure_in_range": F.col("tasa_fallo_pct").between(0, 100),
        }),
        broken(daily, {
            "day_failed_within_transactions": F.col("failed_count") <= F.col("total_transactions"),
            "day_has_users": F.col("unique_users") > 0,
            "day_volume_not_negative": F.col("total_amount_cop") >= 0,
        }),
        broken(events, {"event_parts_add_up": F.col("success_count") + F.col("failed_count") == F.col("count")}),
    ])


def raw_event_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.col("detail.event").alias("event")).agg(rows().alias("n"))


def raw_distinct_values(raw: DataFrame) -> DataFrame:
    """Distinct cities and segments of the raw payloads, an absent city or segment as empty text."""
    values = raw.select(
        F.coalesce("detail.payload.city", F.lit("")).alias("city"),
        F.coalesce("detail.payload.segment", F.lit("")).alias("segment"),
    )
    return values.unpivot([], ["city", "segment"], "field", "value").distinct()
