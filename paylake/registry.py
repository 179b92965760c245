"""Named queries over the driver tables: name -> f(spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paylake.operators import gold
from paylake.plans import alerts, business, metrics, periods, reports
from paylake.session import pin_utc
from paylake.sources.tables import TABLES_SETTINGS as SETTINGS, silver_tx
from paylake import fixed_values as fv

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """UTC timestamps without a zone, so that a result reads the same in any client zone."""
    return df.select(*(
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return gold.user_360(silver_tx(spark, folder), SETTINGS)


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_metrics(silver_tx(spark, folder, with_user=False))


def event_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold.event_summary(silver_tx(spark, folder, with_user=False))


def _on(source: Query, build: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(source(pin_utc(spark), folder)))
    return query


def on_users(build) -> Query:
    return _on(users, build)


def on_daily(build) -> Query:
    return _on(daily, build)


def on_events(build) -> Query:
    return _on(event_summary, build)


def on_silver(build) -> Query:
    return _on(silver_tx, build)


def on_both(build) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        pin_utc(spark)
        return plain(build(users(spark, folder), daily(spark, folder)))
    return query


def builder_queries() -> dict[str, Query]:
    def failure_recency(silver: DataFrame) -> DataFrame:
        return gold.user_360(silver, SETTINGS).select(
            "user_id", "total_transactions", "failed_transactions", "failure_rate", "last_transaction_date",
            "days_since_last_tx",
        )

    def success(silver: DataFrame) -> DataFrame:
        return gold.success_transactions(silver, SETTINGS).select(
            "event_id", "user_id", "date", "event", "amount_cop", "amount_usd"
        )

    return {
        "gold_user_360": users_query,
        "gold_daily_metrics": on_daily(lambda d: d),
        "gold_event_summary": on_events(lambda e: e),
        "gold_success_tx": lambda s, f: success(silver_tx(pin_utc(s), f, with_user=False)),
        "gold_demographics": on_silver(gold.user_demographics),
        "gold_tx_metrics": on_silver(lambda s: gold.user_tx_metrics(s, SETTINGS)),
        "gold_modes": on_silver(lambda s: gold.user_modes(s, SETTINGS)),
        "gold_failure_recency": on_silver(failure_recency),
        "gold_run_summary": on_users(gold.gold_run_summary),
        "gold_period": on_daily(lambda d: d.agg(F.min("date").alias("desde"), F.max("date").alias("hasta"))),
    }


users_query = on_users(lambda u: u)


def metric_queries() -> dict[str, Query]:
    return {
        f"metric_{name}__{dimension}": on_users(
            partial(metrics.metric_by_dimension, dimension=dimension, name=name)
        )
        for name in metrics.METRICS
        for dimension in fv.DIMENSIONS
    }


def business_queries() -> dict[str, Query]:
    out = {
        "q_inactive": on_users(business.inactive_by_segment),
        "q_segment": on_users(business.segments),
        "q_city": on_users(business.cities),
        "q_city_by_failure": on_users(partial(business.cities, by_failure=True)),
        "q_failure": on_users(business.failures_by_segment),
        "q_top_users": on_users(business.top_users),
        "q_merchant": on_users(business.merchants),
        "q_category": on_users(business.categories),
        "q_channel": on_users(business.channels),
        "q_device": on_users(business.devices),
        "q_event": on_events(business.events),
        "q_daily": on_daily(business.recent_days),
        "q_business_kpis": on_users(business.business_kpis),
        "q_campaign": on_users(business.campaign_segments),
        "exec_kpis": on_users(business.executive_kpis),
        "exec_segments": on_users(business.executive_segments),
        "exec_cities": on_users(business.executive_cities),
        "exec_merchants": on_users(business.executive_merchants),
        "user_profile": on_users(lambda u: business.user_profile(u, "user_99", SETTINGS.pii)),
        "pii_drop": on_users(lambda u: u.drop(*SETTINGS.pii)),
        "wh_segment_volume": on_users(business.warehouse_segment_volume),
        "wh_city_failure": on_users(business.warehouse_city_failure),
        "verify_city_failure": on_users(business.worst_city),
    }
    subject = {3: "user_99", 10: "user_210"}
    for n in range(1, 11):
        out[f"ask_{n:02d}"] = on_users(
            lambda u, n=n: business.acceptance(n, u, user_id=subject.get(n, ""), segment="BUILDING")
        )
    return out


def report_queries() -> dict[str, Query]:
    segments = ("BUILDING", "MACHINERY")
    cities = tuple(f"NATION_{i}" for i in range(1, 6))
    out = {
        "report_kpis": on_users(reports.report_kpis),
        "report_kpi_status": on_users(reports.report_kpi_status),
        "report_segments": on_users(reports.report_segments),
        "report_cities": on_users(reports.report_cities),
        "report_merchants": on_users(reports.report_merchants),
        "report_daily": on_daily(reports.report_daily),
        "dash_filtered_kpis": on_users(partial(reports.dashboard_kpis, segments=segments, cities=cities)),
        "dash_leaders": on_users(reports.dashboard_leaders),
        "dash_segment_volume": on_users(reports.segment_volume),
        "dash_channel_share": on_users(reports.channel_share),
        "dash_merchants": on_users(reports.merchant_users),
        "dash_cities": on_users(reports.city_users),
        "dash_daily_trend": on_daily(reports.daily_trend),
        "dash_top_users": on_users(reports.dashboard_top_users),
        "chart_event_counts": on_events(partial(reports.event_chart, detail=False)),
        "chart_event_detail": on_events(partial(reports.event_chart, detail=True)),
        "chart_daily_volume": on_daily(partial(reports.daily_chart, measure="volumen_M_cop")),
        "chart_daily_users": on_daily(partial(reports.daily_chart, measure="unique_users")),
        "chart_daily_failures": on_daily(partial(reports.daily_chart, measure="failed_count")),
        "chart_daily_tx": on_daily(partial(reports.daily_chart, measure="total_transactions")),
    }
    for name in reports.USER_CHARTS:
        out[f"chart_{name}"] = on_users(partial(reports.user_chart, name))
    return out


def alert_queries() -> dict[str, Query]:
    return {
        "alert_base": on_users(alerts.base),
        "alert_global_failure": on_users(alerts.global_failure),
        "alert_segment_failure": on_users(alerts.segment_failure),
        "alert_concentration": on_users(alerts.concentration),
        "alert_churn": on_users(alerts.churn),
        "alert_activity": on_daily(alerts.activity),
        "alert_balance": on_users(alerts.balance),
        "alerts": on_both(alerts.alerts),
        "alert_counts": on_both(alerts.alert_counts),
        "period_compare": on_daily(periods.compare),
        "period_deltas": on_daily(periods.deltas),
        "period_trend": on_daily(periods.trend),
    }


def gold_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (builder_queries, business_queries, metric_queries, report_queries, alert_queries):
        out.update(part())
    return out
