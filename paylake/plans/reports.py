"""Datasets behind the report, the dashboard and the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import exact_avg, exact_sum, half_up, pct, rows, total_of
from paylake.plans.business import ranked, table_by
from paylake.plans.metrics import failure_pct, inactive, mean_ticket, revenue_per_user, volume_millions

# --- Report ----------------------------------------------------------------------------------


def report_kpis(users: DataFrame) -> DataFrame:
    return users.agg(
        rows().alias("usuarios"),
        F.sum("total_transactions").alias("transacciones"),
        volume_millions().alias("volumen_M_cop"),
        mean_ticket().alias("ticket_promedio"),
        failure_pct().alias("tasa_fallo_pct"),
        inactive(30).alias("inactivos_30d"),
    )


def report_kpi_status(users: DataFrame) -> DataFrame:
    """Colour of the two KPIs that have one."""
    kpis = report_kpis(users)
    failure = F.col("tasa_fallo_pct")
    share = F.try_divide(F.col("inactivos_30d"), F.col("usuarios"))
    return kpis.select(
        "tasa_fallo_pct",
        F.when(failure > fv.FAILURE_CRITICAL, "red").when(failure > fv.FAILURE_WARNING, "yellow")
        .otherwise("green").alias("tasa_fallo_status"),
        "inactivos_30d",
        F.when(share > fv.INACTIVE_SHARE_RED, "red").otherwise("neutral").alias("inactivos_status"),
    )


def report_segments(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "Usuarios": rows(),
        "Revenue_por_usuario": revenue_per_user(),
        "Ticket_promedio": mean_ticket(),
        "Tasa_fallo_pct": failure_pct(),
        "Inactivos_30d": inactive(30),
    }).withColumnRenamed("user_segment", "Segmento")
    return ranked(table, "Revenue_por_usuario", "Segmento")


def report_cities(users: DataFrame, limit: int = 10) -> DataFrame:
    table = table_by(users, "city", {
        "Usuarios": rows(), "Revenue_por_usuario": revenue_per_user(), "Tasa_fallo_pct": failure_pct(),
    }).withColumnRenamed("city", "Ciudad")
    return ranked(table, "Revenue_por_usuario", "Ciudad", limit)


def report_merchants(users: DataFrame, limit: int = 8) -> DataFrame:
    table = table_by(
        users, "top_merchant", {"Usuarios": rows(), "Revenue_por_usuario": revenue_per_user()}, known=True
    ).withColumnRenamed("top_merchant", "Merchant")
    return ranked(table, "Revenue_por_usuario", "Merchant", limit)


def report_daily(daily: DataFrame, limit: int = 14) -> DataFrame:
    return daily.orderBy(F.desc("date")).limit(limit).select(
        F.col("date").alias("Fecha"),
        F.col("total_transactions").alias("Transacciones"),
        half_up(F.col("total_amount_cop") / 1e6, 3).alias("Volumen_M_COP"),
        F.col("unique_users").alias("Usuarios_unicos"),
        pct(F.col("failed_count"), F.col("total_transactions"), 1).alias("Tasa_fallo_pct"),
    )


# --- Dashboard -------------------------------------------------------------------------------


def filter_users(users: DataFrame, segments=(), cities=()) -> DataFrame:
    """Keep the chosen segments and cities; an empty choice keeps all."""
    if segments:
        users = users.filter(F.col("user_segment").isin(*segments))
    if cities:
        users = users.filter(F.col("city").isin(*cities))
    return users


def dashboard_kpis(users: DataFrame, segments=(), cities=()) -> DataFrame:
    return filter_users(users, segments, cities).agg(
        rows().alias("usuarios"),
        volume_millions(1).alias("volumen_M_cop"),
        mean_ticket().alias("ticket_promedio"),
        failure_pct().alias("tasa_fallo_pct"),
    )


def dashboard_leaders(users: DataFrame) -> DataFrame:
    """Segment with the most volume and city with the most users, alphabetical on a tie; one pass."""
    named = users.select(
        "total_amount_cop", F.col("user_segment").alias("segment"), "city"
    ).unpivot("total_amount_cop", ["segment", "city"], "kind", "leader").filter(F.col("leader").isNotNull())
    volume = F.coalesce(exact_sum("total_amount_cop"), F.lit(0.0))
    scores = named.groupBy("kind", "leader").agg(
        F.when(F.col("kind") == "segment", volume).otherwise(rows().cast("double")).alias("score")
    )
    best = F.struct(-F.col("score"), F.col("leader"))
    return scores.groupBy("kind").agg(F.min_by("leader", best).alias("leader"), F.min_by("score", best).alias("score"))


def segment_volume(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "total_amount_cop": F.coalesce(exact_sum("total_amount_cop"), F.lit(0.0)),
    }, known=True)
    return ranked(table, "total_amount_cop", "user_segment", ascending=True)


def channel_share(users: DataFrame) -> DataFrame:
    table = table_by(users, "preferred_channel", {"usuarios": rows()}, known=True)
    share = pct(F.col("usuarios"), total_of(table, "usuarios"), 1)
    return ranked(table.withColumn("share_pct", share), "usuarios", "preferred_channel")


def merchant_users(users: DataFrame, limit: int = 12) -> DataFrame:
    """Top merchants by users; the literal text None is taken out after the cut."""
    table = table_by(users, "top_merchant", {"usuarios": rows()}, known=True)
    return ranked(table, "usuarios", "top_merchant", limit).filter(F.col("top_merchant") != "None")


def city_users(users: DataFrame) -> DataFrame:
    table = table_by(users, "city", {"usuarios": F.count("user_id")}, known=True)
    return ranked(table, "usuarios", "city")


def daily_trend(daily: DataFrame) -> DataFrame:
    """Daily transactions beside their overall mean (input: one row per day)."""
    mean = half_up(F.avg("total_transactions").over(Window.partitionBy()), 4)
    return daily.select("date", "total_transactions", mean.alias("mean_transactions")).orderBy("date")


def dashboard_top_users(users: DataFrame, limit: int = 15) -> DataFrame:
    return ranked(users, "total_amount_cop", "user_id", limit).select(
        "user_id", "user_segment", "city", "total_amount_cop", "avg_ticket", "failure_rate", "preferred_channel"
    )


# --- Charts ----------------------------------------------------------------------------------


def _balance() -> Column:
    return half_up(exact_avg("balance_current"), 0)


# name -> (group column, only known values, order column, limit, measures)
def user_charts() -> dict[str, tuple[str, bool, str, int | None, dict[str, Column]]]:
    users, ticket, revenue, fails = rows(), mean_ticket(), revenue_per_user(), failure_pct()
    seg, shop = "user_segment", "top_merchant"
    return {
        "segment_users": (seg, False, "usuarios", None, {"usuarios": users}),
        "segment_revenue": (seg, False, "revenue_por_usuario", None,
                            {"revenue_por_usuario": revenue, "ticket_promedio": ticket}),
        "segment_failure": (seg, False, "usuarios", None, {"usuarios": users, "tasa_fallo": fails}),
        "city_users": ("city", False, "usuarios", None, {"usuarios": users}),
        "city_volume": ("city", False, "volumen_M_cop", None, {"volumen_M_cop": volume_millions()}),
        "city_failure": ("city", False, "tasa_fallo", None, {"tasa_fallo": fails}),
        "merchant_ticket": (shop, True, "ticket_promedio", 8, {"ticket_promedio": ticket}),
        "merchant_users8": (shop, True, "usuarios", 8, {"usuarios": users}),
        "merchant_revenue": (shop, True, "revenue_por_usuario", 10,
                             {"revenue_por_usuario": revenue, "ticket_promedio": ticket}),
        "merchant_users10": (shop, True, "usuarios", 10, {"usuarios": users}),
        "category_users": ("top_category", True, "usuarios", None, {"usuarios": users}),
        "category_ticket": ("top_category", True, "usuarios", 10, {"usuarios": users, "ticket_promedio": ticket}),
        "channel_users": ("preferred_channel", True, "usuarios", None, {"usuarios": users}),
        "channel_failure": ("preferred_channel", True, "usuarios", None, {"usuarios": users, "tasa_fallo": fails}),
        "device_users": ("preferred_device", True, "usuarios", None, {"usuarios": users}),
        "device_ticket": ("preferred_device", True, "usuarios", None,
                          {"usuarios": users, "ticket_promedio": ticket}),
        "revenue_segment": (seg, False, "revenue_por_usuario", None, {"revenue_por_usuario": revenue}),
        "ticket_revenue": (seg, False, "revenue_por_usuario", None,
                           {"ticket_promedio": ticket, "revenue_por_usuario": revenue}),
        "balance_avg": (seg, False, "balance_promedio", None, {"balance_promedio": _balance()}),
        "balance_avg_min": (seg, False, "balance_promedio", None,
                            {"balance_promedio": _balance(),
                             "balance_minimo": half_up(F.min("balance_current"), 0)}),
        "inactive30": (seg, False, "inactivos_30d", None, {"inactivos_30d": inactive(30)}),
        "inactive30_60": (seg, False, "inactivos_30d", None,
                          {"inactivos_30d": inactive(30), "inactivos_60d": inactive(60),
                           "total_usuarios": rows()}),
        "failure_rate": (seg, False, "tasa_fallo", None, {"tasa_fallo": fails}),
        "failure_detail": (seg, False, "tasa_fallo", None,
                           {"tasa_fallo": fails, "transacciones_fallidas": F.sum("failed_transactions")}),
    }


USER_CHARTS = (
    "segment_users", "segment_revenue", "segment_failure", "city_users", "city_volume", "city_failure",
    "merchant_ticket", "merchant_users8", "merchant_revenue", "merchant_users10", "category_users",
    "category_ticket", "channel_users", "channel_failure", "device_users", "device_ticket", "revenue_segment",
    "ticket_revenue", "balance_avg", "balance_avg_min", "inactive30", "inactive30_60", "failure_rate",
    "failure_detail",
)


def user_chart(name: str, users: DataFrame) -> DataFrame:
    key, known, order, limit, measures = user_charts()[name]
    return ranked(table_by(users, key, measures, known), order, key, limit)


def event_chart(summary: DataFrame, detail: bool) -> DataFrame:
    columns = ["event", "count"] + (["success_count", "failed_count"] if detail else [])
    return ranked(summary.select(*columns), "count", "event")


def daily_chart(daily: DataFrame, measure: str) -> DataFrame:
    """One daily series; the volume series is in millions."""
    value = (
        half_up(F.col("total_amount_cop") / 1e6, 2).alias("volumen_M_cop")
        if measure == "volumen_M_cop" else F.col(measure)
    )
    return daily.select("date", value).orderBy("date")
