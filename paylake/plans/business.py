"""The named business questions over Gold: segments, cities, merchants, channels, events, days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.functions.scalars import exact_sum, half_up, pct, rows, total_of
from paylake.plans.metrics import (
    failure_pct, inactive, mean_recency, mean_ticket, revenue_per_user, volume, volume_millions,
)


def ranked(df: DataFrame, by: str, key: str, limit: int | None = None, ascending: bool = False) -> DataFrame:
    """Order by a measure, unknown last, the key breaking ties; optionally a top-k."""
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    result = df.orderBy(order, F.asc_nulls_last(key))
    return result.limit(limit) if limit else result


def table_by(users: DataFrame, key: str, measures: dict[str, Column], known: bool = False) -> DataFrame:
    """Measures per value of ``key``; ``known`` leaves out users without a value."""
    kept = users.filter(F.col(key).isNotNull()) if known else users
    return kept.groupBy(key).agg(*(m.alias(name) for name, m in measures.items()))


def _share_of_users(table: DataFrame, name: str) -> DataFrame:
    """Share of all grouped users, from the group counts."""
    return table.withColumn(name, pct(F.col("usuarios"), total_of(table, "usuarios"), 1))


def inactive_by_segment(users: DataFrame) -> DataFrame:
    idle = users.filter(F.col("days_since_last_tx") > 30)
    table = table_by(idle, "user_segment", {
        "usuarios_inactivos": rows(),
        "promedio_dias_sin_tx": mean_recency(),
        "max_dias_sin_tx": F.max("days_since_last_tx"),
        "ticket_historico": mean_ticket(),
        "tasa_fallo_pct": failure_pct(),
    })
    return ranked(table, "usuarios_inactivos", "user_segment")


def segments(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "revenue_por_usuario": revenue_per_user(),
        "ticket_promedio": mean_ticket(),
        "tasa_fallo_pct": failure_pct(),
        "dias_promedio_sin_tx": mean_recency(),
    })
    return ranked(table, "revenue_por_usuario", "user_segment")


def cities(users: DataFrame, by_failure: bool = False) -> DataFrame:
    table = table_by(users, "city", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "revenue_por_usuario": revenue_per_user(),
        "ticket_promedio": mean_ticket(),
        "tasa_fallo_pct": failure_pct(),
        "inactivos": inactive(30),
    })
    return ranked(table, "tasa_fallo_pct" if by_failure else "revenue_por_usuario", "city")


def failures_by_segment(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "usuarios": rows(),
        "transacciones_fallidas": F.sum("failed_transactions"),
        "tasa_fallo_pct": failure_pct(),
        "revenue_por_usuario": revenue_per_user(),
    })
    return ranked(table, "tasa_fallo_pct", "user_segment")


def top_users(users: DataFrame, limit: int = 10) -> DataFrame:
    return ranked(users, "total_amount_cop", "user_id", limit).select(
        "user_id", "user_segment", "city", "total_transactions",
        half_up("total_amount_cop", 0).alias("total_amount_cop"),
        half_up("avg_ticket", 0).alias("avg_ticket"),
        "top_merchant", "top_category",
    )


def merchants(users: DataFrame, limit: int = 10) -> DataFrame:
    """Penetration is a share of all users, also those without a merchant.

    The whole is a scalar subquery: merchants are an open vocabulary, so their rows are never
    brought into one partition for a total.
    """
    table = table_by(users, "top_merchant", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "ticket_por_usuario": revenue_per_user(),
        "tasa_fallo_pct": failure_pct(),
    }, known=True)
    whole = users.agg(rows()).scalar()
    top = ranked(table, "volumen_cop", "top_merchant", limit)
    return top.withColumn("penetracion_pct", pct(F.col("usuarios"), whole, 1))


def categories(users: DataFrame, limit: int = 10) -> DataFrame:
    table = table_by(users, "top_category", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "revenue_por_usuario": revenue_per_user(),
        "tasa_fallo_pct": failure_pct(),
    }, known=True)
    return ranked(table, "volumen_cop", "top_category", limit)


def channels(users: DataFrame) -> DataFrame:
    table = table_by(users, "preferred_channel", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "revenue_por_usuario": revenue_per_user(),
        "tasa_fallo_pct": failure_pct(),
    })
    return ranked(_share_of_users(table, "share_pct"), "volumen_cop", "preferred_channel")


def devices(users: DataFrame) -> DataFrame:
    table = table_by(users, "preferred_device", {
        "usuarios": rows(),
        "volumen_cop": volume(),
        "revenue_por_usuario": revenue_per_user(),
    })
    return ranked(_share_of_users(table, "share_pct"), "usuarios", "preferred_device")


def events(event_summary: DataFrame) -> DataFrame:
    table = event_summary.withColumn("tasa_fallo_pct", pct(F.col("failed_count"), F.col("count"), 1))
    return ranked(table, "count", "event")


def recent_days(daily: DataFrame, limit: int = 35) -> DataFrame:
    return daily.orderBy(F.desc("date")).limit(limit).select(
        "date", "total_events", "total_transactions",
        half_up("total_amount_cop", 0).alias("total_amount_cop"),
        "failed_count", "unique_users",
        pct(F.col("failed_count"), F.col("total_transactions"), 1).alias("tasa_fallo_pct"),
    )


def business_kpis(users: DataFrame) -> DataFrame:
    return users.agg(
        rows().alias("usuarios"),
        F.sum("total_transactions").alias("total_transacciones"),
        volume_millions().alias("volumen_M_cop"),
        half_up(exact_sum("total_amount_usd"), 2).alias("volumen_usd"),
        mean_ticket().alias("ticket_promedio"),
        failure_pct().alias("tasa_fallo_pct"),
        inactive(30).alias("inactivos_30d"),
    )


def campaign_segments(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "usuarios": rows(),
        "revenue_por_usuario": revenue_per_user(),
        "ticket_promedio": mean_ticket(),
        "tasa_fallo_pct": failure_pct(),
        "inactivos": inactive(30),
    })
    return ranked(table, "revenue_por_usuario", "user_segment")


# --- Executive summary ---------------------------------------------------------------------


def executive_kpis(users: DataFrame) -> DataFrame:
    return users.agg(
        rows().alias("total_usuarios"),
        F.sum("total_transactions").alias("total_transacciones"),
        volume_millions().alias("volumen_M_cop"),
        half_up(exact_sum("total_amount_usd"), 0).alias("volumen_usd"),
        mean_ticket().alias("ticket_promedio"),
        failure_pct().alias("tasa_fallo_pct"),
        inactive(30).alias("usuarios_inactivos_30d"),
        half_up(exact_sum("total_amount_cop") / rows() / 1e3, 1).alias("revenue_K_por_usuario"),
    )


def executive_segments(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "usuarios": rows(),
        "revenue_por_usuario": revenue_per_user(),
        "tasa_fallo_pct": failure_pct(),
        "ticket_promedio": mean_ticket(),
    })
    return ranked(table, "revenue_por_usuario", "user_segment")


def executive_cities(users: DataFrame) -> DataFrame:
    table = table_by(users, "city", {
        "usuarios": rows(), "revenue_por_usuario": revenue_per_user(), "tasa_fallo_pct": failure_pct(),
    })
    return ranked(table, "revenue_por_usuario", "city")


def executive_merchants(users: DataFrame, limit: int = 5) -> DataFrame:
    table = table_by(users, "top_merchant", {"usuarios": rows(), "ticket_por_usuario": revenue_per_user()}, known=True)
    return ranked(table, "ticket_por_usuario", "top_merchant", limit)


# --- Single users, acceptance questions, warehouse samples ----------------------------------


def user_profile(users: DataFrame, user_id: str, pii: tuple[str, ...]) -> DataFrame:
    return users.filter(F.col("user_id") == user_id).drop(*pii)


def acceptance(number: int, users: DataFrame, user_id: str = "", segment: str = "") -> DataFrame:
    """The ten acceptance questions, by number."""
    if number == 1:
        return users.agg(rows().alias("usuarios"))
    if number == 2:
        return ranked(users, "total_amount_cop", "user_id", 1).select("user_id", "total_amount_cop")
    if number == 3:
        return users.filter(F.col("user_id") == user_id).select("user_id", "total_amount_cop")
    if number == 4:
        table = table_by(users, "top_merchant", {"transacciones": F.sum("total_transactions")}, known=True)
        return ranked(table, "transacciones", "top_merchant", 5)
    if number == 5:
        table = table_by(users, "user_segment", {"ticket_promedio": mean_ticket()})
        return ranked(table, "ticket_promedio", "user_segment", 1)
    if number == 6:
        return users.agg(F.count_if(F.col("failed_transactions") > 3).alias("usuarios"))
    if number == 7:
        of_segment = users.filter(F.col("user_segment") == segment)
        return ranked(table_by(of_segment, "preferred_channel", {"usuarios": rows()}, known=True),
                      "usuarios", "preferred_channel", 1)
    if number == 8:
        return ranked(table_by(users, "city", {"volumen_cop": volume()}), "volumen_cop", "city", 1)
    if number == 9:
        return ranked(users, "days_since_last_tx", "user_id", 3).select("user_id", "days_since_last_tx")
    if number == 10:
        return users.filter(F.col("user_id") == user_id).select(
            "user_id", "total_amount_cop", "avg_ticket", "top_merchant", "preferred_channel"
        )
    raise ValueError(f"no acceptance question {number}")


def warehouse_segment_volume(users: DataFrame) -> DataFrame:
    table = table_by(users, "user_segment", {
        "usuarios": rows(), "volumen_cop": volume(), "ticket_promedio": mean_ticket(),
    })
    return ranked(table, "volumen_cop", "user_segment")


def warehouse_city_failure(users: DataFrame) -> DataFrame:
    return ranked(table_by(users, "city", {"tasa_fallo_pct": failure_pct()}), "tasa_fallo_pct", "city")


def worst_city(users: DataFrame) -> DataFrame:
    """City with the highest mean failure rate, an unknown rate counting as 0."""
    rate = F.coalesce("failure_rate", F.lit(0.0))
    known = users.filter(F.col("city").isNotNull()).withColumn("failure_rate", rate)
    return ranked(table_by(known, "city", {"tasa_fallo_pct": failure_pct()}), "tasa_fallo_pct", "city", 1)
