"""Certified metric catalogue: one metric by one dimension over the user table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import RATE, exact_avg, exact_sum, half_up, pct, rows


def inactive(days: int) -> Column:
    """Users whose last transaction is more than ``days`` ago; never-active users do not count."""
    return F.count_if(F.col("days_since_last_tx") > days)


def revenue_per_user() -> Column:
    """Total spend over all users, also those without any."""
    return half_up(exact_sum("total_amount_cop") / rows(), 0)


def volume() -> Column:
    return half_up(exact_sum("total_amount_cop"), 0)


def volume_millions(digits: int = 2) -> Column:
    return half_up(exact_sum("total_amount_cop") / 1e6, digits)


def mean_ticket() -> Column:
    return half_up(exact_avg("avg_ticket"), 0)


def failure_pct(digits: int = 1) -> Column:
    return half_up(exact_avg("failure_rate", RATE) * 100, digits)


def mean_recency() -> Column:
    return half_up(F.avg("days_since_last_tx"), 0)


def metric(name: str) -> tuple[str, Column]:
    """Result column name and expression of a catalogue metric."""
    catalogue = {
        "revenue_usuario": ("revenue_por_usuario", revenue_per_user),
        "volumen_total": ("volumen_M_cop", volume_millions),
        "ticket_transaccion": ("ticket_promedio_tx", mean_ticket),
        "usuarios": ("usuarios", rows),
        "tasa_fallo": ("tasa_fallo_pct", failure_pct),
        "balance_promedio": ("balance_promedio", lambda: half_up(exact_avg("balance_current"), 0)),
        "balance_total": ("balance_total", lambda: half_up(exact_sum("balance_current"), 0)),
        "inactivos_30d": ("inactivos_30d", lambda: inactive(30)),
        "inactivos_60d": ("inactivos_60d", lambda: inactive(60)),
        "pct_inactivos_30d": ("pct_inactivos_30d", lambda: pct(inactive(30), rows(), 1)),
        "transacciones_prom": ("tx_promedio", lambda: half_up(F.avg("total_transactions"), 1)),
        "transacciones_total": ("transacciones_total", lambda: F.sum("total_transactions")),
        "fallos_totales": ("fallos_totales", lambda: F.sum("failed_transactions")),
        "dias_sin_tx": ("dias_promedio_sin_tx", mean_recency),
        "revenue_usd": ("revenue_usd_usuario", lambda: half_up(exact_sum("total_amount_usd") / rows(), 2)),
        "eventos_prom": ("eventos_promedio", lambda: half_up(F.avg("total_events"), 1)),
    }
    label, build = catalogue[name]
    return label, build()


METRICS = (
    "revenue_usuario", "volumen_total", "ticket_transaccion", "usuarios", "tasa_fallo", "balance_promedio",
    "balance_total", "inactivos_30d", "inactivos_60d", "pct_inactivos_30d", "transacciones_prom",
    "transacciones_total", "fallos_totales", "dias_sin_tx", "revenue_usd", "eventos_prom",
)


def metric_by_dimension(
    users: DataFrame, dimension: str, name: str, chart: str = "bar", top_n: int = 10
) -> DataFrame | None:
    """Top groups by one metric; None for an unknown dimension or metric.

    Bars also carry the user count; pies keep 8 groups. The group name breaks ties.
    """
    if dimension not in fv.DIMENSIONS or name not in METRICS:
        return None
    column, drop_nulls = fv.DIMENSIONS[dimension]
    label, value = metric(name)
    measures = [value.alias(label)]
    if chart == "bar" and name != fv.GENERIC_METRIC:
        measures.append(rows().alias("usuarios"))
    kept = users.filter(F.col(column).isNotNull()) if drop_nulls else users
    return (
        kept.groupBy(column)
        .agg(*measures)
        .orderBy(F.desc_nulls_last(label), F.asc_nulls_last(column))
        .limit(8 if chart == "pie" else top_n)
    )
