"""Automatic findings over Gold: (rule, entity, value, severity) rows. Thresholds are strict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import MONEY, RATE, half_up, pct, rows
from paylake.plans.metrics import failure_pct, inactive, mean_ticket, volume_millions


def base(users: DataFrame) -> DataFrame:
    """The global KPIs behind the alerts, one row."""
    kpis = users.agg(
        failure_pct(2).alias("tasa_fallo_global"),
        rows().alias("total_usuarios"),
        inactive(30).alias("inactivos_30d"),
        inactive(60).alias("inactivos_60d"),
        volume_millions().alias("volumen_M_cop"),
        mean_ticket().alias("ticket_promedio"),
    )
    total = F.col("total_usuarios")
    return kpis.withColumns({
        f"pct_inactivos_{n}d": F.coalesce(pct(F.col(f"inactivos_{n}d"), total, 1), F.lit(0.0)) for n in (30, 60)
    })


def _above(value: Column, critical: float, warning: float) -> Column:
    return F.when(value > critical, "critical").when(value > warning, "warning")


def _segment_facts(users: DataFrame) -> DataFrame:
    """One row per segment with its figures, the global ones, and which segment leads.

    Sums stay decimal until they are compared, so global figures are those of all users. The
    windows see one row per segment.
    """
    sums = users.groupBy("user_segment").agg(
        rows().alias("n"),
        F.sum(F.col("failure_rate").try_cast(RATE)).alias("failure"), F.count("failure_rate").alias("failure_n"),
        F.sum(F.col("total_amount_cop").try_cast(MONEY)).alias("amount"),
        F.sum(F.col("balance_current").try_cast(MONEY)).alias("balance"), F.count("balance_current").alias("balance_n"),
        inactive(30).alias("idle_30"), inactive(60).alias("idle_60"),
    )

    def total(c: str) -> Column:
        return F.sum(c).over(Window.partitionBy())

    def mean(part: Column, n: Column) -> Column:
        return F.try_divide(part.cast("double"), n)

    figures = sums.select(
        "user_segment",
        half_up(mean(F.col("failure"), F.col("failure_n")) * 100, 1).alias("segment_failure"),
        half_up(mean(total("failure"), total("failure_n")) * 100, 2).alias("global_failure"),
        pct(F.col("amount").cast("double"), total("amount").cast("double"), 1).alias("share"),
        half_up(mean(F.col("balance"), F.col("balance_n")), 0).alias("mean_balance"),
        pct(total("idle_30"), total("n"), 1).alias("idle_30"),
        pct(total("idle_60"), total("n"), 1).alias("idle_60"),
    )
    by_name = F.asc_nulls_last("user_segment")
    return figures.withColumns({
        "largest": F.row_number().over(Window.orderBy(F.desc_nulls_last("share"), by_name)) == 1,
        "poorest": F.row_number().over(Window.orderBy(F.asc_nulls_last("mean_balance"), by_name)) == 1,
    })


def user_findings(users: DataFrame) -> DataFrame:
    """All findings about users, from one pass over them."""
    segment, largest = F.col("user_segment"), F.col("largest")
    everyone = F.lit("all")
    balance_level = F.when(F.col("mean_balance") < fv.BALANCE_CRITICAL, "critical").when(
        F.col("mean_balance") < fv.BALANCE_WARNING, "warning")
    rules = [  # rule, row that states it, entity, value, severity; no severity is no finding
        ("global_failure", largest, everyone, F.col("global_failure"),
         _above(F.col("global_failure"), fv.FAILURE_CRITICAL, fv.FAILURE_WARNING).otherwise("ok")),
        ("segment_failure", F.lit(True), segment, F.col("segment_failure"),
         _above(F.col("segment_failure"), fv.FAILURE_CRITICAL, fv.FAILURE_WARNING)),
        ("concentration", largest, segment, F.col("share"),
         _above(F.col("share"), fv.CONCENTRATION_CRITICAL, fv.CONCENTRATION_WARNING).otherwise("ok")),
        ("churn", largest, F.lit("30d"), F.col("idle_30"),
         _above(F.col("idle_30"), fv.CHURN30_CRITICAL, fv.CHURN30_WARNING).otherwise("ok")),
        ("churn", largest, F.lit("60d"), F.col("idle_60"),
         F.when(F.col("idle_60") > fv.CHURN60_CRITICAL, "critical")),
        ("balance", F.col("poorest"), segment, F.col("mean_balance"), balance_level),
    ]
    stated = F.array(*(
        F.struct(
            F.lit(rule).alias("rule"), entity.cast("string").alias("entity"), value.cast("double").alias("value"),
            F.when(states, severity).alias("severity"),
        ) for rule, states, entity, value, severity in rules
    ))
    findings = _segment_facts(users).select(F.explode(stated).alias("f")).select("f.*")
    return findings.filter(F.col("severity").isNotNull())


def _only(rule: str, users: DataFrame) -> DataFrame:
    return user_findings(users).filter(F.col("rule") == rule)


def global_failure(users: DataFrame) -> DataFrame:
    """Mean failure rate of all users; always a row."""
    return _only("global_failure", users)


def segment_failure(users: DataFrame) -> DataFrame:
    """Segments above the healthy failure rate."""
    return _only("segment_failure", users)


def concentration(users: DataFrame) -> DataFrame:
    """Largest share of one segment in all revenue; always a row."""
    return _only("concentration", users)


def churn(users: DataFrame) -> DataFrame:
    """Inactive share after 30 days (always a row) and after 60 days (only when critical)."""
    return _only("churn", users)


def balance(users: DataFrame) -> DataFrame:
    """Segment with the lowest mean balance, when that is low."""
    return _only("balance", users)


def activity(daily: DataFrame) -> DataFrame:
    """Mean transactions of the latest 3 days against the 7 before, both rounded before comparing."""
    window = fv.RECENT_DAYS + fv.PRIOR_DAYS
    latest = daily.select("date", "total_transactions").orderBy(F.desc("date")).limit(window)
    rank = F.row_number().over(Window.orderBy(F.desc("date")))  # at most ten rows
    tx = F.col("total_transactions")
    means = latest.withColumn("rn", rank).agg(
        F.coalesce(half_up(F.avg(F.when(F.col("rn") <= fv.RECENT_DAYS, tx)), 0), F.lit(0.0)).alias("recent"),
        half_up(F.avg(F.when(F.col("rn") > fv.RECENT_DAYS, tx)), 0).alias("prior"),
    ).filter(F.col("prior") > 0)
    deltas = means.withColumn("delta", half_up((F.col("recent") - F.col("prior")) / F.col("prior") * 100, 1))
    d = F.col("delta")
    severity = (
        F.when(d < fv.ACTIVITY_CRITICAL, "critical").when(d < fv.ACTIVITY_WARNING, "warning").otherwise("ok")
    )
    label = F.when(d > fv.ACTIVITY_PEAK, "peak").when(d < fv.ACTIVITY_WARNING, "drop").otherwise("stable")
    return deltas.select(
        F.lit("activity").alias("rule"), label.alias("entity"), d.alias("value"), severity.alias("severity")
    )


def alerts(users: DataFrame, daily: DataFrame) -> DataFrame:
    """All findings."""
    return user_findings(users).unionByName(activity(daily))


def alert_counts(users: DataFrame, daily: DataFrame) -> DataFrame:
    return alerts(users, daily).groupBy("severity").agg(rows().alias("n"))
