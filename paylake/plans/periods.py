"""Two consecutive windows of days compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import exact_sum, half_up, pct, rows

CURRENT, PRIOR = "ACTUAL", "ANTERIOR"
# measure -> a lower value is better
COMPARED = {
    "transacciones": False, "volumen_M_cop": False, "usuarios_activos_dia": False, "usuarios_totales": False,
    "fallos": True, "tasa_fallo_pct": True,
}


def compare(daily: DataFrame, days: int = 7) -> DataFrame:
    """One row per period; a period without days is a row of nulls. ``days`` is a whole number from 1 on.

    Only the latest 2 x days rows are ranked: a top-k over the day table, then a window over it.
    """
    if days != int(days) or days < 1:
        raise ValueError(f"not a number of days: {days!r}")
    latest = daily.orderBy(F.desc("date")).limit(2 * days)
    rank = F.row_number().over(Window.orderBy(F.desc("date")))
    labelled = latest.withColumn("periodo", F.when(rank <= days, CURRENT).otherwise(PRIOR))
    measured = labelled.groupBy("periodo").agg(
        F.min("date").alias("desde"),
        F.max("date").alias("hasta"),
        rows().alias("dias_datos"),
        F.sum("total_transactions").alias("transacciones"),
        half_up(exact_sum("total_amount_cop") / 1e6, 3).alias("volumen_M_cop"),
        half_up(F.avg("unique_users"), 0).alias("usuarios_activos_dia"),
        F.sum("unique_users").alias("usuarios_totales"),
        F.sum("failed_count").alias("fallos"),
        pct(F.sum("failed_count"), F.sum("total_transactions"), 2).alias("tasa_fallo_pct"),
    )
    labels = daily.sparkSession.sql(f"SELECT * FROM VALUES ('{CURRENT}'), ('{PRIOR}') AS periods(periodo)")
    return labels.join(measured, "periodo", "left").withColumn("dias_datos", F.coalesce("dias_datos", F.lit(0)))


def _side_by_side(compared: DataFrame) -> DataFrame:
    """One row: every measure as <measure>__a (current) and <measure>__p (prior)."""
    def of(period: str, measure: str, suffix: str):
        return F.max(F.when(F.col("periodo") == period, F.col(measure).cast("double"))).alias(f"{measure}__{suffix}")

    return compared.agg(*(c for m in COMPARED for c in (of(CURRENT, m, "a"), of(PRIOR, m, "p"))))


def deltas(daily: DataFrame, days: int = 7) -> DataFrame:
    """Change per measure in percent with a colour; no percentage against 0."""
    pairs = _side_by_side(compare(daily, days)).select(F.explode(F.array(*(
        F.struct(
            F.lit(m).alias("measure"),
            F.coalesce(F.col(f"{m}__a"), F.lit(0.0)).alias("current"),
            F.coalesce(F.col(f"{m}__p"), F.lit(0.0)).alias("prior"),
            F.lit(lower).alias("lower_is_better"),
        ) for m, lower in COMPARED.items()
    ))).alias("m")).select("m.*")
    change = half_up(F.try_divide(F.col("current") - F.col("prior"), F.abs("prior")) * 100, 1)
    d = F.col("delta_pct")
    better = F.when(F.col("lower_is_better"), d < 0).otherwise(d > 0)
    return pairs.withColumn("delta_pct", change).withColumn(
        "colour",
        F.when(d.isNull(), "N/D").when(better, "green").when(F.abs(d) > fv.PERIOD_RED, "red").otherwise("yellow"),
    )


def trend(daily: DataFrame, days: int = 7) -> DataFrame:
    """Growth when transactions and volume both rose, contraction when both fell, else mixed.

    No row against a prior of 0; an empty prior period is mixed.
    """
    def change(m: str):
        return half_up(F.try_divide(F.col(f"{m}__a") - F.col(f"{m}__p"), F.col(f"{m}__p")) * 100, 1)

    def not_zero(m: str):
        return F.coalesce(F.col(f"{m}__p") != 0, F.lit(True))

    pairs = _side_by_side(compare(daily, days)).filter(not_zero("transacciones") & not_zero("volumen_M_cop"))
    wide = pairs.select(
        change("transacciones").alias("tx_delta_pct"),
        change("volumen_M_cop").alias("volume_delta_pct"),
        half_up(F.col("tasa_fallo_pct__a") - F.col("tasa_fallo_pct__p"), 2).alias("failure_delta_points"),
    )
    tx, vol = F.col("tx_delta_pct"), F.col("volume_delta_pct")
    label = F.when((tx > 0) & (vol > 0), "growth").when((tx < 0) & (vol < 0), "contraction").otherwise("mixed")
    return wide.withColumn("trend", label)
