"""Column profiles and extremes of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paylake import fixed_values as fv
from paylake.functions.scalars import MONEY, half_up, pct, rows


def column_roles(name: str, dtype: T.DataType) -> str:
    """Roles by name fragment, else by type, joined with commas."""
    lower = name.lower()
    found = ["identificador"] if lower.endswith("_id") else []
    found += [role for role, parts in fv.ROLE_FRAGMENTS if any(p in lower for p in parts)]
    if not found and isinstance(dtype, T.StringType):
        found = ["dimension"]
    if not found and isinstance(dtype, T.NumericType):
        found = ["metrica"]
    return ",".join(found or ["descriptiva"])


def _is_day(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _day_of(f: T.StructField) -> Column | None:
    """The date in a column of dates, or of texts whose name says that they are."""
    if _is_day(f.dataType):
        return F.to_date(F.col(f"`{f.name}`"))
    if isinstance(f.dataType, T.StringType) and "fecha" in column_roles(f.name, f.dataType).split(","):
        return F.to_date(F.col(f"`{f.name}`").try_cast("timestamp"))
    return None


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, roles, nulls, distinct values, numeric range and mean, date range (of dates, and of
    texts in columns named after dates).

    Counts, ranges and means are one aggregate without groups. Distinct values are counted from 96 bits of hash per (column, value),
    in the column's own type, combined inside each task before they move; no task holds the values of a column.
    """
    fields = df.schema.fields
    none = F.lit(None)
    figures, hashes = [], []
    for f in fields:
        value = F.col(f"`{f.name}`")
        number = value.cast("double") if isinstance(f.dataType, T.NumericType) else None
        day = _day_of(f)
        mean = F.try_divide(F.sum(number.try_cast(MONEY)).cast("double"), F.count(number)) if number is not None else none
        figures.append(F.struct(
            F.lit(f.name).alias("column"), rows().alias("rows"), F.count_if(value.isNull()).alias("nulls"),
            (F.min(number) if number is not None else none).cast("double").alias("min"),
            (F.max(number) if number is not None else none).cast("double").alias("max"),
            half_up(mean, 4).cast("double").alias("mean"),
            (F.min(day) if day is not None else none).cast("date").alias("min_date"),
            (F.max(day) if day is not None else none).cast("date").alias("max_date")))
        comparable = value.cast("string") if isinstance(f.dataType, (T.MapType, T.VariantType)) else value
        hashes.append(F.when(value.isNotNull(), F.struct(
            F.lit(f.name).alias("column"), F.xxhash64(comparable).alias("h"), F.hash(comparable).alias("g"))))
    measured = df.agg(F.array(*figures).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    distinct = (df.select(F.explode(F.array_compact(F.array(*hashes))).alias("v")).select("v.*").distinct()
                .groupBy("column").agg(rows().alias("distinct")))
    columns = df.sparkSession.range(1).select(F.explode(F.array(*(
        F.struct(
            F.lit(table).alias("table"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(column_roles(f.name, f.dataType)).alias("roles"),
        ) for f in fields
    ))).alias("c")).select("c.*")
    zero = F.lit(0).cast("long")
    return (
        columns.join(measured, "column").join(distinct, "column", "left")
        .withColumn("distinct", F.coalesce("distinct", zero))
        .withColumn("nulls_pct", F.coalesce(pct(F.col("nulls"), F.col("rows"), 2), F.lit(0.0)))
    )


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, columns and which of them are personal, metrics, dimensions or dates, by their roles."""
    def having(df: DataFrame, role: str) -> Column:
        return F.lit(",".join(sorted(
            f.name for f in df.schema.fields if role in column_roles(f.name, f.dataType).split(","))))

    parts = [
        df.agg(rows().alias("rows")).select(
            F.lit(name).alias("table"), "rows",
            F.lit(len(df.columns)).cast("long").alias("columns"),
            F.lit(",".join(sorted(df.columns))).alias("column_names"),
            *(having(df, role).alias(f"{name}_columns") for name, role in
              (("pii", "pii"), ("metric", "metrica"), ("dimension", "dimension"), ("date", "fecha"))),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def metric_extremes(df: DataFrame, label: str, measures: list[str]) -> DataFrame:
    """Per measure: which label has the largest and smallest value, and the gap between them.

    The first label in alphabetical order wins a tie; the gap in percent is null against 0.
    """
    def extreme(m: str) -> Column:
        v = F.col(m).cast("double")
        high = F.min(F.when(v.isNotNull(), F.struct((-v).alias("v"), F.col(label).cast("string").alias("l"))))
        low = F.min(F.when(v.isNotNull(), F.struct(v.alias("v"), F.col(label).cast("string").alias("l"))))
        return F.struct(F.lit(m).alias("measure"), high.alias("high"), low.alias("low"))

    one_row = df.agg(*(extreme(m).alias(f"e{i}") for i, m in enumerate(measures)))
    gap = F.col("max_value") - F.col("min_value")
    return (
        one_row.select(F.explode(F.array(*(f"e{i}" for i in range(len(measures))))).alias("e"))
        .filter(F.col("e.high").isNotNull())
        .select(
            F.col("e.measure").alias("measure"),
            F.col("e.high.l").alias("max_label"), (-F.col("e.high.v")).alias("max_value"),
            F.col("e.low.l").alias("min_label"), F.col("e.low.v").alias("min_value"),
        )
        .withColumns({
            "gap": half_up(gap, 4),
            "gap_pct": half_up(F.try_divide(gap * 100.0, F.abs("min_value")), 1),
        })
    )
