"""Publication of Gold to the session catalog and its readiness check."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake import fixed_values as fv
from paylake.operators import guard
from paylake.sources.files import null_tokens_to_null

REQUIRED_COLUMNS = {
    "gold_user_360": fv.USER_360_COLUMNS,
    "gold_daily_metrics": fv.DAILY_COLUMNS,
    "gold_event_summary": fv.EVENT_SUMMARY_COLUMNS,
}


def publish_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a catalog table; null-like texts become NULL."""
    writer = null_tokens_to_null(df).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def _tables(spark: SparkSession, sql: str = "") -> dict[str, DataFrame]:
    """Stored tables of the current database, those that a text names if one is given. Temporary views are not among them."""
    return {t.name: spark.table(f"{t.catalog}.{'.'.join(t.namespace)}.{t.name}") for t in spark.catalog.listTables()
            if not t.isTemporary and (not sql or re.search(rf"\b{re.escape(t.name)}\b", sql, re.IGNORECASE))}


def ask(spark: SparkSession, sql: str, max_rows: int = fv.WAREHOUSE_ROW_CAP) -> guard.Answer:
    """Read-only SQL over tables of the current database, personal columns masked, at most ``max_rows`` rows; the answer says
    whether it was cut."""
    df, personal = guard.resolved(spark, sql, _tables(spark, sql), fv.WAREHOUSE_FORBIDDEN_WORDS)
    return guard.capped(df, max_rows, personal)


def query(spark: SparkSession, sql: str, max_rows: int = fv.WAREHOUSE_ROW_CAP) -> DataFrame:
    return ask(spark, sql, max_rows).rows


def command(spark: SparkSession, sql: str, max_rows: int = fv.WAREHOUSE_ROW_CAP) -> DataFrame:
    """Like ``query``, also SHOW TABLES, DESCRIBE of a stored table and EXPLAIN of a query: nothing else of these is answered."""
    text = guard.check(sql, fv.WAREHOUSE_FORBIDDEN_WORDS, fv.COMMAND_STARTS).strip()
    if re.match(r"\(*\s*(" + "|".join(fv.QUERY_STARTS) + r")\b", text, re.IGNORECASE):
        return query(spark, sql, max_rows)
    if re.fullmatch(r"SHOW\s+TABLES", text, re.IGNORECASE):
        names = [(".".join(t.namespace), t.name) for t in spark.catalog.listTables() if not t.isTemporary]
        return spark.createDataFrame(names, "namespace string, tableName string").limit(max_rows)
    described = re.fullmatch(r"(?:DESCRIBE|DESC)\s+(?:TABLE\s+)?`?(\w+)`?", text, re.IGNORECASE)
    if described:
        table = {name.lower(): df for name, df in _tables(spark, text).items()}.get(described.group(1).lower())
        if table is None:
            raise guard.UnsafeSQL(f"not a stored table: {described.group(1)}")
        fields = [(f.name, f.dataType.simpleString()) for f in table.schema.fields]
        return spark.createDataFrame(fields, "col_name string, data_type string").limit(max_rows)
    explained = re.fullmatch(r"EXPLAIN\s+(?:EXTENDED\s+|FORMATTED\s+|COST\s+|CODEGEN\s+)?(.*)", text, re.IGNORECASE | re.DOTALL)
    if explained:
        df = guard.answer(spark, explained.group(1), _tables(spark, text), fv.WAREHOUSE_FORBIDDEN_WORDS)
        plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return spark.createDataFrame([(plan,)], "plan string")
    raise guard.UnsafeSQL("not a command that is answered")


def readiness(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    """Per required Gold table: present, row count, missing columns. ``names`` maps it to a catalog name.

    Names and columns come from the catalog; the rows of all tables are counted in one job.
    """
    found = {t.name.lower() for t in spark.catalog.listTables() if not t.isTemporary}
    parts = []
    for table in fv.GOLD_TABLES:
        name, need = names.get(table, table), REQUIRED_COLUMNS[table]
        if name.lower() in found:
            df = spark.table(name)
            lacks = [c for c in need if c not in df.columns]
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(table).alias("table"), F.lit(True).alias("present"), "rows", F.lit(",".join(lacks)).alias("missing_columns")))
        else:
            parts.append(spark.range(1).select(
                F.lit(table).alias("table"), F.lit(False).alias("present"), F.lit(None).cast("long").alias("rows"),
                F.lit(",".join(need)).alias("missing_columns")))
    return reduce(DataFrame.unionByName, parts)
