import datetime as dt

from paylake.operators import checks, profiling

SCHEMA = "user_id string, amount double, n int, day date, flag boolean"


def profile(df):
    return {r.column: r for r in profiling.profile_columns(df, "t").collect()}


def test_profile(spark):
    rows = [("a", 1.5, 1, dt.date(2026, 1, 1), True), ("b", None, 2, dt.date(2026, 1, 3), None),
            ("a", 2.5, 2, None, True), (None, 1e15, 2, None, False)]
    got = profile(spark.createDataFrame(rows, SCHEMA))
    user, amount, n, day, flag = (got[c] for c in ("user_id", "amount", "n", "day", "flag"))
    assert (user.rows, user.nulls, user.nulls_pct, user.distinct, user.roles) == (4, 1, 25.0, 2, "identificador")
    assert (amount.min, amount.max, amount.mean) == (1.5, 1e15, round((1e15 + 4) / 3, 4))
    assert (n.mean, n.distinct, n.roles) == (1.75, 2, "metrica")
    assert (day.min_date, day.max_date, day.min) == (dt.date(2026, 1, 1), dt.date(2026, 1, 3), None)
    assert (flag.distinct, flag.type, flag.roles) == (2, "boolean", "descriptiva")


def test_profile_of_an_empty_table(spark):
    got = profile(spark.createDataFrame([], SCHEMA))
    assert len(got) == 5 and all((r.rows, r.nulls, r.nulls_pct, r.distinct, r.mean) == (0, 0, 0.0, 0, None)
                                 for r in got.values())


def test_extremes_tie_and_zero(spark):
    df = spark.createDataFrame([("b", 5.0, 0.0), ("a", 5.0, 1.0), ("c", -2.0, None)], "label string, x double, y double")
    got = {r.measure: r for r in profiling.metric_extremes(df, "label", ["x", "y"]).collect()}
    assert (got["x"].max_label, got["x"].min_label, got["x"].gap, got["x"].gap_pct) == ("a", "c", 7.0, 350.0)
    assert (got["y"].min_label, got["y"].gap, got["y"].gap_pct) == ("b", 1.0, None)


def test_duplicate_checks_see_shared_ids(spark):
    schema = "event_id string, is_duplicate boolean, batch_id string, ingestion_timestamp string"
    df = spark.createDataFrame([("a", False, "b", "t"), ("a", True, "b", "t"), ("c", False, "b", "t"), (None, True, "b", "t")], schema)
    row = checks.check_bronze(df).first()
    assert (row.rows, row.distinct_ids, row.rows_sharing_an_id, row.flagged_rows, row.missing_columns) == (4, 2, 2, 2, "")
    assert checks.check_bronze(df.drop("batch_id")).first().missing_columns == "batch_id"


def test_broken_rules_are_counted(spark):
    segments = spark.createDataFrame([("s", 1.0, 101.0), (None, None, 5.0)],
                                     "user_segment string, revenue_por_usuario double, tasa_fallo_pct double")
    daily = spark.createDataFrame([(3, 2, 0, -1.0)],
                                  "failed_count long, total_transactions long, unique_users long, total_amount_cop double")
    events = spark.createDataFrame([(1, 1, 3)], "success_count long, failed_count long, count long")
    got = {r.rule: r.broken_rows for r in checks.check_invariants(segments, daily, events).collect()}
    assert got == {"segment_named": 1, "segment_revenue_positive": 1, "segment_failure_in_range": 1,
                   "day_failed_within_transactions": 1, "day_has_users": 1, "day_volume_not_negative": 1,
                   "event_parts_add_up": 1}


def test_dates_in_texts_and_exact_distinct_values(spark):
    rows = [("2026-01-05T10:00:00Z", "a", 0.0, [1]), ("2025-12-31", "a", -0.0, [1]), ("soon", "2026-01-01", 1.0, None), (None, None, None, [2])]
    got = profile(spark.createDataFrame(rows, "fecha_alta string, note string, x double, tags array<int>"))
    made = got["fecha_alta"]
    assert (made.min_date, made.max_date, made.distinct) == (dt.date(2025, 12, 31), dt.date(2026, 1, 5), 3)
    assert got["note"].min_date is None and got["x"].distinct == 2 and (got["tags"].distinct, got["tags"].nulls) == (2, 1)


def test_a_profile_moves_hashes_only(spark):
    df = spark.createDataFrame([("a", 1.5, 1, None, True)], SCHEMA)
    plan = profiling.profile_columns(df, "t")._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Aggregate [column" in line and ", h#" in line]
    assert keys and not any("user_id" in line for line in keys)
