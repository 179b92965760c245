import datetime as dt

import pytest

from paylake.config import Settings
from paylake.operators import gold
from paylake.plans import alerts, business, metrics, periods, reports
from tests.events import silver_frame

SETTINGS = Settings(as_of=dt.date(2026, 1, 31))
FAILED = dict(event="PAYMENT_FAILED", is_failed=True, amount_cop=18400.25)


def user(spark, rows, user_id="user_1"):
    return gold.user_360(silver_frame(spark, rows), SETTINGS).filter(f"user_id = '{user_id}'").first()


def test_two_successes_and_a_failure(spark):
    silver = silver_frame(spark, [dict(amount_cop=37250.5), dict(event_id="x-7", amount_cop=1200.0, merchant="Stall"),
                                  {"event_id": "x-9", **FAILED}])
    row = gold.user_360(silver, SETTINGS).first()
    assert (row.total_events, row.total_transactions, row.total_amount_cop, row.failed_transactions) == (3, 2, 38450.5, 1)
    assert (row.failure_rate, row.top_merchant, row.days_since_last_tx) == (0.3333, "Kiosk 7", 30)
    day = gold.daily_metrics(silver).first()
    assert (day.total_events, day.total_transactions, day.total_amount_cop, day.failed_count, day.unique_users) == \
        (3, 3, 56850.75, 1, 1)
    summary = {r.event: (r["count"], r.success_count, r.failed_count, r.pct_of_total)
               for r in gold.event_summary(silver).collect()}
    assert summary == {"PAYMENT_MADE": (2, 2, 0, 66.67), "PAYMENT_FAILED": (1, 0, 1, 33.33)}


def test_only_failures(spark):
    row = user(spark, [FAILED])
    assert (row.total_transactions, row.failure_rate) == (0, 1.0)
    assert (row.total_amount_cop, row.avg_ticket, row.balance_current, row.top_merchant) == (None,) * 4
    assert row.days_since_last_tx is None and row.preferred_channel == "app"


def test_nothing_tried_has_rate_zero(spark):
    assert user(spark, [dict(event="USER_REGISTERED", is_transactional=False, amount_cop=None)]).failure_rate == 0.0


def test_unknown_keys_are_left_out(spark):
    silver = silver_frame(spark, [{}, {"event_id": "e2", "user_id": None, "timestamp": None, "event": None}])
    assert gold.user_360(silver, SETTINGS).count() == 1
    assert gold.daily_metrics(silver).count() == 1
    assert gold.event_summary(silver).first().pct_of_total == 100.0


def test_first_known_value_last_balance_and_ties(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    row = user(spark, [
        dict(event_id="b", timestamp=t[0], user_name=None, location_city="Cali", merchant="Z", balance_after=1.0),
        dict(event_id="a", timestamp=t[0], user_name="First", location_city="Neiva", merchant="A", balance_after=2.0),
        dict(event_id="c", timestamp=t[2], user_name="Later", balance_after=None, merchant=None),
        dict(event_id="d", timestamp=None, user_name="Untimed", balance_after=7.0, merchant=None),
    ])
    assert (row.user_name, row.city) == ("First", "Neiva")
    assert row.balance_current == 7.0  # an unknown time sorts last
    assert row.top_merchant == "A"     # equal counts: smallest
    assert row.total_transactions == 4


def test_missing_event_ids_are_not_counted(spark):
    assert user(spark, [{}, {"event_id": None}]).total_events == 1


def test_rounding_is_half_up_on_exact_ties(spark):
    rows = [dict(event_id=f"e{i}", amount_cop=a) for i, a in enumerate([0.01, 0.02])]
    assert user(spark, rows).avg_ticket == 0.02  # 0.015
    failures = [dict(event_id=f"f{i}", **FAILED) for i in range(1)]
    oks = [dict(event_id=f"o{i}") for i in range(159)]
    assert user(spark, failures + oks).failure_rate == 0.0063  # 0.00625


def test_sum_over_users_is_sum_over_success_rows(spark):
    rows = [dict(event_id=f"e{i}", user_id=f"u{i % 7}", amount_cop=i * 1.1, is_failed=i % 5 == 0) for i in range(50)]
    silver = silver_frame(spark, rows)
    total = gold.user_360(silver, SETTINGS).selectExpr("sum(total_amount_cop)").first()[0]
    expected = sum(i * 1.1 for i in range(50) if i % 5)
    assert abs(total - expected) < 0.05


# --- catalogue, questions ------------------------------------------------------------------------


def people(spark):
    rows = []
    for i in range(12):
        rows.append(dict(event_id=f"e{i}", user_id=f"u{i:02d}", user_segment="premium" if i % 3 else "student",
                         merchant=f"m{i:02d}", channel=None if i == 0 else "app", amount_cop=1000.0 * (i + 1)))
    rows.append(dict(event_id="x", user_id="u99", user_segment="student", **FAILED))
    return gold.user_360(silver_frame(spark, rows), SETTINGS)


def test_unknown_metric_or_dimension(spark):
    users = people(spark)
    assert metrics.metric_by_dimension(users, "nope", "usuarios") is None
    assert metrics.metric_by_dimension(users, "ciudad", "nope") is None


def test_metric_limits_and_columns(spark):
    users = people(spark)
    bar = metrics.metric_by_dimension(users, "merchant", "revenue_usuario", top_n=3)
    assert bar.columns == ["top_merchant", "revenue_por_usuario", "usuarios"]
    assert [r.top_merchant for r in bar.collect()] == ["m11", "m10", "m09"]
    pie = metrics.metric_by_dimension(users, "merchant", "revenue_usuario", chart="pie")
    assert pie.columns == ["top_merchant", "revenue_por_usuario"] and pie.count() == 8
    assert "usuarios" in metrics.metric_by_dimension(users, "ciudad", "usuarios").columns


def test_revenue_counts_all_users_but_ticket_only_active(spark):
    row = metrics.metric_by_dimension(people(spark), "segmento", "revenue_usuario").filter(
        "user_segment = 'student'").first()
    assert row.revenue_por_usuario == round((1000 + 4000 + 7000 + 10000) / 5)
    ticket = metrics.metric_by_dimension(people(spark), "segmento", "ticket_transaccion").filter(
        "user_segment = 'student'").first()
    assert ticket.ticket_promedio_tx == 5500


def test_penetration_is_of_all_users(spark):
    row = business.merchants(people(spark)).first()
    assert (row.top_merchant, row.usuarios, row.penetracion_pct) == ("m11", 1, 7.7)


def test_null_channel_group_stays(spark):
    got = {r.preferred_channel: r.usuarios for r in business.channels(people(spark)).collect()}
    assert got == {None: 1, "app": 12}


def test_empty_filter_keeps_all(spark):
    users = people(spark)
    assert reports.filter_users(users).count() == 13
    assert reports.filter_users(users, segments=["premium"], cities=["Bogota"]).count() == 8


@pytest.mark.parametrize("number", range(1, 11))
def test_acceptance_questions_answer(spark, number):
    result = business.acceptance(number, people(spark), user_id="u03", segment="premium").collect()
    assert result
    if number == 4:
        assert len(result) == 5
    if number == 6:
        assert result[0].usuarios == 0


# --- alerts and periods --------------------------------------------------------------------------

USERS = """user_id string, user_segment string, failure_rate double, total_amount_cop double, avg_ticket double,
    balance_current double, days_since_last_tx long"""
DAILY = "date date, total_transactions long, total_amount_cop double, failed_count long, unique_users long"


def days_frame(spark, transactions, failed=0):
    start = dt.date(2026, 1, 1)
    return spark.createDataFrame(
        [(start + dt.timedelta(days=i), t, t * 1e6, failed, 1) for i, t in enumerate(transactions)], DAILY)


@pytest.mark.parametrize("rate,severity", [(0.05, "warning"), (0.0501, "critical"), (0.03, "ok"), (0.0301, "warning")])
def test_thresholds_are_strict(spark, rate, severity):
    users = spark.createDataFrame([("u", "s", rate, 1.0, 1.0, 60000.0, 1)], USERS)
    assert alerts.global_failure(users).first().severity == severity


def test_segment_balance_and_churn_rules(spark):
    users = spark.createDataFrame([
        ("a", "x", 0.0, 70.0, 1.0, -5.0, 40), ("b", "y", 0.04, 30.0, 1.0, 60000.0, 1),
        ("c", "y", 0.04, None, None, None, None), ("d", "y", 0.04, None, None, None, None)], USERS)
    assert [(r.entity, r.severity) for r in alerts.segment_failure(users).collect()] == [("y", "warning")]
    top = alerts.concentration(users).first()
    assert (top.entity, top.value, top.severity) == ("x", 70.0, "critical")
    assert [(r.entity, r.severity) for r in alerts.churn(users).collect()] == [("30d", "warning")]
    assert alerts.balance(users).first().severity == "critical"
    well_off = users.filter("user_id = 'b'")
    assert alerts.balance(well_off).count() == 0


@pytest.mark.parametrize("recent,severity,entity", [
    (79, "critical", "drop"), (85, "warning", "drop"), (90, "ok", "stable"), (121, "ok", "peak")])
def test_activity(spark, recent, severity, entity):
    found = alerts.activity(days_frame(spark, [5] * 4 + [100] * 7 + [recent] * 3)).first()
    assert (found.severity, found.entity) == (severity, entity)


def test_activity_needs_a_prior_window(spark):
    assert alerts.activity(days_frame(spark, [10, 10, 10])).count() == 0


def test_periods(spark):
    daily = days_frame(spark, [1] * 5 + [10] * 7 + [20] * 7, failed=1)
    both = {r.periodo: r for r in periods.compare(daily).collect()}
    assert (both["ACTUAL"].transacciones, both["ANTERIOR"].transacciones) == (140, 70)
    assert both["ACTUAL"].tasa_fallo_pct == 5.0
    deltas = {r.measure: (r.delta_pct, r.colour) for r in periods.deltas(daily).collect()}
    assert deltas["transacciones"] == (100.0, "green")
    assert deltas["fallos"] == (0.0, "yellow")
    assert deltas["tasa_fallo_pct"] == (-50.0, "green")
    trend = periods.trend(daily).first()
    assert (trend.trend, trend.failure_delta_points) == ("growth", -5.0)


def test_empty_prior_period_is_a_row(spark):
    both = {r.periodo: r.dias_datos for r in periods.compare(days_frame(spark, [1, 2]), 7).collect()}
    assert both == {"ACTUAL": 2, "ANTERIOR": 0}
    assert {r.colour for r in periods.deltas(days_frame(spark, [1, 2])).collect()} == {"N/D"}
    assert periods.trend(days_frame(spark, [1, 2])).first().trend == "mixed"


def test_any_period_length_is_answered_and_none_below_one(spark):
    assert {r.dias_datos for r in periods.compare(days_frame(spark, range(1, 71)), 35).collect()} == {35}
    for days in (0, -1, 1.5):
        with pytest.raises(ValueError):
            periods.compare(days_frame(spark, [1]), days)


def test_no_trend_against_zero(spark):
    assert periods.trend(days_frame(spark, [0] * 7 + [5] * 7)).count() == 0
