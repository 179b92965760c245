import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st

from paylake.config import Settings
from paylake.operators import silver

ROW = "event_id string, is_duplicate boolean, ingestion_timestamp string, amount long, seq int"
SETTINGS = Settings(as_of=dt.date(2026, 1, 1), fx_rate=0.00025)


def test_canonical_row_is_the_first_unflagged(spark):
    rows = [("evt-1", True, "2026-01-01T00:00:01Z", 999, 1), ("evt-1", False, "2026-01-01T00:00:05Z", 100, 2),
            (" evt-1 ", False, "2026-01-01T00:00:06Z", 5, 3), ("evt-2", False, None, 200, 4),
            ("evt-2", False, "2026-01-01T00:00:02Z", 201, 5), (None, True, "t", 1, 6), ("", None, "t", 2, 7)]
    got = silver.deduplicate(spark.createDataFrame(rows, ROW), ["seq"]).collect()
    assert sorted((r.event_id or "", r.amount, r.bronze_duplicate_count) for r in got) == [
        ("", 1, 1), ("", 2, 1), ("evt-1", 100, 3), ("evt-2", 201, 2)]


def test_missing_event_id_column_is_an_error(spark):
    with pytest.raises(ValueError):
        silver.deduplicate(spark.range(1), ["id"])


@hyp(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(
    st.sampled_from(["a", "b", "hot", "hot", "hot", None, " "]), st.booleans(),
    st.sampled_from(["2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z", None])), min_size=1, max_size=30))
def test_dedup_is_idempotent_and_order_free(spark, rows):
    data = [(e, d, t, i, i) for i, (e, d, t) in enumerate(rows)]
    once = silver.deduplicate(spark.createDataFrame(data, ROW), ["seq"])
    backwards = silver.deduplicate(spark.createDataFrame(data[::-1], ROW).repartition(3), ["seq"])
    twice = silver.deduplicate(once.drop("bronze_duplicate_count"), ["seq"])

    def key(df):
        return sorted((r.event_id or "", r.seq) for r in df.collect())

    assert key(once) == key(backwards) == key(twice)
    without_id = sum(1 for e, _, _ in rows if e is None or not e.strip())
    known = {e.strip() for e, _, _ in rows if e and e.strip()}
    assert once.count() == without_id + len(known)
    assert once.selectExpr("sum(bronze_duplicate_count)").first()[0] == len(rows)


def test_types(spark):
    schema = """timestamp string, amount string, balance_before string, balance_after string, initial_balance string,
        installments string, user_email string"""
    df = spark.createDataFrame([
        ("2026-01-01T23:30:00-02:00", "100.5", "x", None, "nan", None, " USER@EXAMPLE.COM "),
        ("not a date", "inf", "1", "2", "3", "6.0", None)], schema)
    a, b = silver.clean_types(df).collect()
    assert (a.amount, a.balance_before, a.balance_after, a.initial_balance) == (100.5, None, None, None)
    assert (a.installments, a.user_email, a.date) == (1, "user@example.com", dt.date(2026, 1, 2))
    assert (b.timestamp, b.date, b.amount, b.installments) == (None, None, None, 6)


def test_flags(spark):
    df = spark.createDataFrame([
        ("FAILED", "PAYMENT_FAILED", "192.168.1.20"), ("SUCCESS", "USER_REGISTERED", "8.8.8.8"),
        (None, None, None), ("SUCCESS", "MONEY_ADDED", "172.31.0.1"), ("failed", "PAYMENT_MADE", "172.32.0.1"),
        ("SUCCESS", "PAYMENT_MADE", "101.0.0.1"),
    ], "event_status string, event string, ip string")
    got = [(r.is_failed, r.is_transactional, r.ip_is_private, r.geo_source)
           for r in silver.add_flags(df, SETTINGS).collect()]
    payload, looked_up = "payload_location", "ip-api.com"
    assert got == [(True, True, True, payload), (False, False, False, looked_up), (False, False, False, looked_up),
                   (False, True, True, payload), (False, True, False, looked_up), (False, True, False, looked_up)]


GEO = "seq int, ip string, ip_is_private boolean, location_city string, location_country string, user_city string"


def test_location_chain_and_lookup(spark):
    df = spark.createDataFrame([
        (1, "8.8.8.8", False, "Cali", "Colombia", None), (2, "8.8.8.8", True, None, None, "Neiva"),
        (3, None, False, None, None, None), (4, "1.1.1.1", False, "Cali", None, None)], GEO)
    geo = spark.createDataFrame([("8.8.8.8", "Mountain View", "United States"), ("1.1.1.1", "", "Australia")],
                                "ip string, city string, country string")
    expected = [("Mountain View", "United States"), ("Neiva", "Colombia"), ("Desconocida", "Colombia"),
                ("Cali", "Australia")]
    for skew in ({}, {"allow_broadcast": False, "heavy_rows": 1, "salts": 4}):
        out = silver.locate_public_ips(silver.resolve_location(df), geo, ["seq"], **skew)
        assert [(r.location_city, r.location_country) for r in out.orderBy("seq").collect()] == expected


def test_currency_and_final_columns(spark):
    df = spark.createDataFrame(
        [(1000.0, False, "s", "2026-01-01")] * 1 + [(None, True, "s", "2026-01-01")],
        "amount double, is_duplicate boolean, source string, ingestion_date string")
    out = silver.final_columns(silver.add_usd(df, SETTINGS))
    assert out.columns == ["amount_cop", "bronze_is_duplicate", "amount_usd"]
    assert [r.amount_usd for r in out.collect()] == [0.25, None]


def test_numbers_that_no_column_holds_become_null_and_stop_nothing(spark):
    from paylake.operators import gold

    df = spark.createDataFrame(
        [(f"e{i}", a, n, "2026-01-01T00:00:00Z") for i, (a, n) in enumerate(
            [("1e40", "99999999999"), ("1e25", "3"), ("-1e18", "x"), ("1000000000000000000", None)] + [("0.00004", "2")] * 1000)],
        "event_id string, amount string, installments string, timestamp string")
    typed = silver.clean_types(df).orderBy("event_id").cache()
    first = {r.event_id: (r.amount, r.installments) for r in typed.filter("length(event_id) = 2").collect()}
    assert [first[f"e{i}"] for i in range(4)] == [(None, 1), (None, 3), (None, 1), (None, 1)]
    small = typed.filter("amount < 1").selectExpr("*", "amount AS amount_cop", "true AS is_transactional", "false AS is_failed",
                                                  "'u' AS user_id")
    assert gold.daily_metrics(small).first().total_amount_cop == 0.04
    assert gold.daily_metrics(typed.selectExpr("*", "amount AS amount_cop", "true AS is_transactional", "false AS is_failed",
                                               "'u' AS user_id")).first().total_events == 1004
    typed.unpersist()


def test_an_address_listed_twice_does_not_multiply_events(spark):
    events = spark.createDataFrame([("e1", "8.8.8.8", False, None, None)], "event_id string, ip string, ip_is_private boolean, "
                                   "location_city string, location_country string")
    geo = spark.createDataFrame([("8.8.8.8", "", "US"), ("8.8.8.8", "Lima", "Peru"), ("8.8.8.8", "Quito", None)],
                                "ip string, city string, country string")
    assert [tuple(r) for r in silver.locate_public_ips(events, geo, ["event_id"]).select("event_id", "location_city", "location_country")
            .collect()] == [("e1", "Lima", "Peru")]
