"""Literal inputs."""

import json

RAW_CASES = [  # id, user, event, status, amount: the end-to-end case
    ("evt-1", "user_1", "PAYMENT_MADE", "SUCCESS", 100000.0),
    ("evt-1", "user_1", "PAYMENT_MADE", "SUCCESS", 100000.0),
    ("evt-2", "user_2", "PAYMENT_FAILED", "FAILED", 50000.0),
    ("evt-3", "user_2", "PURCHASE_MADE", "SUCCESS", 200000.0),
]


def raw_event(event_id="evt-1", user="user_1", event="PAYMENT_MADE", status="SUCCESS", amount=100000.0,
              timestamp="2026-01-01T10:00:00Z", city="Bogota"):
    return {
        "source": "payments.app", "detailType": "event",
        "detail": {
            "id": event_id, "event": event, "version": "1.0", "eventType": "business", "transactionType": "debit",
            "eventEntity": "user", "eventStatus": status,
            "payload": {
                "userId": user, "name": "Ana", "age": 30, "email": " ANA@Mail.Test ", "city": city,
                "segment": "premium", "timestamp": timestamp, "accountId": "acc", "amount": amount, "currency": "COP",
                "merchant": "Kiosk 7", "category": "food", "paymentMethod": "card", "installments": 1,
                "balanceBefore": 500000.0, "balanceAfter": 400000.0, "location": {"city": city, "country": "Colombia"},
            },
            "metadata": {"device": "mobile", "os": "ios", "ip": "192.168.1.1", "channel": "app"},
        },
    }


def write_raw(path, cases=RAW_CASES):
    with open(path, "w") as out:
        json.dump([raw_event(*case) for case in cases], out)


SILVER = """event_id string, user_id string, user_name string, user_email string, user_age int, user_segment string,
    location_city string, timestamp timestamp, date date, event string, is_failed boolean, is_transactional boolean,
    amount_cop double, amount_usd double, balance_after double, merchant string, category string, channel string,
    device string"""


def silver_frame(spark, rows):
    """Silver rows from dicts; anything not given is a sensible default."""
    import datetime as dt

    base = dict(event_id="evt-1", user_id="user_1", user_name="Ana", user_email="a@b.c", user_age=30,
                user_segment="premium", location_city="Bogota", timestamp=dt.datetime(2026, 1, 1, 10),
                event="PAYMENT_MADE", is_failed=False, is_transactional=True, amount_cop=100000.0, amount_usd=25.0,
                balance_after=400000.0, merchant="Kiosk 7", category="food", channel="app", device="mobile")
    full = []
    for row in rows:
        r = {**base, **row}
        r["date"] = r["timestamp"].date() if r["timestamp"] else None
        full.append(r)
    names = [part.split()[0] for part in SILVER.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SILVER)
