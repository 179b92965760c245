from paylake.operators import messages
from paylake.schemas import MESSAGE


def frame(spark, rows):
    names = [p.split()[0] for p in MESSAGE.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], MESSAGE)


def test_metric_is_flattened_and_nested_parts_stay_in_raw_data(spark):
    data = '{"name":"gmv","value":123,"nested":{"x":1},"tags":["a"],"ok":true,"nothing":null}'
    df = frame(spark, [{"msg_type": "metric", "source": "job", "data": data}])
    flat = messages.flatten_generic(messages.validate(df, "2026-01-01T00:00:00Z"))
    row = flat.first()
    assert row.raw_data == data
    assert row.data_fields == {"name": "gmv", "value": "123", "ok": "true", "nothing": None}
    promoted = messages.promote(flat, {"name": "string", "value": "double"}).first()
    assert (promoted.data_name, promoted.data_value) == ("gmv", 123.0)


def test_every_scalar_key_is_kept_unless_asked_for_the_first(spark):
    data = "{" + ",".join(f'"k{i}":{i}' for i in range(15)) + "}"
    df = frame(spark, [{"msg_type": "log", "data": data}])
    assert sorted(messages.flatten_generic(df).first().data_fields) == sorted(f"k{i}" for i in range(15))
    assert sorted(messages.flatten_generic(df, first_keys=10).first().data_fields) == sorted(f"k{i}" for i in range(10))


def test_defaults_and_unknown_types(spark):
    df = frame(spark, [{"msg_type": "bogus"}, {"msg_type": "alert", "message_id": "m1", "schema_version": "2.0"}, {}])
    a, b, c = messages.validate(df, "now").collect()
    assert (a.is_valid, a.schema_version, a.timestamp, a.metadata, len(a.message_id)) == (False, "1.0", "now", "{}", 36)
    assert (b.is_valid, b.schema_version, b.message_id) == (True, "2.0", "m1")
    assert c.is_valid is False


def test_routes(spark):
    df = frame(spark, [
        {"detail": '{"id":"e1"}'}, {"msg_type": "metric"}, {"msg_type": "event"}, {}, {"msg_type": "log", "detail": '"text"'}])
    got = [(r.msg_kind, r.msg_route) for r in messages.classify(df).collect()]
    assert got == [("event", "fintech_legacy"), ("metric", "metric"), ("event", "event"), ("unknown", "unknown"),
                   ("log", "log")]
    assert {r.msg_kind: r.n for r in messages.stats(df).collect()} == {"event": 2, "metric": 1, "unknown": 1, "log": 1}
