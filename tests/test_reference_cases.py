"""The reference's own unit assertions (C1-C11), run through the Spark operators."""

import json

import pytest
from pyspark.sql import functions as F

from wakeline.functions import jsonfmt
from wakeline.operators import batches, counters, lateness, latest, parse, speed

RAW = "seq long, value string"


def _raw(spark, events):
    return spark.createDataFrame([(i + 1, json.dumps(e)) for i, e in enumerate(events)], RAW)


def _events(spark, rows):
    return spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")


def test_c1_single_event_on_time(spark):
    ev = {"id": 1, "x": 22.2, "y": 33.3, "timestamp": 1234567890.0}
    c = lateness.classify_lateness(parse.parse_events(_raw(spark, [ev]))).collect()
    assert len(c) == 1 and not c[0].is_late
    r = c[0]
    assert r.id == 1 and r.timestamp == 1234567890.0
    assert r.x == pytest.approx(22.2, abs=1e-5) and r.y == pytest.approx(33.3, abs=1e-5)


def test_c2_duplicate_timestamp_is_late(spark):
    ev = {"id": 1, "x": 22.2, "y": 33.3, "timestamp": 1234567890.0}
    c = lateness.classify_lateness(parse.parse_events(_raw(spark, [ev, ev]))).orderBy("seq").collect()
    assert [r.is_late for r in c] == [False, True]
    assert c[1].timestamp == ev["timestamp"] and c[1].id == 1


def test_c3_speed_and_latency(spark):
    df = _events(spark, [(1, 1, 1.0, 1.0, 1.0), (2, 1, 2.0, 1.0, 2.0)])
    w1 = speed.with_time_taken(speed.inst_speed(df), now=5.0).collect()
    w2 = speed.with_time_taken(speed.inst_speed_stateful(df), now=5.0).collect()
    for out in (w1, w2):
        assert len(out) == 1
        assert out[0].inst_speed == 111320.0
        assert out[0].time_taken == 3.0


def test_c4_c6_counters(spark):
    df = _events(spark, [(1, 1, 0.0, 0.0, 1.0), (2, 2, 0.0, 0.0, 2.0), (3, 2, 0.0, 0.0, 3.0)])
    assert counters.count_total(df).first().n == 3
    assert {r.id: r.n for r in counters.count_by_device(df).collect()} == {1: 1, 2: 2}


def test_c5_time_counter(spark):
    one = spark.createDataFrame([(1.0,)], "time_taken float")
    two = spark.createDataFrame([(1.0,), (2.0,)], "time_taken float")
    assert counters.time_counter_ms(one).first().ms == 1000.0
    assert counters.time_counter_ms(two).first().ms == 3000.0


@pytest.mark.parametrize("n", [200, 20])
def test_c7_no_full_batch_below_size(spark, n):
    df = spark.createDataFrame([(1, "{}")], RAW)
    s = batches.batch_summary(batches.assign_batches(df, n)).collect()
    assert len(s) == 1 and s[0].n == 1 < n


@pytest.mark.parametrize("n", [200, 20])
def test_c8_one_batch_at_size(spark, n):
    df = spark.range(n).select(F.col("id").alias("seq"), F.lit("{}").alias("value"))
    s = batches.batch_summary(batches.assign_batches(df, n)).collect()
    assert len(s) == 1 and s[0].n == n


def test_c9_json_round_trip(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([('{"k":"v"}',)], "value string")
    sch = T.StructType([T.StructField("k", T.StringType())])
    back = jsonfmt.to_json_value(jsonfmt.from_json_value(df, sch), ["k"]).first().value
    assert json.loads(back) == {"k": "v"}


def test_c10_one_message_one_output(spark):
    df = spark.createDataFrame([(1, 3, 21.0, 52.0, 4.5)], "seq long, id int, x float, y float, inst_speed float")
    out = latest.latest_per_device(df).collect()
    assert len(out) == 1 and out[0].id == 3 and out[0].inst_speed == 4.5


def test_c11_delayed_event_is_late(spark):
    t = 1234567890.0
    evs = [{"id": 1, "x": 1.0, "y": 1.0, "timestamp": t},
           {"id": 2, "x": 1.0, "y": 1.0, "timestamp": t - 5}]
    c = lateness.classify_lateness(parse.parse_events(_raw(spark, evs))).orderBy("seq").collect()
    assert [r.is_late for r in c] == [False, True]


def test_quarantine_reasons(spark):
    raw = spark.createDataFrame([(1, "not json"), (2, ""), (3, '{"id":1,"x":2}'), (4, '{"id":"7","x":1,"y":1,"timestamp":1}'),
                                 (5, '{"id":1,"x":1,"y":1,"timestamp":1}')], RAW)
    q = {r.seq: r.reason for r in parse.quarantine(raw).collect()}
    assert q == {1: "malformed", 2: "malformed", 3: "missing_field", 4: "malformed"}
    assert [r.seq for r in parse.parse_events(raw).collect()] == [5]


def test_on_bad_fail_raises(spark):
    raw = spark.createDataFrame([(1, '{"id":1,"x":2}')], RAW)
    with pytest.raises(Exception):
        parse.parse_events(raw, on_bad="fail").collect()


def test_nan_and_infinity(spark):
    df = _events(spark, [(1, 1, 0.0, 0.0, 10.0), (2, 1, 0.0, 0.0, float("nan")), (3, 1, 0.0, 0.0, 11.0),
                         (4, 1, 0.0, 0.0, float("inf")), (5, 1, 0.0, 0.0, 12.0)])
    c = [r.is_late for r in lateness.classify_lateness(df).orderBy("seq").collect()]
    assert c == [False, True, False, False, True]


def test_device_scope(spark):
    df = _events(spark, [(1, 1, 0.0, 0.0, 10.0), (2, 2, 0.0, 0.0, 5.0), (3, 1, 0.0, 0.0, 9.0)])
    stream = [r.is_late for r in lateness.classify_lateness(df).orderBy("seq").collect()]
    device = [r.is_late for r in lateness.classify_lateness(df, scope="device").orderBy("seq").collect()]
    assert stream == [False, True, True] and device == [False, False, True]


def test_wide_counters_and_archive_name(spark):
    df = _events(spark, [(1, 1, 0.0, 0.0, 1.0), (2, 2, 0.0, 0.0, 2.0), (3, 2, 0.0, 0.0, 3.0)])
    w = counters.device_counters_wide(df, [1, 2, 3]).first().asDict()
    assert w == {"on_time_device_1": 1, "on_time_device_2": 2, "on_time_device_3": 0}
    t = spark.createDataFrame([("2024-01-02 03:04:05.123456",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    assert t.select(batches.archive_object_name(F.col("t")).alias("n")).first().n == "raw_data/20240102_030405_123456.json"


def test_infinite_time_is_on_time_and_speed_survives(spark):
    df = _events(spark, [(1, 1, 1.0, 1.0, 1.0), (2, 1, 2.0, 1.0, 2.0), (3, 1, 2.0, 1.0, float("inf"))])
    on = lateness.split_late(df)[0]
    assert on.count() == 3
    for fn in (speed.inst_speed, speed.inst_speed_stateful):
        assert [(r.seq, r.inst_speed) for r in fn(on).collect()] == [(2, 111320.0)]
