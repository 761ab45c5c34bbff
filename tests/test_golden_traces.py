"""Golden baseline traces for the two speed rules (one device, fixed cadence)."""

import pytest

from wakeline.operators import speed

# (cadence, rule) -> baseline event number per event 1..15; None = no baseline; "n*" = baseline n, not emitted.
TRACES = {
    (0.6, "coded"): [None, "1*", 1, 2, 3, 4, 5, 6, 7, 3, 9, 5, 11, 7, 13],
    (0.6, "documented"): [None, "1*", 1, 1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6, 7],
    (1.0, "coded"): [None, 1, 1, 2, 3, 4, 2, 7, 7, 8, 9, 10, 8, 13, 13],
    (1.0, "documented"): [None, 1, 1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10],
}


def _expected_emits(trace):
    return {i + 1: b for i, b in enumerate(trace) if b is not None and not isinstance(b, str)}


def _trace_df(spark, cadence):
    rows = [(i, 7, 21.0 + 0.001 * i, 52.0, 100.0 + cadence * (i - 1)) for i in range(1, 16)]
    return spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")


@pytest.mark.parametrize("cadence,rule", list(TRACES))
def test_trace(spark, cadence, rule):
    df = _trace_df(spark, cadence)
    fn = speed.inst_speed_stateful if rule == "coded" else speed.inst_speed
    got = {r.seq: r.baseline_seq for r in fn(df).collect()}
    assert got == _expected_emits(TRACES[(cadence, rule)])


def _folded(evs):
    events = speed.EventList(*zip(*evs))
    emits, base, *_ = speed.fold_events(speed.EventList(), events)
    return dict(zip(events.seq[emits].tolist(), base.tolist()))


@pytest.mark.parametrize("cadence", [0.6, 1.0])
def test_fold_matches_trace(cadence):
    evs = [(i, 21.0 + 0.001 * i, 52.0, 100.0 + cadence * (i - 1)) for i in range(1, 16)]
    got = _folded(evs)
    assert got == _expected_emits(TRACES[(cadence, "coded")])


def test_slow_device_never_emits(spark):
    rows = [(i, 1, 21.0, 52.0, 6.0 * i) for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    assert speed.inst_speed(df).count() == 0
    assert speed.inst_speed_stateful(df).count() == 0


def test_span_cut_does_not_change_w1(spark):
    rows = [(i, 1 + i % 3, 21.0 + 0.0001 * i, 52.0, 290.0 + 0.35 * i) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    a = sorted(map(tuple, speed.inst_speed(df, span=300.0).collect()))
    b = sorted(map(tuple, speed.inst_speed(df, span=7.0).collect()))
    c = sorted(map(tuple, speed.inst_speed(df, span=1e9).collect()))
    assert a == b == c


def test_segments_do_not_change_w2(spark):
    # Devices with silences longer than the horizon are cut into runs; the fold must not notice.
    ts = []
    t = 0.0
    for i in range(300):
        t += 7.0 if i % 23 == 0 else 0.45 + 0.1 * (i % 5)
        ts.append(t)
    rows = [(i, 1 + i % 2, 21.0 + 0.0001 * i, 52.0, ts[i]) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    got = {r.seq: r.baseline_seq for r in speed.inst_speed_stateful(df, span=11.0).collect()}
    want = {}
    for dev in (1, 2):
        evs = [(s, x, y, t) for s, d, x, y, t in rows if d == dev]
        want.update(_folded([(s, float(__import__("numpy").float32(x)), y, t) for s, x, y, t in evs]))
    assert got == want


@pytest.mark.parametrize("warmup", [0, 1, 4, 16])
def test_chunked_fold_is_exact(spark, warmup):
    # Long runs cut into chunks of 16 with a short warm-up; failed checks must fall back.
    import random

    rnd = random.Random(warmup)
    rows, t = [], 0.0
    for i in range(400):
        t += rnd.choice([0.3, 0.5, 0.7, 1.1])
        rows.append((i, 1 + i % 3, 21.0 + 0.0001 * rnd.randint(0, 99), 52.0 + 0.0001 * i, t))
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    seq_result = {r.seq: (r.baseline_seq, r.inst_speed) for r in speed.inst_speed_stateful(df).collect()}
    chunked = {r.seq: (r.baseline_seq, r.inst_speed)
               for r in speed.inst_speed_stateful(df, chunk_rows=16, warmup_rows=warmup).collect()}
    assert chunked == seq_result


def test_chunk_checks_pass_across_arrow_batches(spark):
    """Chunks larger than an Arrow batch report complete end states, so checks pass."""
    import random

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from wakeline.operators.prefix import global_row_number

    rnd = random.Random(5)
    rows, t = [], 0.0
    for i in range(1200):
        t += rnd.choice([0.4, 0.6, 0.8])
        rows.append((i, 1, 21.0 + 0.0001 * rnd.randint(0, 99), 52.0, t))
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        C, H = 300, 100
        ranked = global_row_number(speed.with_segments(df), "seq", "_r", keys=["id", "_seg"])
        own = ranked.withColumn("_chunk", F.expr(f"(_r - 1) div {C}")).withColumn("_warm", F.lit(False))
        warm = (ranked.filter((F.col("_r") - 1) % C >= C - H)
                .withColumn("_chunk", F.expr(f"(_r - 1) div {C} + 1")).withColumn("_warm", F.lit(True)))
        schema = T.StructType(speed.SPEED_SCHEMA.fields + [
            T.StructField("_seg", T.LongType()), T.StructField("_chunk", T.LongType()),
            T.StructField("_kind", T.IntegerType()), T.StructField("_start", T.StringType()),
            T.StructField("_end", T.StringType())])
        folded = speed._fold(own.unionByName(warm).drop("_r"), 5.0, 1.0, 111320.0, [], schema, None)
        info = sorted(((r._chunk, r._start, r._end) for r in folded.filter("_kind = 1").collect()))
        assert [c for c, _, _ in info] == [0, 1, 2, 3]
        assert all(info[j][1] == info[j - 1][2] for j in range(1, 4))
        full = speed.inst_speed_stateful(df)
        chunked = speed.inst_speed_stateful(df, chunk_rows=C, warmup_rows=H)
        assert sorted(map(tuple, full.collect())) == sorted(map(tuple, chunked.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_failed_chunks_are_repaired_one_by_one(spark):
    """With a warm-up too short to always couple, failed chunks are re-folded from the
    previous chunk's end alone; no run falls back to a full sequential fold."""
    import random

    from pyspark.sql import types as T

    rnd = random.Random(11)
    rows, t = [], 0.0
    for i in range(2400):
        t += rnd.choice([0.3, 0.5, 0.7, 1.1])
        rows.append((i, 1 + i % 2, 21.0 + 0.0001 * rnd.randint(0, 99), 52.0, t))
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    seg = speed.with_segments(df)
    schema = T.StructType(speed.SPEED_SCHEMA.fields + [
        T.StructField("_seg", T.LongType()), T.StructField("_chunk", T.LongType()),
        T.StructField("_kind", T.IntegerType()), T.StructField("_start", T.StringType()),
        T.StructField("_end", T.StringType())])
    res = speed._chunked_fold(seg, 5.0, 1.0, 111320.0, [], schema, None, chunk_rows=100, warmup_rows=3)
    assert res["failed"].count() > 0
    assert res["redo_ok"].count() == res["failed"].count()
    assert res["bad_runs"].count() == 0
    want = sorted(map(tuple, speed.inst_speed_stateful(df).collect()))
    got = sorted(map(tuple, res["out"].withColumn("inst_speed", res["out"]["inst_speed"].cast("float")
                                                   .cast("double")).collect()))
    assert got == want


def test_ids_near_two_to_the_62_are_exact(spark):
    """Ids and carried integers keep every bit, with info rows in the same output."""
    top = 1 << 62
    rows = [(top + 2 * i + 1, 1, 21.0 + 0.001 * i, 52.0, 100.0 + 0.6 * i, top + i) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double, tag long")
    got = speed.inst_speed_stateful(df, carry=["tag"]).collect()
    chunked = speed.inst_speed_stateful(df, carry=["tag"], chunk_rows=100, warmup_rows=40).collect()
    ids = {r[0] for r in rows}
    assert got and {r.seq for r in got} <= ids and {r.baseline_seq for r in got} <= ids
    assert len({r.seq for r in got}) == len(got)
    assert all(r.tag == top + (r.seq - top) // 2 for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, chunked))


def test_to_fixed_1_rounds_the_binary_value(spark):
    from wakeline.functions.geo import to_fixed_1
    from pyspark.sql import functions as F

    cases = {1.45: "1.4", 0.35: "0.3", 2.25: "2.3", 0.25: "0.3", 0.05: "0.1", 8.345: "8.3", 0.0: "0.0", 9.96: "10.0",
             -1.45: "-1.4", 1e15: "1000000000000000.0", 123.95: "124.0", 0.95: "0.9"}
    df = spark.createDataFrame([(k,) for k in cases], "v double")
    got = {r.v: r.t for r in df.select("v", to_fixed_1(F.col("v")).alias("t")).collect()}
    assert got == cases


def test_log_files_on_disk_get_labels(spark, scratch):
    import os

    from wakeline.operators import logs
    from wakeline.sources.logs import read_container_logs, read_log_files

    os.makedirs(f"{scratch}/logs/producer")
    with open(f"{scratch}/logs/producer/a.log", "w") as fh:
        fh.write("2024-01-01 00:00:00 [ERROR] x - bad\n2024-01-01 00:00:01 [INFO] x - fine\n")
    with open(f"{scratch}/containers.json", "w") as fh:
        fh.write('{"container": "/sink", "line": "2024-01-01 00:00:02 [ERROR] y - worse"}\n')
    files, boxes = read_log_files(spark, f"{scratch}/logs/*/*.log"), read_container_logs(spark, f"{scratch}/containers.json")
    got = logs.error_logs(logs.labelled_logs(files, boxes, root=f"{scratch}/logs")).collect()
    assert [(r.service_name, r.message) for r in got] == [("sink", "worse"), ("producer", "bad")]
