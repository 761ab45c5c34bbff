"""Hold-back order, device carry, counters and alerts of the stream, fed in random slices; samples at any times."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from wakeline.operators import alerts as AL
from wakeline.operators import lateness
from wakeline.operators import metrics as M
from wakeline.streaming import app
from wakeline.streaming import pipeline as P
from wakeline.streaming import state


class Recorder:
    """A sink that keeps what it gets, once per id."""

    def __init__(self):
        self.got = {}

    def __call__(self, rows, at):
        self.got.setdefault(at, sorted(r.seq for r in rows.collect()))

    def order(self):
        return [s for at in sorted(self.got) for s in self.got[at]]


def _records(spark, rows):
    return spark.createDataFrame([(p, o, f"{p}-{o}") for p, o in rows], "partition int, offset long, value string")


def _slices(rnd, sizes, start, n):
    """Random micro-batches that keep each partition's order."""
    left = {p: [(p, o) for o in range(start.get(p, 0), size)] for p, size in enumerate(sizes)}
    out = []
    for _ in range(n):
        batch = []
        for p in left:
            k = rnd.randint(0, max(1, 2 * sizes[p] // n))
            batch, left[p] = batch + left[p][:k], left[p][k:]
        rnd.shuffle(batch)
        out.append(batch)
    return [*out, [r for p in left for r in left[p]]]


@pytest.mark.parametrize("seed", [1, 2])
def test_hold_back_gives_one_order_whatever_the_slices(spark, scratch, seed):
    rnd = random.Random(seed)
    sizes, sink = [23, 9, 17], Recorder()
    batches = _slices(rnd, sizes, {}, 4)
    for i, b in enumerate(batches):
        order = P.HoldBack(scratch, sink, 3)  # a new object each time: nothing lives but the state
        order(_records(spark, b), i)
        if i == 2:
            order(_records(spark, b), i)      # replayed
    seen = sink.order()
    assert seen == sorted(seen)
    P.HoldBack(scratch, sink, 3).flush(spark)
    P.HoldBack(scratch, sink, 3).flush(spark)
    assert sink.order() == sorted(o * 3 + p for p, n in enumerate(sizes) for o in range(n))
    assert len(state.batch_ids(spark, scratch, "order_next")) <= 3


def test_hold_back_drops_what_was_sent_before_and_goes_on_after_a_flush(spark, scratch):
    sink = Recorder()
    order = P.HoldBack(scratch, sink, 2)
    order(_records(spark, [(0, 0), (0, 1), (1, 0)]), 0)
    assert sink.order() == [0, 1, 2]      # (0, 1) too: all of partition 1 that could precede it is there
    order(_records(spark, [(0, 1), (0, 2), (0, 3)]), 1)
    assert sink.order() == [0, 1, 2]
    order.flush(spark)
    assert sink.order() == [0, 1, 2, 4, 6]
    order(_records(spark, [(1, 1), (1, 2), (1, 3), (0, 4)]), 2)
    assert sink.order() == [0, 1, 2, 4, 6, 3, 5, 7, 8]
    with pytest.raises(Exception, match="unknown source partition"):
        order(_records(spark, [(5, 0)]), 3)


def test_hold_back_from_the_latest_offsets(spark, scratch):
    sink, start = Recorder(), {0: 5, 1: 2, 2: 9}
    for i, b in enumerate(_slices(random.Random(3), [12, 8, 20], start, 3)):
        P.HoldBack(scratch, sink, 3, start)(_records(spark, [(0, 1), *b]), i)  # offsets before the start are not read
    P.HoldBack(scratch, sink, 3, start).flush(spark)
    assert sink.order() == sorted(o * 3 + p for p, n in enumerate([12, 8, 20]) for o in range(start[p], n))


def test_partitioned_stream_equals_batch_and_restarts(spark, scratch):
    rnd = random.Random(9)
    raw, rows = [], []
    for p in range(3):
        for o in range(40):
            t = o * 0.5 + rnd.random() * 3
            rows.append((p + 3 * (o % 4), 0.5, 0.25, t, o * 3 + p))
            raw.append((p, o, '{"id":%d,"x":0.5,"y":0.25,"timestamp":%r}' % (p + 3 * (o % 4), t)))
    want = lateness.classify_lateness(spark.createDataFrame(rows, "id int, x float, y float, timestamp double, seq long"))
    src, root = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    schema = "partition int, offset long, value string"
    for i in range(2):
        # Partition 0 is ahead: its second half comes with the first halves of the others.
        part = [r for r in raw if (r[1] >= 20) == (i == 1) or (r[0] == 0 and i == 0)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q1, q2, rest = app.start_ingest(stream, root, available_now=True, partitions=3, archive_batch=10)
        q1.awaitTermination(300), q2.awaitTermination(300)
    rest.flush(spark)
    for table, late in (("on_time", False), ("late", True)):
        got = sorted(r.seq for r in state.read_table(spark, root, table).collect())
        assert got == sorted(r.seq for r in want.filter(F.col("is_late") == late).collect())
    counts = {r.metric: r.value for r in app.counters(root).totals(spark).collect()}
    assert counts["total_on_time_events"] + counts["total_late_events"] == 120
    assert counts["total_late_events"] == want.filter("is_late").count()
    from wakeline.sources.io import replay_archive

    back = replay_archive(spark, os.path.join(root, "archive")).orderBy("batch_no", "pos").collect()
    assert [r.timestamp for r in back] == [r[3] for r in sorted(rows, key=lambda r: r[4])]


def test_device_scope_carries_a_maximum_per_device(spark, scratch):
    rnd = random.Random(4)
    rows = [(s, rnd.randrange(5), 0.5, 0.5, float("nan") if s % 17 == 0 else rnd.random() * 50 + s) for s in range(120)]
    frame = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    want = {r.seq: r.is_late for r in lateness.classify_lateness(frame, scope="device").collect()}
    ingest = P.LatenessIngest(scratch, scope="device", every=2)
    text = F.to_json(F.struct("id", "x", "y", F.col("timestamp")))
    value = F.when(F.isnan("timestamp"), F.format_string('{"id":%d,"x":0.5,"y":0.5,"timestamp":NaN}', "id")).otherwise(text)
    for i, (a, b) in enumerate([(0, 30), (30, 31), (31, 90), (90, 120)]):
        for _ in range(2 if i == 2 else 1):
            ingest(frame.filter((F.col("seq") >= a) & (F.col("seq") < b)).select("seq", value.alias("value")), i)
    got = {r.seq: late for t, late in (("on_time", False), ("late", True)) for r in state.read_table(spark, scratch, t).collect()}
    assert got == want
    with pytest.raises(ValueError, match="scope"):
        P.LatenessIngest(scratch, scope="x")


def test_counters_survive_replays_and_are_samples(spark, scratch):
    c = P.CounterWriter(scratch, P.event_bumps, every=2, clock=lambda b: 100.0 + 15.0 * b)
    rows = lambda *r: spark.createDataFrame(list(r), "id int, is_late boolean")
    c(rows((1, False), (1, False), (2, True)), 0)
    c(rows((2, False)), 1)
    c(rows((1, False), (2, True), (2, True)), 2)
    c(rows((1, False), (2, True), (2, True)), 2)
    got = {r.metric: r.value for r in c.totals(spark).collect()}
    assert got == {"on_time_device_1": 3, "on_time_device_2": 1, "late_device_2": 3, "total_on_time_events": 4,
                   "total_late_events": 3}
    samples = c.samples(spark)
    assert samples.filter("metric = 'total_on_time_events'").orderBy("ts").select("ts", "value").collect() == [
        (100.0, 2.0), (115.0, 3.0), (130.0, 4.0)]
    grid = spark.createDataFrame([("total_on_time_events", 120.0), ("total_on_time_events", 500.0)], "metric string, t double")
    assert [tuple(r) for r in M.instant_at(samples, grid, ["metric"]).collect()] == [("total_on_time_events", 120.0, 3.0)]


def test_folded_tables_keep_a_bounded_number_of_folders(spark, scratch):
    up = P.LatestUpsert(scratch, every=4)
    sch = "id int, seq long, x float, y float, inst_speed float"
    for b in range(26):
        up(spark.createDataFrame([(b % 3, b, 1.0, 2.0, float(b))], sch), b)
    assert len(state.batch_ids(spark, scratch, "latest")) <= 8
    assert len(state.batch_ids(spark, scratch, "latest_snapshot")) <= 2
    up(spark.createDataFrame([(25 % 3, 25, 1.0, 2.0, 25.0)], sch), 25)
    assert {r.id: r.inst_speed for r in P.latest_table(spark, scratch).collect()} == {0: 24.0, 1: 25.0, 2: 23.0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_alert_stream_equals_batch(spark, scratch, seed):
    rnd = random.Random(seed)
    end, rows = 48, []
    for s, first in (("a", 1), ("b", 9), ("c", 21)):
        level = 0.0
        for k in range(first, end + 1):
            level = rnd.choice([level, level, level, 1.0 - level])
            if rnd.random() < 0.85:
                rows.append((s, k, level))
    values = spark.createDataFrame(rows, "series string, k int, value double")
    kmax = spark.createDataFrame([(end,)], "_kmax int")
    grid = AL.eval_grid(kmax, series=["series"], series_df=values, every=30.0)
    want = AL.alert_states(values, grid, ["series"], "gt", 0.5, hold=60.0)
    bounds = sorted(rnd.sample(range(1, end), 4)) + [end]
    for i, (a, b) in enumerate(zip([0, *bounds], bounds)):
        stream = P.AlertStream(scratch, ["series"], "gt", 0.5, hold=60.0, every=30.0)
        part = values.filter((F.col("k") > a) & (F.col("k") <= b))
        for _ in range(2 if i == 1 else 1):
            stream(part, i, upto=b)
    cols = ["series", "k", "value", "state"]
    key = lambda r: (r[0], r[1])
    got = state.read_table(spark, scratch, "alert_states").select(*cols).collect()
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)
    sent = state.read_table(spark, scratch, "alert_sent").select(*cols, "prev_state").collect()
    changes = AL.transitions(want, ["series"]).select(*cols, "prev_state").collect()
    assert sorted(map(tuple, sent), key=key) == sorted(map(tuple, changes), key=key)
    assert {r.state for r in got} == {"ok", "pending", "firing", "nodata"}


def _brute_rate(samples, t, window, extrapolate):
    inside = [(a, v) for a, v in samples if t - window <= a <= t]
    if len(inside) < 2:
        return None
    inc = sum(v if v < u else v - u for (_, u), (_, v) in zip(inside, inside[1:]))
    if not extrapolate:
        return inc / window
    sampled = inside[-1][0] - inside[0][0]
    avg = sampled / (len(inside) - 1)
    lead, trail = inside[0][0] - (t - window), t - inside[-1][0]
    lead = avg / 2 if lead >= avg * 1.1 else lead
    if inc > 0 and inside[0][1] >= 0:
        lead = min(lead, sampled * (inside[0][1] / inc))
    trail = avg / 2 if trail >= avg * 1.1 else trail
    return inc * ((sampled + lead + trail) / sampled / window)


def test_rates_and_instants_at_any_time_match_brute_force(spark):
    rnd = random.Random(6)
    series = {}
    for name in "abc":
        t, v, out = 0.0, float(rnd.randrange(50)), []
        for _ in range(60):
            t += rnd.choice([5.0, 15.0, 15.0, 120.0, 400.0])
            v = 0.0 if rnd.random() < 0.1 else v + rnd.randrange(9)
            out.append((t, v))
        series[name] = out
    samples = spark.createDataFrame([(s, t, v) for s, r in series.items() for t, v in r], "s string, ts double, value double")
    grid = M.evaluation_times(samples, ["s"], 2.5, 60.0)
    times = {(r.s, r.t) for r in grid.collect()}
    for s, r in series.items():
        mine = sorted(t for n, t in times if n == s)
        assert mine[0] >= r[0][0] and mine[0] - 60.0 < r[0][0] and mine[-1] <= r[-1][0] + 300.0 < mine[-1] + 60.0
    for extrapolate in (True, False):
        got = {(r.s, r.t): r.value for r in M.rate_at(samples, grid, ["s"], 150.0, extrapolate).collect()}
        want = {(s, t): _brute_rate(series[s], t, 150.0, extrapolate) for s, t in times}
        want = {k: v for k, v in want.items() if v is not None}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)
    got = {(r.s, r.t): r.value for r in M.instant_at(samples, grid, ["s"], 150.0).collect()}
    want = {(s, t): max((a, v) for a, v in series[s] if a <= t)[1] for s, t in times
            if any(t - 150.0 < a <= t for a, _ in series[s])}
    assert got == want
