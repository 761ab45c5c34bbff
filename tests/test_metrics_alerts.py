"""Rate rule, vector matching, alert islands and panel bands on hand-made series."""

import pytest
from pyspark.sql import functions as F

from wakeline.operators import alerts as AL
from wakeline.operators import metrics as M


def _series(spark, values, sid="a"):
    rows = [(sid, k, v) for k, v in values]
    return spark.createDataFrame(rows, "sid string, k int, units long")


def test_rate_with_reset(spark):
    s = _series(spark, [(1, 0), (2, 10), (3, 20), (4, 5), (5, 15)])
    plain = {r.k: r.value for r in M.rate(s, ["sid"], window=60.0, extrapolate=False).collect()}
    assert plain[5] == pytest.approx(35 / 60)
    assert 1 not in plain  # one sample is not enough
    ext = {r.k: r.value for r in M.rate(s, ["sid"], window=60.0).collect()}
    assert ext[5] == pytest.approx(35 / 60)
    assert ext[3] == pytest.approx(20 / 60)  # extrapolated back to the counter's zero point only


def test_rate_extrapolates_half_interval_when_far(spark):
    s = _series(spark, [(1, 100), (2, 110), (3, 120)])
    ext = {r.k: r.value for r in M.rate(s, ["sid"], window=60.0).collect()}
    # sampled 30 s, start gap 30 s >= 1.1 * 15 s, so half an interval (7.5 s) is added.
    assert ext[3] == pytest.approx(20 * (37.5 / 30) / 60)


def test_counter_samples_dense(spark):
    inc = spark.createDataFrame([("a", 2, 1), ("a", 2, 1), ("a", 5, 3), ("b", 4, 1)], "sid string, k int, inc long")
    kmax = spark.createDataFrame([(6,)], "_kmax int")
    got = {(r.sid, r.k): r.units for r in M.counter_samples(inc, ["sid"], kmax).collect()}
    assert got == {("a", 2): 2, ("a", 3): 2, ("a", 4): 2, ("a", 5): 5, ("a", 6): 5,
                   ("b", 4): 1, ("b", 5): 1, ("b", 6): 1}


def test_binary_match_inner(spark):
    a = spark.createDataFrame([(1, "", 2.0), (2, "", 4.0)], "k int, job string, value double")
    b = spark.createDataFrame([(2, "", 8.0), (3, "", 1.0)], "k int, job string, value double")
    got = M.binary_match(a, b, ["job"], lambda x, y: x / y).collect()
    assert [(r.k, r.value) for r in got] == [(2, 0.5)]


def test_alert_states(spark):
    vals = [(4, 0.1), (8, 0.3), (12, 0.3), (16, 0.3), (20, None), (24, 0.5)]
    v = spark.createDataFrame([("s", k, x) for k, x in vals], "series string, k int, value double")
    grid = spark.createDataFrame([("s", k) for k, _ in vals], "series string, k int")
    got = [r.state for r in AL.alert_states(v, grid, ["series"], "gt", 0.25).orderBy("k").collect()]
    assert got == ["ok", "pending", "firing", "firing", "nodata", "pending"]
    tr = AL.transitions(AL.alert_states(v, grid, ["series"], "gt", 0.25), ["series"]).orderBy("k").collect()
    assert [r.state for r in tr] == ["ok", "pending", "firing", "nodata", "pending"]


def test_low_output_uses_lt(spark):
    v = spark.createDataFrame([("o", 4, 0.4), ("o", 8, 0.6)], "series string, k int, value double")
    grid = spark.createDataFrame([("o", 4), ("o", 8)], "series string, k int")
    assert [r.state for r in AL.alert_states(v, grid, ["series"], "lt", 0.5).orderBy("k").collect()] == ["pending", "ok"]


def test_band_and_last_and_instant(spark):
    df = spark.createDataFrame([(1, "x", 50.0), (2, "x", 85.0), (3, "x", None), (1, "y", 95.0)],
                               "k int, series string, value double")
    last = {r.series: r.value for r in M.last_value(df, ["series"]).collect()}
    assert last == {"x": 85.0, "y": 95.0}
    bands = [r.b for r in df.select(M.band(F.col("value"), [(80.0, "#EAB839"), (90.0, "red")]).alias("b"))
             .orderBy("k", "series").collect()]
    assert sorted(b for b in bands if b) == ["#EAB839", "green", "red"]
    inst = {r.series: r.value for r in M.instant(df.filter("value IS NOT NULL"), ["series"], F.lit(2), 1).collect()}
    assert inst == {"x": 85.0}


def test_canonical_samples_round_trip(spark, scratch):
    from wakeline.sources import samples as S

    df = spark.createDataFrame([("node-0", "0", "idle", 3, 10.0), ("node-1", "1", "user", 3, 7.0)],
                               "instance string, cpu string, mode string, k int, value double")
    canon = S.to_metric_samples(df, "node_cpu_seconds_total", ["instance", "cpu", "mode"])
    M.write_metric_samples(canon, scratch + "/samples")
    back = M.read_metric_samples(spark, scratch + "/samples")
    idle = M.select_series(back, "node_cpu_seconds_total", mode="idle").collect()
    assert len(idle) == 1 and idle[0].labels["instance"] == "node-0"
    assert M.time_range(back, now=S.START + 45.0, seconds=15.0).count() == 2
    assert M.time_range(back, now=S.START + 30.0, seconds=15.0).count() == 0
    keys = [r.k for r in back.select(M.label_key(F.col("labels")).alias("k")).collect()]
    assert len(set(keys)) == 2


@pytest.mark.parametrize("window,extrapolate", [(60.0, False), (60.0, True), (300.0, True)])
def test_dense_rate_equals_range_rate(spark, window, extrapolate):
    import random

    rnd = random.Random(int(window) + extrapolate)
    rows = []
    for sid in ("a", "b", "c"):
        v, k0 = 0, rnd.randint(1, 30)
        for k in range(k0, k0 + 60):
            v = rnd.randint(0, 5) if rnd.random() < 0.05 else v + rnd.randint(0, 9)  # occasional reset
            rows.append((sid, k, v))
    s = spark.createDataFrame(rows, "sid string, k int, units long")
    a = {(r.sid, r.k): r.value for r in M.rate(s, ["sid"], window=window, extrapolate=extrapolate).collect()}
    b = {(r.sid, r.k): r.value for r in M.rate(s, ["sid"], window=window, extrapolate=extrapolate,
                                               dense=True).collect()}
    assert a == b


def test_left_open_rate_leaves_out_the_edge(spark):
    rows = [("a", k, 10 * k * k) for k in range(1, 9)]
    s = spark.createDataFrame(rows, "series string, k int, units long")
    for dense in (True, False):
        got = {r.k: r.value for r in M.rate(s, ["series"], window=60.0, extrapolate=False, dense=dense,
                                            left_open=True).collect()}
        # 60 s are four steps: the open window ends three samples back.
        assert got[8] == pytest.approx((10 * 64 - 10 * 25) / 60)
        closed = {r.k: r.value for r in M.rate(s, ["series"], window=60.0, extrapolate=False, dense=dense).collect()}
        assert closed[8] == pytest.approx((10 * 64 - 10 * 16) / 60)


def test_failed_evaluations_have_their_own_state(spark):
    rows = [(4, 1.0, False), (8, 1.0, False), (12, 1.0, True), (16, 1.0, None), (20, None, True)]
    values = spark.createDataFrame([("s", *r) for r in rows], "series string, k int, value double, failed boolean")
    grid = values.select("series", "k").unionByName(spark.createDataFrame([("s", 24)], "series string, k int"))
    got = {r.k: r.state for r in AL.alert_states(values, grid, ["series"], "gt", 0.5, error="failed").collect()}
    assert got == {4: "pending", 8: "firing", 12: "error", 16: "pending", 20: "error", 24: "nodata"}


def test_counter_rates_equal_the_rates_of_dense_samples(spark):
    """The rates of late and on-time counters, whatever the gaps between their bumps, to the last bit."""
    import random

    rnd = random.Random(31)
    end, bumps = 40, []
    for d in range(12):
        for kind in ("late", "on_time"):
            for k in rnd.sample(range(1, end + 1), rnd.choice([0, 1, 2, 3, 9, 25])):
                bumps += [(f"d{d}", kind, k, 1)] * rnd.randint(1, 4)
    inc = spark.createDataFrame(bumps, "id string, kind string, k int, inc long").repartition(3)
    kmax = spark.createDataFrame([(end,)], "_kmax int")
    for window in (60.0, 300.0):
        dense = M.rate(M.counter_samples(inc, ["id", "kind"], kmax), ["id", "kind"], window=window, dense=True)
        want = {(r.id, r.k, r.kind): r.value for r in dense.collect()}
        got = M.counter_rates(inc, ["id"], "kind", ["late", "on_time"], kmax, window=window).collect()
        assert len({(r.id, r.k) for r in got}) == len(got)
        assert {(r.id, r.k, x): r[x] for r in got for x in ("late", "on_time") if r[x] is not None} == want
        some = M.counter_rates(inc, ["id"], "kind", ["late", "on_time"], kmax, window=window, every=7)
        assert sorted(map(tuple, some.collect()), key=str) == sorted((tuple(r) for r in got if r.k % 7 == 0 or r.k == end), key=str)


def test_late_ratio_sorts_no_row_per_scrape(spark):
    """Scrapes are filled in after the last sort and shuffle."""
    from wakeline.plans.queries import QUERIES

    plan = QUERIES["late_ratio"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Window") and "sequence" in plan[:plan.index("Window")]
