"""Parallel prefix scans equal the single-task windows, and the plans stay partitioned."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wakeline.operators import lateness, prefix
from wakeline.operators.batches import assign_batches
from wakeline.sources.io import arrival_seq


def _naive_late(df):
    w = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.greatest(F.lit(0.0), F.max(F.when(F.isnan("timestamp"), None).otherwise(F.col("timestamp"))).over(w))
    return df.withColumn("is_late", ~(~F.isnan("timestamp") & (F.col("timestamp") > prev)))


@pytest.mark.parametrize("bucket_rows", [1, 7, 1000, 100000])
def test_lateness_equals_naive(spark, bucket_rows):
    rnd = random.Random(bucket_rows)
    rows = []
    t = 100.0
    for i in range(500):
        t += rnd.choice([0.5, 0.0, 1.0])
        ts = t - (5.0 if rnd.random() < 0.1 else 0.0)
        rows.append((i * 3 + 1, rnd.randint(1, 5), 0.0, 0.0, ts))
    df = spark.createDataFrame(rows, "seq long, id int, x float, y float, timestamp double")
    got = {r.seq: r.is_late for r in lateness.classify_lateness(df, bucket_rows=bucket_rows).collect()}
    want = {r.seq: r.is_late for r in _naive_late(df).collect()}
    assert got == want


@pytest.mark.parametrize("bucket_rows", [1, 5, 64, 10**6])
def test_global_row_number(spark, bucket_rows):
    df = spark.range(0, 400, 3).select(F.col("id").alias("seq"), (F.col("id") % 4).alias("k"))
    got = {r.seq: r.rn for r in prefix.global_row_number(df, "seq", bucket_rows=bucket_rows).collect()}
    assert got == {s: i + 1 for i, s in enumerate(range(0, 400, 3))}
    per = prefix.global_row_number(df, "seq", keys=["k"], bucket_rows=bucket_rows).collect()
    w = Window.partitionBy("k").orderBy("seq")
    want = {r.seq: r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert {r.seq: r.rn for r in per} == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lateness_plan_has_no_single_partition_over_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), F.lit(1).alias("id"),
                                  F.col("id").cast("double").alias("timestamp"))
    plan = lateness.classify_lateness(df)._jdf.queryExecution().sparkPlan().toString()
    # The only global step works on the per-bucket summary (below an aggregate).
    for part in plan.split("Exchange SinglePartition")[1:]:
        head = part.split("\n")[1:4]
        assert any("HashAggregate" in h for h in head), plan


@pytest.mark.parametrize("levels,bucket_rows", [(1, 10), (2, 3), (3, 2), (3, 50)])
def test_scan_levels(spark, levels, bucket_rows):
    rnd = random.Random(levels * 100 + bucket_rows)
    rows = [(i * 2 + 1, rnd.randint(1, 3), float(rnd.randint(0, 1000))) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k int, v double")
    got = {r.seq: (r.m, r.rn) for r in prefix.global_row_number(
        prefix.running_max_before(df, "v", "seq", "m", keys=["k"], bucket_rows=bucket_rows, levels=levels),
        "seq", keys=["k"], bucket_rows=bucket_rows, levels=levels).collect()}
    want = {}
    best, count = {}, {}
    for s, k, v in rows:
        want[s] = (best.get(k), count.get(k, 0) + 1)
        best[k] = v if k not in best else max(best[k], v)
        count[k] = count.get(k, 0) + 1
    assert got == want


def test_colliding_offsets_of_three_partitions(spark):
    """Offsets start at 0 in every partition; the order is by offset, then by partition, and keys are unique."""
    rnd = random.Random(5)
    rows = [(p, o, p, 100.0 + o + rnd.random() * 3) for p, n in ((0, 40), (1, 25), (2, 9)) for o in range(n)]
    df = spark.createDataFrame(rows, "partition int, offset long, id int, timestamp double")
    df = df.withColumn("seq", arrival_seq(F.col("partition"), F.col("offset"), 3))
    top, want = 0.0, {}
    for p, o, _, t in sorted(rows, key=lambda r: (r[1], r[0])):
        want[p, o] = t <= top
        top = max(top, t)
    for levels in (2, 3):
        got = lateness.classify_lateness(df, bucket_rows=7, levels=levels).collect()
        assert {(r.partition, r.offset): r.is_late for r in got} == want
    sizes = assign_batches(df, 20, bucket_rows=7, levels=3).groupBy("batch_no").count().collect()
    assert {r["batch_no"]: r["count"] for r in sizes} == {0: 20, 1: 20, 2: 20, 3: 14}
    with pytest.raises(Exception, match="unknown source partition 2"):
        df.withColumn("seq", arrival_seq(F.col("partition"), F.col("offset"), 2)).collect()


@pytest.mark.parametrize("name, most", [("device_counters_long", 4), ("late_ratio", 3), ("alert_low_output", 4),
                                        ("inst_speed", 2), ("stat_panels", 6)])
def test_queries_scan_the_events_few_times(spark, name, most):
    from wakeline.plans.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("events.parquet") <= most


@pytest.mark.parametrize("kind", ["thin", "outlier", "clumps", "dense", "one", "none"])
def test_measured_buckets(spark, kind):
    """Few buckets, in the order of the numbers, none of them far above the wished size."""
    rnd = random.Random(kind)
    n = {"one": 1, "none": 0}.get(kind, 3000)
    seqs = {"thin": lambda i: rnd.randrange(-(2**62), 2**62), "outlier": lambda i: i if i else 2**62,
            "clumps": lambda i: (i // 100 << 50) + i % 100}.get(kind, lambda i: i + 5)
    numbers = sorted({seqs(i) for i in range(n)})
    df = spark.createDataFrame([(s,) for s in numbers], "seq long").repartition(3)
    cut = prefix.measured_buckets(df, "seq", bucket_rows=50, cuts=16)
    found = [(r.seq, r.b) for r in df.select("seq", cut.of("seq").alias("b")).collect()]
    order = [b for _, b in sorted(found)]
    assert order == sorted(order) and None not in order
    sizes = [order.count(b) for b in set(order)]
    assert len(sizes) <= len(numbers) / 50 + 2 * 16
    assert max(sizes, default=0) <= (4 if kind != "clumps" else 8) * 50
    got = {r.seq: r.rn for r in prefix.global_row_number(df, "seq", bucket_rows=cut).collect()}
    assert got == {s: i + 1 for i, s in enumerate(numbers)}
    assert spark.createDataFrame([(None,)], "seq long").select(cut.of("seq")).first()[0] is None
