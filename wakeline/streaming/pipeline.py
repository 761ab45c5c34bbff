"""Structured Streaming forms of the job (S1-S4, K1-K8, W0 carry, W2 state, R*).

* ``LatenessIngest``: ``foreachBatch`` on the raw stream. Parses, splits late
  from on-time with the batch plan of W0 starting from the carried maximum,
  writes ``on_time``, ``late`` and ``quarantine`` tables, then the carry-out.
* ``CodedSpeedProcessor``: W2 as a ``transformWithStateInPandas`` processor
  with per-device ``ListState`` (optional TTL for idle devices).
* ``ArchiveWriter``: exact ``n``-record archive batches across micro-batch
  boundaries; the remainder is carried, and ``flush`` writes the last partial
  batch when the stream stops.
* ``LatestUpsert``: keeps the latest row per device in a table.
* ``HoldBack``: one order over several source partitions in front of any of these.
* ``CounterWriter``: the job's counters, kept by the stream; ``AlertStream``: alerts as values come in.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wakeline.functions.geo import HORIZON_S, METRES_PER_DEGREE, MIN_GAP_S
from wakeline.operators import alerts, batches, lateness, latest, parse
from wakeline.operators.metrics import STEP_S
from wakeline.operators.speed import EventList, fold_events
from wakeline.sources.io import TAIL, archive_lines, arrival_seq
from wakeline.sources.objects import write_objects
from wakeline.streaming import state

ON_TIME_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("batch_id", T.LongType()),
])

SPEED_OUT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("baseline_seq", T.LongType()),
    T.StructField("dt", T.DoubleType()),
    T.StructField("inst_speed", T.FloatType()),
])


class LatenessIngest:
    """``foreachBatch`` function: parse + W0 with a carry that survives restarts.

    ``scope="device"`` carries one maximum per device (table ``device_carry``) instead of one for the stream.
    ``counters`` is called with each batch's classified events (see ``CounterWriter``).
    """

    def __init__(self, root: str, start: float = 0.0, scope: str = "stream", counters=None, every: int = 100):
        if scope not in ("stream", "device"):
            raise ValueError(f"scope must be 'stream' or 'device', not {scope!r}")
        self.root, self.start, self.scope, self.counters = root, float(start), scope, counters
        # A maximum does not care how often or in which order it is taken, so replays change nothing.
        self.tops = state.Folded(root, "device_carry", lambda d: d.groupBy("id").agg(F.max("top").alias("top")), every)

    def carry_in(self, spark: SparkSession, batch_id: int) -> float:
        prev = state.carry_before(spark, self.root, "carry", batch_id)
        if prev is None:
            return self.start
        v = prev.select("carry_out").first()[0]
        return self.start if v is None else float(v)

    def _classified(self, good: DataFrame, batch_id: int) -> DataFrame:
        spark = good.sparkSession
        if self.scope == "stream":
            return lateness.classify_lateness(good, start=self.carry_in(spark, batch_id))
        tops = self.tops.before(spark, batch_id)
        first = F.lit(self.start) if tops is None else F.coalesce("top", F.lit(self.start))
        known = good if tops is None else good.join(tops, "id", "left")
        rows = known.withColumn("_first", first).select(*good.columns, "_first")
        return lateness.classify_lateness(rows, start="_first", scope="device").drop("_first")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = parse.parse_with_reason(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            state.write_batch(checked.filter(F.col("reason").isNotNull()).select("seq", "value", "reason"),
                              self.root, "quarantine", batch_id)
            good = checked.filter(F.col("reason").isNull()).select(
                "seq", F.col("_j.id").cast("int").alias("id"), F.col("_j.x").cast("float").alias("x"),
                F.col("_j.y").cast("float").alias("y"), F.col("_j.timestamp").alias("timestamp"))
            c = self._classified(good, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                on_time = c.filter(~F.col("is_late")).drop("is_late")
                state.write_batch(on_time, self.root, "on_time", batch_id)
                state.write_batch(c.filter(F.col("is_late")).drop("is_late"), self.root, "late", batch_id)
                if self.counters is not None:
                    self.counters(c, batch_id)
                # The carry comes last: a batch without it is done again from the start.
                if self.scope == "device":
                    self.tops.write(on_time.groupBy("id").agg(F.max("timestamp").alias("top")), batch_id)
                else:
                    self._carry_out(spark, on_time, batch_id)
            finally:
                c.unpersist()
        finally:
            checked.unpersist()

    def _carry_out(self, spark: SparkSession, on_time: DataFrame, batch_id: int) -> None:
        cin = self.carry_in(spark, batch_id)
        top = on_time.agg(F.max("timestamp")).first()[0]
        cout = cin if top is None else max(cin, float(top))
        carry = spark.createDataFrame([(float(cin), float(cout))], "carry_in double, carry_out double")
        state.write_batch(carry, self.root, "carry", batch_id)


class HoldBack:
    """``foreachBatch`` function: one order over several source partitions, whatever the slicing into micro-batches.

    Records (partition, offset, value) come in order within their partition, but one partition may be ahead of
    another. A record is held back until no partition can still send one that precedes it in the order of
    ``arrival_seq`` (by offset, then by partition); then it goes to ``sink(rows(seq, value, partition, offset), id)``.
    So the sink sees one total order, cut into batches. State is the held-back rows and, per partition, the next
    offset; records below it (sent again) are dropped.

    ``start`` gives each partition's first offset where it is not 0, as when reading starts at the latest records. A
    silent partition holds the others back; ``flush`` lets all go when the stream has stopped. The sink's ids are
    even for micro-batches and odd for a flush, and the sink must accept an id again after a failure, like all here.
    """

    def __init__(self, root: str, sink, partitions: int, start: dict[int, int] | None = None, table: str = "order"):
        self.root, self.sink, self.partitions, self.table = root, sink, int(partitions), table
        self.start = {q: int((start or {}).get(q, 0)) for q in range(self.partitions)}

    def next_offsets(self, spark: SparkSession, at: int) -> tuple[int | None, dict[int, int]]:
        """The newest state before ``at`` and the offsets that come next (a number per partition)."""
        prev = state.batch_before(spark, self.root, self.table + "_next", at)
        if prev is None:
            return None, dict(self.start)
        rows = state.read_partition(spark, self.root, self.table + "_next", prev).collect()
        return prev, {int(r["partition"]): int(r["next"]) for r in rows}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch.sparkSession, batch.select("partition", "offset", "value"), 2 * batch_id)

    def flush(self, spark: SparkSession) -> None:
        """Let everything go that is held back. Records that come later, after a restart, follow what was let go."""
        prev, _ = self.next_offsets(spark, 1 << 62)
        if prev is not None and prev % 2 == 0:
            self._step(spark, None, prev + 1)

    def _step(self, spark: SparkSession, fresh: DataFrame | None, at: int) -> None:
        prev, offsets = self.next_offsets(spark, at)
        held = None if prev is None else state.read_partition(spark, self.root, self.table + "_held", prev)
        rows = None if held is None else held.select("partition", "offset", "value")
        if fresh is not None:
            begin = F.create_map(*[F.lit(x) for q in sorted(offsets.items()) for x in q])
            fresh = fresh.select(F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"), "value")
            # An unknown partition has no offset here; arrival_seq reports it.
            fresh = fresh.filter(F.col("offset") >= F.coalesce(begin[F.col("partition")], F.lit(0)))
            rows = fresh if rows is None else rows.unionByName(fresh)
        if rows is None:
            rows = spark.createDataFrame([], "partition int, offset long, value string")
        rows = rows.withColumn("seq", arrival_seq(F.col("partition"), F.col("offset"), self.partitions))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for r in rows.groupBy("partition").agg(F.max("offset").alias("top")).collect():
                offsets[r["partition"]] = max(offsets[r["partition"]], r["top"] + 1)
            low = min(o * self.partitions + q for q, o in offsets.items())
            free = F.lit(True) if fresh is None else F.col("seq") < F.lit(low)
            self.sink(rows.filter(free).select("seq", "value", "partition", "offset"), at)
            state.write_batch(rows.filter(~free).drop("seq"), self.root, self.table + "_held", at)
        finally:
            rows.unpersist()
        state.write_batch(spark.createDataFrame(sorted(offsets.items()), "partition int, next long"), self.root,
                          self.table + "_next", at)
        if prev is not None:
            for name in ("_held", "_next"):
                state.forget(spark, self.root, self.table + name, prev)


class CounterWriter:
    """Job counters kept by the stream itself: ``bumps`` turns a batch into rows (metric, inc); the counters that a batch
    bumps are written with their new totals and the time ``clock(batch_id)``.

    With ``keep`` every written value stays, so the table is also the counters' stored samples.
    """

    def __init__(self, root: str, bumps, table: str = "counters", every: int = 100, keep: bool = True, clock=None):
        self.bumps, self.clock = bumps, clock or (lambda batch_id: time.time())
        last = F.max_by(F.struct("value", "ts"), "at").alias("_l")
        self.store = state.Folded(root, table, lambda d: d.groupBy("metric").agg(last, F.max("at").alias("at")).select(
            "metric", "_l.value", "_l.ts", "at"), every, keep)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        more = self.bumps(batch).groupBy("metric").agg(F.sum("inc").alias("inc"))
        before = self.store.before(spark, batch_id)
        value = F.col("inc")
        if before is not None:
            more = more.join(before.select("metric", F.col("value").alias("_before")), "metric", "left")
            value = F.coalesce("_before", F.lit(0)) + F.col("inc")
        self.store.write(more.select("metric", value.alias("value"), F.lit(float(self.clock(batch_id))).alias("ts"),
                                     F.lit(int(batch_id)).cast("long").alias("at")), batch_id)

    def totals(self, spark: SparkSession) -> DataFrame | None:
        """The counters now: metric, value."""
        rows = self.store.rows(spark)
        return None if rows is None else rows.select("metric", "value")

    def samples(self, spark: SparkSession) -> DataFrame | None:
        """The values written so far, in the canonical form of stored samples."""
        rows = state.read_table(spark, self.store.root, self.store.table)
        none = F.create_map().cast("map<string,string>")
        return None if rows is None else rows.select("ts", "metric", none.alias("labels"), F.col("value").cast("double").alias("value"))


def event_bumps(classified: DataFrame) -> DataFrame:
    """Bumps of the on-time and late counters, per device and in total."""
    late = F.col("is_late")
    device = F.concat(F.when(late, "late_device_").otherwise("on_time_device_"), F.col("id").cast("string"))
    total = F.when(late, "total_late_events").otherwise("total_on_time_events")
    return classified.select(F.explode(F.array(device, total)).alias("metric"), F.lit(1).cast("long").alias("inc"))


def latency_bumps(enriched: DataFrame) -> DataFrame:
    """Bumps of the latency sum, in whole microseconds."""
    return enriched.select(F.lit("time_counter_us").alias("metric"),
                           F.round(F.col("time_taken").cast("double") * F.lit(1e6)).cast("long").alias("inc"))


class AlertStream:
    """``foreachBatch`` function: threshold alerts (M15-M18) evaluated as the values come in.

    A batch holds values (series.., k, value) of later scrapes than the batches before. Every series seen so far
    is evaluated at each evaluation index up to ``upto`` (by default the batch's largest k), so one without values gets
    ``nodata``; a series seen for the first time is evaluated from the grid's start. Carried per series: its last state
    and, while it breaches, since when. Tables ``<name>_states`` and ``<name>_sent`` (changes of state) get a batch's rows.
    """

    def __init__(self, root: str, series: list[str], op: str, limit: float, hold: float = alerts.HOLD_S,
                 every: float = alerts.EVAL_EVERY_S, step: float = STEP_S, name: str = "alert"):
        self.root, self.series, self.name = root, list(series), name
        self.op, self.limit, self.hold, self.step = op, limit, hold, step
        self.every = int(round(every / step))

    def __call__(self, batch: DataFrame, batch_id: int, upto: int | None = None) -> None:
        spark = batch.sparkSession
        s = self.series
        prev = state.batch_before(spark, self.root, self.name + "_upto", batch_id)
        done = 0 if prev is None else int(state.read_partition(spark, self.root, self.name + "_upto", prev).first()["upto"])
        carry = None if prev is None else state.read_partition(spark, self.root, self.name + "_carry", prev)
        batch = batch.select(*s, "k", "value").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if upto is None:
                upto = batch.agg(F.max("k")).first()[0]
            upto = max(done, done if upto is None else int(upto))
            if carry is None:
                known = batch.select(*s).distinct().withColumn("_from", F.lit(0))
            else:
                known = batch.select(*s).distinct().join(carry.select(*s), s, "left_anti").withColumn("_from", F.lit(0)).unionByName(
                    carry.select(*s, F.when(F.col("state").isNull(), 0).otherwise(done).alias("_from")))
            e = self.every
            first = (F.floor(F.col("_from") / e) + 1) * e
            times = F.sequence(first.cast("int"), F.greatest(first.cast("int"), F.lit(upto // e * e)), F.lit(e))
            grid = known.select(*s, F.explode(times).alias("k")).filter(F.col("k") <= upto)
            # Values between two evaluations only tell that their series is there.
            values = batch.filter(F.col("k") % e == 0)
            if carry is not None:
                # An open breach goes on: its first evaluation stands before the new ones.
                since = carry.filter("since is not null").select(*s, F.col("since").alias("k"), "value")
                grid, values = grid.unionByName(since.select(*s, "k")), values.unionByName(since)
            states = alerts.alert_states(values, grid, s, self.op, self.limit, self.hold, self.step)
            states = states.join(known, s).filter(F.col("k") > F.col("_from")).drop("_from")
            states = states.persist(StorageLevel.MEMORY_AND_DISK)
            self._write(spark, states, known, carry, batch_id, upto)
            states.unpersist()
        finally:
            batch.unpersist()
        if prev is not None:
            for table in ("_carry", "_upto"):
                state.forget(spark, self.root, self.name + table, prev)

    def _write(self, spark: SparkSession, states: DataFrame, known: DataFrame, carry: DataFrame | None, batch_id: int,
               upto: int) -> None:
        s = self.series
        w = Window.partitionBy(*s).orderBy("k")
        state.write_batch(states, self.root, self.name + "_states", batch_id)
        old = None if carry is None else carry.select(*s, F.col("state").alias("_was"))
        rows = states.withColumn("_was", F.lit(None).cast("string")) if old is None else states.join(old, s, "left")
        sent = rows.withColumn("prev_state", F.coalesce(F.lag("state").over(w), "_was")).drop("_was").filter(
            F.col("prev_state").isNull() | (F.col("prev_state") != F.col("state")))
        state.write_batch(sent, self.root, self.name + "_sent", batch_id)
        # The breach that is open at the end: its first evaluation after the last one that did not breach.
        open_state = F.col("state").isin("pending", "firing")
        ends = states.groupBy(*s).agg(F.max_by(F.struct("state", "value"), "k").alias("_l"),
                                      F.max(F.when(~open_state, F.col("k"))).alias("_calm"))
        last = states.join(ends, s).filter(open_state & (F.col("k") > F.coalesce("_calm", F.lit(-1)))).groupBy(*s).agg(
            F.min("k").alias("_first"), F.min_by("value", "k").alias("_value"))
        now = ends.join(last, s, "left")
        if carry is not None:
            now = now.join(carry.select(*s, F.col("since").alias("_since"), F.col("value").alias("_held")), s, "left")
        else:
            now = now.withColumn("_since", F.lit(None).cast("int")).withColumn("_held", F.lit(None).cast("double"))
        goes_on = F.col("_calm").isNull() & F.col("_since").isNotNull()
        now = now.select(*s, F.col("_l.state").alias("state"),
                         F.when(goes_on, F.col("_since")).otherwise(F.col("_first")).alias("since"),
                         F.when(goes_on, F.col("_held")).otherwise(F.col("_value")).alias("value"))
        # Series without an evaluation in this batch stay as they are, new ones without a state.
        rest = known.select(*s).join(states.select(*s).distinct(), s, "left_anti")
        none = [F.lit(None).cast(t).alias(c) for c, t in (("state", "string"), ("since", "int"), ("value", "double"))]
        rest = rest.select(*s, *none) if carry is None else rest.join(carry, s, "left").select(*s, "state", "since", "value")
        now = now.unionByName(rest)
        state.write_batch(now, self.root, self.name + "_carry", batch_id)
        state.write_batch(spark.createDataFrame([(upto,)], "upto int"), self.root, self.name + "_upto", batch_id)


# Latest time of a timer, in seconds; an infinite event time counts as it.
LATEST_S = 1e11


class CodedSpeedProcessor(StatefulProcessor):
    """W2 per device: the reference's list-state fold, state kept in a ``ListState``.

    With ``idle_s`` a device's state is cleared once the watermark is that far past its last event. A device has one
    timer at a time, set when its state begins and set again if newer events came meanwhile.
    """

    def __init__(self, horizon: float = HORIZON_S, min_gap: float = MIN_GAP_S,
                 metres_per_degree: float = METRES_PER_DEGREE, ttl_ms: int | None = None, idle_s: float | None = None):
        self.horizon, self.min_gap, self.mpd, self.ttl_ms, self.idle_s = horizon, min_gap, metres_per_degree, ttl_ms, idle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "seq long, x double, y double, ts double", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        known = self.events.exists()
        stored = list(zip(*self.events.get())) if known else []
        events = EventList(pdf["seq"], pdf["x"], pdf["y"], pdf["timestamp"])
        emits, base, dt, speed, after = fold_events(EventList(*stored), events, self.horizon, self.min_gap, self.mpd)
        self.events.put(list(zip(after.seq.tolist(), after.x.tolist(), after.y.tolist(), after.t.tolist())))
        if self.idle_s is not None and not known:
            self._expire_after(after.t)
        sel = pdf.iloc[emits]
        yield pd.DataFrame({
            "seq": sel["seq"].astype("int64"), "id": sel["id"].astype("int32"),
            "x": sel["x"].astype("float32"), "y": sel["y"].astype("float32"),
            "timestamp": sel["timestamp"].astype("float64"),
            "baseline_seq": base, "dt": dt, "inst_speed": speed.astype("float32"),
        })

    def _expire_after(self, times) -> None:
        self.handle.registerTimer(int((min(max(times), LATEST_S) + self.idle_s) * 1000) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        times = [e[3] for e in self.events.get()] if self.events.exists() else []
        if times and (min(max(times), LATEST_S) + self.idle_s) * 1000 >= expiredTimerInfo.getExpiryTimeInMs():
            self._expire_after(times)
        else:
            self.events.clear()
        yield from ()

    def close(self) -> None:
        pass


def speed_stream(on_time_stream: DataFrame, ttl_ms: int | None = None, idle_s: float | None = None,
                 delay: str = "0 seconds", **kw) -> DataFrame:
    """Enriched stream (without ``time_taken``) from a stream of on-time events.

    ``idle_s`` lets the state of silent devices go, by event time: after a silence longer than the horizon the fold
    starts anew anyway, so with ``idle_s`` of the horizon or more the output stays the same. It needs events in the stream's
    order (lateness of scope ``stream``, whole ingest batches), as events behind the watermark are dropped by the
    engine; ``delay`` holds the watermark back where a source may deal them out of order.
    """
    from wakeline.session import ship_package

    ship_package(on_time_stream.sparkSession)
    if idle_s is not None:
        if ttl_ms or idle_s < kw.get("horizon", HORIZON_S):
            raise ValueError("idle_s must be the horizon or more, and excludes ttl_ms")
        at = F.timestamp_millis(F.floor(F.least("timestamp", F.lit(LATEST_S)) * 1000).cast("long")).alias("event_time")
        rows = on_time_stream.select("seq", "id", "x", "y", "timestamp", at).withWatermark("event_time", delay)
        return rows.groupBy("id").transformWithStateInPandas(CodedSpeedProcessor(idle_s=idle_s, **kw), SPEED_OUT, "Append", "EventTime")
    mode = "ProcessingTime" if ttl_ms else "None"
    return (on_time_stream.select("seq", "id", "x", "y", "timestamp").groupBy("id")
            .transformWithStateInPandas(CodedSpeedProcessor(ttl_ms=ttl_ms, **kw), SPEED_OUT, "Append", mode))


class ArchiveWriter:
    """``foreachBatch`` function: archive files of exactly ``n`` raw records, in arrival order.

    With ``objects`` (an address) every batch becomes an object there instead of a line: a JSON array under the name
    of its time (F9). A micro-batch's objects count up in microseconds from ``clock(batch_id)``, or from its predecessor's last name if
    that is later; the time is kept before the first object appears, so a replay writes the same names.
    """

    def __init__(self, root: str, n: int = batches.ARCHIVE_BATCH, out: str = "archive", objects: str | None = None, clock=None):
        self.root, self.n, self.out, self.objects = root, n, out, objects
        self.clock = clock or (lambda batch_id: time.time())

    def _publish(self, arch: DataFrame, batch_id: int, first_no: int, n_full: int, folder: str) -> None:
        """Write whole batches: as objects, or as lines of ``folder``."""
        spark = arch.sparkSession
        if self.objects is None:
            state.write_batch(archive_lines(arch).select("value"), self.root, folder, batch_id, "text")
            return
        table = f"{self.out}_names"
        kept = state.read_partition(spark, self.root, table, batch_id)
        if kept is None:
            prev = state.carry_before(spark, self.root, table, batch_id)
            begin = max(int(self.clock(batch_id) * 1e6), 0 if prev is None else int(prev.first()["next"]))
            state.write_batch(spark.createDataFrame([(begin, begin + n_full)], "begin long, next long"), self.root, table, batch_id)
        else:
            begin = int(kept.first()["begin"])
        at = F.timestamp_micros(F.lit(begin) + F.col("batch_no") - F.lit(first_no))
        write_objects(arch.select(batches.archive_object_name(at).alias("name"), "value"), self.objects)

    def _state(self, spark, batch_id):
        # The counter table gets a row every batch; the pending rows of that same
        # batch may be empty (then no partition exists), so never search for them.
        prev = state.batch_before(spark, self.root, f"{self.out}_next", batch_id)
        if prev is None:
            return None, 0
        next_no = int(state.read_partition(spark, self.root, f"{self.out}_next", prev).first()[0])
        return state.read_partition(spark, self.root, f"{self.out}_pending", prev), next_no

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pend, next_no = self._state(spark, batch_id)
        rows = batch.select("seq", "value").filter(F.try_parse_json("value").isNotNull())
        if pend is not None:
            rows = pend.select("seq", "value").unionByName(rows)
        b = batches.assign_batches(rows, self.n).withColumn("batch_no", F.col("batch_no") + F.lit(next_no))
        b = b.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = b.groupBy("batch_no").count()
            full = sizes.filter(F.col("count") == self.n).select("batch_no")
            last_full = full.agg(F.max("batch_no")).first()[0]
            # Batches fill in order, so only the last one can be short.
            complete = F.lit(False) if last_full is None else F.col("batch_no") <= F.lit(last_full)
            done = b.filter(complete)
            arch = batches.archive_records(done.select("seq", "value"), self.n)
            # archive_records numbers batches from 0 within its input: shift to the global numbering.
            arch = arch.withColumn("batch_no", F.col("batch_no") + F.lit(next_no))
            new_next = next_no if last_full is None else int(last_full) + 1
            self._publish(arch, batch_id, next_no, new_next - next_no, self.out)
            rest = b.filter(~complete).select("seq", "value")
            state.write_batch(rest, self.root, f"{self.out}_pending", batch_id)
            state.write_batch(spark.createDataFrame([(new_next,)], "next_no long"), self.root,
                              f"{self.out}_next", batch_id)
            if self.objects is not None:
                # The flushed rows are in this batch's objects or pending rows now.
                state.drop_folder(spark, self.objects + TAIL)
        finally:
            b.unpersist()

    def flush(self, spark: SparkSession) -> None:
        """Write the carried partial batch (called once the stream has stopped).

        It goes to a folder of its own, as the batch grows on if the stream is started again.
        """
        pend, next_no = self._state(spark, 1 << 62)
        if pend is None or pend.limit(1).count() == 0:
            return
        arch = batches.archive_records(pend.select("seq", "value"), self.n)
        arch = arch.withColumn("batch_no", F.col("batch_no") + F.lit(next_no))
        if self.objects is not None:
            write_objects(arch.select(F.lit("tail.json").alias("name"), "value"), self.objects + TAIL)
            return
        archive_lines(arch).select("value").write.mode("overwrite").text(os.path.join(self.root, self.out + TAIL))


def _fold_latest(rows: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("seq", "x", "y", "inst_speed"), F.col("seq"))
    return rows.filter(F.col("inst_speed").isNotNull()).groupBy("id").agg(last.alias("_l")).select("id", "_l.*")


class LatestUpsert:
    """``foreachBatch`` function: a table of the latest row per device, as changes and snapshots (``state.Folded``)."""

    def __init__(self, root: str, table: str = "latest", every: int = 100):
        self.store = state.Folded(root, table, _fold_latest, every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.store.write(_fold_latest(batch.select("id", "seq", "x", "y", "inst_speed")), batch_id)


def latest_table(spark: SparkSession, root: str, table: str = "latest") -> DataFrame | None:
    rows = state.Folded(root, table, _fold_latest).rows(spark)
    return None if rows is None else latest.latest_per_device(rows)


class ReadingsWriter:
    """``foreachBatch`` function for the relational sink: serial ids carried across batches.

    A batch's rows are written under its batch id with overwrite, so a replay
    neither duplicates rows nor advances the serial.
    """

    def __init__(self, root: str, table: str = "readings"):
        self.root, self.table = root, table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from wakeline.operators.readings import rejected_readings, to_readings

        spark = batch.sparkSession
        prev = state.carry_before(spark, self.root, f"{self.table}_next", batch_id)
        first = 1 if prev is None else int(prev.first()[0])
        rows = to_readings(batch, first_id=first).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            state.write_batch(rows, self.root, self.table, batch_id)
            state.write_batch(rejected_readings(batch), self.root, f"{self.table}_rejected", batch_id)
            top = rows.agg(F.max("reading_id")).first()[0]
        finally:
            rows.unpersist()
        nxt = first if top is None else int(top) + 1
        state.write_batch(spark.createDataFrame([(nxt,)], "next_id long"), self.root, f"{self.table}_next", batch_id)
