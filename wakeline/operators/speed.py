"""Per-device instantaneous speed over a trailing event-time horizon.

Two rules are offered, both taking on-time events ``seq, id, x, y, timestamp``:

* ``inst_speed`` (W1, the documented rule): the baseline is the oldest earlier
  event of the same device with ``ts - ts_b <= horizon``; a row is emitted iff
  ``ts - ts_b >= min_gap``. Pure window plan, no Python.
* ``inst_speed_stateful`` (W2, the rule the reference's code really runs): a
  per-device list state rewritten newest-first on every event, so its order
  zig-zags and the early ``break`` cuts a different part of it. The fold is
  sequential per device; it runs as an Arrow-batched ``mapInArrow`` over
  partitions sorted by device and arrival, with independent segments split
  wherever a device is silent for longer than the horizon (state resets there).

Both produce ``seq, id, x, y, timestamp, baseline_seq, dt, inst_speed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wakeline.functions.geo import HORIZON_S, METRES_PER_DEGREE, MIN_GAP_S, latency_seconds, planar_speed
from wakeline.operators.prefix import DEFAULT_BUCKET_ROWS, running_max_before

# Event-time span of one window partition. Rows of the previous span that lie
# within the horizon are copied in as read-only context, so a device that
# reports very often is still cut into bounded window partitions.
DEFAULT_SPAN_S = 300.0

_SENTINEL_SPAN = 1 << 62

SPEED_COLUMNS = ["seq", "id", "x", "y", "timestamp", "baseline_seq", "dt", "inst_speed"]

SPEED_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("baseline_seq", T.LongType()),
    T.StructField("dt", T.DoubleType()),
    T.StructField("inst_speed", T.DoubleType()),
])


def _with_span_context(df: DataFrame, horizon: float, span: float) -> DataFrame:
    """Each row in its own span (``_home``) plus, near the next span's start, a context copy there."""
    t = F.col("timestamp")
    # Non-finite times (an on-time +Infinity) go to sentinel spans, away from overflow.
    span_no = (F.when(F.abs(t) < F.lit(1e15), F.floor(t / F.lit(span)).cast("long"))
               .when(t > 0, F.lit(_SENTINEL_SPAN)).otherwise(F.lit(-_SENTINEL_SPAN)))
    next_start = (span_no + 1).cast("double") * F.lit(span)
    near_next = F.col("timestamp") >= next_start - F.lit(horizon + 1.0)
    copies = F.when(near_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.withColumn("_span0", span_no)
            .withColumn("_shift", F.explode(copies))
            .withColumn("_span", F.col("_span0") + F.col("_shift"))
            .withColumn("_home", F.col("_shift") == 0)
            .drop("_span0", "_shift"))


def with_baseline(on_time: DataFrame, horizon: float = HORIZON_S, span: float = DEFAULT_SPAN_S,
                  key: str = "id") -> DataFrame:
    """Add ``_base`` = oldest event of the same device within ``horizon`` seconds (may be the row itself).

    Equal to ``min(struct(t, seq, x, y)) OVER (PARTITION BY id ORDER BY t RANGE
    BETWEEN horizon PRECEDING AND CURRENT ROW)``, but computed with a running
    frame, whose cost per row is constant however many events the horizon
    holds: every row also sends a probe at ``t - horizon``; scanning each
    (device, span) partition in descending time, the last event seen before a
    probe is the earliest event at or after the probe's time.
    """
    d = _with_span_context(on_time, horizon, span)
    # Events (kind 0) and probes (kind 1) come from one pass over the input.
    kinds = F.when(F.col("_home"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = d.withColumn("_kind", F.explode(kinds)).withColumn(
        "_t", F.col("timestamp") - F.when(F.col("_kind") == 1, F.lit(float(horizon))).otherwise(F.lit(0.0)))
    ev = F.struct(F.col("timestamp").alias("t"), F.col("seq").alias("seq"),
                  F.col("x").alias("x"), F.col("y").alias("y"))
    # Descending time; at equal time events before probes (the bound is inclusive),
    # and among equal times the smallest seq last (it wins, as in min(struct)).
    w = (Window.partitionBy(key, "_span")
         .orderBy(F.col("_t").desc(), F.col("_kind").asc(), F.col("seq").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_base", F.last(F.when(F.col("_kind") == 0, ev), ignorenulls=True).over(w))
    return found.filter(F.col("_kind") == 1).select(*on_time.columns, "_base")


def inst_speed(on_time: DataFrame, horizon: float = HORIZON_S, min_gap: float = MIN_GAP_S,
               metres_per_degree: float = METRES_PER_DEGREE, span: float = DEFAULT_SPAN_S) -> DataFrame:
    """Documented speed rule (window plan)."""
    b = with_baseline(on_time, horizon, span)
    dt = F.col("timestamp") - F.col("_base.t")
    return (b.filter(F.col("_base.seq") != F.col("seq"))
            .withColumn("dt", dt)
            .filter(F.col("dt") >= F.lit(min_gap))
            .select("seq", "id", "x", "y", "timestamp",
                    F.col("_base.seq").alias("baseline_seq"), "dt",
                    planar_speed(F.col("x"), F.col("y"), F.col("_base.x"), F.col("_base.y"),
                                 F.col("dt"), metres_per_degree).cast("double").alias("inst_speed")))


def speed_suppressed(on_time: DataFrame, horizon: float = HORIZON_S, min_gap: float = MIN_GAP_S,
                     span: float = DEFAULT_SPAN_S) -> DataFrame:
    """On-time rows that yield no speed, with the reason."""
    b = with_baseline(on_time, horizon, span)
    reason = (F.when(F.col("_base.seq") == F.col("seq"), F.lit("first_in_horizon"))
              .when(F.col("timestamp") - F.col("_base.t") < F.lit(min_gap), F.lit("gap_below_min")))
    return b.select("seq", "id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def with_time_taken(enriched: DataFrame, now=None) -> DataFrame:
    """``time_taken = now - timestamp`` (float32); ``now`` defaults to the batch clock."""
    return enriched.withColumn("time_taken", latency_seconds(F.col("timestamp"), now))


# ---------------------------------------------------------------------------
# The coded rule as a sequential fold


def newest_suffix(ages: np.ndarray, horizon: float) -> int:
    """Where the longest run of entries at the end of the list begins that are all within ``horizon``."""
    stale = np.flatnonzero(~(ages <= horizon))
    return int(stale[-1]) + 1 if len(stale) else 0


def fold_positions(times: np.ndarray, first: int, order: np.ndarray, horizon: float) -> tuple[np.ndarray, np.ndarray]:
    """The coded rule on positions: events ``first`` onwards of ``times``, list state ``order`` (positions).

    One event at time t cuts the list to its newest suffix, takes the suffix's first entry as the event's baseline
    (-1 if the suffix is empty), and turns the list into the suffix reversed plus the event. Returns the baselines
    and the final list.
    """
    base = np.full(len(times) - first, -1, dtype=np.int64)
    for i in range(first, len(times)):
        kept = order[newest_suffix(times[i] - times[order], horizon):]
        if len(kept):
            base[i - first] = kept[0]
        order = np.append(kept[::-1], i)
    return base, order


# Below this many runs an array operation over all of them costs more than their lists one by one.
LOCK_STEP_RUNS = 3


def fold_lock_step(times: np.ndarray, first: np.ndarray, count: np.ndarray, orders: list[np.ndarray],
                   horizon: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """``fold_positions`` for many independent runs side by side: one array operation takes a step of all of them.

    Run r has the events ``first[r] .. first[r] + count[r]`` of ``times`` and the list state ``orders[r]`` (positions
    in ``times``). Returns the baseline of every position in ``times`` (-1 if none) and the final lists.
    """
    base = np.full(len(times), -1, dtype=np.int64)
    runs = np.argsort(-count, kind="stable")
    first, count = first[runs], count[runs]
    size = np.array([len(orders[r]) for r in runs], dtype=np.int64)
    lists = np.zeros((len(runs), int(size.max(initial=0)) + 1), dtype=np.int64)
    for k, r in enumerate(runs):
        lists[k, :size[k]] = orders[r]
    step = 0
    while True:
        live = int(np.searchsorted(-count, -step, side="left"))
        if live < LOCK_STEP_RUNS:
            break
        at, held = first[:live] + step, size[:live]
        width = int(held.max())
        if width + 1 > lists.shape[1]:
            lists = np.concatenate([lists, np.zeros_like(lists)], axis=1)
        rows, places = np.arange(live), np.arange(width + 1)
        now = lists[:live, :width]
        stale = ~(times[at][:, None] - times[now] <= horizon) & (places[:-1] < held[:, None])
        # Length of each list's newest suffix: entries after its last stale one.
        end = np.where(stale.any(axis=1), width - np.argmax(stale[:, ::-1], axis=1), 0) if width else np.zeros(live, np.int64)
        kept = held - end
        some = np.flatnonzero(kept)
        base[at[some]] = now[some, end[some]]
        if width:
            turned = np.take_along_axis(now, np.clip(held[:, None] - 1 - places, 0, width - 1), axis=1)
        else:
            turned = np.zeros((live, 1), dtype=np.int64)
        turned[rows, kept] = at
        lists[:live, :width + 1] = turned
        size[:live] = kept + 1
        step += 1
    out: list = [None] * len(runs)
    for k, r in enumerate(runs):
        order = lists[k, :size[k]]
        if count[k] > step:
            stop = first[k] + count[k]
            base[first[k] + step:stop], order = fold_positions(times[:stop], first[k] + step, order, horizon)
        out[r] = order
    return base, out


class EventList:
    """A device's list state: parallel arrays seq (int64), x, y, t (float64), in stored order."""

    __slots__ = ("seq", "x", "y", "t")

    def __init__(self, seq=(), x=(), y=(), t=()):
        self.seq = np.asarray(seq, dtype=np.int64)
        self.x, self.y, self.t = (np.asarray(v, dtype=np.float64) for v in (x, y, t))

    def plus(self, other: EventList) -> EventList:
        return EventList(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in self.__slots__))

    def take(self, at: np.ndarray) -> EventList:
        return EventList(self.seq[at], self.x[at], self.y[at], self.t[at])

    def text(self) -> str:
        """An event is identified by its seq within a device, so the seq list is the state."""
        return ",".join(map(str, self.seq.tolist()))


def fold_events(state: EventList, events: EventList, horizon: float = HORIZON_S, min_gap: float = MIN_GAP_S,
                metres_per_degree: float = METRES_PER_DEGREE):
    """Fold a device's next events into its list state.

    Returns (which events emit, their baseline seq, dt, speed, new state).
    """
    every = state.plus(events)
    n = len(state.seq)
    base, order = fold_positions(every.t, n, np.arange(n), horizon)
    dt = events.t - every.t[base]
    emits = np.flatnonzero((base >= 0) & (dt >= min_gap))
    b, dt = base[emits], dt[emits]
    dx, dy = events.x[emits] - every.x[b], events.y[emits] - every.y[b]
    return emits, every.seq[b], dt, np.sqrt(dx * dx + dy * dy) * metres_per_degree / dt, every.take(order)


def _fold_partitions(horizon: float, min_gap: float, metres_per_degree: float, schema: pa.Schema, carry=()):
    """Fold partitions sorted by (id, _seg, _chunk, _seedpos, seq).

    Rows with ``_seedpos`` set are a given start state (in that order);
    ``_warm`` rows only build up state (no output). For every group with own
    rows one info row (``_kind = 1``) reports the state before its first own
    row (``_start``) and after its last (``_end``), emitted once the group is
    complete (groups may span Arrow batches); speed rows have ``_kind = 0``.
    Speed and info rows go out in batches of their own, so no column changes its type. The groups of an Arrow
    batch are folded side by side (``fold_lock_step``).
    """
    def typed(n: int, **cols) -> pa.RecordBatch:
        arrays = [cols[f.name].cast(f.type) if f.name in cols else pa.nulls(n, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def info(done: list) -> pa.RecordBatch:
        ids, segs, chunks, starts, ends = zip(*done)
        return typed(len(done), id=pa.array(ids, pa.int32()), _seg=pa.array(segs, pa.int64()), _chunk=pa.array(chunks, pa.int64()),
                     _kind=pa.array([1] * len(done), pa.int32()), _start=pa.array(starts, pa.string()), _end=pa.array(ends, pa.string()))

    def fold(states: list[EventList], parts: list[EventList]):
        """Fold each part into its state, all side by side; returns the joined events, baselines and new states."""
        both = [st.plus(p) for st, p in zip(states, parts)]
        every = EventList(*(np.concatenate([getattr(e, f) for e in both]) for f in EventList.__slots__))
        old, new = (np.array([len(e.seq) for e in side], dtype=np.int64) for side in (states, parts))
        begin = np.cumsum(old + new) - old - new
        lists = [np.arange(b, b + n) for b, n in zip(begin, old)]
        base, orders = fold_lock_step(every.t, begin + old, new, lists, horizon)
        own = np.concatenate([np.arange(b, b + n) for b, n in zip(begin + old, new)])
        return every, base, own, [every.take(o) for o in orders]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the group that may go on in the next batch: key, state, state before its first own row
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            # Rows of one group and role (given state, warm-up, own) are folded together.
            role = np.where(col["_seedpos"].is_valid().to_numpy(False), 0, np.where(col["_warm"].to_numpy(False), 1, 2))
            parts = [col["id"].is_valid().to_numpy(False), col["id"].fill_null(0).to_numpy(),
                     col["_seg"].to_numpy(), col["_chunk"].to_numpy(), role]
            change = np.zeros(batch.num_rows, dtype=bool)
            for p in parts:
                change[1:] |= p[1:] != p[:-1]
            bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            events = EventList(col["seq"].to_numpy(), *(col[c].to_numpy(False) for c in ("x", "y", "timestamp")))
            groups, todo = [], ([], [], [])
            if last is not None:
                groups.append(list(last))
            ids = col["id"].take(pa.array(bounds[:-1])).to_pylist()
            for lo, hi, device in zip(bounds, bounds[1:], ids):
                at = (device, int(parts[2][lo]), int(parts[3][lo]))
                if not groups or groups[-1][0] != at:
                    groups.append([at, EventList(), None])
                todo[role[lo]].append((len(groups) - 1, lo, hi))
            for g, lo, hi in todo[0]:
                groups[g][1] = groups[g][1].plus(events.take(np.arange(lo, hi)))
            if todo[1]:
                folded = fold([groups[g][1] for g, _, _ in todo[1]], [events.take(np.arange(lo, hi)) for _, lo, hi in todo[1]])
                for (g, _, _), after in zip(todo[1], folded[3]):
                    groups[g][1] = after
            if todo[2]:
                for g, _, _ in todo[2]:
                    if groups[g][2] is None:
                        groups[g][2] = groups[g][1].text()
                every, base, own, after = fold([groups[g][1] for g, _, _ in todo[2]],
                                               [events.take(np.arange(lo, hi)) for _, lo, hi in todo[2]])
                for (g, _, _), new in zip(todo[2], after):
                    groups[g][1] = new
                b = base[own]
                dt = every.t[own] - every.t[b]
                emits = (b >= 0) & (dt >= min_gap)
                sel = pa.array(np.concatenate([np.arange(lo, hi) for _, lo, hi in todo[2]])[emits])
                own, b, dt = own[emits], b[emits], dt[emits]
                dx, dy = every.x[own] - every.x[b], every.y[own] - every.y[b]
                n = len(sel)
                if n:
                    passed = {c: col[c].take(sel) for c in ("seq", "id", "x", "y", "timestamp", "_seg", "_chunk", *carry)}
                    yield typed(n, baseline_seq=pa.array(every.seq[b]), dt=pa.array(dt),
                                inst_speed=pa.array(np.sqrt(dx * dx + dy * dy) * metres_per_degree / dt),
                                _kind=pa.array([0] * n, pa.int32()), **passed)
            last = groups[-1]
            done = [(*at, start, state.text()) for at, state, start in groups[:-1] if start is not None]
            if done:
                yield info(done)
        if last is not None and last[2] is not None:
            yield info([(*last[0], last[2], last[1].text())])
    return run


def with_segments(on_time: DataFrame, horizon: float = HORIZON_S, span: float = DEFAULT_SPAN_S,
                  key: str = "id", bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Add ``_seg`` = seq of the first event of the run this event belongs to.

    A run restarts at a device's first event and after every silence longer
    than ``horizon``; the W2 state is empty at each restart, so runs fold
    independently.
    """
    d = _with_span_context(on_time, horizon, span)
    w = Window.partitionBy(key, "_span").orderBy("seq")
    prev_t = F.lag("timestamp").over(w)
    starts = (d.withColumn("_gap", F.col("timestamp") - prev_t)
              .filter("_home").drop("_home", "_span"))
    starts = starts.withColumn(
        "_start", F.when(F.col("_gap").isNull() | (F.col("_gap") > F.lit(horizon)), F.col("seq")))
    # The run id is the latest start at or before the row: a per-device prefix max.
    seg = running_max_before(starts.withColumn("_s", F.col("_start")), "_s", "seq", "_prev_start",
                             keys=[key], bucket_rows=bucket_rows)
    return seg.withColumn("_seg", F.coalesce("_start", "_prev_start")).drop(
        "_gap", "_start", "_s", "_prev_start")


DEFAULT_CHUNK_ROWS = 50_000
DEFAULT_WARMUP_ROWS = 2_048


def _fold(rows: DataFrame, horizon, min_gap, metres_per_degree, carry, schema, num_partitions):
    from wakeline.session import ship_package

    ship_package(rows.sparkSession)
    parts = [num_partitions] if num_partitions else []
    if "_seedpos" not in rows.columns:
        rows = rows.withColumn("_seedpos", F.lit(None).cast("int"))
    ordered = (rows.repartition(*parts, "id", "_seg", "_chunk")
               .sortWithinPartitions("id", "_seg", "_chunk", F.col("_seedpos").asc_nulls_last(), "seq"))
    return ordered.mapInArrow(_fold_partitions(horizon, min_gap, metres_per_degree, to_arrow_schema(schema), carry), schema)


def inst_speed_stateful(on_time: DataFrame, horizon: float = HORIZON_S, min_gap: float = MIN_GAP_S,
                        metres_per_degree: float = METRES_PER_DEGREE, span: float = DEFAULT_SPAN_S,
                        num_partitions: int | None = None, carry=(),
                        chunk_rows: int = DEFAULT_CHUNK_ROWS, warmup_rows: int = DEFAULT_WARMUP_ROWS) -> DataFrame:
    """The coded speed rule, exactly, as a batch plan.

    Runs (see ``with_segments``) fold independently. A run longer than
    ``chunk_rows`` is cut into chunks folded in parallel: each chunk first
    replays the previous chunk's last ``warmup_rows`` events from an empty
    state (the fold forgets its history within a few horizons), then its own
    events. Every chunk's state after the warm-up is checked against the
    previous chunk's final state; by induction from the run start (empty
    state, exact) all chunks of a run whose checks pass are exact. A chunk
    whose check fails is folded again alone, seeded with the previous chunk's
    final state, and kept if it ends in its first-pass final state (the one
    the next chunk was checked against); only a run where that also fails is
    folded again sequentially. ``carry`` names extra input columns passed
    through to the emitted rows.
    """
    carry = list(carry)
    if not 0 <= warmup_rows <= chunk_rows:
        raise ValueError("need 0 <= warmup_rows <= chunk_rows")
    seg = with_segments(on_time.select("seq", "id", "x", "y", "timestamp", *carry), horizon, span)
    schema = T.StructType(SPEED_SCHEMA.fields + [
        T.StructField("_seg", T.LongType()), T.StructField("_chunk", T.LongType()),
        T.StructField("_kind", T.IntegerType()), T.StructField("_start", T.StringType()),
        T.StructField("_end", T.StringType())] + [on_time.schema[c] for c in carry])
    out = _chunked_fold(seg, horizon, min_gap, metres_per_degree, carry, schema, num_partitions,
                        chunk_rows, warmup_rows)["out"]
    return out.withColumn("inst_speed", F.col("inst_speed").cast("float").cast("double"))


def _chunked_fold(seg: DataFrame, horizon, min_gap, metres_per_degree, carry, schema, num_partitions,
                  chunk_rows: int, warmup_rows: int) -> dict:
    """The chunked plan of ``inst_speed_stateful``; returns ``out`` and the check tables."""
    from wakeline.operators.prefix import global_row_number
    from wakeline.session import materialize

    out_cols = [*SPEED_COLUMNS, *carry]
    ranked = global_row_number(seg, "seq", "_r", keys=["id", "_seg"])
    pos = F.col("_r") - 1
    chunk = F.expr(f"(_r - 1) div {int(chunk_rows)}")
    own = ranked.withColumn("_chunk", chunk).withColumn("_warm", F.lit(False))
    # A row near its chunk's end also warms up the next chunk; one pass makes both copies.
    warms = F.when(pos % F.lit(chunk_rows) >= F.lit(chunk_rows - warmup_rows),
                   F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    copies = ranked.withColumn("_warm", F.explode(warms)).withColumn("_chunk", chunk + F.col("_warm").cast("long"))
    folded = materialize(_fold(copies.drop("_r"), horizon, min_gap, metres_per_degree,
                               carry, schema, num_partitions))
    info = folded.filter(F.col("_kind") == 1).select("id", "_seg", "_chunk", "_start", "_end")
    prev = info.select("id", "_seg", (F.col("_chunk") + 1).alias("_chunk"), F.col("_end").alias("_prev_end"))
    checked = info.filter(F.col("_chunk") > 0).join(prev, ["id", "_seg", "_chunk"], "left")
    failed = checked.filter(F.col("_prev_end").isNull() | (F.col("_prev_end") != F.col("_start")))
    if failed.isEmpty():
        # Every chunk is exact: there is nothing to fold again.
        return {"out": folded.filter(F.col("_kind") == 0).select(*out_cols), "failed": failed,
                "redo_ok": failed.select("id", "_seg", "_chunk"), "bad_runs": failed.select("id", "_seg")}
    # A failed check means only that chunk started from a wrong state (the
    # previous chunk's end is exact by induction). Fold it again from that
    # end state; accept it if it ends where the first pass ended (the state
    # the next chunk was checked against), else fold the whole run again.
    redo_keys = failed.filter(F.col("_prev_end").isNotNull()).select(
        "id", "_seg", "_chunk", "_prev_end", F.col("_end").alias("_old_end"))
    seeds = (redo_keys.select("id", "_seg", "_chunk",
                              F.posexplode(F.split("_prev_end", ",")).alias("_seedpos", "_sseq"))
             .filter(F.col("_sseq") != "")
             .withColumn("seq", F.col("_sseq").cast("long")).drop("_sseq"))
    seed_rows = seg.join(seeds, ["id", "_seg", "seq"], "inner").withColumn("_warm", F.lit(False))
    own_redo = (own.join(redo_keys.select("id", "_seg", "_chunk"), ["id", "_seg", "_chunk"], "left_semi")
                .drop("_r").withColumn("_seedpos", F.lit(None).cast("int")))
    refold = materialize(_fold(own_redo.unionByName(seed_rows), horizon, min_gap, metres_per_degree,
                               carry, schema, num_partitions))
    re_info = (refold.filter(F.col("_kind") == 1).select("id", "_seg", "_chunk", F.col("_end").alias("_new_end"))
               .join(redo_keys, ["id", "_seg", "_chunk"]))
    redo_ok = re_info.filter(F.col("_new_end") == F.col("_old_end")).select("id", "_seg", "_chunk")
    bad_runs = (failed.select("id", "_seg", "_chunk").join(redo_ok, ["id", "_seg", "_chunk"], "left_anti")
                .select("id", "_seg").distinct())
    first = (folded.filter(F.col("_kind") == 0)
             .join(failed.select("id", "_seg", "_chunk"), ["id", "_seg", "_chunk"], "left_anti"))
    second = refold.filter(F.col("_kind") == 0).join(redo_ok, ["id", "_seg", "_chunk"], "left_semi")
    kept = first.unionByName(second).join(bad_runs, ["id", "_seg"], "left_anti").select(*out_cols)
    redo_rows = (seg.join(bad_runs, ["id", "_seg"], "left_semi")
                 .withColumn("_chunk", F.lit(0).cast("long")).withColumn("_warm", F.lit(False)))
    redo = _fold(redo_rows, horizon, min_gap, metres_per_degree, carry, schema, num_partitions)
    out = kept.unionByName(redo.filter(F.col("_kind") == 0).select(*out_cols))
    return {"out": out, "failed": failed, "redo_ok": redo_ok, "bad_runs": bad_runs}
