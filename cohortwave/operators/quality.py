"""Quality flags."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortwave.functions.ordered import Cuts, Slicing, exact_median, join_per_key, running, slices
from cohortwave.functions.sorted_batches import groups, packed, repeat_keys
from cohortwave.operators.joins import mask_invalid, pair_events
from cohortwave.schema import BLOCK, HOST, MONO, ORDER, RUN, TRIAL


def focus_loss_intervals(ev: DataFrame, keys: Sequence[str] = RUN, width: Slicing = None) -> DataFrame:
    """Q1: from focus lost to the next regained; an open span ends with the run."""
    return pair_events(ev, "focus_lost", "focus_regained", keys, width=width, run_keys=keys)


def frame_drop_flags(trials: DataFrame, drops: DataFrame, pad: float, keys: Sequence[str] = RUN, t: str = "t", width: Slicing = None) -> DataFrame:
    """Q2: trials with a frame drop inside `[t0 - pad, t1 + pad]`."""
    return mask_invalid(trials, drops.select(*keys, F.col(t).alias("t0"), F.col(t).alias("t1")), keys, pad, width=width)


def debounce(events: DataFrame, keys: Sequence[str], t: str, min_gap: float, *, qualifies: Column | None = None, tie: str = "event_seq", width: Slicing = None) -> DataFrame:
    """Q3: keep a qualifying event only if more than `min_gap` after the last kept one.

    The rule is sequential, but a slice of time acts on the last kept time as a step function with
    few steps (chains from different starts soon meet). Keys with more than a task's share of the rows are cut (see `Cuts`); their
    slices compute theirs in parallel, the small step tables are chained per key, and each slice then replays from its true
    start. All other keys are walked whole, in one pass. Spark partitions and sorts; the tasks only walk sorted arrays. Returns
    keys, `t` and `tie` of the kept events.
    """
    keys = list(keys)
    q = events if qualifies is None else events.where(qualifies)
    rows = q.select(*keys, slices(q, keys, [t], width).alias("__s"), F.col(t).cast("double").alias("__t"), F.col(tie).cast("bigint").alias("__tie"))
    fields = {f.name: f for f in rows.schema.fields}
    part = [*keys, "__s"]
    step_schema = T.StructType([*[fields[k] for k in part], T.StructField("first", T.DoubleType()), T.StructField("kept", T.DoubleType())])
    start_schema = T.StructType([*[fields[k] for k in part], T.StructField("start", T.DoubleType())])
    out_schema = T.StructType([*[fields[k] for k in keys], fields["__t"], fields["__tie"]])

    def slice_steps(tbl: pa.Table) -> pa.Table:
        ts = np.unique(tbl.column("__t").to_numpy())
        nxt = np.searchsorted(ts, ts + min_gap, side="right").tolist()  # first event more than min_gap away
        last = list(range(len(ts)))
        for i in range(len(ts) - 1, -1, -1):
            if nxt[i] < len(ts):
                last[i] = last[nxt[i]]
        # the last one kept before came no later than the first event here, so up to min_gap after that, or next, is the first to keep
        reach = min(int(np.searchsorted(ts, ts[0] + min_gap, side="right")), len(ts) - 1)
        firsts, kept = ts[: reach + 1], ts[last[: reach + 1]]
        new = np.append(kept[1:] != kept[:-1], True)  # one step per distinct result, at its highest entry
        return pa.Table.from_arrays([*repeat_keys(tbl, part, int(new.sum())), pa.array(firsts[new]), pa.array(kept[new])], names=step_schema.names)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def starts() -> Iterator[pa.Table]:
            who, state = None, -np.inf
            for g in groups(batches, part):
                key = [g.column(k)[0].as_py() for k in keys]
                if key != who:
                    who, state = key, -np.inf
                yield pa.Table.from_arrays([*repeat_keys(g, part, 1), pa.array([state], pa.float64())], names=start_schema.names)
                i = int(np.searchsorted(g.column("first").to_numpy(), state + min_gap, side="right"))
                if i < g.num_rows:
                    state = g.column("kept")[i].as_py()

        yield from packed(starts())

    def slice_kept(tbl: pa.Table) -> pa.Table:
        start = tbl.column("start")[0].as_py()
        lead, start = (0, -np.inf) if start is None else (1, start)  # a key that is not cut has no start row
        ts = tbl.column("__t").slice(lead).to_numpy()
        nxt, keep = np.searchsorted(ts, ts + min_gap, side="right").tolist(), []
        i = int(np.searchsorted(ts, start + min_gap, side="right"))
        while i < len(ts):
            keep.append(i + lead)
            i = nxt[i]
        return tbl.take(pa.array(keep, pa.int64())).select(out_schema.names)

    steps = lambda batches: packed(slice_steps(g) for g in groups(batches, part))
    replay = lambda batches: packed(slice_kept(g) for g in groups(batches, part))
    table = rows.where("__s IS NOT NULL").repartition(*part).sortWithinPartitions(*part, "__t").mapInArrow(steps, step_schema)
    starts = table.repartition(*keys).sortWithinPartitions(*part, "first").mapInArrow(chain, start_schema)
    line = rows.unionByName(starts, allowMissingColumns=True)  # the start row has no time, so it sorts first
    kept = line.repartition(*part).sortWithinPartitions(*part, "__t", "__tie").mapInArrow(replay, out_schema)
    return kept.select(*keys, F.col("__t").alias(t), F.col("__tie").alias(tie))


def enabled_devices(manifests: DataFrame) -> DataFrame:
    """Q4: device roles a session's configuration switches on."""
    m = manifests.select("session_id", F.explode(F.try_variant_get("config_snapshot", F.lit("$.devices"), "map<string,variant>")).alias("device_role", "d"))
    return m.where(F.try_variant_get("d", F.lit("$.enabled"), "boolean")).select("session_id", "device_role")


def unaligned_devices(expected: DataFrame, sync: DataFrame, keys: Sequence[str] = ("session_id", "device_role")) -> DataFrame:
    """Q4: expected devices without a good sync record; their samples must not be labelled."""
    return expected.join(sync.where("result = 'ok'").select(*keys), list(keys), "left_anti")


def ambiguous_devices(sync: DataFrame, session: str = "session_id", role: str = "device_role", device: str = "device_id") -> DataFrame:
    """Q5: a device used for two roles, or a role served by two devices, within one session."""
    pairs = sync.select(session, role, device).distinct()
    a = pairs.groupBy(session, F.col(device).alias("subject")).agg(F.count("*").alias("n")).withColumn("problem", F.lit("device_with_roles"))
    b = pairs.groupBy(session, F.col(role).alias("subject")).agg(F.count("*").alias("n")).withColumn("problem", F.lit("role_with_devices"))
    return a.unionByName(b).where("n > 1")


def ack_echo_delta(sync: DataFrame, detail: str = "detail", sent: str = "sync_time_host_utc") -> DataFrame:
    """Q6: time a device echoed minus the time that was sent."""
    echo = F.regexp_extract(detail, r"device echoed (-?\d+(?:\.\d+)?)", 1).try_cast("double")
    return sync.withColumn("echo_delta_sec", echo - F.col(sent))


def single_lane_double(obstacles: DataFrame, block: Sequence[str] = BLOCK) -> DataFrame:
    """Q7: hazards of one wave in the same lane, which look like one and score as several."""
    return obstacles.groupBy(*block, "wave", "lane").agg(F.count("*").alias("n")).where("n > 1")


def safe_lane_invariant(obstacles: DataFrame, n_lanes: int, keys: Sequence[str] = RUN, width_ms: Slicing = None) -> DataFrame:
    """Q8: spawns after which every lane held a live hazard (the new one included).

    A hazard adds to its lane at the spawn and is taken off at the resolution; running counts per
    lane then tell how many lanes are blocked, without pairing hazards.
    """
    leave = F.struct(F.col("resolve_ms").alias("at"), F.lit(0).alias("k"), F.lit(-1).alias("d"))
    enter = F.struct(F.col("spawn_ms").alias("at"), F.lit(1).alias("k"), F.lit(1).alias("d"))
    read = F.struct(F.col("spawn_ms").alias("at"), F.lit(2).alias("k"), F.lit(0).alias("d"))
    cols = list(dict.fromkeys([*keys, *TRIAL, "lanes", "lane", "spawn_ms"]))
    line = obstacles.select(*cols, F.explode(F.array(leave, enter, read)).alias("e")).select(*cols, F.col("e.at").alias("__at"), F.col("e.k").alias("__k"), F.col("e.d").alias("__d"))
    per_lane = {f"__lane_{i}": ("sum", F.when(F.col("lane") == i, F.col("__d"))) for i in range(n_lanes)}
    live = running(line, keys, ["__at", "__k"], per_lane, width_ms).where("__k = 2")
    blocked = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in per_lane), F.lit(0))
    return live.select(*[c for c in cols if c != "lane"], blocked.alias("blocked")).where("blocked >= lanes")


def unit_outliers(meta: DataFrame, col: str, keys: Sequence[str], width: Slicing = None, ratio: float = 0.1) -> DataFrame:
    """Q9: rows whose score is below `ratio` times the group's median, so likely in another unit."""
    cuts = width if isinstance(width, Cuts) else Cuts(meta, col)
    med = exact_median(meta, keys, col, "group_median", cuts if width is None else width)
    return join_per_key(meta, med, keys, cuts).where(F.col(col) < F.col("group_median") * ratio)


def range_check(rows: DataFrame, value: str, low: str | Column, high: str | Column) -> DataFrame:
    """Q10: ratings outside their scale."""
    lo, hi = (F.col(c) if isinstance(c, str) else c for c in (low, high))
    return rows.where(F.col(value).isNotNull() & ((F.col(value) < lo) | (F.col(value) > hi)))


def option_check(answers: DataFrame, rules: DataFrame, keys: Sequence[str] = ("session_id", "item_id"), value: str = "value") -> DataFrame:
    """Q10: choices that are not in the item's option list."""
    r = rules.where("options IS NOT NULL").select(*keys, "options")
    return answers.join(r, list(keys)).where(~F.array_contains("options", F.col(value)))


def orphans(starts: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q11: starts without an end and ends without a start."""
    s, e = starts.select(*keys), ends.select(*keys)
    return s.join(e, list(keys), "left_anti").withColumn("problem", F.lit("no_end")).unionByName(e.join(s, list(keys), "left_anti").withColumn("problem", F.lit("no_start")))


def incomplete_rows(ev: DataFrame) -> DataFrame:
    """Q11: rows without the fields every event must carry."""
    return ev.where(F.col(HOST).isNull() | F.col(MONO).isNull() | F.col("session_id").isNull() | F.col("event_type").isNull())


def clock_step(ev: DataFrame, keys: Sequence[str] = ("session_id",), order: Sequence[str] = ORDER, host: str = HOST, mono: str = MONO, tolerance: float = 0.05, width: Slicing = None) -> DataFrame:
    """Q12: gap to the previous event on both clocks; `jump` is how far the wall clock moved against the monotonic one."""
    r = running(ev, keys, order, {"__prev": ("last", F.struct(F.col(host).alias("h"), F.col(mono).alias("m")))}, width, inclusive=False)
    gap_m, gap_h = F.col(mono) - F.col("__prev.m"), F.col(host) - F.col("__prev.h")
    return r.withColumns({"gap_sec": gap_m, "jump_sec": gap_h - gap_m, "stepped": F.coalesce(F.abs(gap_h - gap_m) > tolerance, F.lit(False))}).drop("__prev")


def longest_gap(stepped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q12: longest silence per phase."""
    return stepped.groupBy(*keys).agg(F.max("gap_sec").alias("longest_gap_sec"), F.count_if("stepped").alias("steps"))
