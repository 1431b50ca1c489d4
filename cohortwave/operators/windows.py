"""Window operators over runs, all built on the sliced scans."""

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortwave.functions.ordered import Cuts, Slicing, asof_join, clamped_cumsum, numbered, rolling_mean, running, slice_id
from cohortwave.functions.sorted_batches import groups, packed, repeat_keys
from cohortwave.schema import BLOCK, NEAR_MISS_SEC, ROLLING_SEC, RUN


def clamped_score(trials: DataFrame, order: Sequence[str], keys: Sequence[str] = RUN, width: Slicing = None, correct: str = "correct", silent: str | None = "silent") -> DataFrame:
    """Running score: +1 correct, -1 genuine miss, never below 0; silently cleared drops change nothing."""
    d = F.when(F.col(correct), 1).otherwise(-1)
    if silent:
        d = F.when(F.coalesce(F.col(silent), F.lit(False)), 0).otherwise(d)
    return clamped_cumsum(trials, keys, order, d.cast("bigint"), "score", width)


def rolling_collision_rate(outcomes: DataFrame, t_ms: str = "resolve_ms", keys: Sequence[str] = RUN, sec: float = ROLLING_SEC, width_ms: Slicing = None) -> DataFrame:
    """Share of collisions among outcomes of the last `sec` seconds, not reset between tiers.

    Rows with a null outcome (ticks, say) only read the rate."""
    hit = F.when(F.col("outcome").isNotNull(), (F.col("outcome") == "collision").cast("int"))
    return rolling_mean(outcomes, keys, t_ms, sec * 1000, hit, "rolling_collision_rate", width_ms)


def rolling_avg_rt(changes: DataFrame, t_ms: str = "client_ms", keys: Sequence[str] = RUN, sec: float = ROLLING_SEC, width_ms: Slicing = None) -> DataFrame:
    """Mean reaction time of forced lane changes, blocked ones too, in the same window."""
    return rolling_mean(changes, keys, t_ms, sec * 1000, F.when(F.col("forced"), F.col("reaction_time_ms")), "rolling_avg_reaction_time_ms", width_ms)


def time_since_last(ev: DataFrame, flag: Column, out: str, t: str, order: Sequence[str], keys: Sequence[str] = RUN, width: Slicing = None) -> DataFrame:
    """Time since the last flagged row, 0 at the row itself, null before the first."""
    r = running(ev, keys, order, {"__at": ("last", F.when(flag, F.col(t)))}, width)
    return r.withColumn(out, F.col(t) - F.col("__at")).drop("__at")


def camp_exposure(spawns: DataFrame, changes: DataFrame, starts: DataFrame, grace: float, ramp: float, peak: float = 1.0, keys: Sequence[str] = RUN, t: str = "t", width: Slicing = None) -> DataFrame:
    """Time in lane at each spawn and the nudge probability that follows from it.

    Time counts from the last unblocked lane change, else from the run's first tier (`starts`).
    """
    moved = changes.where(~F.col("blocked")).select(*keys, F.col(t).alias("__since"))
    since = starts.groupBy(*keys).agg(F.min("t0").alias("__since")).unionByName(moved)
    out = asof_join(spawns, since, keys, t, "__since", ["__since"], width).withColumn("time_in_lane_sec", F.col(t) - F.col("__since"))
    over = F.col("time_in_lane_sec") - F.lit(grace)
    frac = F.least(F.lit(1.0), over / F.lit(ramp)) if ramp > 0 else F.lit(1.0)
    p = F.lit(0.0) if not grace and not ramp else F.when(over <= 0, 0.0).otherwise(frac * F.lit(peak))
    return out.withColumn("nudge_probability", F.when(F.col("time_in_lane_sec").isNotNull(), p)).drop("__since")


def inter_click_time(clicks: DataFrame, order: Sequence[str], keys: Sequence[str] = BLOCK, rt: str = "rt_sec", width: Slicing = None) -> DataFrame:
    """Search time per target: difference of cumulative times between correct clicks."""
    r = running(clicks.where("correct"), keys, order, {"__prev": ("last", F.col(rt))}, width, inclusive=False)
    return r.withColumn("search_sec", F.col(rt) - F.coalesce("__prev", F.lit(0.0))).drop("__prev")


def live_state(ticks: DataFrame, obstacles: DataFrame, changes: DataFrame, lanes: int, keys: Sequence[str] = RUN, width_ms: Slicing = None) -> DataFrame:
    """Hazards live at each tick: their number, blocked lanes, nearest arrival, and the same in the own lane.

    A hazard is live on [spawn, resolve). The own lane is the last unblocked target lane, at first
    the middle one. `ticks` need `tick_id` and `t_ms`. Hazards go to every slice they reach into;
    Spark sorts each slice by time and a task walks it once with a heap of arrivals per lane, so
    no tick-hazard pairs are formed.
    """
    keys = list(keys)
    moved = changes.where(~F.col("blocked")).select(*keys, F.col("client_ms").alias("__m"), F.col("to_lane").cast("int").alias("own_lane"))
    width_ms = Cuts(ticks, "t_ms") if width_ms is None else width_ms  # one slicing for all frames
    t = asof_join(ticks, moved, keys, "t_ms", "__m", ["own_lane"], width_ms).select(
        *keys, slice_id("t_ms", width_ms).alias("__s"), F.col("t_ms").cast("double").alias("__at"), F.lit(2).alias("__k"), F.col("tick_id").cast("bigint").alias("tick_id"),
        F.coalesce("own_lane", F.lit(lanes // 2)).alias("own_lane"),
    )
    reach = F.sequence(slice_id("spawn_ms", width_ms), slice_id(F.greatest("spawn_ms", "resolve_ms"), width_ms))
    o = obstacles.select(
        *keys, F.explode(reach).alias("__s"), F.col("spawn_ms").cast("double").alias("__at"), F.lit(1).alias("__k"), F.col("resolve_ms").cast("double").alias("resolve"),
        F.col("lane").cast("int").alias("lane"), (F.col("spawn_ms") + F.col("fall_sec") * 1000).cast("double").alias("due"),
    )
    line = t.unionByName(o, allowMissingColumns=True)
    fields, part = {f.name: f for f in line.schema.fields}, [*keys, "__s"]
    out = T.StructType(
        [*[fields[k] for k in keys], fields["tick_id"], T.StructField("t_ms", T.DoubleType()), fields["own_lane"], T.StructField("active_obstacle_count", T.LongType()),
         T.StructField("blocked_lane_count", T.LongType()), T.StructField("nearest_time_to_collision_ms", T.DoubleType()), T.StructField("own_lane_time_to_collision_ms", T.DoubleType())]
    )

    def walk(tbl: pa.Table) -> pa.Table:
        cols = [tbl.column(c).to_pylist() for c in ("__at", "__k", "resolve", "lane", "due", "tick_id", "own_lane")]
        ends, due, count, rows = [], {}, {}, []
        for at, k, resolve, lane, arrives, tick, own in zip(*cols):
            if k == 1:
                heapq.heappush(ends, (resolve, lane))
                heapq.heappush(due.setdefault(lane, []), (arrives, resolve))
                count[lane] = count.get(lane, 0) + 1
                continue
            while ends and ends[0][0] <= at:
                count[heapq.heappop(ends)[1]] -= 1
            near = {}
            for lane, heap in due.items():
                while heap and heap[0][1] <= at:  # already resolved
                    heapq.heappop(heap)
                if heap:
                    near[lane] = heap[0][0] - at
            rows.append((tick, at, own, sum(count.values()), sum(c > 0 for c in count.values()), min(near.values(), default=None), near.get(own)))
        found = [pa.array(c, f) for c, f in zip(zip(*rows) if rows else [[]] * 7, (pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
        return pa.Table.from_arrays([*repeat_keys(tbl, keys, len(rows)), *found], names=out.names)

    batches = line.repartition(*part).sortWithinPartitions(*part, "__at", "__k")
    return batches.mapInArrow(lambda it: packed(walk(g) for g in groups(it, part)), out)


def near_miss_class(answered: DataFrame, window: float = NEAR_MISS_SEC) -> DataFrame:
    """Margin of the last response, near miss and no response, recomputed from J6."""
    hit, did = F.col("outcome") == "collision", F.col("response_ms").isNotNull()
    margin = (F.col("fall_sec") * 1000 - (F.col("response_ms") - F.col("spawn_ms"))) / 1000
    return answered.withColumns(
        {
            "margin_recomputed": margin,
            "near_miss_recomputed": F.coalesce(~hit & (margin <= window), F.lit(False)),
            "no_response_recomputed": hit & ~did,
        }
    )


def record_history(scores: DataFrame, order: Sequence[str], score: str = "score", keys: Sequence[str] = (), width: Slicing = None) -> DataFrame:
    """Sessions that set a new best, in time order. `scores` has one row per session."""
    r = running(scores, keys, order, {"__best": ("max", F.col(score))}, width, inclusive=False)
    return r.where(F.col("__best").isNull() | (F.col(score) > F.col("__best"))).withColumnRenamed("__best", "previous_best")


def vigilance_trend(trials: DataFrame, order: Sequence[str], keys: Sequence[str] = BLOCK, rt: str = "rt_sec", width: Slicing = None) -> DataFrame:
    """Per third of a block: mean reaction time and error rate, and their slopes over trial order."""
    n = numbered(trials, keys, order, "pos", width=width)
    size = trials.groupBy(*keys).agg(F.count("*").alias("n_trials"))
    third = chunk_of(F.col("pos") - 1, F.col("n_trials"), 3)
    rows = n.join(size, list(keys)).withColumns({"third": third, "err": (~F.col("correct")).cast("double"), "x": F.col("pos").cast("double")})
    mean = lambda c, k: F.avg(F.when(F.col("third") == k, F.col(c)))
    return rows.groupBy(*keys).agg(
        *[mean(rt, k).alias(f"rt_third_{k + 1}") for k in range(3)],
        *[mean("err", k).alias(f"err_third_{k + 1}") for k in range(3)],
        F.regr_slope(rt, "x").alias("rt_slope"),
        F.regr_slope("err", "x").alias("err_slope"),
    )


def chunk_of(i: Column, n: Column, k: int) -> Column:
    """0-based chunk of the 0-based row `i` of `n` when the first `n mod k` chunks are one larger."""
    base, extra = F.floor(n / k), n % k
    head = extra * (base + 1)
    return F.when(i < head, F.floor(i / (base + 1))).otherwise(extra + F.floor((i - head) / F.greatest(base, F.lit(1)))).cast("int")


def gauge_gap_check(events: DataFrame, timeout_sec: float, gauge: Sequence[str] = ("gauge",), t: str = "t_sec", width: Slicing = None, order: Sequence[str] | None = None) -> DataFrame:
    """Triggers that came before the gauge's previous alert had timed out."""
    r = running(events, gauge, order or [t], {"__prev": ("last", F.col(t))}, width, inclusive=False)
    return r.withColumn("gap_sec", F.col(t) - F.col("__prev")).drop("__prev").where(F.col("gap_sec") < timeout_sec)


def activity_stretches(ev: DataFrame, keys: Sequence[str], order: Sequence[str], gap: float, t: str = "t", width: Slicing = None) -> DataFrame:
    """Stretches of activity that a silence of `gap` or more ends (batch form of the session window)."""
    slim = ev.select(*keys, *dict.fromkeys([*order, t]))
    seen = running(slim, keys, order, {"__prev": ("last", F.col(t))}, width, inclusive=False)
    fresh = F.when(F.col("__prev").isNull() | (F.col(t) - F.col("__prev") >= gap), 1)
    return running(seen, keys, order, {"stretch": ("count", fresh)}, width).groupBy(*keys, "stretch").agg(
        F.min(t).alias("start_t"), F.max(t).alias("last_t"), F.count("*").alias("n")
    )
