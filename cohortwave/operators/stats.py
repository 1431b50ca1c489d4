"""Aggregations: block and session statistics, audits, clock fits, window features.

All of them are plain grouped aggregates, so Spark combines partially before it shuffles.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.functions.ordered import Slicing, exact_median
from cohortwave.functions.scalars import clock_key
from cohortwave.schema import BLOCK, DURATION_TOLERANCE_SEC, HOST, MIN_HEIGHT, MONO, RUN, field


def _n(c: Column | str) -> Column:
    return F.count_if(F.col(c) if isinstance(c, str) else c)


def arithmetic_block_stats(trials: DataFrame, block: Sequence[str] = BLOCK) -> DataFrame:
    """A1: correct, total and accuracy; silently cleared drops count as misses, as in the logged block end."""
    return trials.groupBy(*block).agg(
        _n("correct").alias("correct"), F.count("*").alias("total"), F.try_divide(_n("correct"), F.count("*")).alias("accuracy")
    )


def wrong_submission_rate(wrong: DataFrame, blocks: DataFrame, block: Sequence[str] = BLOCK) -> DataFrame:
    """A2: wrong commits per block and per drop of the block (`blocks` from A1)."""
    w = wrong.groupBy(*block).agg(F.count("*").alias("wrong"))
    return blocks.join(w, list(block), "left").withColumn("wrong", F.coalesce("wrong", F.lit(0).cast("bigint"))).withColumn(
        "wrong_per_drop", F.try_divide("wrong", "total")
    )


def stroop_block_stats(trials: DataFrame, block: Sequence[str] = BLOCK, rt: str = "rt_sec") -> DataFrame:
    """A3: answered trials, accuracy over all and mean reaction time over correct ones."""
    return trials.where("correct IS NOT NULL").groupBy(*block).agg(
        F.count("*").alias("n_trials"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg(F.when(F.col("correct"), F.col(rt))).alias("mean_rt_sec"),
    )


def stroop_interference(trials: DataFrame, keys: Sequence[str] = RUN, rt: str = "rt_sec") -> DataFrame:
    """A4: correct reaction time and accuracy by congruency, and incongruent minus congruent."""
    con = F.col("congruent")
    mean = lambda flag: F.avg(F.when(F.col("correct") & flag, F.col(rt)))
    acc = lambda flag: F.avg(F.when(flag, F.col("correct").cast("double")))
    return trials.groupBy(*keys).agg(
        mean(con).alias("rt_congruent"), mean(~con).alias("rt_incongruent"), acc(con).alias("acc_congruent"), acc(~con).alias("acc_incongruent")
    ).withColumns(
        {"rt_interference": F.col("rt_incongruent") - F.col("rt_congruent"), "acc_interference": F.col("acc_incongruent") - F.col("acc_congruent")}
    )


def schulte_stats(clicks: DataFrame, blocks: DataFrame, block: Sequence[str] = BLOCK) -> DataFrame:
    """A5: completion time (null when skipped), misclicks (repeats do not count) and repeats."""
    c = clicks.groupBy(*block).agg(
        F.max(F.when(F.col("correct"), F.col("rt_sec"))).alias("last_correct_sec"),
        _n((~F.col("correct")) & ~F.col("repeat")).alias("misclicks"),
        _n("repeat").alias("repeats"),
        _n("correct").alias("found"),
    )
    return blocks.select(*block, "skipped", "truncated").join(c, list(block), "left").withColumn(
        "completion_time_sec", F.when(~F.coalesce("skipped", F.lit(False)) & ~F.col("truncated"), F.col("last_correct_sec"))
    ).select(*block, "completion_time_sec", *[F.coalesce(x, F.lit(0).cast("bigint")).alias(x) for x in ("misclicks", "repeats", "found")])


def sart_stats(trials: DataFrame, keys: Sequence[str] = RUN, rt: str = "rt_sec") -> DataFrame:
    """go/no-go accuracy, commission and omission errors and go reaction times of the real block."""
    omit, hit, go_rt = F.col("is_omit"), F.col("responded"), F.when(~F.col("is_omit") & F.col("responded"), F.col(rt))
    return trials.where(~F.col("practice") & hit.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg((hit != omit).cast("double")).alias("accuracy"),
        _n(hit & omit).alias("commission"),
        _n(~hit & ~omit).alias("omission"),
        F.avg(go_rt).alias("go_rt_mean"),
        F.stddev_samp(go_rt).alias("go_rt_sd"),
        F.try_divide(F.stddev_samp(go_rt), F.avg(go_rt)).alias("go_rt_cv"),
    )


def highway_block_stats(obstacles: DataFrame, keys: Sequence[str] = BLOCK, width: Slicing = None) -> DataFrame:
    """Outcomes per block or tier; silent resolutions count. The median margin is exact."""
    hit = F.col("outcome") == "collision"
    counts = obstacles.groupBy(*keys).agg(
        _n(~hit).alias("avoided"), _n(hit).alias("collisions"), _n("near_miss").alias("near_misses"), _n("no_response").alias("no_responses")
    )
    return counts.join(exact_median(obstacles, keys, "margin_sec", "median_margin_sec", width), list(keys), "left")


def lane_change_stats(changes: DataFrame, keys: Sequence[str] = BLOCK) -> DataFrame:
    """Forced, unforced and blocked lane changes and the mean forced reaction time."""
    return changes.groupBy(*keys).agg(
        _n("forced").alias("forced"), _n(~F.col("forced")).alias("unforced"), _n("blocked").alias("blocked"),
        F.avg(F.when(F.col("forced"), F.col("reaction_time_ms"))).alias("mean_forced_rt_ms"),
    )


def wave_stats(obstacles: DataFrame, block: Sequence[str] = BLOCK) -> DataFrame:
    """Hazards and collisions per wave, logged size against counted size."""
    return obstacles.groupBy(*block, "wave").agg(
        F.count("*").alias("hazards"), _n(F.col("outcome") == "collision").alias("collisions"), F.max("wave_size").alias("logged_size")
    ).withColumn("size_ok", F.col("hazards") == F.col("logged_size"))


def dose_response(obstacles: DataFrame, reports: DataFrame, item: str = "stress", level: str = "nominal_difficulty", keys: Sequence[str] = ()) -> DataFrame:
    """A10: outcome rates per induced level next to the self-report of the same level."""
    outcome = obstacles.groupBy(*keys, level).agg(
        F.count("*").alias("n"), F.avg((F.col("outcome") == "collision").cast("double")).alias("collision_rate")
    )
    told = reports.groupBy(*keys, level).agg(F.avg(item).alias("mean_report"), F.count(item).alias("n_reports"))
    return outcome.join(told, [*keys, level], "left")


def dose_trend(levels: DataFrame, keys: Sequence[str] = (), level: str = "nominal_difficulty") -> DataFrame:
    """A10: correlation and slope of the outcome and the report over the induced level."""
    x = F.col(level).cast("double")
    return levels.groupBy(*keys).agg(
        F.corr(x, "collision_rate").alias("corr_outcome"), F.regr_slope("collision_rate", x).alias("slope_outcome"),
        F.corr(x, "mean_report").alias("corr_report"), F.regr_slope("mean_report", x).alias("slope_report"),
    )


def manipulation_check(ratings: DataFrame, groups: Sequence[str], pick: str = "emotion_pick", intended: str = "valence_group") -> DataFrame:
    """Picks per intended group and the agreement rate, case ignored, skipped ratings left out."""
    p = F.lower(pick)
    return ratings.where(~F.coalesce(F.col("skipped"), F.lit(False)) & F.col(pick).isNotNull()).groupBy(intended).agg(
        *[_n(p == g.lower()).alias(f"picked_{g.lower()}") for g in groups],
        F.count("*").alias("n"),
        F.avg((p == F.lower(intended)).cast("double")).alias("agreement"),
    )


def rating_items(ratings: DataFrame, items: Sequence[str], col: str = "event_payload_json") -> DataFrame:
    """One row per rated item, read from the payload; the item list comes from the configuration."""
    pairs = F.array(*[F.struct(F.lit(i).alias("item"), field(i, "double", col).alias("score"), field(f"{i}_rt", "double", col).alias("item_rt")) for i in items])
    return ratings.withColumn("__i", F.explode(pairs)).select("*", "__i.*").drop("__i").where("score IS NOT NULL")


def rating_summary(items: DataFrame, by: Sequence[str], item: str = "item", score: str = "score") -> DataFrame:
    """N, mean and SD per item and group; skipped ratings left out."""
    rows = items.where(~F.coalesce(F.col("skipped"), F.lit(False))) if "skipped" in items.columns else items
    return rows.groupBy(*by, item).agg(F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("sd"))


def final_score(scored: DataFrame, order: str, keys: Sequence[str] = RUN, score: str = "score") -> DataFrame:
    """The score after a run's last event; quit and practice runs are filtered before."""
    return scored.groupBy(*keys).agg(F.max_by(score, order).alias("final_score"), F.max(order).alias("ended_at"))


def high_score(finals: DataFrame, holder: str = "participant_id", score: str = "final_score", at: str = "ended_at", tie: str | None = None) -> DataFrame:
    """The study's best score; only a higher one replaces it, so the first holder keeps a tie.

    One global partial aggregation, no sort.
    """
    rank = F.struct(F.col(score), -F.col(at), *([-F.col(tie)] if tie else []))
    return finals.where(F.col(score).isNotNull()).agg(F.max_by(F.struct(holder, score, at), rank).alias("b")).where("b IS NOT NULL").select("b.*")


def clip_time_budget(selected: DataFrame, group: str = "valence_group") -> DataFrame:
    """Clips and watching time per group."""
    return selected.groupBy(group).agg(F.count("*").alias("n_clips"), F.sum("duration_sec").alias("clip_sec"))


def block_time_budget(laid_out: DataFrame, rest_sec: float, start_sec: float, mid_sec: float, end_sec: float, keys: Sequence[str] = ("block",)) -> DataFrame:
    """Controlled time per block. Each gap between clips is a rest, but the gap after clip
    `floor(n/2) - 1` is the mid baseline."""
    n = F.col("n_clips")
    mid = (n >= 2).cast("int")
    return laid_out.groupBy(*keys).agg(F.count("*").alias("n_clips"), F.sum("duration_sec").alias("clip_sec")).withColumns(
        {"rest_total_sec": (n - 1 - mid) * F.lit(rest_sec), "baseline_total_sec": F.lit(start_sec + end_sec) + mid * F.lit(mid_sec)}
    ).withColumn("controlled_sec", F.col("clip_sec") + F.col("rest_total_sec") + F.col("baseline_total_sec"))


def trial_count_audit(planned: DataFrame, trials: DataFrame, keys: Sequence[str] = BLOCK, planned_col: str = "planned_trials") -> DataFrame:
    """Announced against observed number of trials."""
    seen = trials.groupBy(*keys).agg(F.count("*").alias("observed"))
    return planned.select(*keys, planned_col).where(F.col(planned_col).isNotNull()).join(seen, list(keys), "left").withColumn(
        "observed", F.coalesce("observed", F.lit(0).cast("bigint"))
    ).withColumn("missing", F.col(planned_col) - F.col("observed"))


def logged_vs_recomputed(logged: DataFrame, recomputed: DataFrame, keys: Sequence[str], cols: Mapping[str, str], eps: float = 1e-6) -> DataFrame:
    """Rows where a logged statistic and the recomputed one differ; `cols` maps logged to recomputed names."""
    l = logged.select(*keys, *[F.col(c).cast("double").alias(f"logged_{c}") for c in cols])
    r = recomputed.select(*keys, *[F.col(n).cast("double").alias(f"recomputed_{c}") for c, n in cols.items()])
    diff = F.lit(False)
    for c in cols:
        a, b = F.col(f"logged_{c}"), F.col(f"recomputed_{c}")
        diff = diff | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > eps, F.lit(False))
    return l.join(r, list(keys), "left").where(diff)


def duration_audit(blocks: DataFrame, planned: DataFrame, on: Sequence[str], tolerance: float = 1.0) -> DataFrame:
    """Wall length against planned length (`planned.planned_sec`, already demo-scaled); skipped blocks are not flagged."""
    out = blocks.join(planned, list(on), "left").withColumn("length_sec", F.col("t1") - F.col("t0"))
    off = F.abs(F.col("length_sec") - F.col("planned_sec")) > tolerance
    return out.withColumn("off_plan", F.coalesce(off & ~F.coalesce("skipped", F.lit(False)), F.lit(False)))


def design_balance(trials: DataFrame, targets: DataFrame, who: str = "participant_id", cls: str = "label") -> DataFrame:
    """Trials per class and participant against the target of the class."""
    return trials.groupBy(who, cls).agg(F.count("*").alias("n")).join(targets, cls, "left").withColumn("shortfall", F.greatest(F.lit(0).cast("bigint"), F.col("target") - F.col("n")))


def tier_band_check(trials: DataFrame, bands: DataFrame, tier: str = "tier") -> DataFrame:
    """Observed accuracy per tier against its target band (`low`, `high`)."""
    acc = trials.groupBy(tier).agg(F.count("*").alias("n"), F.avg(F.col("correct").cast("double")).alias("accuracy"))
    return acc.join(bands, tier, "left").withColumn(
        "verdict", F.when(F.col("accuracy") < F.col("low"), "below").when(F.col("accuracy") > F.col("high"), "above").when(F.col("low").isNotNull(), "in")
    )


def clock_points(ev: DataFrame) -> DataFrame:
    """Checkpoints as (client midpoint, host counter); the shell's two labels share one clock."""
    task, ordinal = clock_key(F.col("task"), F.col("run_ordinal"))
    return ev.where("event_type = 'sync_checkpoint'").select(
        "session_id", task.alias("task"), ordinal.alias("run_ordinal"),
        ((field("client_perf_now_before_ms", "double") + field("client_perf_now_after_ms", "double")) / 2).alias("client_mid_ms"),
        field("host_perf_counter_at_receipt", "double").alias("host_counter"),
        field("round_trip_ms", "double").alias("round_trip_ms"),
    )


def clock_fit(points: DataFrame, keys: Sequence[str] = RUN, max_round_trip_ms: float | None = None) -> DataFrame:
    """Least-squares line from browser time to the host counter, per browser clock.

    Slope and intercept are null with fewer than two checkpoints.
    """
    p = points if max_round_trip_ms is None else points.where(F.col("round_trip_ms") <= max_round_trip_ms)
    return p.groupBy(*keys).agg(
        F.regr_slope("host_counter", "client_mid_ms").alias("slope"),
        F.regr_intercept("host_counter", "client_mid_ms").alias("intercept"),
        F.count("*").alias("n"),
        F.max("round_trip_ms").alias("max_round_trip_ms"),
        F.sqrt(F.try_divide(F.regr_syy("host_counter", "client_mid_ms") - F.try_divide(F.pow(F.regr_sxy("host_counter", "client_mid_ms"), 2), F.regr_sxx("host_counter", "client_mid_ms")), F.count("*"))).alias("residual"),
    )


def host_clock_fit(ev: DataFrame, keys: Sequence[str] = ("session_id",), host: str = HOST, mono: str = MONO, width: Slicing = None) -> DataFrame:
    """Wall clock minus monotonic clock per session; a spread above jitter means the wall clock was stepped."""
    gap = ev.select(*keys, (F.col(host) - F.col(mono)).alias("gap"))
    spread = gap.groupBy(*keys).agg((F.max("gap") - F.min("gap")).alias("spread"))
    return exact_median(gap, keys, "gap", "median_offset", width).join(spread, list(keys))


def sync_health(sync: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """Per session and device: state, attempts and the last detail; `skipped` are skip events."""
    mock = F.startswith("device_id", F.lit("mock-"))
    out = sync.groupBy("session_id", "device_role").agg(
        F.count("*").alias("attempts"),
        F.when(F.bool_or(mock), "mock").when(F.bool_or(F.col("result") == "ok"), "ok").otherwise("error").alias("state"),
        F.max_by("detail", "sync_time_host_utc").alias("detail"),
    )
    if skipped is None:
        return out
    s = skipped.select("session_id").distinct().join(sync.select("session_id").distinct(), "session_id", "left_anti")
    return out.unionByName(s.withColumns({"attempts": F.lit(0).cast("bigint"), "state": F.lit("skipped")}), allowMissingColumns=True)


def playback_rows(ev: DataFrame) -> DataFrame:
    """Video facts per played clip."""
    return ev.where("event_type = 'clip_video_metadata'").select(
        "session_id", field("clip_id", "string").alias("clip_id"), field("native_width", "int").alias("native_width"),
        field("native_height", "int").alias("native_height"), field("object_fit", "string").alias("object_fit"), field("below_720p", "boolean").alias("below_720p"),
    )


def playback_audit(rows: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Clips checked, badly fitted and low-resolution ones per session; a session without rows is `no_rows`."""
    out = rows.groupBy("session_id").agg(
        F.count("*").alias("checked"), _n(F.col("object_fit") != "contain").alias("bad_fit"), _n("below_720p").alias("low_res")
    )
    if sessions is not None:
        out = sessions.select("session_id").join(out, "session_id", "left")
    return out.withColumn("outcome", F.when(F.col("checked").isNull(), "no_rows").when(F.col("bad_fit") > 0, "bad").otherwise("ok"))


def playback_duration_audit(rows: DataFrame, measured: str, expected: str, tolerance: float = DURATION_TOLERANCE_SEC) -> DataFrame:
    """Measured minus expected length; a missing expectation is never flagged."""
    d = F.col(measured) - F.col(expected)
    return rows.withColumns({"difference_sec": d, "needs_trim_check": F.coalesce(F.abs(d) > tolerance, F.lit(False))})


def low_res_clips(rows: DataFrame, category: str = "category", height: str = "height", minimum: int = MIN_HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Clips below the minimum height, and their number per category."""
    low = rows.where(F.col(height) < minimum)
    return low, low.groupBy(category).agg(F.count("*").alias("n"), F.min(height).alias("lowest"))


def session_summary(status: DataFrame, *measures: DataFrame) -> DataFrame:
    """One wide row per session; each measure frame has one row per session."""
    out = status
    for m in measures:
        out = out.join(m, "session_id", "left")
    return out


def task_measures(rows: DataFrame, measures: Mapping[str, tuple[str, Column]], keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Key measures pivoted by task in one aggregation: name -> (task, aggregate input)."""
    return rows.groupBy(*keys).agg(*[F.avg(F.when(F.col("task") == task, value)).alias(name) for name, (task, value) in measures.items()])


def window_features(samples: DataFrame, keys: Sequence[str] = ("window_id",), expected: str | None = None, channels: str = "ch") -> DataFrame:
    """N, mean, SD, min, max and missing share per window and channel; NaN and null count as missing."""
    x = F.nanvl(F.col("x"), F.lit(None).cast("double"))
    rows = samples.select(*keys, *([expected] if expected else []), F.posexplode(channels).alias("channel", "raw")).withColumn("x", F.col("raw").cast("double"))
    n_all = F.max(expected) if expected else F.count("*")
    return rows.withColumn("x", x).groupBy(*keys, "channel").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.min("x").alias("min"), F.max("x").alias("max"),
        (F.lit(1.0) - F.try_divide(F.count("x"), n_all)).alias("missing_share"),
    )


def external_log_summary(log: DataFrame, keys: Sequence[str], outcome: str, rt: str, hit: str = "HIT", miss: str = "MISS", false_alarm: str = "FA") -> DataFrame:
    """Hits, misses, false alarms and mean hit response time of an external task log."""
    o = F.col(outcome)
    return log.groupBy(*keys).agg(
        _n(o == hit).alias("hits"), _n(o == miss).alias("misses"), _n(o == false_alarm).alias("false_alarms"), F.avg(F.when(o == hit, F.col(rt))).alias("mean_rt")
    )
