"""Joins: event pairing, as-of state, stimulus tables and clock alignment."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.functions.ordered import Slicing, asof_join, numbered, range_join, running
from cohortwave.schema import BLOCK, HOST, MONO, ORDER, RUN, TRIAL, field


def pair_trials(starts: DataFrame, responses: DataFrame, keys: Sequence[str] = TRIAL) -> DataFrame:
    """Each trial start with its response; a start without one stays, `responded` null."""
    dup = [c for c in responses.columns if c in starts.columns and c not in keys]
    return starts.join(responses.drop(*dup), list(keys), "left")


def pair_events(
    ev: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str],
    *,
    start_cols: dict[str, Column] | None = None,
    end_cols: dict[str, Column] | None = None,
    width: Slicing = None,
    run_end: DataFrame | None = None,
    run_keys: Sequence[str] = RUN,
    closed_only: bool = False,
) -> DataFrame:
    """A start with the end event that directly follows it under the same keys, on both clocks.

    A start with no such end is `truncated`: it closes at the run's last event. Rows are looked at
    from the end of the log, so the next event is carried back to the start. `closed_only` leaves
    truncated ones out, and with them the pass that finds the runs' ends.
    """
    start_cols, end_cols = start_cols or {}, end_cols or {}
    is_start = F.col("event_type") == start
    # only what either role needs is shuffled, not the payload
    e = ev.where(F.col("event_type").isin(start, end)).select(
        *keys, *ORDER, HOST, is_start.alias("__start"), *[F.when(is_start, c).alias(n) for n, c in start_cols.items()],
        F.struct(*[F.when(~is_start, c).alias(n) for n, c in end_cols.items()]).alias("__end") if end_cols else F.lit(None).cast("int").alias("__end"),
    )
    nxt = F.struct("__start", F.col(MONO).alias("t"), F.col(HOST).alias("h"), F.col("__end").alias("end"))
    seen = running(e, keys, ORDER, {"__next": ("last", nxt)}, width, inclusive=False, descending=True).where("__start")
    hit = ~F.col("__next.__start")
    if closed_only:
        ended = seen.where(hit).withColumns({"__last_t": F.lit(None).cast("double"), "__last_h": F.lit(None).cast("double")})
    else:
        last = run_end if run_end is not None else ev.groupBy(*run_keys).agg(F.max(MONO).alias("__last_t"), F.max(HOST).alias("__last_h"))
        # runs are keyed by session, task and ordinal, which are set on every block and baseline row
        ended = seen.join(last, list(run_keys), "left")
    return ended.select(
        *keys,
        *start_cols,
        F.col(MONO).alias("t0"),
        F.when(hit, F.col("__next.t")).otherwise(F.col("__last_t")).alias("t1"),
        F.col(HOST).alias("host_t0"),
        F.when(hit, F.col("__next.h")).otherwise(F.col("__last_h")).alias("host_t1"),
        (~F.coalesce(hit, F.lit(False))).alias("truncated"),
        *[F.when(hit, F.col(f"__next.end.{n}")).alias(n) for n in end_cols],
    )


def pair_blocks(ev: DataFrame, width: Slicing = None, closed_only: bool = False) -> DataFrame:
    """Blocks as intervals; pause blocks without an index pair in order within their condition."""
    return pair_events(
        ev, "block_start", "block_end", [*BLOCK, "condition_label"],
        start_cols={
            "tier": field("tier", "int"), "nominal_difficulty": field("nominal_difficulty", "int"), "practice": F.coalesce(field("practice", "boolean"), F.lit(False)),
            "planned_trials": F.coalesce(field("num_trials", "int"), field("n_stimuli", "int")), "grid_size": field("grid_size", "int"),
        },
        end_cols={
            "skipped": field("skipped", "boolean"), "accuracy": field("accuracy", "double"), "mean_rt_ms": field("mean_rt_ms", "double"),
            "n_trials": field("n_trials", "int"), "completion_time_sec": field("completion_time_sec", "double"),
            "misclicks": field("misclicks", "int"), "avoided": field("avoided", "int"), "collisions": field("collisions", "int"),
        },
        width=width,
        closed_only=closed_only,
    )


def pair_baselines(ev: DataFrame, width: Slicing = None, closed_only: bool = False) -> DataFrame:
    """Baselines by block and position, planned next to real length."""
    at = ev.where(F.col("event_type").isin("baseline_start", "baseline_end")).withColumns(
        {"position": field("position", "string"), "planned_sec": field("duration_sec", "double")}
    )
    last = None if closed_only else ev.groupBy(*RUN).agg(F.max(MONO).alias("__last_t"), F.max(HOST).alias("__last_h"))
    paired = pair_events(
        at, "baseline_start", "baseline_end", [*BLOCK, "position"], start_cols={"planned_sec": F.col("planned_sec")}, width=width, run_end=last, closed_only=closed_only
    )
    return paired.withColumn("real_sec", F.col("t1") - F.col("t0"))


def pair_playbacks(ev: DataFrame, width: Slicing = None) -> DataFrame:
    """Clip playbacks as intervals on both clocks, by run and clip; `outcome` is played, error or truncated.

    A start lasts until the next end or error of its clip. A player that fails may play the clip again by another
    way, which logs an end but no second start: so an error opens a playback too if an end follows. A start that is
    followed by another start, or by nothing, is truncated and closes at the run's last event.
    """
    keys = [*RUN, "clip_id"]
    e = ev.where(F.col("event_type").isin("clip_playback_start", "clip_playback_end", "clip_playback_error")).select(
        *RUN, field("clip_id", "string").alias("clip_id"), *ORDER, HOST, F.col("event_type").alias("__kind"), field("wall_duration_sec", "double").alias("__wall")
    )
    following = F.struct(F.col("__kind").alias("kind"), F.col(MONO).alias("t"), F.col(HOST).alias("h"), F.col("__wall").alias("wall"))
    seen = running(e, keys, ORDER, {"__next": ("last", following)}, width, inclusive=False, descending=True)
    kind, begun = F.col("__next.kind"), F.col("__kind") == "clip_playback_start"
    played, failed = kind == "clip_playback_end", kind == "clip_playback_error"
    last = ev.groupBy(*RUN).agg(F.max(MONO).alias("__last_t"), F.max(HOST).alias("__last_h"))
    closed = played | failed
    return (
        seen.where(begun | ((F.col("__kind") == "clip_playback_error") & played)).join(last, RUN, "left")
        .select(
            *keys, F.col(MONO).alias("t0"), F.when(closed, F.col("__next.t")).otherwise(F.col("__last_t")).alias("t1"),
            F.col(HOST).alias("host_t0"), F.when(closed, F.col("__next.h")).otherwise(F.col("__last_h")).alias("host_t1"),
            F.when(played, "played").when(failed, "error").otherwise("truncated").alias("outcome"),
            (~begun).alias("retried"), F.when(played, F.col("__next.wall")).alias("wall_duration_sec"),
        )
    )


def obstacle_spawns(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'obstacle_spawn'").select(
        *TRIAL, "condition_label", F.col(MONO).alias("spawn_t"), field("client_perf_now_ms", "double").alias("spawn_ms"),
        field("lane", "int").alias("lane"), field("lanes", "int").alias("lanes"), field("fall_duration_sec", "double").alias("fall_sec"),
        field("camp_nudged", "boolean").alias("camp_nudged"), field("nominal_difficulty", "int").alias("nominal_difficulty"),
        field("spawn_wave_index", "int").alias("wave"), field("spawn_wave_size", "int").alias("wave_size"),
    )


def obstacle_outcomes(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'obstacle_resolved'").select(
        *TRIAL, F.col(MONO).alias("resolve_t"), field("client_perf_now_ms", "double").alias("resolve_ms"),
        field("player_lane", "int").alias("player_lane"), field("outcome", "string").alias("outcome"),
        F.coalesce(field("skipped", "boolean"), F.lit(False)).alias("silent"), field("near_miss", "boolean").alias("near_miss"),
        field("no_response", "boolean").alias("no_response"), field("response_attempted", "boolean").alias("response_attempted"),
        field("reaction_margin_sec", "double").alias("margin_sec"),
    )


def lane_changes(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'lane_change'").select(
        *RUN, *ORDER, field("client_perf_now_ms", "double").alias("client_ms"), field("from_lane", "int").alias("from_lane"),
        field("to_lane", "int").alias("to_lane"), field("blocked", "boolean").alias("blocked"), field("forced", "boolean").alias("forced"),
        field("reaction_time_ms", "double").alias("reaction_time_ms"), field("threatening_trial_index", "int").alias("threatening_trial_index"),
    )


def pair_obstacles(spawns: DataFrame, outcomes: DataFrame, keys: Sequence[str] = TRIAL) -> DataFrame:
    """Spawn and resolution of a hazard; the response window is [spawn, resolve]."""
    return spawns.join(outcomes, list(keys))


def attach_block(points: DataFrame, blocks: DataFrame, t: str = MONO, keys: Sequence[str] = RUN, width: Slicing = None) -> DataFrame:
    """The enclosing block of points that carry no block index.

    Blocks of a run do not nest, so the latest block start decides and its end is then checked;
    this needs no range join.
    """
    b = blocks.where(F.col("block_index").isNotNull()).select(*keys, F.col("t0").alias("__t0"), F.struct("block_index", "t0", "t1").alias("__block"))
    out = asof_join(points.drop("block_index"), b, keys, t, "__t0", ["__block"], width)
    inside = F.col(t) <= F.col("__block.t1")
    return out.withColumn("block_index", F.when(inside, F.col("__block.block_index"))).drop("__block")


def response_to_obstacle(changes: DataFrame, obstacles: DataFrame, block: Sequence[str] = BLOCK, t: str = "client_ms") -> DataFrame:
    """The last forced lane change that answered each hazard; `changes` carry a block."""
    last = (
        changes.where("forced")
        .groupBy(*block, F.col("threatening_trial_index").alias("trial_index"))
        .agg(F.max(t).alias("response_ms"), F.max_by("reaction_time_ms", F.struct(t, "reaction_time_ms")).alias("reaction_time_ms"), F.count("*").alias("attempts"))
    )
    return obstacles.join(last, [*block, "trial_index"], "left")


def enrich_clips(clips: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clips with their scores, and the clips no metadata row matches."""
    scores = metadata.select(F.col("video_code").alias("title"), F.col("valence_wsd").alias("valence_score"), F.col("arousal_wsd").alias("arousal_score"))
    return clips.join(scores, "title"), clips.join(scores, "title", "left_anti")


def match_files(links: DataFrame, labels: DataFrame, selected: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Files with a label, ordered by code number, and the count of files without one."""
    hit = links.join(labels, "code")
    if selected:
        hit = hit.where(F.col("emotion").isin(*selected))
    ordered = hit.orderBy(F.get(F.split("code", "_"), F.lit(1)).try_cast("bigint"))
    return ordered, links.join(labels, "code", "left_anti").agg(F.count("*").alias("ignored"))


def attach_clip(ratings: DataFrame, clips: DataFrame) -> DataFrame:
    """Valence group, fine label and length of the rated clip."""
    return ratings.join(clips.select("clip_id", "valence_group", "fine_grained_label", "duration_sec"), "clip_id", "left")


def unused_clips(clips: DataFrame, used: DataFrame) -> DataFrame:
    """Clips not shown; the whole pool when all were. The test reads one row at most."""
    rest = clips.join(used.select("clip_id"), "clip_id", "left_anti")
    return clips if rest.isEmpty() else rest


def fixed_selection(clips: DataFrame, fixed: DataFrame, n: int | dict[str, int], fallback: DataFrame | None = None) -> DataFrame:
    """Clips of a group among its first `n` listed ids; a listed id the manifest lacks is not replaced.

    Groups without a list come from `fallback` (a sampled selection, T3).
    """
    if isinstance(n, dict):
        limit = F.lit(0)
        for g, k in n.items():
            limit = F.when(F.col("valence_group") == g, F.lit(k)).otherwise(limit)
    else:
        limit = F.lit(n)
    wanted = fixed.where(F.col("pos") < limit).select("valence_group", "clip_id")
    chosen = clips.join(wanted, ["valence_group", "clip_id"], "left_semi")
    if fallback is None:
        return chosen
    uncovered = fallback.join(fixed.select("valence_group").distinct(), "valence_group", "left_anti")
    return chosen.unionByName(uncovered, allowMissingColumns=True)


def merge_manual_clips(clips: DataFrame, entries: DataFrame, metadata: DataFrame, fixed: DataFrame, language: Column, file_path: Column) -> dict[str, DataFrame]:
    """Upsert of hand-picked clips into the manifest and the fixed lists.

    A known code keeps its own group; a new one gets the next clip number in list order. A touched
    group's fixed list is replaced. What a new clip says of its `language` and where its file lies are expressions of the
    caller over the metadata columns. Returns `clips`, `fixed` and `errors` (codes nobody knows).
    """
    first = entries.groupBy("video_code").agg(F.min("line_no").alias("line_no"), F.min_by("valence_group", "line_no").alias("wanted_group"))
    meta = metadata.select("video_code", "modal_emotion", "language_free", "length_s", "valence_wsd", "arousal_wsd")
    known = clips.select(F.col("title").alias("video_code"), F.col("clip_id").alias("known_id"), F.col("valence_group").alias("known_group"))
    merged = first.join(known, "video_code", "left").join(meta, "video_code", "left")
    top = clips.agg(F.coalesce(F.max(F.regexp_extract("clip_id", r"(\d+)", 1).try_cast("int")), F.lit(0)).alias("top"))
    fresh = merged.where("known_id IS NULL AND modal_emotion IS NOT NULL")
    number = numbered(fresh, [], ["line_no"], "k", width=1000.0).withColumn("num", (F.col("k") + top.scalar()).cast("string"))
    new = number.select(
        F.concat(F.lit("clip_"), F.expr("lpad(num, greatest(2, length(num)), '0')")).alias("clip_id"),
        F.col("wanted_group").alias("valence_group"),
        F.col("modal_emotion").alias("fine_grained_label"),
        F.col("video_code").alias("title"),
        language.alias("language"),
        file_path.alias("file_path"),
        F.col("length_s").alias("duration_sec"),
    )
    all_clips = clips.unionByName(new, allowMissingColumns=True)
    listed = (
        entries.select("line_no", F.col("video_code").alias("title"))
        .join(all_clips.select("title", "clip_id", "valence_group"), "title")
        .join(meta.select(F.col("video_code").alias("title"), F.col("valence_wsd").alias("valence_score"), F.col("arousal_wsd").alias("arousal_score")), "title", "left")
    )
    placed = numbered(listed, ["valence_group"], ["line_no"], "pos", width=1000.0).withColumn("pos", (F.col("pos") - 1).cast("int")).drop("line_no")
    kept = fixed.join(listed.select("valence_group").distinct(), "valence_group", "left_anti")
    errors = merged.where("known_id IS NULL AND modal_emotion IS NULL").select("line_no", "video_code")
    return {"clips": all_clips, "fixed": kept.unionByName(placed, allowMissingColumns=True), "errors": errors}


def expand_sync(manifests: DataFrame) -> DataFrame:
    """Sync records as rows; the role is the map key."""
    return manifests.select("session_id", F.explode("device_sync_records").alias("role", "records")).selectExpr("session_id", "role", "inline(records)").drop("device_role").withColumnRenamed("role", "device_role")


def align_samples(samples: DataFrame, sync: DataFrame, recordings: DataFrame | None = None, keys: Sequence[str] = ("session_id", "device_id")) -> DataFrame:
    """`wall = sync time + relative time`, one offset per recording.

    The newest good record is used; with `recordings` (recording_id, started_utc) the newest one
    at or before the start. Where these rows carry `keys`, the samples are read once. Sync rows are few per device; Spark broadcasts them when their
    measured size allows and splits skewed devices otherwise.
    """
    ok = sync.where("result = 'ok'")
    if recordings is None:
        offset = ok.groupBy(*keys).agg(F.max("sync_time_host_utc").alias("__sync"))
        return samples.join(offset, list(keys)).withColumn("wall", F.col("__sync") + F.col("rel_sec")).drop("__sync")
    if set(keys) <= set(recordings.columns):
        rec = recordings.select(*keys, "recording_id", "started_utc")
    else:
        rec = samples.select(*keys, "recording_id").distinct().join(recordings.select("recording_id", "started_utc"), "recording_id")
    offset = (
        rec.join(ok.select(*keys, "sync_time_host_utc"), list(keys))
        .where("sync_time_host_utc <= started_utc")
        .groupBy("recording_id")
        .agg(F.max("sync_time_host_utc").alias("__sync"))
    )
    return samples.join(offset, "recording_id").withColumn("wall", F.col("__sync") + F.col("rel_sec")).drop("__sync")


def align_samples_multi(samples: DataFrame, sync: DataFrame, keys: Sequence[str] = ("session_id", "device_id"), width: Slicing = None, bucket: float = 3600.0) -> DataFrame:
    """Offset interpolated between sync records that carry a device counter; end slopes extended.

    Two neighbouring records are a line on the half-open range between them, which samples meet in buckets of
    `bucket` seconds; before the first and after the last record they take that record's line. Samples are joined
    to these few rows and never sorted in time. With one record this is J14.
    """
    ok = sync.where("result = 'ok' AND device_rel_sec IS NOT NULL").select(
        *keys, F.col("device_rel_sec").alias("r"), (F.col("sync_time_host_utc") - F.col("device_rel_sec")).alias("o")
    )
    here = F.struct("r", "o")
    nxt = running(ok, keys, ["r"], {"nxt": ("last", here)}, width, inclusive=False, descending=True)
    both = running(nxt, keys, ["r"], {"prv": ("last", here)}, width, inclusive=False)
    slope = F.coalesce(
        F.try_divide(F.col("nxt.o") - F.col("o"), F.col("nxt.r") - F.col("r")), F.try_divide(F.col("o") - F.col("prv.o"), F.col("r") - F.col("prv.r")), F.lit(0.0)
    )
    lines = both.select(*keys, F.struct("r", "o", slope.alias("slope")).alias("__l"), F.col("r").alias("__t0"), F.col("nxt.r").alias("__t1"))
    ends = lines.groupBy(*keys).agg(F.min_by("__l", "__t0").alias("__first"), F.max_by("__l", "__t0").alias("__last"))
    at = F.col("rel_sec")
    line = F.when(at < F.col("__first.r"), F.col("__first")).when(at >= F.col("__last.r"), F.col("__last")).otherwise(F.col("__l"))
    met = range_join(samples.join(ends, list(keys)), lines.where("__t1 IS NOT NULL"), keys, "rel_sec", "__t0", "__t1", bucket, how="left")
    return met.withColumn("__l", line).withColumn("wall", at + F.col("__l.o") + F.col("__l.slope") * (at - F.col("__l.r"))).select(*samples.columns, "wall")


def label_samples(samples: DataFrame, intervals: DataFrame, keys: Sequence[str] = ("session_id",), bucket: float = 60.0, keep_unlabelled: bool = False) -> DataFrame:
    """Each sample with the label of the half-open interval that holds it."""
    i = intervals.select(*keys, "t0", "t1", "label")
    return range_join(samples, i, keys, "wall", "t0", "t1", bucket, how="left" if keep_unlabelled else "inner").drop("t0", "t1")


def asof_state(points: DataFrame, ticks: DataFrame, values: Sequence[str], keys: Sequence[str] = RUN, t_point: str = "t", t_tick: str = "t", tie: str | None = None, tolerance: float | None = None, width: Slicing = None) -> DataFrame:
    """The latest state tick at or before a point."""
    return asof_join(points, ticks, keys, t_point, t_tick, values, width, tie=tie, tolerance=tolerance)


def asof_baseline(blocks: DataFrame, baselines: DataFrame, keys: Sequence[str] = RUN, width: Slicing = None) -> DataFrame:
    """The last baseline of the run that ended before the block began."""
    b = baselines.select(*keys, F.col("t0").alias("baseline_t0"), F.col("t1").alias("baseline_t1"))
    return asof_join(blocks, b, keys, "t0", "baseline_t1", ["baseline_t0", "baseline_t1"], width)


def link_followup_session(sessions: DataFrame, width: Slicing = None, follow_task: str = "sart") -> DataFrame:
    """Each completed main session with the participant's next follow-up session, if any."""
    main = sessions.where("session_task IS NULL AND status = 'completed'").select("participant_id", "session_id", "start_unix")
    follow = sessions.where(F.col("session_task") == follow_task).select(
        "participant_id", F.col("start_unix").alias("followup_unix"), F.col("session_id").alias("followup_session_id")
    )
    return asof_join(main, follow, ["participant_id"], "start_unix", "followup_unix", ["followup_session_id", "followup_unix"], width, forward=True)


def mask_invalid(rows: DataFrame, bad: DataFrame, keys: Sequence[str] = RUN, pad: float = 0.0, t0: str = "t0", t1: str = "t1", width: Slicing = None) -> DataFrame:
    """Flag rows that overlap a bad span (`t0`, `t1`) widened by `pad`.

    A row overlaps some span exactly when the furthest end among spans that begin by the row's
    end reaches its start; that is a running maximum, so overlapping spans never multiply rows.
    """
    spans = bad.select(*keys, (F.col("t0") - pad).alias("__t"), F.lit(0).alias("__k"), (F.col("t1") + pad).alias("__end"))
    line = rows.select(*keys, F.col(t1).alias("__t"), F.lit(1).alias("__k"), F.struct(*rows.columns).alias("__p"))
    out = running(spans.unionByName(line, allowMissingColumns=True), keys, ["__t", "__k"], {"__reach": ("max", F.col("__end"))}, width)
    return out.where(F.col("__p").isNotNull()).select("__p.*", "__reach").withColumn("invalid", F.coalesce(F.col("__reach") >= F.col(t0), F.lit(False))).drop("__reach")
