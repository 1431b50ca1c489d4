"""Projections, filters and predicates over the event log."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.functions.ordered import Slicing, running
from cohortwave.schema import HOST, MONO, ORDER, PAY, PRACTICE_TASK, RUN, field


def filter_event_type(ev: DataFrame, *types: str) -> DataFrame:
    """Rows of the given types (reaches the Parquet scan as a pushed filter)."""
    return ev.where(F.col("event_type").isin(*types))


def payload(ev: DataFrame, fields: Mapping[str, str], col: str = PAY) -> DataFrame:
    """Typed payload fields as columns; missing or unconvertible ones are null."""
    return ev.withColumns({n: field(n, t, col) for n, t in fields.items()})


def scored_only(
    ev: DataFrame,
    sessions: DataFrame,
    *,
    practice_tasks: bool = True,
    practice_blocks: bool = True,
    demo_scaled: bool = True,
    mock_devices: bool = True,
    practice: Column | None = None,
) -> DataFrame:
    """Drop practice rows and, by session, demo-scaled or mock-device runs; each part can be switched off."""
    out = ev
    if practice_tasks:
        out = out.where(F.coalesce(F.col("task"), F.lit("")) != PRACTICE_TASK)
    if practice_blocks:
        out = out.where(~F.coalesce(practice if practice is not None else field("practice", "boolean"), F.lit(False)))
    bad = F.lit(False)
    if demo_scaled:
        bad = bad | (F.coalesce("demo_scale", F.lit(1.0)) < 1)
    if mock_devices:
        bad = bad | F.coalesce("mock_device", F.lit(False))
    return out.join(sessions.where(bad).select("session_id"), "session_id", "left_anti")


def session_facts(manifests: DataFrame) -> DataFrame:
    """Session columns that P3 and the reports need, from the manifest."""
    records = F.flatten(F.map_values("device_sync_records"))
    mock = F.exists(records, lambda r: F.startswith(r["device_id"], F.lit("mock-")))
    return manifests.select(
        "session_id", "participant_id", "created_at_utc", F.coalesce("demo_scale", F.lit(1.0)).alias("demo_scale"), "rng_seed",
        F.coalesce(mock, F.lit(False)).alias("mock_device"), "config_snapshot",
    )


def completed_only(blocks: DataFrame) -> DataFrame:
    """Blocks with an end event that were not skipped."""
    return blocks.where(~F.col("truncated") & ~F.coalesce("skipped", F.lit(False)))


def event_time(ev: DataFrame) -> DataFrame:
    """P5: wall clock as a microsecond timestamp; the monotonic clock stays a double."""
    return ev.withColumn("ts", F.timestamp_micros(F.round(F.col(HOST) * 1e6).cast("bigint")))


def parse_session_id(df: DataFrame) -> DataFrame:
    """Start time and task inside `<participant>[_<task>]_<unix>`; participants may contain `_`."""
    rest = F.expr("substring(session_id, length(participant_id) + 2)")
    ok = F.startswith("session_id", F.concat("participant_id", F.lit("_")))
    return df.withColumns(
        {
            "session_task": F.when(ok, F.nullif(F.regexp_extract(rest, r"^(.*)_\d+$", 1), F.lit(""))),
            "session_start_unix": F.when(ok, F.regexp_extract(rest, r"(\d+)$", 1).try_cast("bigint")),
        }
    )


def assign_run_ordinal(ev: DataFrame, width: Slicing = None, checkpoint_label: Column | None = None, position: Column | None = None) -> DataFrame:
    """Running number of process runs per (session, task).

    A run opens at a `session_start_0` checkpoint, or at a `task_start` that no such checkpoint
    preceded since the last `task_start`. Rows before the first opener have ordinal 0; a baseline
    logged ahead of its task (`pre_task`) belongs to the run that follows.
    """
    label = checkpoint_label if checkpoint_label is not None else field("label", "string")
    pos = position if position is not None else field("position", "string")
    keys = ["session_id", "task"]
    marker = F.when((F.col("event_type") == "sync_checkpoint") & (label == "session_start_0"), F.lit("C")).when(
        F.col("event_type") == "task_start", F.lit("T")
    )
    marks = ev.where(F.col("event_type").isin("sync_checkpoint", "task_start")).select(*keys, *ORDER, marker.alias("m")).where("m IS NOT NULL")
    openers = running(marks, keys, ORDER, {"prev": ("last", F.col("m"))}, width, inclusive=False).where("m = 'C' OR prev IS NULL OR prev <> 'C'")
    opened = openers.select(*keys, *ORDER, F.lit(1).alias("__open"))
    # an opener stands just before its own event on the time line
    line = ev.withColumn("__ev", F.lit(1)).unionByName(opened.withColumn("__ev", F.lit(0)), allowMissingColumns=True)
    out = running(line, keys, [MONO, "event_seq", "__ev"], {"run_ordinal": ("count", F.col("__open"))}, width).where("__ev = 1")
    ahead = (F.col("event_type").isin("baseline_start", "baseline_end")) & (pos == "pre_task")
    return out.withColumn("run_ordinal", (F.col("run_ordinal") + F.when(ahead, 1).otherwise(0)).cast("int")).drop("__ev", "__open")


def trial_starts(ev: DataFrame) -> DataFrame:
    """Typed `trial_start` rows of every task."""
    return ev.where("event_type = 'trial_start'").select(
        *RUN, "block_index", "trial_index", "condition_label", F.col(MONO).alias("t_start"),
        field("client_perf_now_ms", "double").alias("client_ms"), field("tier", "int").alias("tier"), *_stimulus(),
    )


def _stimulus() -> list[Column]:
    return [
        field("expression", "string").alias("expression"),
        field("correct_answer", "double").alias("correct_answer"),
        field("word", "string").alias("word"),
        field("ink_color", "string").alias("ink_color"),
        field("congruent", "boolean").alias("congruent"),
        field("number", "int").alias("number"),
        field("is_omit", "boolean").alias("is_omit"),
        F.coalesce(field("practice", "boolean"), F.lit(False)).alias("practice"),
        field("clip_id", "string").alias("clip_id"),
    ]


def normalise_trials(ev: DataFrame) -> DataFrame:
    """One response schema over all tasks, in one pass.

    Reaction times become seconds, verdict fields share a name, and the retired arithmetic task's
    1-based index is shifted. A cell click's time counts from its block's start (see `unit`).
    """
    rt, rt_ms = field("rt", "double"), field("rt_ms", "double")
    click = F.col("event_type") == "cell_click"
    legacy = field("timed_out", "boolean").isNotNull()
    missed = field("missed", "boolean")
    index = F.when(click, field("number_clicked", "int")).when(legacy, F.col("trial_index") - 1).otherwise(F.col("trial_index"))
    responded = F.coalesce(
        field("responded", "boolean"), ~missed, ~field("timed_out", "boolean"), field("clicked_color", "string").isNotNull() | click
        | field("emotion_pick", "string").isNotNull()
    )
    return ev.where(F.col("event_type").isin("response", "rating_response", "cell_click")).select(
        *RUN,
        "block_index",
        index.alias("trial_index"),
        "condition_label",
        "event_type",
        F.col(MONO).alias("t_response"),
        field("client_perf_now_ms", "double").alias("response_client_ms"),
        F.coalesce(rt, rt_ms / 1000, field("emotion_pick_rt", "double")).alias("rt_sec"),
        F.when(click, "since_block_start").otherwise("since_stimulus").alias("unit"),
        F.coalesce(field("correct", "boolean"), field("accurate", "boolean")).alias("correct"),
        responded.alias("responded"),
        F.coalesce(field("skipped", "boolean"), F.lit(False)).alias("skipped"),
        missed.alias("missed"),
        F.coalesce(
            field("expression", "string"), field("word", "string"), field("number", "string"), field("number_clicked", "string"), field("clip_id", "string")
        ).alias("stimulus"),
        field("participant_answer", "double").alias("participant_answer"),
        F.coalesce(field("repeat", "boolean"), F.lit(False)).alias("repeat"),
    )


def mark_silent(trials: DataFrame, blocks: DataFrame, fall_sec: DataFrame) -> DataFrame:
    """Separate silently cleared drops from genuine misses.

    A genuine miss fires only at full fall, so in a skipped block a miss is silent when the drop
    lived shorter than its tier's fall time. `fall_sec`: (session_id, tier, fall_duration_sec).
    """
    skipped = blocks.where("skipped").select(*RUN, "block_index", F.lit(True).alias("block_skipped"))
    life = (F.col("response_client_ms") - F.col("client_ms")) / 1000
    return (
        trials.join(skipped, [*RUN, "block_index"], "left")
        .join(fall_sec, ["session_id", "tier"], "left")
        .withColumn("silent", F.coalesce(F.col("block_skipped") & F.col("missed") & (life < F.col("fall_duration_sec")), F.lit(False)))
        .drop("block_skipped", "fall_duration_sec")
    )


def session_status(ev: DataFrame) -> DataFrame:
    """Crashed, else aborted, else completed, else truncated; one partial aggregation."""
    has = lambda *types: F.bool_or(F.col("event_type").isin(*types))
    return ev.groupBy("session_id").agg(
        F.when(has("session_crashed"), "crashed")
        .when(has("session_aborted", "task_abort"), "aborted")
        .when(has("session_end"), "completed")
        .otherwise("truncated")
        .alias("status")
    )


_TIERS = (
    "array<struct<id:int,label:string,duration_sec:double,nominal_difficulty:int,fall_duration_sec:double,spawn_interval_sec:double,"
    "spawn_interval_range_sec:array<double>,concurrent_obstacles:int>>"
)


def _tiers(manifests: DataFrame, task: str) -> DataFrame:
    return manifests.select(
        "session_id", "demo_scale", F.explode(F.try_variant_get("config_snapshot", F.lit(f"$.{task}.tiers"), _TIERS)).alias("tier")
    ).select("session_id", "demo_scale", "tier.*")


def _order(manifests: DataFrame, task: str) -> DataFrame:
    return manifests.select(
        "session_id", F.posexplode(F.try_variant_get("config_snapshot", F.lit(f"$.{task}.trial_order"), "array<int>")).alias("position", "id")
    )


def validate_config(manifests: DataFrame, tasks: tuple[str, ...] = ("stress_task", "attention_highway_task")) -> DataFrame:
    """P10: violations: tier ids in `trial_order` that no tier defines, and `omit_count` outside 1..8."""
    found = None
    for task in tasks:
        missing = (
            _order(manifests, task)
            .join(_tiers(manifests, task).select("session_id", "id"), ["session_id", "id"], "left_anti")
            .select("session_id", F.lit(f"{task}.trial_order").alias("setting"), F.col("id").cast("string").alias("value"))
        )
        found = missing if found is None else found.unionByName(missing)
    omit = F.try_variant_get("config_snapshot", F.lit("$.sart_task.omit_count"), "int")
    return found.unionByName(
        manifests.select("session_id", F.lit("sart_task.omit_count").alias("setting"), omit.alias("value")).where("value NOT BETWEEN 1 AND 8")
        .withColumn("value", F.col("value").cast("string"))
    )


def tier_dimension(manifests: DataFrame, task: str = "attention_highway_task") -> DataFrame:
    """Tiers in presentation order with defaults; only the block length follows `demo_scale`."""
    return (
        _order(manifests, task)
        .join(_tiers(manifests, task), ["session_id", "id"])
        .select(
            "session_id", "position", "id",
            F.coalesce("label", F.concat(F.lit("tier_"), F.col("id"))).alias("label"),
            (F.col("duration_sec") * F.coalesce("demo_scale", F.lit(1.0))).alias("duration_sec"),
            F.coalesce("nominal_difficulty", "id").alias("nominal_difficulty"),
            "fall_duration_sec", "spawn_interval_range_sec", "spawn_interval_sec",
            F.coalesce("concurrent_obstacles", F.lit(1)).alias("concurrent_obstacles"),
        )
    )


def label_policy(df: DataFrame, policy: str, label: str = "condition_label", clips: DataFrame | None = None) -> DataFrame:
    """`binary` (baseline or stress), `ordinal` (0 for baseline, else the tier number),
    `valence` or `fine` (clip label by `clip_id`; needs `clips`)."""
    c = F.col(label)
    tier = F.regexp_extract(c, r"^tier_(\d+)$", 1).try_cast("int")
    if policy == "binary":
        return df.withColumn("label", F.when(c == "baseline", "baseline").when(tier.isNotNull(), "stress"))
    if policy == "ordinal":
        return df.withColumn("label", F.when(c == "baseline", F.lit(0)).otherwise(tier).cast("string"))
    pick = {"valence": "valence_group", "fine": "fine_grained_label"}[policy]
    return df.join(clips.select("clip_id", F.col(pick).alias("label")), "clip_id", "left")
