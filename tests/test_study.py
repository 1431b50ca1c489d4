"""Session packages end to end: one check per trap of the data model."""

import pytest
from pyspark.sql import functions as F

from cohortwave.functions.scalars import client_to_host, pivot_items, prefix_matches, stai6_score
from cohortwave.operators import joins as J, project as P, quality as Q, sets as U, stats as A, windows as X
from cohortwave.schema import BLOCK, MONO, ORDER, RUN, TRIAL, field
from cohortwave.sources import readers as R
from tests import study

MAIN, SART, QUIT, CRASH = "P_01_1700000000", "P_01_sart_1700005000", "P_02_1700010000", "P_03_1700020000"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return study.build(tmp_path_factory.mktemp("sessions"))


@pytest.fixture(scope="module")
def raw(spark, root):
    return R.read_events(spark, root)


@pytest.fixture(scope="module")
def ev(raw):
    return P.assign_run_ordinal(R.intact(raw), width=30.0).cache()


@pytest.fixture(scope="module")
def manifests(spark, root):
    return R.read_manifests(spark, root)


@pytest.fixture(scope="module")
def blocks(ev):
    return J.pair_blocks(ev, 20.0).cache()


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_torn_line_is_kept_aside(raw):
    bad = R.torn(raw).collect()
    assert len(bad) == 1 and bad[0]["_corrupt_record"].startswith('{"timestamp_host_utc"')
    assert Q.incomplete_rows(R.intact(raw)).count() == 0
    assert "P_03" in bad[0]["source_file"]


def test_run_ordinals(ev):
    runs = ev.where("task = 'attention_focus_stroop'").groupBy("run_ordinal").agg(F.count_if(F.col("event_type") == "response").alias("n"))
    assert rows(runs, "run_ordinal", "n") == [(1, 3), (2, 2)]
    # checkpoints around the task belong to its run, and so does a baseline logged before it
    assert ev.where("event_type = 'sync_checkpoint' AND run_ordinal = 0 AND task <> 'debrief'").count() == 0
    assert rows(ev.where("task = 'sart'").select("run_ordinal").distinct(), "run_ordinal") == [(1,)]


def test_status_and_followup(ev):
    s = P.session_status(ev)
    assert rows(s, "session_id", "status") == [(MAIN, "completed"), (SART, "completed"), (QUIT, "aborted"), (CRASH, "crashed")]
    ids = P.parse_session_id(ev.select("session_id", "participant_id").distinct()).withColumnRenamed("session_start_unix", "start_unix")
    link = J.link_followup_session(ids.join(s, "session_id"))
    assert rows(link, "session_id", "followup_session_id") == [(MAIN, SART)]


def test_trials_do_not_cross_runs(ev):
    starts, resp = P.trial_starts(ev), P.normalise_trials(ev)
    t = J.pair_trials(starts, resp.where("event_type <> 'cell_click'").drop("event_type"))
    stroop = t.where("task = 'attention_focus_stroop'")
    assert stroop.count() == 6 and stroop.where("responded IS NULL").count() == 1
    st = A.stroop_block_stats(stroop)
    assert rows(st, "run_ordinal", "n_trials", "mean_rt_sec") == [(1, 3, 0.6), (2, 2, 0.5)]
    i = A.stroop_interference(stroop, ["session_id"]).first()
    assert i.rt_congruent == pytest.approx(0.45) and i.rt_incongruent == pytest.approx(0.65) and i.acc_incongruent == pytest.approx(2 / 3)


def test_sart(ev):
    t = J.pair_trials(P.trial_starts(ev), P.normalise_trials(ev).drop("event_type")).where("task = 'sart'")
    s = A.sart_stats(t).first()
    assert (s.n, s.commission, s.omission) == (5, 1, 1)
    assert s.accuracy == pytest.approx(3 / 5) and s.go_rt_mean == pytest.approx(0.5)
    b = J.pair_baselines(ev).where("task = 'sart'").first()
    assert b.position == "pre_task" and b.real_sec == pytest.approx(30) and b.planned_sec == 30


def test_blocks_and_truncation(blocks):
    q = blocks.where(F.col("session_id") == QUIT)
    assert rows(q, "block_index", "truncated") == [(0, False), (1, True)]
    pauses = blocks.where("condition_label = 'inter_trial_pause'")
    assert [round(r.t1 - r.t0, 6) for r in pauses.collect()] == [2.0, 2.0]
    done = P.completed_only(blocks)
    assert done.where("task = 'stress' AND condition_label = 'tier_2'").count() == 0


def test_raindrop_score_and_silent_misses(ev, blocks, manifests):
    t = J.pair_trials(P.trial_starts(ev), P.normalise_trials(ev).drop("event_type")).where("task = 'stress'")
    fall = P.tier_dimension(manifests, "stress_task").select("session_id", F.col("id").alias("tier"), "fall_duration_sec")
    m = P.mark_silent(t, blocks, fall)
    assert rows(m.where("block_index = 3"), "trial_index", "silent") == [(0, False), (1, True), (2, True)]
    acc = A.arithmetic_block_stats(m)
    assert rows(acc, "block_index", "correct", "total") == [(1, 2, 5), (3, 0, 3)]
    logged = blocks.where("task = 'stress' AND accuracy IS NOT NULL")
    assert A.logged_vs_recomputed(logged, acc, BLOCK, {"accuracy": "accuracy"}).count() == 0
    s = X.clamped_score(m.withColumn("o", F.col("t_response")), ["o", "trial_index"], width=2.0)
    assert [r.score for r in s.orderBy("o").collect()] == [0, 0, 1, 2, 1, 0, 0, 0]
    wrong = ev.where("event_type = 'wrong_submission'")
    assert rows(A.wrong_submission_rate(wrong, acc), "block_index", "wrong") == [(1, 1), (3, 0)]
    drops = m.select(*RUN, "trial_index", F.col("t_start").alias("t0"), F.col("t_response").alias("t1"), F.col("correct_answer").cast("int").alias("correct_answer"))
    sub = wrong.select(*RUN, F.col(MONO).alias("t"), field("participant_answer", "string").alias("participant_answer"))
    assert rows(prefix_matches(sub, drops, RUN, 5.0), "trial_index") == [(2,)]


def test_highway(ev, blocks, manifests):
    hw = ev.where("task = 'attention_highway'")
    o = J.pair_obstacles(J.obstacle_spawns(hw), J.obstacle_outcomes(hw))
    b = A.highway_block_stats(o).first()
    assert (b.avoided, b.collisions, b.near_misses, b.no_responses, b.median_margin_sec) == (2, 2, 1, 2, 0.3)
    logged = blocks.where("avoided IS NOT NULL")
    assert A.logged_vs_recomputed(logged, A.highway_block_stats(o), BLOCK, {"avoided": "avoided", "collisions": "collisions"}).count() == 0
    ch = J.attach_block(J.lane_changes(hw), blocks, width=3.0)
    assert rows(ch, "block_index", "forced") == [(1, True)]
    r = X.near_miss_class(J.response_to_obstacle(ch, o))
    assert rows(r, "trial_index", "near_miss_recomputed", "no_response_recomputed") == [(0, True, False), (1, False, False), (2, False, True), (3, False, True)]
    assert r.where("near_miss <> near_miss_recomputed OR no_response <> no_response_recomputed").count() == 0
    assert rows(Q.single_lane_double(o), "wave", "lane", "n") == [(1, 1, 2)]
    assert rows(A.wave_stats(o), "wave", "hazards", "collisions", "size_ok") == [(0, 2, 0, True), (1, 2, 2, True)]
    assert Q.safe_lane_invariant(o, 4).count() == 0
    assert rows(Q.safe_lane_invariant(o.withColumn("lanes", F.lit(2)), 4), "trial_index", "blocked") == [(0, 2), (1, 2)]
    ticks = hw.where("event_type = 'state_tick'").select(*RUN, F.col("event_seq").alias("tick_id"), field("client_perf_now_ms", "double").alias("t_ms"),
                                                         field("active_obstacle_count", "int").alias("n"), field("nearest_time_to_collision_ms", "double").alias("ttc"), field("own_lane_time_to_collision_ms", "double").alias("own"))
    live = X.live_state(ticks.select(*RUN, "tick_id", "t_ms"), o, J.lane_changes(hw), 4).join(ticks.select("tick_id", "n", "ttc", "own"), "tick_id")
    assert live.where("active_obstacle_count <> n").count() == 0
    near = live.where("n = 2").first()
    assert near.nearest_time_to_collision_ms == pytest.approx(near.ttc) and near.own_lane_time_to_collision_ms == pytest.approx(near.own)
    assert [round(r.t1 - r.t0, 6) for r in Q.focus_loss_intervals(ev).orderBy("t0").collect()] == [0.4, 0.4]
    drops = hw.where("event_type = 'frame_drop_warning'").select(*RUN, F.col(MONO).alias("t"))
    flagged = Q.frame_drop_flags(o.withColumns({"t0": F.col("spawn_t"), "t1": F.col("resolve_t")}), drops, 0.05)
    assert rows(flagged.where("invalid"), "trial_index") == [(2,), (3,)]
    tiers = P.tier_dimension(manifests)
    assert rows(tiers.where(F.col("session_id") == MAIN), "position", "nominal_difficulty", "concurrent_obstacles") == [(0, 5, 3), (1, 2, 1)]
    rep = A.rating_items(hw.where("event_type = 'self_report_response'"), ["stress", "workload"])
    assert rows(Q.range_check(rep, "score", F.lit(1), F.lit(7)), "item", "score") == [("workload", 9.0)]


def test_schulte(ev, blocks):
    c = J.attach_block(P.normalise_trials(ev).where("event_type = 'cell_click'").withColumnRenamed("t_response", MONO), blocks, width=5.0)
    s = A.schulte_stats(c, blocks.where("condition_label = 'schulte_trial'"))
    assert rows(s, "session_id", "completion_time_sec", "misclicks", "repeats", "found") == [(MAIN, 2.6, 1, 1, 4), (CRASH, None, 1, 1, 2)]
    w = X.inter_click_time(c.where(F.col("session_id") == MAIN), ["rt_sec"], width=1.0)
    assert [round(r.search_sec, 6) for r in w.orderBy("rt_sec").collect()] == [0.5, 0.9, 0.6, 0.6]


def test_emotion(ev, blocks):
    rt = ev.where("event_type = 'rating_response'")
    shown = rt.withColumns({"emotion_pick": field("emotion_pick", "string"), "skipped": field("skipped", "boolean"), "valence_group": F.col("condition_label")})
    m = A.manipulation_check(shown, ["positive", "negative", "neutral"]).first()
    assert (m.picked_positive, m.picked_neutral, m.n) == (5, 3, 8) and m.agreement == pytest.approx(5 / 8)
    items = A.rating_items(shown, ["valence", "arousal"])
    assert rows(A.rating_summary(items, ["valence_group"]), "item", "n", "mean") == [("arousal", 8, pytest.approx(15 / 8)), ("valence", 8, 5.0)]
    pl = A.playback_audit(A.playback_rows(ev), ev.select("session_id").distinct())
    assert rows(pl, "session_id", "outcome") == [(MAIN, "bad"), (SART, "no_rows"), (QUIT, "bad"), (CRASH, "no_rows")]
    base = J.pair_baselines(ev).where("task = 'emotion'")
    assert base.where("position = 'start' AND abs(real_sec - 60) < 1e-6").count() == 4
    hit = J.asof_baseline(blocks.where("task = 'stress' AND condition_label LIKE 'tier%'"), blocks.where("condition_label = 'baseline'"), width=10.0)
    assert hit.where("baseline_t1 IS NULL OR baseline_t1 > t0").count() == 0
    assert A.trial_count_audit(blocks.where("NOT truncated"), P.trial_starts(ev)).where("missing <> 0").count() == 0
    assert rows(U.repeat_exposure(ev.where("event_type = 'trial_start' AND task = 'emotion'").withColumn("clip_id", field("clip_id", "string"))), "clip_id") == []


def test_questionnaire(ev, manifests):
    rules = U.questionnaire_rules(manifests)
    a = U.answers(ev)
    last = U.latest_answers(a, F.struct(*ORDER), rules=rules)
    got = {r.item_id: r.value for r in last.collect()}
    assert got["gender"] == "Male" and "gender_self_describe" not in got and "alcohol" not in got and got["age_range"] == "99"
    score = pivot_items(last, ["session_id"], ["stai_calm", "stai_relaxed", "stai_content", "stai_tense", "stai_upset", "stai_worried"]).select(stai6_score().alias("s")).first().s
    assert score == (1 + 2 + 1) + (2 + 1 + 1)
    bad = Q.option_check(last, U.questionnaire_rules(manifests))
    assert rows(bad, "item_id") == [("age_range",)]


def test_clocks(ev):
    fit = A.clock_fit(A.clock_points(ev))
    shell = fit.where("task = 'shell'").first()
    assert shell.n == 6 and shell.slope == pytest.approx(0.001) and shell.intercept == pytest.approx(100.0)
    assert fit.where("abs(slope - 0.001) > 1e-9").count() == 0 and fit.count() == 9
    host = client_to_host(ev.withColumn("client_ms", F.lit(5000.0)), fit)
    assert host.where("task IN ('preparation', 'debrief') AND abs(host_t - 105) > 1e-6").count() == 0 and host.count() == ev.count()
    assert host.where("task = 'stress' AND abs(host_t - 105) > 1e-6").count() == 0
    assert host.where("task = 'sart' AND clock_fitted").count() == 0
    spread = A.host_clock_fit(ev).agg(F.max("spread")).first()[0]
    assert spread < 1e-5
    assert Q.clock_step(ev).where("stepped").count() == 0


def test_sync_and_scored(ev, manifests):
    sync = J.expand_sync(manifests)
    assert rows(A.sync_health(sync), "session_id", "device_role", "state") == [(MAIN, "ear_eeg_out", "ok"), (MAIN, "wristband", "error"), (SART, "ear_eeg_out", "mock")]
    gone = Q.unaligned_devices(Q.enabled_devices(manifests), sync)
    assert (MAIN, "wristband") in rows(gone, "session_id", "device_role") and (MAIN, "ear_eeg_out") not in rows(gone, "session_id", "device_role")
    facts = P.session_facts(manifests)
    kept = P.scored_only(ev, facts)
    assert rows(kept.select("session_id").distinct(), "session_id") == [(MAIN,), (CRASH,)]
    both = P.scored_only(ev, facts, demo_scaled=False, mock_devices=False)
    assert both.select("session_id").distinct().count() == 4
    assert both.where(field("practice", "boolean")).count() == 0
    assert P.validate_config(manifests).count() == 0


def test_dedupe_after_second_ingest(ev):
    twice = U.union_sessions(ev, ev)
    assert U.dedupe_events(twice).count() == ev.count()
