"""Hand-made session packages in the log's own file format."""

import json
from pathlib import Path

CONFIG = {
    "stress_task": {"trial_order": [1, 2], "tiers": [{"id": 1, "duration_sec": 60, "fall_duration_sec": 3.0}, {"id": 2, "duration_sec": 60, "fall_duration_sec": 2.7}]},
    "attention_highway_task": {
        "lanes": 4, "trial_order": [1, 2],
        "tiers": [
            {"id": 1, "label": "tier_1", "nominal_difficulty": 5, "duration_sec": 60, "spawn_interval_range_sec": [1.0, 1.2], "fall_duration_sec": 2.0, "concurrent_obstacles": 3},
            {"id": 2, "label": "tier_2", "duration_sec": 60, "spawn_interval_range_sec": [0.7, 0.9], "fall_duration_sec": 1.5},
        ],
    },
    "sart_task": {"omit_count": 3},
    "devices": {"mode": "mock", "skip_sync": True, "ear_eeg_out": {"enabled": True}, "wristband": {"enabled": True}, "emotiv_flex": {"enabled": False}},
    "questionnaire": {
        "items": [
            {"id": "age_range", "type": "choice", "options": ["18-24", "25-34"]},
            {"id": "demographics", "type": "group", "fields": [
                {"id": "gender", "type": "choice", "options": ["Female", "Male", "Prefer to self-describe"]},
                {"id": "gender_self_describe", "type": "text", "show_if": {"field": "gender", "equals": "Prefer to self-describe"}},
            ]},
            {"id": "alcohol", "type": "choice", "options": ["Yes", "No"], "enabled": False},
            {"id": "stai6", "type": "multi_rating", "scale_min": 1, "scale_max": 4, "items": [{"id": f"stai_{x}"} for x in ("calm", "tense", "upset", "relaxed", "content", "worried")]},
        ]
    },
}


class Log:
    """One session's event file; `at` moves the clocks, the browser clock runs in ms from `client0`."""

    def __init__(self, root, session_id: str, participant_id: str, start: float = 1_700_000_000.0):
        self.dir = Path(root) / session_id
        self.dir.mkdir(parents=True, exist_ok=True)
        self.session_id, self.participant_id, self.start = session_id, participant_id, start
        self.t, self.client0, self.rows = 0.0, 0.0, []

    def __call__(self, event_type, task=None, block=None, trial=None, cond=None, dt=0.1, **payload):
        self.t = round(self.t + dt, 6)
        payload.setdefault("client_perf_now_ms", round((self.t - self.client0) * 1000, 3))
        self.rows.append(
            {
                "timestamp_host_utc": self.start + self.t, "timestamp_monotonic": 100.0 + self.t, "session_id": self.session_id, "participant_id": self.participant_id, "task": task,
                "block_index": block, "trial_index": trial, "condition_label": cond, "event_type": event_type, "event_payload_json": payload,
            }
        )
        return self

    def checkpoints(self, task, label, n=3, slope=0.001, offset=100.0):
        for i in range(n):
            host = 100.0 + self.t + 0.1
            mid = (host - offset) / slope
            self("sync_checkpoint", task, label=f"{label}_{i}", client_perf_now_before_ms=mid - 1, client_perf_now_after_ms=mid + 1, round_trip_ms=2.0, host_utc_at_receipt=0.0, host_perf_counter_at_receipt=host)

    def write(self, torn: str = "", sync=None, demo_scale=1.0, config=CONFIG):
        text = "".join(json.dumps(r) + "\n" for r in self.rows) + torn
        (self.dir / "events.jsonl").write_text(text, encoding="utf-8")
        manifest = {
            "session_id": self.session_id, "participant_id": self.participant_id, "created_at_utc": self.start, "demo_scale": demo_scale, "rng_seed": self.start,
            "device_sync_records": sync or {}, "config_snapshot": config,
        }
        (self.dir / "session_manifest.json").write_text(json.dumps(manifest, indent=2), encoding="utf-8")
        return self


def record(role, t, result="ok", device=None, **kw):
    return {"device_role": role, "device_id": device or f"{role}-1", "protocol": "p", "sync_time_host_utc": t, "result": result, "detail": kw.pop("detail", ""), **kw}


def stroop_run(log, answers):
    """One process: checkpoints, task_start, baseline block 0, trial block 1."""
    task = "attention_focus_stroop"
    log.client0 = log.t
    log.checkpoints(task, "session_start")
    log("task_start", task)
    log("block_start", task, 0, cond="baseline")
    log("block_end", task, 0, cond="baseline", dt=10, skipped=False)
    log("block_start", task, 1, cond="stroop_trial", n_stimuli=len(answers))
    ok = [rt for c, rt, _ in answers if c]
    for i, (correct, rt, congruent) in enumerate(answers):
        log("trial_start", task, 1, i, "stroop_trial", word="red", ink_color="red" if congruent else "blue", congruent=congruent)
        if correct is not None:
            log("response", task, 1, i, "stroop_trial", dt=rt / 1000, word="red", congruent=congruent, clicked_color="red", correct=correct, rt_ms=rt)
    done = [a for a in answers if a[0] is not None]
    log("block_end", task, 1, cond="stroop_trial", skipped=len(done) < len(answers), accuracy=sum(a[0] for a in done) / len(done), mean_rt_ms=sum(ok) / len(ok), n_trials=len(done))
    log("task_end", task)
    log.checkpoints(task, "session_end")


def sart_run(log):
    """Baseline before task_start, no checkpoints, practice and real block, quit inside the last trial."""
    log("baseline_start", "sart", position="pre_task", duration_sec=30)
    log("baseline_end", "sart", dt=30, position="pre_task")
    log("task_start", "sart", omit_numbers=[3], reps=1, fixed_order=False)
    for block, practice, trials in ((0, True, [(1, True, 0.4)]), (1, False, [(1, True, 0.4), (3, True, 0.3), (3, False, None), (5, False, None), (7, True, 0.6), (8, None, None)])):
        log("block_start", "sart", block, practice=practice, num_trials=len(trials))
        for i, (number, responded, rt) in enumerate(trials):
            omit = number == 3
            log("trial_start", "sart", block, i, practice=practice, number=number, font_size=41.0, is_omit=omit, omit_numbers=[3])
            if responded is not None:
                log("response", "sart", block, i, dt=1.15, practice=practice, number=number, is_omit=omit, responded=responded, rt=rt, accurate=responded != omit)
        log("block_end", "sart", block, practice=practice)


def raindrop_run(log):
    """Misses first, then hits; a pause; a skipped second tier with two silent misses and a genuine one."""
    task = "stress"
    log.client0 = log.t
    log.checkpoints(task, "session_start")
    log("task_start", task)
    log("block_start", task, 0, cond="baseline")
    log("block_end", task, 0, cond="baseline", dt=10, skipped=False)
    log("block_start", task, 1, cond="tier_1", tier=1)
    for i, hit in enumerate([False, False, True, True, False]):
        log("trial_start", task, 1, i, "tier_1", tier=1, expression="12 + 1", correct_answer=13)
        if i == 2:
            log("wrong_submission", task, 1, None, "tier_1", tier=1, participant_answer="1", dt=0.5)
        log("response", task, 1, i, "tier_1", dt=1.0 if hit else 3.0, tier=1, expression="12 + 1", correct_answer=13, participant_answer=13 if hit else None, rt=1.0 if hit else None, correct=hit, missed=not hit)
    log("block_end", task, 1, cond="tier_1", tier=1, skipped=False, accuracy=0.4)
    for _ in range(2):
        log("block_start", task, cond="inter_trial_pause")
        log("block_end", task, cond="inter_trial_pause", dt=2, skipped=False)
    log("block_start", task, 3, cond="tier_2", tier=2)
    for i in range(3):
        log("trial_start", task, 3, i, "tier_2", tier=2, expression="36 / 2", correct_answer=18, dt=0.5)
    log("response", task, 3, 0, "tier_2", dt=1.7, tier=2, participant_answer=None, rt=None, correct=False, missed=True)
    log("response", task, 3, 1, "tier_2", tier=2, participant_answer=None, rt=None, correct=False, missed=True, dt=0.01)
    log("response", task, 3, 2, "tier_2", tier=2, participant_answer=None, rt=None, correct=False, missed=True, dt=0.01)
    log("block_end", task, 3, cond="tier_2", tier=2, skipped=True, accuracy=0.0)
    log("task_end", task)
    log.checkpoints(task, "session_end")


def highway_run(log):
    """Two hazards of one wave in one lane, a dodge with exactly 0.3 s left, an unanswered hit, ticks."""
    task = "attention_highway"
    log.client0 = log.t
    log.checkpoints(task, "session_start")
    log("task_start", task)
    log("block_start", task, 0, cond="baseline")
    log("block_end", task, 0, cond="baseline", dt=5, skipped=False)
    log("block_start", task, 1, cond="tier_1", tier=1, nominal_difficulty=5)
    base = dict(lanes=4, fall_duration_sec=2.0, camp_nudged=False, nominal_difficulty=5)
    log("obstacle_spawn", task, 1, 0, "tier_1", lane=2, spawn_wave_index=0, spawn_wave_size=2, **base)
    log("obstacle_spawn", task, 1, 1, "tier_1", lane=0, spawn_wave_index=0, spawn_wave_size=2, dt=0.0, **base)
    log("state_tick", task, cond="tier_1", tier=1, dt=1.0, player_lane=2, lanes=4, active_obstacle_count=2, blocked_lane_count=2, nearest_time_to_collision_ms=1000.0, own_lane_time_to_collision_ms=1000.0)
    log("lane_change", task, key="a", from_lane=2, to_lane=1, blocked=False, forced=True, reaction_time_ms=1700.0, threatening_trial_index=0, dt=0.7)
    log("obstacle_resolved", task, 1, 0, "tier_1", dt=0.3, lane=2, player_lane=1, outcome="avoided", skipped=False, near_miss=True, no_response=False, response_attempted=True, reaction_margin_sec=0.3)
    log("obstacle_resolved", task, 1, 1, "tier_1", dt=0.0, lane=0, player_lane=1, outcome="avoided", skipped=False, near_miss=False, no_response=False, response_attempted=False, reaction_margin_sec=None)
    log("focus_lost", task, dt=0.2)
    log("focus_regained", task, dt=0.4)
    log("obstacle_spawn", task, 1, 2, "tier_1", lane=1, spawn_wave_index=1, spawn_wave_size=2, **base)
    log("obstacle_spawn", task, 1, 3, "tier_1", lane=1, spawn_wave_index=1, spawn_wave_size=2, dt=0.0, **base)
    log("frame_drop_warning", task, delta_ms=80.0, threshold_ms=50, dt=0.5)
    for i in (2, 3):
        log("obstacle_resolved", task, 1, i, "tier_1", dt=1.5 if i == 2 else 0.0, lane=1, player_lane=1, outcome="collision", skipped=False, near_miss=False, no_response=True, response_attempted=False, reaction_margin_sec=None)
    log("state_tick", task, cond="tier_1", tier=1, dt=0.1, player_lane=1, lanes=4, active_obstacle_count=0, blocked_lane_count=0, nearest_time_to_collision_ms=None, own_lane_time_to_collision_ms=None)
    log("block_end", task, 1, cond="tier_1", tier=1, nominal_difficulty=5, skipped=False, avoided=2, collisions=2)
    log("self_report_response", task, 1, cond="tier_1", tier=1, skipped=False, scale_min=1, scale_max=7, stress=6, stress_rt=1.2, workload=9, workload_rt=0.5)
    log("focus_lost", task)
    log("task_end", task)
    log.checkpoints(task, "session_end")


def schulte_run(log, skipped=False):
    task = "attention_focus_schulte"
    log.client0 = log.t
    log.checkpoints(task, "session_start")
    log("task_start", task)
    log("block_start", task, 1, cond="schulte_trial", grid_size=2)
    for number, expected, correct, rt in ((1, 1, True, 500.0), (3, 2, False, 900.0), (2, 2, True, 1400.0)):
        log("cell_click", task, number_clicked=number, expected_number=expected, correct=correct, rt_ms=rt, dt=0.4)
    log("cell_click", task, number_clicked=1, expected_number=3, correct=None, repeat=True)
    if not skipped:
        for number, rt in ((3, 2000.0), (4, 2600.0)):
            log("cell_click", task, number_clicked=number, expected_number=number, correct=True, rt_ms=rt, dt=0.4)
    log("block_end", task, 1, cond="schulte_trial", grid_size=2, skipped=skipped, completion_time_sec=None if skipped else 2.6, misclicks=1)
    log("task_end", task)
    log.checkpoints(task, "session_end")


def emotion_run(log, quit_in_block=None):
    task = "emotion"
    log.client0 = log.t
    log.checkpoints(task, "session_start")
    log("task_start", task)
    for b, clips in enumerate([["clip_01", "clip_02", "clip_03"], ["clip_04", "clip_05"]]):
        log("block_start", task, b, condition_labels=["positive"], num_trials=len(clips))
        log("baseline_start", task, b, position="start", duration_sec=60)
        log("baseline_end", task, b, dt=60, position="start")
        for i, c in enumerate(clips):
            log("trial_start", task, b, i, "positive", clip_id=c, fine_grained_label="joy")
            log("clip_playback_start", task, clip_id=c, file_path="x")
            log("clip_video_metadata", task, clip_id=c, native_width=1280, native_height=676 if c == "clip_02" else 720, object_fit="fill" if c == "clip_03" else "contain", below_720p=c == "clip_02")
            if quit_in_block == b:
                log("rating_response", task, b, i, "positive", clip_id=c, emotion_pick=None, emotion_pick_rt=None, skipped=True)
                return
            log("clip_playback_end", task, dt=20, clip_id=c, wall_duration_sec=20.0)
            log("rating_response", task, b, i, "positive", dt=5, clip_id=c, emotion_pick="Positive" if i else "Neutral", emotion_pick_rt=1.0, skipped=False, valence=5, valence_rt=0.5, arousal=i + 1, arousal_rt=0.7)
        log("block_end", task, b, condition_labels=["positive"], skipped=False)
    log("task_end", task)
    log.checkpoints(task, "session_end")


def questionnaire(log):
    t = "preparation"
    log.checkpoints(t, "session_start")
    log("phase_start", t)
    log("questionnaire_response", t, item_id="gender", value="Prefer to self-describe", rt=1.0)
    log("questionnaire_response", t, item_id="gender_self_describe", value="x", rt=1.0)
    log("questionnaire_response", t, item_id="age_range", value="18-24", rt=1.0)
    log("questionnaire_response", t, item_id="gender", value="Male", rt=1.0)
    log("questionnaire_response", t, item_id="age_range", value="99", rt=1.0)
    log("questionnaire_response", t, item_id="alcohol", value="Yes", rt=1.0)
    for item, v in (("calm", 4), ("tense", 2), ("upset", 1), ("relaxed", 3), ("content", 4), ("worried", 1)):
        log("questionnaire_response", t, item_id=f"stai_{item}", value=v, rt=1.0)


def build(root):
    """A small study; returns its folder."""
    main = Log(root, "P_01_1700000000", "P_01")
    questionnaire(main)
    emotion_run(main)
    raindrop_run(main)
    highway_run(main)
    schulte_run(main)
    stroop_run(main, [(True, 500, True), (False, 900, False), (True, 700, False)])
    stroop_run(main, [(True, 400, True), (True, 600, False), (None, None, False)])
    main.checkpoints("debrief", "session_end")
    main("session_end", "debrief")
    main.write(sync={"ear_eeg_out": [record("ear_eeg_out", 1_700_000_000.0)], "wristband": [record("wristband", 1_700_000_001.0, "error", detail="timeout")]})

    follow = Log(root, "P_01_sart_1700005000", "P_01", 1_700_005_000.0)
    sart_run(follow)
    follow("session_end", "sart")
    follow.write(sync={"ear_eeg_out": [record("ear_eeg_out", 1_700_005_000.0, device="mock-ear_eeg_out")]})

    quitter = Log(root, "P_02_1700010000", "P_02", 1_700_010_000.0)
    emotion_run(quitter, quit_in_block=1)
    quitter("session_aborted")
    quitter.write(demo_scale=0.1)

    crash = Log(root, "P_03_1700020000", "P_03", 1_700_020_000.0)
    schulte_run(crash, skipped=True)
    crash("session_crashed", traceback="boom")
    crash.write(torn='{"timestamp_host_utc": 17000')
    return str(root)
