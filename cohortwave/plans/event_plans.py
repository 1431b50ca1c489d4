"""Plans over the event log: projections, pairing, scans and clocks."""

from pyspark.sql import functions as F

from cohortwave import keep
from cohortwave.functions.ordered import running
from cohortwave.functions.scalars import client_to_host
from cohortwave.operators import joins as J, project as P, quality as Q, sets as U, stats as A, windows as X
from cohortwave.plans.registry import plan
from cohortwave.plans.views import EV, Tables
from cohortwave.schema import HOST, MONO, ORDER, PAY, RUN

SES = ["session_id"]


def r(c, n: int = 4):
    return F.round(c, n)


@plan("SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'error')")
def filter_type(d: Tables):
    return P.filter_event_type(d.events, "click", "error").select("event_id", "event_type", "value")


@plan("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.absent') AS VARCHAR) AS absent FROM events")
def payload_field(d: Tables):
    return P.payload(d.study({}), {"k": "int", "absent": "string"}).select(F.col("event_seq").alias("event_id"), "k", "absent")


@plan(
    EV
    + """SELECT session_id, seq AS event_seq, et AS event_type FROM ev
  WHERE et <> 'signup' AND k >= 5 AND user_id % 10 <> 0 AND user_id % 7 <> 0"""
)
def scored_only(d: Tables):
    ev = d.ev.withColumn("task", F.when(F.col("event_type") == "signup", "familiarization").otherwise("stress"))
    sessions = d.events.select("user_id").distinct().select(
        F.col("user_id").cast("string").alias("session_id"), F.when(F.col("user_id") % 10 == 0, 0.5).otherwise(1.0).alias("demo_scale"),
        (F.col("user_id") % 7 == 0).alias("mock_device"),
    )
    return P.scored_only(ev, sessions, practice=F.col("k") < 5).select("session_id", "event_seq", "event_type")


@plan("SELECT event_id, epoch_us(ts) AS us FROM events")
def event_time(d: Tables):
    return P.event_time(d.ev.withColumn(HOST, F.col(MONO))).select(F.col("event_seq").alias("event_id"), F.unix_micros("ts").alias("us"))


@plan(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'sart' END AS session_task,
       CAST(epoch(o_orderdate) AS BIGINT) AS session_start_unix FROM orders"""
)
def session_id_parts(d: Tables):
    who = F.concat(F.lit("P_"), "o_custkey")
    unix = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    task = F.when(F.col("o_orderkey") % 3 != 0, F.lit("sart"))
    df = d.orders.select("o_orderkey", who.alias("participant_id"), F.concat_ws("_", who, task, unix.cast("string")).alias("session_id"))
    return P.parse_session_id(df).select("o_orderkey", "session_task", "session_start_unix")


_RUNS = (
    EV
    + """, m AS (
  SELECT session_id, t, seq, CASE WHEN et = 'error' AND k < 50 THEN 'C' WHEN et = 'signup' THEN 'T' END AS m FROM ev),
 o AS (SELECT session_id, t, seq FROM (
   SELECT *, lag(m) OVER (PARTITION BY session_id ORDER BY t, seq) AS prev FROM m WHERE m IS NOT NULL) WHERE m = 'C' OR prev IS NULL OR prev <> 'C'),
 runs AS (SELECT ev.session_id, ev.seq, ev.et, ev.t, count(o.seq) OVER (PARTITION BY ev.session_id ORDER BY ev.t, ev.seq) AS n
   FROM ev LEFT JOIN o ON o.session_id = ev.session_id AND o.seq = ev.seq)
"""
)


@plan(_RUNS + "SELECT session_id, seq AS event_seq, CAST(n + CASE WHEN et = 'view' AND seq % 2 = 0 THEN 1 ELSE 0 END AS INT) AS run_ordinal FROM runs")
def run_ordinal(d: Tables):
    ev = d.study({"signup": "task_start", "error": "sync_checkpoint", "view": "baseline_start"}).drop("run_ordinal")
    label = F.when(F.col("k") < 50, "session_start_0").otherwise("session_end_0")
    pos = F.when(F.col("event_seq") % 2 == 0, "pre_task").otherwise("mid")
    return P.assign_run_ordinal(ev, d.cuts(), label, pos).select("session_id", "event_seq", "run_ordinal")


@plan(
    EV
    + """SELECT seq AS event_seq, CASE WHEN user_id % 3 = 0 THEN seq ELSE seq END AS trial_index,
     round(CASE user_id % 3 WHEN 0 THEN value WHEN 1 THEN value / 1000 ELSE value END, 6) AS rt_sec,
     CASE user_id % 3 WHEN 0 THEN k > 50 WHEN 1 THEN k > 30 ELSE k > 70 END AS correct,
     CASE user_id % 3 WHEN 0 THEN k > 10 WHEN 1 THEN true ELSE k > 20 END AS responded,
     CASE user_id % 3 WHEN 0 THEN '1 + ' || k WHEN 1 THEN 'red' ELSE CAST(k % 9 AS VARCHAR) END AS stimulus
   FROM ev WHERE et = 'click'"""
)
def normalised_trials(d: Tables):
    k, v, u = F.col("k"), F.col("value"), F.col("session_id").cast("bigint") % 3
    rain = F.to_json(F.struct(v.alias("rt"), (k > 50).alias("correct"), (k <= 10).alias("missed"), F.concat(F.lit("1 + "), k).alias("expression")))
    stroop = F.to_json(F.struct(v.alias("rt_ms"), (k > 30).alias("correct"), F.lit("blue").alias("clicked_color"), F.lit("red").alias("word")))
    sart = F.to_json(F.struct(v.alias("rt"), (k > 70).alias("accurate"), (k > 20).alias("responded"), (k % 9).alias("number")))
    body = F.try_parse_json(F.when(u == 0, rain).when(u == 1, stroop).otherwise(sart))
    ev = d.study({"click": "response"}, body).withColumn("trial_index", F.col("event_seq"))
    out = P.normalise_trials(ev.where("event_type = 'response'"))
    return out.select(F.col("trial_index").alias("event_seq"), "trial_index", r("rt_sec", 6).alias("rt_sec"), "correct", "responded", "stimulus")


@plan(
    EV
    + """SELECT seq AS event_seq, CASE et WHEN 'view' THEN k % 25 WHEN 'signup' THEN seq - 1 ELSE seq END AS trial_index,
     round(CASE et WHEN 'click' THEN value / 1000 ELSE value END, 6) AS rt_sec, CASE et WHEN 'view' THEN 'since_block_start' ELSE 'since_stimulus' END AS unit,
     CASE et WHEN 'view' THEN k > 50 WHEN 'click' THEN k > 30 WHEN 'purchase' THEN NULL WHEN 'signup' THEN k > 40 ELSE k > 70 END AS correct,
     CASE et WHEN 'purchase' THEN k % 4 <> 0 WHEN 'signup' THEN k >= 10 WHEN 'error' THEN k > 20 ELSE true END AS responded, et = 'purchase' AND k % 4 = 0 AS skipped,
     CASE WHEN et = 'error' THEN k <= 20 END AS missed, et = 'purchase' AND k % 5 = 0 AS repeat, CASE WHEN et = 'signup' THEN k / 2.0::DOUBLE END AS participant_answer,
     CASE et WHEN 'view' THEN CAST(k % 25 AS VARCHAR) WHEN 'click' THEN 'red' WHEN 'purchase' THEN 'clip_' || k WHEN 'signup' THEN k || ' - 1' ELSE '1 + ' || k END AS stimulus
   FROM ev WHERE et IN ('view', 'click', 'purchase', 'signup', 'error')"""
)
def trial_shapes(d: Tables):
    """All payload shapes: cell clicks, colour words, ratings, the retired arithmetic task with its index from 1, falling drops."""
    k, v = F.col("k"), F.col("value")
    shapes = {
        "view": [v.alias("rt"), (k > 50).alias("correct"), (k % 25).alias("number_clicked")],
        "click": [v.alias("rt_ms"), (k > 30).alias("correct"), F.lit("blue").alias("clicked_color"), F.lit("red").alias("word")],
        "purchase": [v.alias("emotion_pick_rt"), F.when(k % 4 != 0, "calm").alias("emotion_pick"), F.concat(F.lit("clip_"), k).alias("clip_id"), (k % 4 == 0).alias("skipped"), (k % 5 == 0).alias("repeat")],
        "signup": [v.alias("rt"), (k > 40).alias("correct"), (k < 10).alias("timed_out"), F.concat(k, F.lit(" - 1")).alias("expression"), (k / 2).alias("participant_answer")],
        "error": [v.alias("rt"), (k > 70).alias("correct"), (k <= 20).alias("missed"), F.concat(F.lit("1 + "), k).alias("expression")],
    }
    body = F.coalesce(*[F.when(F.col("event_type") == et, F.to_json(F.struct(*fields))) for et, fields in shapes.items()])
    names = {"view": "cell_click", "click": "response", "purchase": "rating_response", "signup": "response", "error": "response"}
    ev = d.study({}, F.try_parse_json(body))
    named = F.coalesce(*[F.when(F.col("event_type") == et, F.lit(n)) for et, n in names.items()])
    ev = ev.withColumns({"event_type": named, "trial_index": F.col("event_seq"), "block_index": F.col("event_seq")})
    out = P.normalise_trials(ev).withColumnRenamed("block_index", "event_seq")
    return out.select("event_seq", "trial_index", r("rt_sec", 6).alias("rt_sec"), "unit", "correct", "responded", "skipped", "missed", "repeat", "participant_answer", "stimulus")


@plan(
    EV
    + """SELECT session_id, CASE WHEN bool_or(et = 'error' AND k = 0) THEN 'crashed' WHEN bool_or(et = 'purchase' AND k < 3) THEN 'aborted'
      WHEN bool_or(et = 'signup' AND k < 20) THEN 'completed' ELSE 'truncated' END AS status FROM ev GROUP BY 1"""
)
def session_status(d: Tables):
    et, k = F.col("event_type"), F.col("k")
    new = F.when((et == "error") & (k == 0), "session_crashed").when((et == "purchase") & (k < 3), "session_aborted").when((et == "signup") & (k < 20), "session_end").otherwise(et)
    return P.session_status(d.ev.withColumn("event_type", new))


def _blocks(d: Tables, done: bool = True):
    """view opens a block, purchase closes it."""
    ev = d.study({"view": "block_start", "purchase": "block_end"})
    b = J.pair_blocks(ev, d.cuts(), closed_only=done)
    # blocks are a fact table that the operators behind read several times
    return keep(b, "blocks") if done else b


_BLOCKS = (
    EV
    + """, pairs AS (SELECT *, lead(et) OVER w AS net, lead(t) OVER w AS nt, lead(h) OVER w AS nh FROM ev WHERE et IN ('view', 'purchase')
     WINDOW w AS (PARTITION BY session_id ORDER BY t, seq)),
  ends AS (SELECT session_id, max(t) AS last_t FROM ev GROUP BY 1),
  blocks AS (SELECT session_id, seq, k, value, t AS t0, CASE WHEN net = 'purchase' THEN nt ELSE last_t END AS t1,
     coalesce(net <> 'purchase', true) AS truncated FROM pairs JOIN ends USING (session_id) WHERE et = 'view'),
  done AS (SELECT * FROM blocks WHERE NOT truncated)
"""
)


@plan(_BLOCKS + "SELECT session_id, t0, t1, truncated FROM blocks")
def pair_blocks(d: Tables):
    return _blocks(d, False).select("session_id", "t0", "t1", "truncated")


@plan(_BLOCKS + "SELECT session_id, t0, t1 FROM done")
def completed_blocks(d: Tables):
    return P.completed_only(_blocks(d, False)).select("session_id", "t0", "t1")


@plan(
    EV
    + """, p AS (SELECT *, lead(et) OVER w AS net, lead(t) OVER w AS nt FROM ev WHERE et IN ('click', 'error')
       WINDOW w AS (PARTITION BY session_id, k % 2 ORDER BY t, seq)),
  last AS (SELECT session_id, max(t) AS last_t FROM ev GROUP BY 1)
  SELECT session_id, CASE k % 2 WHEN 0 THEN 'start' ELSE 'end' END AS position, t AS t0, round(CASE WHEN net = 'error' THEN nt ELSE last_t END - t, 4) AS real_sec,
    value AS planned_sec, coalesce(net, '') <> 'error' AS truncated
  FROM p JOIN last USING (session_id) WHERE et = 'click'"""
)
def pair_baselines(d: Tables):
    body = F.try_parse_json(F.to_json(F.struct(F.when(F.col("k") % 2 == 0, "start").otherwise("end").alias("position"), F.col("value").alias("duration_sec"))))
    b = J.pair_baselines(d.study({"click": "baseline_start", "error": "baseline_end"}, body), d.cuts())
    return b.select("session_id", "position", "t0", r("real_sec").alias("real_sec"), "planned_sec", "truncated")


@plan(
    EV
    + """SELECT a.session_id, a.k, a.seq AS start_seq, b.seq AS response_seq, b.value AS rt FROM ev a
    LEFT JOIN ev b ON a.session_id = b.session_id AND a.k = b.k AND b.et = 'click' WHERE a.et = 'view'"""
)
def pair_trials(d: Tables):
    starts = d.ev.where("event_type = 'view'").select("session_id", "k", F.col("event_seq").alias("start_seq"))
    resp = d.ev.where("event_type = 'click'").select("session_id", "k", F.col("event_seq").alias("response_seq"), F.col("value").alias("rt"))
    return J.pair_trials(starts, resp, ["session_id", "k"])


@plan(
    EV
    + """SELECT session_id, k, 'no_end' AS problem FROM ev a WHERE et = 'view' AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.session_id = a.session_id AND b.k = a.k AND b.et = 'click')
    UNION ALL SELECT session_id, k, 'no_start' FROM ev a WHERE et = 'click' AND NOT EXISTS (SELECT 1 FROM ev b WHERE b.session_id = a.session_id AND b.k = a.k AND b.et = 'view')"""
)
def orphans(d: Tables):
    return Q.orphans(d.ev.where("event_type = 'view'"), d.ev.where("event_type = 'click'"), ["session_id", "k"])


@plan(
    _BLOCKS
    + """SELECT p.session_id, p.seq AS event_seq, CASE WHEN p.t <= b.t1 THEN b.t0 END AS block_t0
    FROM (SELECT * FROM ev WHERE et = 'click') p ASOF LEFT JOIN done b ON p.session_id = b.session_id AND p.t >= b.t0"""
)
def attach_block(d: Tables):
    blocks = _blocks(d).withColumn("block_index", F.col("t0"))
    points = d.ev.where("event_type = 'click'")
    return J.attach_block(points, blocks, MONO, RUN, d.cuts()).select("session_id", "event_seq", F.col("block_index").alias("block_t0"))


@plan(
    EV
    + """SELECT p.session_id, p.seq AS event_seq, CASE WHEN p.t - f.t <= 172800 THEN f.value END AS state_value,
       CASE WHEN p.t - f.t <= 172800 THEN f.seq END AS state_seq
    FROM (SELECT * FROM ev WHERE et = 'purchase') p ASOF LEFT JOIN (SELECT * FROM ev WHERE et = 'view') f ON p.session_id = f.session_id AND p.t >= f.t"""
)
def asof_state(d: Tables):
    ticks = d.ev.where("event_type = 'view'").select("session_id", "t", F.col("value").alias("state_value"), F.col("event_seq").alias("state_seq"))
    points = d.ev.where("event_type = 'purchase'").select("session_id", "event_seq", "t")
    return J.asof_state(points, ticks, ["state_value", "state_seq"], SES, tie="state_seq", tolerance=172800.0, width=d.cuts()).drop("t")


@plan(
    _BLOCKS
    + """, base AS (SELECT session_id, t AS b0, nt AS b1 FROM (SELECT *, lead(et) OVER w AS net, lead(t) OVER w AS nt FROM ev WHERE et IN ('click', 'error')
       WINDOW w AS (PARTITION BY session_id ORDER BY t, seq)) WHERE et = 'click' AND net = 'error')
    SELECT d.session_id, d.t0, b.b0 AS baseline_t0, b.b1 AS baseline_t1 FROM done d ASOF LEFT JOIN base b ON d.session_id = b.session_id AND d.t0 >= b.b1"""
)
def asof_baseline(d: Tables):
    base = keep(J.pair_baselines(d.study({"click": "baseline_start", "error": "baseline_end"}), d.cuts(), closed_only=True), "baselines")
    return J.asof_baseline(_blocks(d), base, RUN, d.cuts()).select("session_id", "t0", "baseline_t0", "baseline_t1")


@plan(
    _BLOCKS
    + """SELECT session_id, t0, t1, EXISTS (SELECT 1 FROM ev e WHERE e.session_id = d.session_id AND e.et = 'error' AND e.t - 3600 <= d.t1 AND e.t + 3600 >= d.t0) AS invalid FROM done d"""
)
def mask_invalid(d: Tables):
    bad = d.ev.where("event_type = 'error'").select(*RUN, F.col("t").alias("t0"), F.col("t").alias("t1"))
    return J.mask_invalid(_blocks(d), bad, RUN, 3600.0, width=d.cuts()).select("session_id", "t0", "t1", "invalid")


@plan(
    _BLOCKS
    + """SELECT session_id, t0, t1, EXISTS (SELECT 1 FROM ev e WHERE e.session_id = d.session_id AND e.et = 'signup' AND e.t >= d.t0 - 60 AND e.t <= d.t1 + 60) AS invalid FROM done d"""
)
def frame_drop_flags(d: Tables):
    drops = d.ev.where("event_type = 'signup'").select(*RUN, "t")
    return Q.frame_drop_flags(_blocks(d), drops, 60.0, RUN, width=d.cuts()).select("session_id", "t0", "t1", "invalid")


@plan(
    EV
    + """, p AS (SELECT *, lead(et) OVER w AS net, lead(t) OVER w AS nt, max(t) OVER (PARTITION BY session_id) AS last_t FROM
       (SELECT *, max(t) OVER (PARTITION BY session_id) AS mx FROM ev) e WHERE et IN ('error', 'click') WINDOW w AS (PARTITION BY session_id ORDER BY t, seq))
    SELECT session_id, t AS t0, CASE WHEN net = 'click' THEN nt ELSE mx END AS t1 FROM p WHERE et = 'error'"""
)
def focus_loss(d: Tables):
    return Q.focus_loss_intervals(d.study({"error": "focus_lost", "click": "focus_regained"}), RUN, d.cuts()).select("session_id", "t0", "t1")


_SCORE = (
    EV
    + """, s AS (SELECT session_id, seq, t, et, CASE et WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS d FROM ev WHERE et IN ('purchase', 'error', 'view')),
  p AS (SELECT *, sum(d) OVER (PARTITION BY session_id ORDER BY t, seq) AS p FROM s),
  sc AS (SELECT session_id, seq, t, CAST(p - least(0, min(p) OVER (PARTITION BY session_id ORDER BY t, seq)) AS BIGINT) AS score FROM p),
  fin AS (SELECT session_id, arg_max(score, seq) AS final_score, max(t) AS ended_at, max(seq) AS seq FROM sc GROUP BY 1)
"""
)


def _scores(d: Tables):
    """purchase is a hit, error a miss, view a silently cleared drop."""
    tr = d.ev.where("event_type IN ('purchase', 'error', 'view')").withColumns({"correct": F.col("event_type") == "purchase", "silent": F.col("event_type") == "view"})
    return X.clamped_score(tr, ORDER, SES, d.cuts())


@plan(_SCORE + "SELECT session_id, seq AS event_seq, score FROM sc")
def clamped_score(d: Tables):
    return _scores(d).select("session_id", "event_seq", "score")


def _finals(d: Tables):
    return A.final_score(_scores(d), "event_seq", SES)


@plan(_SCORE + "SELECT session_id, final_score FROM fin")
def final_score(d: Tables):
    return _finals(d).select("session_id", "final_score")


@plan(_SCORE + "SELECT session_id, final_score FROM fin ORDER BY final_score DESC, seq LIMIT 1")
def high_score(d: Tables):
    return A.high_score(_finals(d), "session_id").select("session_id", "final_score")


@plan(
    _SCORE
    + """SELECT session_id, final_score, best AS previous_best FROM (
    SELECT *, max(final_score) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM fin) WHERE best IS NULL OR final_score > best"""
)
def record_history(d: Tables):
    return X.record_history(_finals(d), ["ended_at"], "final_score", (), d.cuts("ev", "event_seq", None)).select("session_id", "final_score", "previous_best")


_MS = EV + ", x AS (SELECT *, epoch_us(ts) AS us FROM ev)\n"


@plan(
    _MS
    + """SELECT session_id, seq AS event_seq, round(avg(CASE WHEN et = 'error' THEN 1.0 ELSE 0.0 END) OVER
    (PARTITION BY session_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW), 6) AS rate FROM x WHERE et IN ('error', 'purchase')"""
)
def rolling_rate(d: Tables):
    o = d.ev.where("event_type IN ('error', 'purchase')").withColumns({"resolve_ms": F.unix_micros("ts"), "outcome": F.when(F.col("event_type") == "error", "collision").otherwise("avoided")})
    # microseconds here, so that the frame is exact on integers
    out = X.rolling_collision_rate(o, "resolve_ms", SES, 86_400_000, d.cuts(tie=None).times(1e6))
    return out.select("session_id", "event_seq", r("rolling_collision_rate", 6).alias("rate"))


@plan(
    _MS
    + """SELECT session_id, seq AS event_seq, round(avg(CASE WHEN et = 'click' THEN value END) OVER
    (PARTITION BY session_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW), 8) AS rt FROM x WHERE et IN ('click', 'view')"""
)
def rolling_avg(d: Tables):
    c = d.ev.where("event_type IN ('click', 'view')").select("session_id", "event_seq", F.unix_micros("ts").alias("client_ms"), (F.col("event_type") == "click").alias("forced"), F.col("value").alias("reaction_time_ms"))
    out = X.rolling_avg_rt(c, "client_ms", SES, 86_400_000, d.cuts(tie=None).times(1e6))
    return out.select("session_id", "event_seq", r("rolling_avg_reaction_time_ms", 8).alias("rt"))


@plan(EV + "SELECT session_id, seq AS event_seq, round(t - max(CASE WHEN et = 'error' THEN t END) OVER (PARTITION BY session_id ORDER BY t, seq), 4) AS since FROM ev")
def time_since_last(d: Tables):
    out = X.time_since_last(d.ev, F.col("event_type") == "error", "since", "t", ORDER, SES, d.cuts())
    return out.select("session_id", "event_seq", r("since").alias("since"))


@plan(
    EV
    + """, c AS (SELECT session_id, t FROM ev WHERE et = 'click' AND k % 3 <> 0 UNION ALL SELECT session_id, min(t) FROM ev WHERE et = 'signup' GROUP BY 1)
    SELECT s.session_id, s.seq AS event_seq, round(s.t - c.t, 4) AS in_lane, round(CASE WHEN c.t IS NULL THEN NULL WHEN s.t - c.t - 3600 <= 0 THEN 0.0 ELSE least(1.0, (s.t - c.t - 3600) / 36000) * 0.8 END, 6) AS p
    FROM (SELECT * FROM ev WHERE et = 'view') s ASOF LEFT JOIN c ON s.session_id = c.session_id AND s.t >= c.t"""
)
def camp_exposure(d: Tables):
    spawns = d.ev.where("event_type = 'view'").select("session_id", "event_seq", "t")
    moves = d.ev.where("event_type = 'click'").select("session_id", "t", (F.col("k") % 3 == 0).alias("blocked"))
    starts = d.ev.where("event_type = 'signup'").select("session_id", F.col("t").alias("t0"))
    out = X.camp_exposure(spawns, moves, starts, 3600.0, 36000.0, 0.8, SES, width=d.cuts())
    return out.select("session_id", "event_seq", r("time_in_lane_sec").alias("in_lane"), r("nudge_probability", 6).alias("p"))


@plan(EV + "SELECT session_id, seq AS event_seq, round(value - coalesce(lag(value) OVER (PARTITION BY session_id ORDER BY t, seq), 0), 4) AS search FROM ev WHERE et = 'click'")
def inter_click_time(d: Tables):
    c = d.ev.withColumn("correct", F.col("event_type") == "click")
    return X.inter_click_time(c, ORDER, SES, "value", d.cuts()).select("session_id", "event_seq", r("search_sec").alias("search"))


@plan(
    EV
    + """SELECT session_id, seq AS event_seq, round(t - pt, 4) AS gap, abs((h - ph) - (t - pt)) > 0.05 AND pt IS NOT NULL AS stepped FROM (
    SELECT *, lag(t) OVER w AS pt, lag(h) OVER w AS ph FROM ev WINDOW w AS (PARTITION BY session_id ORDER BY t, seq))"""
)
def clock_step(d: Tables):
    return Q.clock_step(d.ev, SES, width=d.cuts()).select("session_id", "event_seq", r("gap_sec").alias("gap"), F.coalesce("stepped", F.lit(False)).alias("stepped"))


@plan(
    EV
    + """SELECT et AS phase, round(max(t - pt), 4) AS longest_gap_sec FROM (SELECT *, lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) AS pt FROM ev) GROUP BY 1"""
)
def longest_gap(d: Tables):
    out = Q.longest_gap(Q.clock_step(d.ev, SES, width=d.cuts()), ["event_type"])
    return out.select(F.col("event_type").alias("phase"), r("longest_gap_sec").alias("longest_gap_sec"))


@plan(
    """WITH RECURSIVE q AS (SELECT user_id, epoch_us(ts) / 1e6 AS t, event_id FROM events WHERE value > 20),
  f AS (SELECT user_id, min(t) AS t FROM q GROUP BY 1),
  kept(user_id, t) AS (SELECT user_id, t FROM f UNION ALL
    SELECT n.user_id, n.t FROM (SELECT k.user_id, (SELECT min(q.t) FROM q WHERE q.user_id = k.user_id AND q.t > k.t + 43200) AS t FROM kept k) n WHERE n.t IS NOT NULL)
  SELECT CAST(user_id AS VARCHAR) AS session_id, t FROM kept"""
)
def debounce(d: Tables):
    return Q.debounce(d.ev, SES, "t", 43200.0, qualifies=F.col("value") > 20, width=d.cuts(tie=None)).select("session_id", "t")


@plan(EV + "SELECT session_id, k, arg_max(value, (t, seq)) AS value FROM ev WHERE et = 'click' GROUP BY 1, 2")
def latest_answers(d: Tables):
    a = d.ev.where("event_type = 'click'").select("session_id", F.col("k").alias("item_id"), "value", *ORDER)
    return U.latest_answers(a, F.struct(*ORDER)).select("session_id", F.col("item_id").alias("k"), "value")


@plan(
    EV
    + """, l AS (SELECT session_id, k, arg_max(value, (t, seq)) AS value FROM ev GROUP BY 1, 2)
    SELECT l.session_id, l.k, l.value FROM l LEFT JOIN l p ON p.session_id = l.session_id AND p.k = l.k - 1 AND l.k % 5 = 4
    WHERE l.k % 7 <> 0 AND (l.k % 5 <> 4 OR p.value > 50)"""
)
def visible_answers(d: Tables):
    """Conditional items (k mod 5 = 4) show when the item before was answered with `high`; k mod 7 = 0 is disabled."""
    a = d.ev.select("session_id", F.col("k").alias("item_id"), F.struct("value", F.when(F.col("value") > 50, "high").otherwise("low").alias("band")).alias("v"), *ORDER)
    rules = d.ev.select(F.col("k").alias("item_id")).distinct().select(
        "item_id", (F.col("item_id") % 7 != 0).alias("enabled"), F.when(F.col("item_id") % 5 == 4, F.col("item_id") - 1).alias("parent"), F.lit("high").alias("equals")
    )
    last = U.latest_answers(a, F.struct(*ORDER), value="v").select("session_id", "item_id", "v.band", "v.value")
    shown = U.latest_answers(last.withColumn("o", F.lit(0)), F.col("o"), value="band", rules=rules)
    return last.join(shown.select("session_id", "item_id"), ["session_id", "item_id"]).select("session_id", F.col("item_id").alias("k"), "value")


@plan("SELECT count(*) AS n FROM events")
def union_dedupe(d: Tables):
    twice = U.union_sessions(d.events, d.events.drop("value"))
    ev = twice.select(F.col("user_id").alias("session_id"), F.col("ts").alias(MONO), "event_type", F.col("props").alias(PAY))
    return U.dedupe_events(ev, ["session_id", MONO, "event_type"]).agg(F.count("*").alias("n"))


@plan(EV + "SELECT DISTINCT session_id, t, et AS event_type, props FROM ev JOIN events ON event_id = seq")
def deduped_events(d: Tables):
    """The log ingested twice, the second time without one column: every row is there once."""
    twice = U.union_sessions(d.ev, d.ev.drop("value"))
    ev = twice.select("session_id", F.col("t").alias(MONO), "event_type", F.col("props").alias(PAY))
    return U.dedupe_events(ev, ["session_id", MONO, "event_type"]).select("session_id", F.col(MONO).alias("t"), "event_type", F.col(PAY).alias("props"))


@plan(EV + "SELECT session_id, k, count(*) AS times, count(DISTINCT et) AS sessions FROM ev GROUP BY 1, 2 HAVING count(*) > 1")
def repeat_exposure(d: Tables):
    return U.repeat_exposure(d.ev, "session_id", "k", "event_type")


@plan(EV + "SELECT session_id, list_sort(list(DISTINCT et)) AS labels FROM ev GROUP BY 1")
def distinct_conditions(d: Tables):
    return U.distinct_conditions(d.ev, SES, "event_type").withColumnRenamed("condition_labels", "labels")


@plan(EV + "SELECT session_id, count(*) AS n, round(regr_slope(k, value), 6) AS slope, round(regr_intercept(k, value), 4) AS intercept FROM ev WHERE et <> 'error' AND value <= 400 GROUP BY 1")
def clock_fit(d: Tables):
    p = d.ev.where("event_type <> 'error'").select("session_id", F.col("value").alias("client_mid_ms"), F.col("k").cast("double").alias("host_counter"), F.col("value").alias("round_trip_ms"))
    return A.clock_fit(p, SES, 400.0).select("session_id", "n", r("slope", 6).alias("slope"), r("intercept").alias("intercept"))


@plan(
    EV
    + """, f AS (SELECT session_id, regr_slope(k, value) AS a, regr_intercept(k, value) AS b FROM ev WHERE et = 'error' GROUP BY 1)
    SELECT ev.session_id, seq AS event_seq, round(coalesce(a * value + b, t), 3) AS host_t, coalesce(a * value + b, NULL) IS NOT NULL AS fitted FROM ev LEFT JOIN f USING (session_id)"""
)
def client_to_host_time(d: Tables):
    p = d.ev.where("event_type = 'error'").select("session_id", F.col("value").alias("client_mid_ms"), F.col("k").cast("double").alias("host_counter"), F.lit(0.0).alias("round_trip_ms"))
    out = client_to_host(d.ev, A.clock_fit(p, SES), "value", "t", SES)
    return out.select("session_id", "event_seq", r("host_t", 3).alias("host_t"), F.col("clock_fitted").alias("fitted"))


@plan(EV + "SELECT session_id, round(median(h - t), 4) AS median_offset, round(max(h - t) - min(h - t), 4) AS spread FROM ev GROUP BY 1")
def host_clock_fit(d: Tables):
    return A.host_clock_fit(d.ev, SES).select("session_id", r("median_offset").alias("median_offset"), r("spread").alias("spread"))


@plan(
    EV
    + """SELECT session_id, et AS device_role, count(*) AS attempts, CASE WHEN bool_or(k % 10 = 0) THEN 'mock' WHEN bool_or(k >= 90) THEN 'ok' ELSE 'error' END AS state FROM ev GROUP BY 1, 2"""
)
def sync_health(d: Tables):
    sync = d.ev.select(
        "session_id", F.col("event_type").alias("device_role"), F.when(F.col("k") % 10 == 0, "mock-x").otherwise("real").alias("device_id"), F.col("t").alias("sync_time_host_utc"),
        F.when(F.col("k") >= 90, "ok").otherwise("error").alias("result"), F.col("props").alias("detail"),
    )
    return A.sync_health(sync).select("session_id", "device_role", "attempts", "state")


@plan(
    EV
    + """, c AS (SELECT session_id, et, t, seq, date_trunc('day', ts) AS day FROM ev)
    SELECT session_id, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS problems FROM (
      SELECT session_id, count(DISTINCT k) AS n FROM ev GROUP BY session_id, et UNION ALL SELECT session_id, count(DISTINCT et) FROM ev GROUP BY session_id, k) GROUP BY 1 HAVING sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) > 0"""
)
def ambiguous_devices(d: Tables):
    sync = d.ev.select("session_id", F.col("event_type").alias("device_role"), F.col("k").cast("string").alias("device_id"))
    return Q.ambiguous_devices(sync).groupBy("session_id").agg(F.count("*").alias("problems"))


@plan(EV + "SELECT DISTINCT session_id, et AS device_role FROM ev a WHERE NOT EXISTS (SELECT 1 FROM ev b WHERE b.session_id = a.session_id AND b.et = a.et AND b.k >= 80)")
def unaligned_devices(d: Tables):
    dev = d.ev.select("session_id", F.col("event_type").alias("device_role"), F.when(F.col("k") >= 80, "ok").otherwise("error").alias("result"))
    return Q.unaligned_devices(dev.select("session_id", "device_role").distinct(), dev)


@plan(EV + "SELECT seq AS event_seq, round(value - k, 4) AS delta FROM ev")
def ack_echo_delta(d: Tables):
    sync = d.ev.select("event_seq", F.concat(F.lit("device echoed "), F.format_string("%.3f", "value")).alias("detail"), F.col("k").cast("double").alias("sync_time_host_utc"))
    return Q.ack_echo_delta(sync).select("event_seq", r("echo_delta_sec").alias("delta"))


@plan("SELECT event_id AS event_seq, value FROM events WHERE value IS NOT NULL AND (value < 2 OR value > 300)")
def range_check(d: Tables):
    return Q.range_check(d.ev, "value", F.lit(2.0), F.lit(300.0)).select("event_seq", "value")


@plan(
    EV
    + """SELECT et AS gauge, seq AS event_seq, round(t - pt, 4) AS gap FROM (SELECT *, lag(t) OVER (PARTITION BY et ORDER BY t, seq) AS pt FROM ev) WHERE t - pt < 300"""
)
def gauge_gap_check(d: Tables):
    g = d.ev.select(F.col("event_type").alias("gauge"), "event_seq", "t")
    out = X.gauge_gap_check(g, 300.0, ["gauge"], "t", d.cuts(), ["t", "event_seq"])
    return out.select("gauge", "event_seq", r("gap_sec").alias("gap"))


@plan(
    EV
    + """, s AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) < 86400 THEN 0 ELSE 1 END AS fresh FROM ev),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY t, seq) AS stretch FROM s)
    SELECT session_id, min(t) AS start_t, count(*) AS n FROM g GROUP BY session_id, stretch"""
)
def idle_gaps(d: Tables):
    s = X.activity_stretches(d.ev, SES, ORDER, 86400.0, MONO, d.cuts())
    return s.select("session_id", "start_t", "n")


@plan(
    EV
    + """, b AS (SELECT session_id, bool_or(et = 'purchase') AS bought, count(*) AS n FROM ev GROUP BY 1)
    SELECT b.session_id, CASE WHEN bought THEN 'completed' ELSE 'truncated' END AS status, n, round(avg(CASE WHEN et = 'click' THEN value END), 8) AS click_mean, round(avg(CASE WHEN et = 'view' THEN value END), 8) AS view_mean
    FROM b JOIN ev USING (session_id) GROUP BY ALL"""
)
def session_summary(d: Tables):
    status = P.session_status(d.study({"purchase": "session_end"}))
    n = d.ev.groupBy("session_id").agg(F.count("*").alias("n"))
    means = A.task_measures(d.ev.withColumn("task", F.col("event_type")), {"click_mean": ("click", F.col("value")), "view_mean": ("view", F.col("value"))})
    return A.session_summary(status, n, means.select("session_id", r("click_mean", 8).alias("click_mean"), r("view_mean", 8).alias("view_mean")))


@plan(EV + "SELECT seq AS event_seq FROM ev WHERE k % 11 = 0 OR k % 13 = 1 OR k % 17 = 2 OR k % 19 = 3")
def incomplete_events(d: Tables):
    """Events that lost their session, type or one of their clocks."""
    lost = lambda m, r, c: F.when(F.coalesce(F.col("k") % m == r, F.lit(False)), None).otherwise(F.col(c))
    ev = d.ev.withColumns({"session_id": lost(11, 0, "session_id"), "event_type": lost(13, 1, "event_type"), MONO: lost(17, 2, MONO), HOST: lost(19, 3, HOST)})
    return Q.incomplete_rows(ev).select("event_seq")


@plan("SELECT count(*) AS incomplete FROM events WHERE user_id IS NULL OR event_type IS NULL OR ts IS NULL")
def incomplete_rows(d: Tables):
    return Q.incomplete_rows(d.ev).agg(F.count("*").alias("incomplete"))


@plan(
    EV
    + """, s AS (SELECT session_id, seq, t FROM ev WHERE et = 'signup')
    SELECT v.session_id, v.seq AS event_seq, (SELECT count(*) FROM s WHERE s.session_id = v.session_id AND s.t <= v.t) AS signups FROM (SELECT * FROM ev WHERE et = 'view') v"""
)
def running_count(d: Tables):
    out = running(d.ev, SES, ORDER, {"signups": ("count", F.when(F.col("event_type") == "signup", 1))}, d.cuts())
    return out.where("event_type = 'view'").select("session_id", "event_seq", "signups")
