"""Plans over trials and blocks: block statistics, hazards, ratings, audits."""

from pyspark.sql import functions as F

from cohortwave.functions.scalars import answer_audit as audit_answers, operand_mix as mix, panas_scores, pivot_items, prefix_matches, stai6_score
from cohortwave.operators import joins as J, project as P, quality as Q, stats as A, windows as X
from cohortwave.plans.registry import plan
from cohortwave.plans.views import DAY, EV, Tables, as_trials
from cohortwave.schema import PANAS_NEGATIVE, PANAS_POSITIVE, STAI_NEGATIVE, STAI_POSITIVE

SES = ["session_id"]
BLK = ["block_index"]


def r(c, n: int = 4):
    return F.round(c, n)


def _rounded(df, keep, cols, n: int = 4):
    return df.select(*keep, *[r(c, n).alias(c) for c in cols])


@plan("""SELECT l_orderkey AS block_index, count(*) FILTER (l_returnflag <> 'R') AS correct, count(*) AS total,
  round(count(*) FILTER (l_returnflag <> 'R') / count(*), 6) AS accuracy FROM lineitem GROUP BY 1""")
def arithmetic_block_stats(d: Tables):
    return _rounded(A.arithmetic_block_stats(d.trials, BLK), ["block_index", "correct", "total"], ["accuracy"], 6)


@plan("""SELECT l_orderkey AS block_index, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS wrong,
  round(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') / count(*), 6) AS wrong_per_drop FROM lineitem GROUP BY 1""")
def wrong_submission_rate(d: Tables):
    wrong = d.trials.where("NOT correct AND NOT congruent")
    return _rounded(A.wrong_submission_rate(wrong, A.arithmetic_block_stats(d.trials, BLK), BLK), ["block_index", "wrong"], ["wrong_per_drop"], 6)


@plan("""SELECT l_orderkey AS block_index, count(*) AS n_trials, round(avg(CASE WHEN l_returnflag <> 'R' THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(avg(CASE WHEN l_returnflag <> 'R' THEN l_quantity END), 6) AS mean_rt_sec FROM lineitem GROUP BY 1""")
def block_stats(d: Tables):
    return _rounded(A.stroop_block_stats(d.trials, BLK), ["block_index", "n_trials"], ["accuracy", "mean_rt_sec"], 6)


@plan("""WITH a AS (SELECT CAST(l_suppkey AS VARCHAR) AS session_id,
   avg(l_quantity) FILTER (l_returnflag <> 'R' AND l_linestatus = 'O') AS rc, avg(l_quantity) FILTER (l_returnflag <> 'R' AND l_linestatus <> 'O') AS ri,
   avg(CASE WHEN l_returnflag <> 'R' THEN 1.0 ELSE 0.0 END) FILTER (l_linestatus = 'O') AS ac, avg(CASE WHEN l_returnflag <> 'R' THEN 1.0 ELSE 0.0 END) FILTER (l_linestatus <> 'O') AS ai
   FROM lineitem GROUP BY 1)
  SELECT session_id, round(ri - rc, 4) AS rt_interference, round(ai - ac, 4) AS acc_interference FROM a""")
def interference(d: Tables):
    return _rounded(A.stroop_interference(d.trials, SES), SES, ["rt_interference", "acc_interference"])


@plan("""WITH c AS (SELECT l_orderkey, max(l_quantity) FILTER (l_returnflag = 'N') AS last_ok, count(*) FILTER (l_returnflag = 'R' AND l_linestatus <> 'O') AS mis,
    count(*) FILTER (l_linestatus = 'O') AS rep, count(*) FILTER (l_returnflag = 'N') AS found FROM lineitem GROUP BY 1)
  SELECT o_orderkey AS block_index, CASE WHEN o_orderstatus <> 'P' THEN last_ok END AS completion_time_sec, coalesce(mis, 0) AS misclicks,
    coalesce(rep, 0) AS repeats, coalesce(found, 0) AS found FROM orders LEFT JOIN c ON o_orderkey = l_orderkey""")
def schulte_stats(d: Tables):
    clicks = d.trials.withColumns({"correct": F.when(F.col("flag") == "N", True).when(F.col("flag") == "R", False), "repeat": F.col("congruent")})
    blocks = d.orders.select(F.col("o_orderkey").alias("block_index"), (F.col("o_orderstatus") == "P").alias("skipped"), F.lit(False).alias("truncated"))
    return A.schulte_stats(clicks, blocks, BLK)


@plan("""WITH x AS (SELECT CAST(l_suppkey AS VARCHAR) AS s, l_tax < 0.03 AS omit, l_returnflag <> 'N' AS hit, l_quantity AS rt FROM lineitem WHERE l_linestatus = 'O')
  SELECT s AS session_id, count(*) AS n, round(avg(CASE WHEN hit <> omit THEN 1.0 ELSE 0.0 END), 4) AS accuracy, count(*) FILTER (hit AND omit) AS commission,
    count(*) FILTER (NOT hit AND NOT omit) AS omission, round(avg(rt) FILTER (hit AND NOT omit), 4) AS go_rt_mean, round(stddev_samp(rt) FILTER (hit AND NOT omit), 4) AS go_rt_sd,
    round(stddev_samp(rt) FILTER (hit AND NOT omit) / avg(rt) FILTER (hit AND NOT omit), 4) AS go_rt_cv FROM x GROUP BY 1""")
def go_nogo(d: Tables):
    t = d.trials.withColumns({"is_omit": F.col("tax") < 0.03, "responded": F.col("flag") != "N", "practice": ~F.col("congruent")})
    return _rounded(A.sart_stats(t, SES), ["session_id", "n", "commission", "omission"], ["accuracy", "go_rt_mean", "go_rt_sd", "go_rt_cv"])


def _obstacles(d: Tables):
    """Lines as hazards: lane from the part, wave from the quantity, a returned line is a collision."""
    return d.trials.select(
        "session_id", "block_index", "trial_index", (F.col("clip_id") % 4).cast("int").alias("lane"), F.col("rt_sec").cast("int").alias("wave"),
        (F.col("rt_sec").cast("int") % 7).alias("wave_size"), F.when(F.col("correct"), "avoided").otherwise("collision").alias("outcome"),
        (F.col("discount") > 0.08).alias("near_miss"), (F.col("tax") < 0.01).alias("no_response"), F.col("price").alias("margin_sec"),
        F.col("trial_index").alias("nominal_difficulty"),
    )


@plan("""SELECT CAST(l_suppkey AS VARCHAR) AS session_id, count(*) FILTER (l_returnflag <> 'R') AS avoided, count(*) FILTER (l_returnflag = 'R') AS collisions,
   count(*) FILTER (l_discount > 0.08) AS near_misses, count(*) FILTER (l_tax < 0.01) AS no_responses, round(median(l_extendedprice), 4) AS median_margin_sec FROM lineitem GROUP BY 1""")
def highway_stats(d: Tables):
    out = A.highway_block_stats(_obstacles(d), SES, d.cuts("trials", "price", "block_index"))
    return _rounded(out, ["session_id", "avoided", "collisions", "near_misses", "no_responses"], ["median_margin_sec"])


@plan("""SELECT l_orderkey AS block_index, count(*) FILTER (l_returnflag <> 'N') AS forced, count(*) FILTER (l_returnflag = 'N') AS unforced, count(*) FILTER (l_linestatus = 'O') AS blocked,
  round(avg(l_quantity) FILTER (l_returnflag <> 'N'), 4) AS mean_forced_rt_ms FROM lineitem GROUP BY 1""")
def lane_change_stats(d: Tables):
    return _rounded(A.lane_change_stats(_changes(d), BLK), ["block_index", "forced", "unforced", "blocked"], ["mean_forced_rt_ms"])


def _changes(d: Tables):
    return d.trials.select(
        "session_id", "block_index", F.col("trial_index").alias("threatening_trial_index"), (F.col("flag") != "N").alias("forced"), F.col("congruent").alias("blocked"),
        F.col("rt_sec").alias("reaction_time_ms"), F.col("price").alias("client_ms"),
    )


@plan("""SELECT CAST(l_suppkey AS VARCHAR) AS session_id, CAST(l_quantity AS INT) AS wave, count(*) AS hazards, count(*) FILTER (l_returnflag = 'R') AS collisions,
  count(*) = CAST(l_quantity AS INT) % 7 AS size_ok FROM lineitem GROUP BY 1, 2, CAST(l_quantity AS INT) % 7""")
def wave_stats(d: Tables):
    return A.wave_stats(_obstacles(d), SES).drop("logged_size")


@plan("""SELECT CAST(l_suppkey AS VARCHAR) AS session_id, CAST(l_quantity AS INT) AS wave, CAST(l_partkey % 4 AS INT) AS lane, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def single_lane_double(d: Tables):
    return Q.single_lane_double(_obstacles(d), SES)


@plan("""WITH o AS (SELECT o_orderkey, o_totalprice FROM orders), a AS (
    SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS response_ms, arg_max(l_quantity, (l_extendedprice, l_quantity)) AS reaction_time_ms, count(*) AS attempts
    FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
  k AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
  SELECT k.l_orderkey AS block_index, k.l_linenumber AS trial_index, response_ms, reaction_time_ms, attempts FROM k LEFT JOIN a USING (l_orderkey, l_linenumber)""")
def response_to_obstacle(d: Tables):
    obstacles = d.trials.select("block_index", "trial_index").distinct()
    return J.response_to_obstacle(_changes(d), obstacles, BLK)


@plan("""WITH a AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) FILTER (l_returnflag <> 'N') AS resp, bool_or(l_returnflag = 'R') AS hit FROM lineitem GROUP BY 1, 2)
  SELECT l_orderkey AS block_index, l_linenumber AS trial_index, round((50000 - (resp - 2000)) / 1000, 6) AS margin_recomputed,
   coalesce(NOT hit AND (50000 - (resp - 2000)) / 1000 <= 0.3, false) AS near_miss_recomputed, hit AND resp IS NULL AS no_response_recomputed FROM a""")
def near_miss(d: Tables):
    obstacles = d.trials.groupBy("block_index", "trial_index").agg(F.when(F.bool_or(~F.col("correct")), "collision").otherwise("avoided").alias("outcome")).withColumns(
        {"spawn_ms": F.lit(2000.0), "fall_sec": F.lit(50.0)}
    )
    out = X.near_miss_class(J.response_to_obstacle(_changes(d), obstacles, BLK))
    return _rounded(out, ["block_index", "trial_index", "near_miss_recomputed", "no_response_recomputed"], ["margin_recomputed"], 6)


@plan("""SELECT o_orderkey AS block_index, l_linenumber AS trial_index, o_totalprice AS spawn, l_extendedprice AS resolve FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def pair_obstacles(d: Tables):
    spawns = d.orders.select(F.col("o_orderkey").alias("block_index"), F.col("o_totalprice").alias("spawn"))
    outcomes = d.trials.select("block_index", "trial_index", F.col("price").alias("resolve"))
    return J.pair_obstacles(spawns, outcomes, BLK)


_LEVELS = """WITH o AS (SELECT l_linenumber AS lvl, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS rate FROM lineitem GROUP BY 1),
  s AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS lvl, avg(o_totalprice) AS rep, count(*) AS m FROM orders GROUP BY 1),
  j AS (SELECT o.lvl, n, rate, rep, m FROM o LEFT JOIN s USING (lvl))
"""


def _levels(d: Tables):
    reports = d.orders.select(F.substring("o_orderpriority", 1, 1).cast("int").alias("nominal_difficulty"), F.col("o_totalprice").alias("stress"))
    return A.dose_response(_obstacles(d), reports)


@plan(_LEVELS + "SELECT lvl AS nominal_difficulty, n, round(rate, 6) AS collision_rate, round(rep, 2) AS mean_report, m AS n_reports FROM j")
def dose_response(d: Tables):
    return _levels(d).select("nominal_difficulty", "n", r("collision_rate", 6).alias("collision_rate"), r("mean_report", 2).alias("mean_report"), "n_reports")


@plan(_LEVELS + "SELECT round(corr(lvl, rate), 4) AS corr_outcome, round(regr_slope(rate, lvl), 6) AS slope_outcome, round(regr_slope(rep, lvl), 2) AS slope_report FROM j")
def dose_trend(d: Tables):
    return A.dose_trend(_levels(d)).select(r("corr_outcome").alias("corr_outcome"), r("slope_outcome", 6).alias("slope_outcome"), r("slope_report", 2).alias("slope_report"))


@plan("""SELECT p_type AS valence_group, count(*) FILTER (split_part(p_name, ' ', 1) = 'large') AS picked_large, count(*) FILTER (split_part(p_name, ' ', 1) = 'small') AS picked_small,
  count(*) AS n, round(avg(CASE WHEN split_part(p_name, ' ', 1) = lower(p_type) THEN 1.0 ELSE 0.0 END), 6) AS agreement FROM part WHERE p_size % 10 <> 0 GROUP BY 1""")
def confusion(d: Tables):
    ratings = d.part.select(F.col("p_type").alias("valence_group"), F.get(F.split("p_name", " "), F.lit(0)).alias("emotion_pick"), (F.col("p_size") % 10 == 0).alias("skipped"))
    return _rounded(A.manipulation_check(ratings, ["LARGE", "SMALL"]), ["valence_group", "picked_large", "picked_small", "n"], ["agreement"], 6)


@plan("""SELECT g AS flag, item, count(*) AS n, round(avg(score), 4) AS mean, round(stddev_samp(score), 4) AS sd FROM (
  SELECT l_returnflag AS g, 'valence' AS item, l_quantity AS score FROM lineitem UNION ALL SELECT l_returnflag, 'arousal', l_discount FROM lineitem) GROUP BY 1, 2""")
def rating_summary(d: Tables):
    ratings = as_trials(d.lineitem).select("flag", F.try_parse_json(F.to_json(F.struct(F.col("rt_sec").alias("valence"), F.col("discount").alias("arousal")))).alias("event_payload_json"))
    out = A.rating_summary(A.rating_items(ratings, ["valence", "arousal", "liking"]), ["flag"])
    return _rounded(out, ["flag", "item", "n"], ["mean", "sd"])


@plan("""WITH s AS (SELECT l_orderkey, count(*) AS observed FROM lineitem GROUP BY 1)
  SELECT o_orderkey AS block_index, coalesce(observed, 0) AS observed, o_orderkey % 7 - coalesce(observed, 0) AS missing FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def count_audit(d: Tables):
    planned = d.orders.select(F.col("o_orderkey").alias("block_index"), (F.col("o_orderkey") % 7).alias("planned_trials"))
    return A.trial_count_audit(planned, d.trials, BLK).drop("planned_trials")


@plan("""WITH s AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1)
  SELECT o_orderkey AS block_index, n FROM orders LEFT JOIN s ON o_orderkey = l_orderkey WHERE n IS NULL OR n <> o_orderkey % 5""")
def logged_vs_recomputed(d: Tables):
    logged = d.orders.select(F.col("o_orderkey").alias("block_index"), (F.col("o_orderkey") % 5).alias("n_trials"))
    out = A.logged_vs_recomputed(logged, A.stroop_block_stats(d.trials, BLK), BLK, {"n_trials": "n_trials"})
    return out.select("block_index", F.col("recomputed_n_trials").cast("bigint").alias("n"))


@plan("""SELECT CAST(o_custkey AS VARCHAR) AS participant_id, o_orderpriority AS label, count(*) AS n, greatest(0, 2 + o_orderpriority_rank - count(*)) AS shortfall
  FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INT) AS o_orderpriority_rank FROM orders) GROUP BY o_custkey, o_orderpriority, o_orderpriority_rank""")
def design_balance(d: Tables):
    t = d.orders.select(F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderpriority").alias("label"))
    targets = t.select("label").distinct().withColumn("target", F.lit(2) + F.substring("label", 1, 1).cast("int"))
    return A.design_balance(t, targets).drop("target")


@plan("""WITH a AS (SELECT l_linenumber AS tier, count(*) AS n, avg(CASE WHEN l_returnflag <> 'R' THEN 1.0 ELSE 0.0 END) AS acc FROM lineitem GROUP BY 1),
  b AS (SELECT r_regionkey + 1 AS tier, 0.66 + r_regionkey * 0.002 AS low, 0.668 + r_regionkey * 0.002 AS high FROM region)
  SELECT a.tier, n, round(acc, 6) AS accuracy, CASE WHEN acc < low THEN 'below' WHEN acc > high THEN 'above' WHEN low IS NOT NULL THEN 'in' END AS verdict FROM a LEFT JOIN b USING (tier)""")
def tier_band(d: Tables):
    bands = d.region.select((F.col("r_regionkey") + 1).alias("tier"), (0.66 + F.col("r_regionkey") * 0.002).alias("low"), (0.668 + F.col("r_regionkey") * 0.002).alias("high"))
    out = A.tier_band_check(d.trials.withColumn("tier", F.col("trial_index")), bands)
    return _rounded(out, ["tier", "n", "verdict"], ["accuracy"], 6)


@plan("""WITH x AS (SELECT l_suppkey, l_quantity AS rt, l_returnflag = 'R' AS err, row_number() OVER w AS pos, ntile(3) OVER w AS third FROM lineitem
    WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey))
  SELECT CAST(l_suppkey AS VARCHAR) AS session_id, round(avg(rt) FILTER (third = 1), 4) AS rt_third_1, round(avg(rt) FILTER (third = 2), 4) AS rt_third_2, round(avg(rt) FILTER (third = 3), 4) AS rt_third_3,
   round(avg(CASE WHEN err THEN 1.0 ELSE 0.0 END) FILTER (third = 1), 4) AS err_third_1, round(regr_slope(rt, pos), 6) AS rt_slope, round(regr_slope(CASE WHEN err THEN 1.0 ELSE 0.0 END, pos), 6) AS err_slope
  FROM x GROUP BY 1""")
def vigilance(d: Tables):
    out = X.vigilance_trend(d.trials, ["price", "block_index", "trial_index", "clip_id"], SES, width=d.cuts("trials", "price", "block_index"))
    return out.select("session_id", *[r(c).alias(c) for c in ("rt_third_1", "rt_third_2", "rt_third_3", "err_third_1")], *[r(c, 6).alias(c) for c in ("rt_slope", "err_slope")])


@plan("""SELECT l_orderkey AS k, l_linenumber AS trial_index, l_partkey AS clip_id, round(((l_linenumber * l_quantity) - l_suppkey) / 4, 6) AS recomputed,
    abs(((l_linenumber * l_quantity) - l_suppkey) / 4 - l_quantity) < 1e-9 AS answer_ok, (l_returnflag <> 'R') = (l_discount > 0.05) AS verdict_ok FROM lineitem""")
def answer_audit(d: Tables):
    expr = F.concat_ws(" ", "l_linenumber", F.lit("*"), F.col("l_quantity").cast("bigint"), F.lit("-"), "l_suppkey", F.lit("/"), F.lit("4"))
    rows = d.lineitem.select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("trial_index"), F.col("l_partkey").alias("clip_id"), expr.alias("expression"), F.col("l_quantity").alias("correct_answer"),
        F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("participant_answer"), (F.col("l_returnflag") != "R").alias("correct"),
    )
    return audit_answers(rows).select("k", "trial_index", "clip_id", r("recomputed", 6).alias("recomputed"), "answer_ok", "verdict_ok")


@plan("""WITH x AS (SELECT l_linenumber AS tier, CASE WHEN l_quantity >= 10 THEN 1.0 ELSE 0.0 END AS two, CASE l_returnflag WHEN 'R' THEN '+' WHEN 'A' THEN '*' ELSE '/' END AS op FROM lineitem)
  SELECT tier, count(*) AS n, round(avg(two), 6) AS two_digit_share, round(avg(CASE WHEN op = '+' THEN 1.0 ELSE 0.0 END), 6) AS share_add, round(avg(CASE WHEN op = '*' THEN 1.0 ELSE 0.0 END), 6) AS share_mul FROM x GROUP BY 1""")
def operand_mix(d: Tables):
    op = F.when(F.col("flag") == "R", "+").when(F.col("flag") == "A", "*").otherwise("/")
    rows = d.trials.select(F.col("trial_index").alias("tier"), F.concat_ws(" ", F.col("rt_sec").cast("bigint"), op, F.lit("2")).alias("expression"), F.lit(0.0).alias("correct_answer"), F.lit(0.0).alias("participant_answer"), F.lit(True).alias("correct"))
    return _rounded(mix(audit_answers(rows), ["tier"]), ["tier", "n"], ["two_digit_share", "share_add", "share_mul"], 6)


@plan("""SELECT CAST(l_suppkey AS VARCHAR) AS session_id, count(*) FILTER (l_returnflag = 'R') AS hits, count(*) FILTER (l_returnflag = 'A') AS misses, count(*) FILTER (l_returnflag = 'N') AS false_alarms,
  round(avg(l_quantity) FILTER (l_returnflag = 'R'), 4) AS mean_rt FROM lineitem GROUP BY 1""")
def external_log(d: Tables):
    return _rounded(A.external_log_summary(d.trials, SES, "flag", "rt_sec", "R", "A", "N"), ["session_id", "hits", "misses", "false_alarms"], ["mean_rt"])


_STAI = {c: i for i, c in enumerate((*STAI_POSITIVE, *STAI_NEGATIVE))}
_PANAS = {c: i for i, c in enumerate((*PANAS_POSITIVE, *PANAS_NEGATIVE))}


def _items(d: Tables, items: dict[str, int], scale: int):
    n = len(items)
    name = F.get(F.array(*[F.lit(i) for i in items]), (F.col("l_partkey") % n).cast("int"))
    return pivot_items(d.lineitem.select(F.col("l_suppkey").cast("string").alias("session_id"), name.alias("item_id"), (F.col("l_quantity") % scale + 1).cast("string").alias("value")), SES, list(items))


@plan("""WITH p AS (SELECT l_suppkey, l_partkey % 6 AS i, max(l_quantity % 4 + 1) AS v FROM lineitem GROUP BY 1, 2)
  SELECT CAST(l_suppkey AS VARCHAR) AS session_id, CASE WHEN count(*) = 6 THEN sum(CASE WHEN i < 3 THEN 5 - v ELSE v END) END AS stai FROM p GROUP BY 1""")
def stai6(d: Tables):
    return _items(d, _STAI, 4).select("session_id", stai6_score().alias("stai"))


@plan("""WITH p AS (SELECT l_suppkey, l_partkey % 10 AS i, max(l_quantity % 5 + 1) AS v FROM lineitem GROUP BY 1, 2)
  SELECT CAST(l_suppkey AS VARCHAR) AS session_id, CASE WHEN count(*) FILTER (i < 5) = 5 THEN sum(v) FILTER (i < 5) END AS positive,
    CASE WHEN count(*) FILTER (i >= 5) = 5 THEN sum(v) FILTER (i >= 5) END AS negative FROM p GROUP BY 1""")
def panas(d: Tables):
    pos, neg = panas_scores()
    return _items(d, _PANAS, 5).select("session_id", pos.alias("positive"), neg.alias("negative"))


@plan("""WITH m AS (SELECT l_returnflag AS g, median(l_extendedprice) AS med FROM lineitem GROUP BY 1)
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price FROM lineitem JOIN m ON g = l_returnflag WHERE l_extendedprice < med * 0.1""")
def unit_outliers(d: Tables):
    return Q.unit_outliers(d.trials, "price", ["flag"], d.cuts("trials", "price", "block_index")).select(F.col("block_index").alias("l_orderkey"), F.col("trial_index").alias("l_linenumber"), F.col("clip_id").alias("l_partkey"), "price")


_LIVE = EV + """, sp AS (SELECT session_id, seq, k, t * 1000 AS s, t * 1000 + value * 60000 AS e, k % 4 AS lane, value * 60 AS fall FROM ev WHERE et = 'view')
"""


def _live(d: Tables):
    """Each view is a hazard that lives `value` minutes."""
    ms = F.col("t") * 1000
    return d.ev.where("event_type = 'view'").select(
        "session_id", "task", "run_ordinal", F.lit(0).alias("block_index"), F.col("event_seq").alias("trial_index"), ms.alias("spawn_ms"), (ms + F.col("value") * 60000).alias("resolve_ms"),
        (F.col("k") % 4).alias("lane"), (F.col("value") * 60).alias("fall_sec"), F.lit(2).alias("lanes"), F.col("k").alias("correct_answer"),
    )


@plan(_LIVE + """, tk AS (SELECT session_id, seq, t * 1000 AS t FROM ev WHERE et = 'click'), mv AS (SELECT session_id, t * 1000 AS t, k % 4 AS lane FROM ev WHERE et = 'purchase' AND k % 5 <> 0),
    x AS (SELECT tk.*, coalesce(mv.lane, 2) AS own FROM tk ASOF LEFT JOIN mv ON tk.session_id = mv.session_id AND tk.t >= mv.t)
  SELECT x.session_id, x.seq AS tick_id, own AS own_lane, count(sp.s) AS active, count(DISTINCT sp.lane) AS blocked, round(min(fall * 1000 - (x.t - s)), 2) AS nearest,
    round(min(CASE WHEN sp.lane = own THEN fall * 1000 - (x.t - s) END), 2) AS own_ttc
  FROM x LEFT JOIN sp ON sp.session_id = x.session_id AND s <= x.t AND x.t < e GROUP BY x.session_id, x.seq, own""")
def live_state(d: Tables):
    ticks = d.ev.where("event_type = 'click'").select("session_id", F.col("event_seq").alias("tick_id"), (F.col("t") * 1000).alias("t_ms"))
    moves = d.ev.where("event_type = 'purchase'").select("session_id", (F.col("t") * 1000).alias("client_ms"), (F.col("k") % 4).alias("to_lane"), (F.col("k") % 5 == 0).alias("blocked"))
    out = X.live_state(ticks, _live(d), moves, 4, SES, d.cuts(tie=None).times(1000))
    return out.select("session_id", "tick_id", "own_lane", F.col("active_obstacle_count").alias("active"), F.col("blocked_lane_count").alias("blocked"),
                      r("nearest_time_to_collision_ms", 2).alias("nearest"), r("own_lane_time_to_collision_ms", 2).alias("own_ttc"))


@plan(_LIVE + """SELECT a.session_id, a.seq AS trial_index, count(DISTINCT b.lane) AS blocked FROM sp a JOIN sp b ON a.session_id = b.session_id AND b.s <= a.s AND a.s < b.e
  GROUP BY 1, 2 HAVING count(DISTINCT b.lane) >= 2""")
def safe_lane_invariant(d: Tables):
    return Q.safe_lane_invariant(_live(d), 4, SES, d.cuts(tie=None).times(1000)).select("session_id", "trial_index", "blocked")


@plan(_LIVE + """SELECT w.session_id, w.seq AS event_seq, sp.seq AS drop_seq FROM (SELECT * FROM ev WHERE et = 'error') w JOIN sp ON sp.session_id = w.session_id
   AND s <= w.t * 1000 AND w.t * 1000 < e AND starts_with(CAST(sp.k AS VARCHAR), CAST(w.k % 10 AS VARCHAR))""")
def prefix_match(d: Tables):
    wrong = d.ev.where("event_type = 'error'").select("session_id", "event_seq", (F.col("t") * 1000).alias("t"), (F.col("k") % 10).cast("string").alias("participant_answer"))
    drops = _live(d).select("session_id", F.col("trial_index").alias("drop_seq"), F.col("spawn_ms").alias("t0"), F.col("resolve_ms").alias("t1"), "correct_answer")
    return prefix_matches(wrong, drops, SES, 3.6e6).select("session_id", "event_seq", "drop_seq")


@plan("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'baseline' WHEN o_orderkey % 4 = 1 THEN NULL ELSE 'stress' END AS binary_label,
   CASE WHEN o_orderkey % 4 = 0 THEN '0' WHEN o_orderkey % 4 = 1 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS ordinal_label FROM orders""")
def label_policy(d: Tables):
    cond = F.when(F.col("o_orderkey") % 4 == 0, "baseline").when(F.col("o_orderkey") % 4 == 1, "inter_trial_pause").otherwise(F.concat(F.lit("tier_"), F.substring("o_orderpriority", 1, 1)))
    df = P.label_policy(d.orders.withColumn("condition_label", cond), "binary").withColumnRenamed("label", "binary_label")
    return P.label_policy(df, "ordinal").select("o_orderkey", "binary_label", F.col("label").alias("ordinal_label"))


@plan("SELECT l_orderkey, l_linenumber, p_brand AS valence, p_type AS fine FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size >= 5")
def clip_labels(d: Tables):
    """Labels of the clip that a trial belongs to; a trial whose clip is not listed has none."""
    listed = d.clips.where("duration_sec >= 5")
    trials = d.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("clip_id"))
    valence = P.label_policy(trials, "valence", clips=listed).withColumnRenamed("label", "valence")
    return P.label_policy(valence, "fine", clips=listed).select("l_orderkey", "l_linenumber", "valence", F.col("label").alias("fine"))


@plan("""WITH o AS (SELECT s_nationkey AS n, s_suppkey % 3 AS v FROM supplier WHERE s_nationkey % 4 <> 0 AND s_suppkey % 10 < 4)
  SELECT CAST(c_nationkey AS VARCHAR) AS session_id, c_custkey AS answer_id, CAST(c_custkey % 5 AS VARCHAR) AS value FROM customer
  WHERE c_nationkey IN (SELECT n FROM o) AND NOT EXISTS (SELECT 1 FROM o WHERE n = c_nationkey AND v = c_custkey % 5)""")
def options_outside(d: Tables):
    """Answers that are no option of their item; items without a list of options allow all."""
    listed = F.when((F.col("s_nationkey") % 4 != 0) & (F.col("s_suppkey") % 10 < 4), (F.col("s_suppkey") % 3).cast("string"))
    rules = d.supplier.groupBy(F.col("s_nationkey").cast("string").alias("session_id")).agg(F.collect_set(listed).alias("o"))
    rules = rules.select("session_id", F.when(F.size("o") > 0, F.col("o")).alias("options"))
    answers = d.customer.select(F.col("c_nationkey").cast("string").alias("session_id"), F.col("c_custkey").alias("answer_id"), (F.col("c_custkey") % 5).cast("string").alias("value"))
    return Q.option_check(answers, rules, ["session_id"]).select("session_id", "answer_id", "value")


_CONF = """WITH c AS (SELECT c_custkey AS id, c_nationkey AS nk FROM customer)
"""


def _manifests(d: Tables):
    """Customers as manifests: the configuration is built from their columns."""
    cfg = F.concat(
        F.lit('{"stress_task": {"trial_order": [1, 2, '), F.col("c_nationkey") % 5, F.lit('], "tiers": [{"id": 1, "duration_sec": 60}, {"id": 2, "duration_sec": 30, "nominal_difficulty": 7}, {"id": 3, "concurrent_obstacles": 3}]}, "sart_task": {"omit_count": '),
        F.col("c_nationkey") % 11, F.lit('}, "devices": {"mode": "real", "skip_sync": true, "wristband": {"enabled": '), (F.col("c_nationkey") % 2 == 0).cast("string"), F.lit('}, "ear": {"enabled": true}}}'),
    )
    rec = F.struct(
        F.lit("x").alias("device_role"), F.concat(F.lit("dev-"), F.col("c_nationkey")).alias("device_id"), F.lit("p").alias("protocol"), F.col("c_acctbal").alias("sync_time_host_utc"),
        F.when(F.col("c_nationkey") % 3 == 0, "error").otherwise("ok").alias("result"), F.lit("").alias("detail"), F.lit(None).cast("double").alias("device_rel_sec"),
    )
    return d.customer.select(
        F.col("c_custkey").cast("string").alias("session_id"), F.col("c_mktsegment").alias("participant_id"), F.col("c_acctbal").alias("created_at_utc"),
        F.when(F.col("c_nationkey") % 4 == 0, 0.5).otherwise(1.0).alias("demo_scale"), F.lit(1.0).alias("rng_seed"),
        F.create_map(F.lit("ear"), F.array(rec, rec), F.lit("wristband"), F.when(F.col("c_nationkey") % 2 == 0, F.array(rec)).otherwise(F.array_remove(F.array(rec), rec))).alias("device_sync_records"),
        F.try_parse_json(cfg).alias("config_snapshot"),
    )


@plan(_CONF + """SELECT CAST(id AS VARCHAR) AS session_id, 'stress_task.trial_order' AS setting, CAST(nk % 5 AS VARCHAR) AS value FROM c WHERE nk % 5 IN (0, 4)
  UNION ALL SELECT CAST(id AS VARCHAR), 'sart_task.omit_count', CAST(nk % 11 AS VARCHAR) FROM c WHERE nk % 11 NOT BETWEEN 1 AND 8""")
def validate_config(d: Tables):
    return P.validate_config(_manifests(d))


@plan(_CONF + """, t AS (SELECT * FROM (VALUES (1, 60.0, 1, 1), (2, 30.0, 7, 1), (3, NULL, 3, 3)) v(tid, dur, nominal, conc)),
  o AS (SELECT id, nk, 0 AS position, 1 AS tid FROM c UNION ALL SELECT id, nk, 1, 2 FROM c UNION ALL SELECT id, nk, 2, nk % 5 FROM c)
  SELECT CAST(o.id AS VARCHAR) AS session_id, position, tid AS id, CAST(dur * CASE WHEN nk % 4 = 0 THEN 0.5 ELSE 1 END AS DOUBLE) AS duration_sec, nominal AS nominal_difficulty, conc AS concurrent_obstacles FROM o JOIN t USING (tid)""")
def tier_dimension(d: Tables):
    return P.tier_dimension(_manifests(d), "stress_task").select("session_id", "position", "id", "duration_sec", "nominal_difficulty", "concurrent_obstacles")


@plan(_CONF + """, x AS (SELECT id, nk, unnest(CASE WHEN nk % 2 = 0 THEN ['ear', 'ear', 'wristband'] ELSE ['ear', 'ear'] END) AS device_role FROM c)
  SELECT CAST(id AS VARCHAR) AS session_id, device_role, 'dev-' || nk AS device_id, CASE WHEN nk % 3 = 0 THEN 'error' ELSE 'ok' END AS result FROM x""")
def expand_sync(d: Tables):
    return J.expand_sync(_manifests(d)).select("session_id", "device_role", "device_id", "result")


@plan(_CONF + """SELECT CAST(id AS VARCHAR) AS session_id, role AS device_role FROM c, (VALUES ('ear'), ('wristband')) v(role) WHERE (role = 'ear' OR nk % 2 = 0) AND nk % 3 = 0""")
def enabled_unaligned(d: Tables):
    m = _manifests(d)
    return Q.unaligned_devices(Q.enabled_devices(m), J.expand_sync(m))


@plan("""WITH s AS (SELECT o_custkey, o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS st, o_orderpriority LIKE '1%' AS sart, o_orderstatus = 'F' AS done FROM orders),
  m AS (SELECT * FROM s WHERE NOT sart AND done), f AS (SELECT o_custkey, st, o_orderkey AS fk FROM s WHERE sart)
  SELECT m.o_orderkey AS session_id, (SELECT min(f.st) FROM f WHERE f.o_custkey = m.o_custkey AND f.st >= m.st) AS followup_unix FROM m""")
def followup_session(d: Tables):
    s = d.orders.select(
        F.col("o_custkey").cast("string").alias("participant_id"), F.col("o_orderkey").alias("session_id"),
        (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400).alias("start_unix"),
        F.when(F.col("o_orderpriority").startswith("1"), "sart").alias("session_task"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("truncated").alias("status"),
    )
    return J.link_followup_session(s, 3650 * DAY).select("session_id", "followup_unix")


@plan("""SELECT o_orderkey AS block_index, round(o_totalprice / 1000, 6) AS length_sec, abs(o_totalprice / 1000 - 60 * CAST(substr(o_orderpriority, 1, 1) AS INT)) > 50 AND o_orderstatus <> 'P' AS off_plan FROM orders""")
def duration_audit(d: Tables):
    blocks = d.orders.select(F.col("o_orderkey").alias("block_index"), F.col("o_orderpriority").alias("tier"), F.lit(0.0).alias("t0"), (F.col("o_totalprice") / 1000).alias("t1"), (F.col("o_orderstatus") == "P").alias("skipped"))
    planned = blocks.select("tier").distinct().withColumn("planned_sec", F.substring("tier", 1, 1).cast("double") * 60)
    return A.duration_audit(blocks, planned, ["tier"], 50.0).select("block_index", r("length_sec", 6).alias("length_sec"), "off_plan")
