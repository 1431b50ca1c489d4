"""Plans that align, label and slice samples."""

from pyspark.sql import functions as F

from cohortwave.operators import joins as J, labelling as B, project as P, stats as A
from cohortwave.plans.event_plans import _BLOCKS, _blocks
from cohortwave.plans.registry import plan
from cohortwave.plans.views import EV, Tables
from cohortwave.schema import MONO

SES = ["session_id"]
HOUR = 3600.0


def r(c, n: int = 4):
    return F.round(c, n)


def _samples(d: Tables):
    """Every event is a sample with two channels, already on the wall clock."""
    return d.ev.select("session_id", F.col("event_seq").alias("sample_idx"), F.col("t").alias("wall"), F.array(F.col("value"), F.col("k").cast("double")).alias("ch"))


def _intervals(d: Tables):
    b = _blocks(d).withColumn("label", F.when(F.pmod(F.floor("t0").cast("bigint"), F.lit(2)) == 0, "baseline").otherwise("stress"))
    return B.labelled_intervals(("block", b))


_I = _BLOCKS + ", i AS (SELECT session_id, t0, t1, CASE WHEN CAST(floor(t0) AS BIGINT) % 2 = 0 THEN 'baseline' ELSE 'stress' END AS label FROM done)\n"


@plan(_I + "SELECT session_id, t0, t1, label, 'block' AS source FROM i")
def labelled_intervals(d: Tables):
    return _intervals(d)


@plan("""WITH i AS (SELECT l_suppkey AS s, l_extendedprice AS t0, l_extendedprice + l_quantity * 10 AS t1, l_orderkey AS a, l_linenumber AS b, l_partkey AS c FROM lineitem),
   x AS (SELECT *, max(t1) OVER (PARTITION BY s ORDER BY t0, t1, a, b, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM i)
   SELECT CAST(s AS VARCHAR) AS session_id, a AS block_index, b AS trial_index, c AS clip_id FROM x WHERE t0 < e""")
def overlapping_intervals(d: Tables):
    i = d.trials.select("session_id", F.col("price").alias("t0"), (F.col("price") + F.col("rt_sec") * 10).alias("t1"), "block_index", "trial_index", "clip_id")
    return B.overlapping_intervals(i, SES, d.cuts("trials", "price", "block_index"), ["t0", "t1", "block_index", "trial_index", "clip_id"]).select("session_id", "block_index", "trial_index", "clip_id")


@plan(_I + "SELECT e.session_id, e.seq AS sample_idx, i.label FROM ev e LEFT JOIN i ON i.session_id = e.session_id AND e.t >= i.t0 AND e.t < i.t1")
def label_events(d: Tables):
    return J.label_samples(_samples(d), _intervals(d), bucket=HOUR * 6, keep_unlabelled=True).select("session_id", "sample_idx", "label")


@plan(_I + """, n AS (SELECT *, CAST(floor((t1 - t0 - 14400) / 7200 + 1e-9) AS BIGINT) AS last FROM i)
   SELECT session_id, t0, w AS window_no, t0 + w * 7200 AS w0, label FROM n, LATERAL (SELECT unnest(range(0, last + 1)) AS w) WHERE last >= 0""")
def fixed_windows(d: Tables):
    return B.fixed_windows(_intervals(d), 4 * HOUR, 2 * HOUR).select("session_id", "t0", "window_no", "w0", "label")


_SLICED = _I + """, n AS (SELECT *, CAST(floor((t1 - t0 - 14400) / 7200 + 1e-9) AS BIGINT) AS last FROM i),
   w AS (SELECT session_id, t0, label, w AS window_no, t0 + w * 7200 AS w0 FROM n, LATERAL (SELECT unnest(range(0, last + 1)) AS w) WHERE last >= 0),
   s AS (SELECT w.session_id, w.t0, w.window_no, w.label, w.w0, e.seq, e.t, e.value, e.k FROM w JOIN ev e ON e.session_id = w.session_id AND e.t >= w.w0 AND e.t < w.w0 + 14400)
"""


def _sliced(d: Tables, intervals=None):
    return B.slice_samples(_samples(d), intervals or _intervals(d), 4 * HOUR, 2 * HOUR, bucket=HOUR * 6)


@plan(_SLICED + "SELECT session_id, t0, window_no, label, seq AS sample_idx, round(t - w0, 4) AS offset_sec FROM s")
def slice_samples(d: Tables):
    return _sliced(d).select("session_id", "t0", "window_no", "label", "sample_idx", r("offset_sec").alias("offset_sec"))


@plan(_SLICED + """SELECT w.session_id, w.t0, w.window_no, count(e.seq) AS found, round(count(e.seq) / 3.0, 6) AS completeness, count(e.seq) / 3.0 >= 0.95 AS accepted
   FROM w LEFT JOIN ev e ON e.session_id = w.session_id AND e.t >= w.w0 AND e.t < w.w0 + 14400 GROUP BY 1, 2, 3""")
def completeness(d: Tables):
    i = _intervals(d)
    out = B.completeness(_sliced(d, i), B.fixed_windows(i, 4 * HOUR, 2 * HOUR), 3.0 / (4 * HOUR), 4 * HOUR, ["session_id", "t0", "window_no"])
    return out.withColumn("completeness", r("completeness", 6))


_PLAYS = """, q AS (SELECT *, lead(et) OVER w AS net, lead(t) OVER w AS nt, lead(h) OVER w AS nh, lead(value) OVER w AS nv FROM ev WHERE et IN ('view', 'purchase', 'error')
     WINDOW w AS (PARTITION BY session_id, k % 7 ORDER BY t, seq)),
   ends AS (SELECT session_id, max(t) AS last_t, max(h) AS last_h FROM ev GROUP BY 1),
   plays AS (SELECT session_id, k % 7 AS clip, t AS t0, h AS h0, et = 'error' AS retried,
     CASE WHEN net IN ('purchase', 'error') THEN nt ELSE last_t END AS t1, CASE WHEN net IN ('purchase', 'error') THEN nh ELSE last_h END AS h1,
     CASE net WHEN 'purchase' THEN 'played' WHEN 'error' THEN 'error' ELSE 'truncated' END AS outcome, CASE WHEN net = 'purchase' THEN nv END AS wall
     FROM q JOIN ends USING (session_id) WHERE et = 'view' OR (et = 'error' AND net = 'purchase'))
"""


def _playbacks(d: Tables):
    """view starts a clip, purchase ends it, error breaks it off; seven clips."""
    body = F.try_parse_json(F.to_json(F.struct((F.col("k") % 7).cast("string").alias("clip_id"), F.col("value").alias("wall_duration_sec"))))
    return J.pair_playbacks(d.study({"view": "clip_playback_start", "purchase": "clip_playback_end", "error": "clip_playback_error"}, body), d.cuts())


@plan(EV + _PLAYS + "SELECT session_id, CAST(clip AS VARCHAR) AS clip_id, t0, t1, h1 AS host_t1, outcome, retried, wall AS wall_duration_sec FROM plays")
def pair_playbacks(d: Tables):
    return _playbacks(d).select("session_id", "clip_id", "t0", "t1", F.col("host_t1"), "outcome", "retried", "wall_duration_sec")


@plan(EV + _PLAYS + """SELECT session_id, t0, clip AS clip_no, round(wall - p_size, 4) AS difference_sec, coalesce(abs(wall - p_size) > 3, false) AS needs_trim_check
   FROM plays LEFT JOIN part ON p_partkey = clip WHERE outcome = 'played'""")
def playback_lengths(d: Tables):
    """A25 from the log: measured lengths of playbacks against those of the clips."""
    known = d.clips.select(F.col("clip_id").cast("string").alias("clip_id"), "duration_sec")
    rows = _playbacks(d).where("outcome = 'played'").join(known, "clip_id", "left")
    out = A.playback_duration_audit(rows, "wall_duration_sec", "duration_sec")
    return out.select("session_id", "t0", F.col("clip_id").cast("int").alias("clip_no"), r("difference_sec").alias("difference_sec"), "needs_trim_check")


@plan(_BLOCKS + _PLAYS.replace(" ends AS", " last_of AS").replace("JOIN ends", "JOIN last_of") + """, b AS (SELECT *, lead(et) OVER w AS net, lead(h) OVER w AS nh FROM ev WHERE et IN ('click', 'error')
     WINDOW w AS (PARTITION BY session_id ORDER BY t, seq)),
   closing AS (SELECT session_id, seq, lead(h) OVER w AS nh FROM ev WHERE et IN ('view', 'purchase') WINDOW w AS (PARTITION BY session_id ORDER BY t, seq))
   SELECT d.session_id, e.h AS t0, c.nh AS t1, CASE WHEN d.k % 5 = 0 THEN 'baseline' ELSE 'stress' END AS label, 'block' AS source
   FROM done d JOIN ev e ON e.session_id = d.session_id AND e.seq = d.seq JOIN closing c ON c.session_id = d.session_id AND c.seq = d.seq WHERE d.k % 5 < 4
   UNION ALL SELECT session_id, h, nh, 'baseline', 'baseline' FROM b WHERE et = 'click' AND net = 'error'
   UNION ALL SELECT session_id, h0, h1, p_brand, 'clip' FROM plays JOIN part ON p_partkey = clip WHERE outcome = 'played'""")
def label_sources(d: Tables):
    """L1 from all three sources on the wall clock: tier blocks (pauses have no label), baselines and clip playbacks."""
    tier = F.col("k") % 5
    ev = d.study({"view": "block_start", "purchase": "block_end"}).withColumn("condition_label", F.lit(None).cast("string"))
    # the tier is part of the payload of the start
    named = F.when(tier == 0, "baseline").when(tier < 4, F.concat(F.lit("tier_"), tier.cast("string"))).otherwise("pause")
    starts = ev.where("event_type = 'block_start'").select("session_id", F.col(MONO).alias("t0"), F.col("event_seq"), named.alias("name"))
    blocks = J.pair_blocks(ev, d.cuts(), closed_only=True).drop("condition_label")
    # two starts with one reading: the later one is closed
    starts = starts.groupBy("session_id", "t0").agg(F.max_by("name", "event_seq").alias("condition_label"))
    tiers = P.label_policy(blocks.join(starts, ["session_id", "t0"]), "binary").select("session_id", F.col("host_t0").alias("t0"), F.col("host_t1").alias("t1"), "label")
    base = J.pair_baselines(d.study({"click": "baseline_start", "error": "baseline_end"}), d.cuts(), closed_only=True)
    clips = d.clips.withColumn("clip_id", F.col("clip_id").cast("string"))
    return B.labelled_intervals(("block", tiers), ("baseline", B.baseline_source(base)), ("clip", B.playback_source(_playbacks(d), clips)))


_FEATURES = """WITH x AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS channel FROM embeddings)
"""


@plan(_FEATURES + """SELECT label, CAST(channel AS INT) AS channel, count(v) AS n, round(avg(v::DOUBLE), 6) AS mean, round(stddev_samp(v::DOUBLE), 6) AS sd, round(min(v)::DOUBLE, 6) AS min, round(max(v)::DOUBLE, 6) AS max, 0.0::DOUBLE AS missing_share FROM x GROUP BY 1, 2""")
def window_features(d: Tables):
    """Vectors as multi-channel samples, their label as the window."""
    out = A.window_features(d.embeddings.withColumnRenamed("embedding", "ch"), ["label"])
    return out.select("label", "channel", "n", *[r(c, 6).alias(c) for c in ("mean", "sd", "min", "max", "missing_share")])


@plan(_FEATURES + """, f AS (SELECT label, channel, avg(v::DOUBLE) AS mean FROM x GROUP BY 1, 2)
   SELECT f.label, CAST(f.channel AS INT) AS channel, round(f.mean - b.mean, 6) AS mean_corrected FROM f LEFT JOIN f b ON b.channel = f.channel AND b.label = 0""")
def baseline_correct(d: Tables):
    f = A.window_features(d.embeddings.withColumnRenamed("embedding", "ch"), ["label"])
    return B.baseline_correct(f, f.where("label = 0"), ["channel"]).select("label", "channel", r("mean_corrected", 6).alias("mean_corrected"))


_SYNC = EV + ", y AS (SELECT session_id, max(t) AS st FROM ev WHERE et = 'signup' AND k >= 20 GROUP BY 1)\n"


def _sync(d: Tables):
    return d.ev.where("event_type = 'signup'").select("session_id", F.lit("dev").alias("device_id"), F.col("t").alias("sync_time_host_utc"), F.when(F.col("k") >= 20, "ok").otherwise("error").alias("result"))


@plan(_SYNC + "SELECT session_id, seq AS sample_idx, st + value AS wall FROM ev JOIN y USING (session_id)")
def align_samples(d: Tables):
    s = d.ev.select("session_id", F.lit("dev").alias("device_id"), F.col("event_seq").alias("sample_idx"), F.col("value").alias("rel_sec"))
    return J.align_samples(s, _sync(d)).select("session_id", "sample_idx", "wall")


@plan(EV + """, rec AS (SELECT session_id, k % 4 AS rid, max(t) AS started FROM ev WHERE et = 'view' GROUP BY 1, 2),
   o AS (SELECT rec.session_id, rid, max(e.t) AS st FROM rec JOIN ev e ON e.session_id = rec.session_id AND e.et = 'signup' AND e.k >= 20 AND e.t <= started GROUP BY 1, 2)
   SELECT v.session_id, v.seq AS sample_idx, st + v.value AS wall FROM ev v JOIN o ON o.session_id = v.session_id AND o.rid = v.k % 4 WHERE v.et = 'view'""")
def align_recordings(d: Tables):
    rid = F.concat_ws("/", "session_id", (F.col("k") % 4).cast("string"))
    v = d.ev.where("event_type = 'view'")
    s = v.select("session_id", F.lit("dev").alias("device_id"), rid.alias("recording_id"), F.col("event_seq").alias("sample_idx"), F.col("value").alias("rel_sec"))
    rec = v.groupBy("session_id", F.lit("dev").alias("device_id"), rid.alias("recording_id")).agg(F.max("t").alias("started_utc"))
    return J.align_samples(s, _sync(d), rec).select("session_id", "sample_idx", "wall")


_WINDOWS = """, n AS (SELECT *, CAST(floor((t1 - t0 - 14400) / 7200 + 1e-9) AS BIGINT) AS last FROM i),
   w AS (SELECT session_id, t0, label, w AS window_no, t0 + w * 7200 AS w0 FROM n, LATERAL (SELECT unnest(range(0, last + 1)) AS w) WHERE last >= 0)
   SELECT a.session_id, a.sample_idx, w.t0, w.window_no, w.label, round(a.wall - w.w0, 3) AS offset_sec FROM a JOIN w ON w.session_id = a.session_id AND a.wall >= w.w0 AND a.wall < w.w0 + 14400"""


@plan(_I + """, rec AS (SELECT session_id, k % 4 AS rid, max(t) AS started FROM ev WHERE et = 'view' GROUP BY 1, 2),
   o AS (SELECT rec.session_id, rid, max(e.t) AS st FROM rec JOIN ev e ON e.session_id = rec.session_id AND e.et = 'signup' AND e.k >= 20 AND e.t <= started GROUP BY 1, 2),
   a AS (SELECT v.session_id, v.seq AS sample_idx, st + v.value * 3600 AS wall FROM ev v JOIN o ON o.session_id = v.session_id AND o.rid = v.k % 4)
""" + _WINDOWS)
def labelled_recordings(d: Tables):
    """The whole path: recordings take the sync before their start, their samples the labels of the windows they fall in."""
    rid = F.concat_ws("/", "session_id", (F.col("k") % 4).cast("string"))
    s = d.ev.select("session_id", F.lit("dev").alias("device_id"), rid.alias("recording_id"), F.col("event_seq").alias("sample_idx"), (F.col("value") * 3600).alias("rel_sec"))
    rec = d.ev.where("event_type = 'view'").groupBy("session_id", F.lit("dev").alias("device_id"), rid.alias("recording_id")).agg(F.max("t").alias("started_utc"))
    out = B.label_recordings(s, _sync(d), _intervals(d), 4 * HOUR, 2 * HOUR, 6 * HOUR, recordings=rec)
    return out.select("session_id", "sample_idx", "t0", "window_no", "label", r("offset_sec", 3).alias("offset_sec"))


@plan(EV + """, y AS (SELECT session_id, t - 1704067200 AS r, t + k * 0.01::DOUBLE - (t - 1704067200) AS o FROM ev WHERE et = 'signup'),
   l AS (SELECT session_id, r, o, coalesce((lead(o) OVER w - o) / (lead(r) OVER w - r), (o - lag(o) OVER w) / (r - lag(r) OVER w), 0) AS m, lag(r) OVER w IS NULL AS is_first FROM y WINDOW w AS (PARTITION BY session_id ORDER BY r)),
   g AS (SELECT session_id, CASE WHEN is_first THEN '-infinity'::DOUBLE ELSE r END AS f, r, o, m FROM l)
   SELECT s.session_id, s.seq AS sample_idx, round(s.t - 1704067200 + o + m * (s.t - 1704067200 - r), 3) AS wall FROM (SELECT *, t - 1704067200 AS rel FROM ev) s ASOF JOIN g ON g.session_id = s.session_id AND s.rel >= g.f""")
def align_samples_multi(d: Tables):
    rel = F.col("t") - 1704067200
    s = d.ev.select("session_id", F.lit("dev").alias("device_id"), F.col("event_seq").alias("sample_idx"), rel.alias("rel_sec"))
    sync = d.ev.where("event_type = 'signup'").select("session_id", F.lit("dev").alias("device_id"), (F.col("t") + F.col("k") * 0.01).alias("sync_time_host_utc"), rel.alias("device_rel_sec"), F.lit("ok").alias("result"))
    return J.align_samples_multi(s, sync, bucket=86400.0).select("session_id", "sample_idx", r("wall", 3).alias("wall"))


@plan(_I + """, y AS (SELECT session_id, t - 1704067200 AS r, t + k * 0.01::DOUBLE - (t - 1704067200) AS o FROM ev WHERE et = 'signup'),
   l AS (SELECT session_id, r, o, coalesce((lead(o) OVER w - o) / (lead(r) OVER w - r), (o - lag(o) OVER w) / (r - lag(r) OVER w), 0) AS m, lag(r) OVER w IS NULL AS is_first FROM y WINDOW w AS (PARTITION BY session_id ORDER BY r)),
   g AS (SELECT session_id, CASE WHEN is_first THEN '-infinity'::DOUBLE ELSE r END AS f, r, o, m FROM l),
   a AS (SELECT s.session_id, s.seq AS sample_idx, s.rel + o + m * (s.rel - r) AS wall FROM (SELECT *, t - 1704067200 + 60 AS rel FROM ev) s ASOF JOIN g ON g.session_id = s.session_id AND s.rel >= g.f)
""" + _WINDOWS)
def labelled_drift(d: Tables):
    """The same with drifting device clocks: offsets between two syncs are interpolated; the device counts a minute ahead."""
    rel = F.col("t") - 1704067200
    s = d.ev.select("session_id", F.lit("dev").alias("device_id"), F.col("event_seq").alias("sample_idx"), (rel + 60).alias("rel_sec"))
    sync = d.ev.where("event_type = 'signup'").select("session_id", F.lit("dev").alias("device_id"), (F.col("t") + F.col("k") * 0.01).alias("sync_time_host_utc"), rel.alias("device_rel_sec"), F.lit("ok").alias("result"))
    out = B.label_recordings(s, sync, _intervals(d), 4 * HOUR, 2 * HOUR, 6 * HOUR, drift=True)
    return out.select("session_id", "sample_idx", "t0", "window_no", "label", r("offset_sec", 3).alias("offset_sec"))


@plan("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS participant_id,
   CASE WHEN h % 100 < 80 THEN 'train' WHEN h % 100 < 90 THEN 'valid' ELSE 'test' END AS split
   FROM (SELECT *, ('0x' || substr(md5('0|' || o_custkey), 1, 15))::BIGINT AS h FROM orders)""")
def participant_split(d: Tables):
    """Orders split by customer."""
    return B.participant_split(d.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("participant_id")))


@plan("SELECT count(DISTINCT o_custkey) AS participants, 0 AS leaks FROM orders")
def split_leaks(d: Tables):
    s = B.participant_split(d.orders.select(F.col("o_custkey").cast("string").alias("participant_id")))
    per = s.groupBy("participant_id").agg(F.count_distinct("split").alias("sides"))
    return per.agg(F.count("*").alias("participants"), F.count_if(F.col("sides") > 1).cast("int").alias("leaks"))
