"""Streaming plans: the events table is read as a file stream, processed to its end, and read back."""

from pyspark.sql import DataFrame, functions as F

from cohortwave.plans.labelling_plans import _I, _intervals
from cohortwave.plans.registry import plan
from cohortwave.plans.views import EV, Tables, as_events
from cohortwave.session import work_dir
from cohortwave.streaming import streams as S

SES = ["session_id"]
BUCKETS = 1024  # state rows that sessions share
MONTH = "40 days"  # the table is one file, so order inside it is open: let the watermark wait


def _stream(d: Tables) -> DataFrame:
    raw = d.spark.readStream.schema(d.events.schema).option("maxFilesPerTrigger", 64).parquet(f"{d.dir}/events.parquet*")
    return as_events(raw)


def _result(d: Tables, df: DataFrame, name: str, **kw) -> DataFrame:
    return d.spark.read.parquet(S.run_available(d.spark, df, name, **kw))


def _latest(out: DataFrame, keys: list[str]) -> DataFrame:
    """Update mode writes a row per change; the last batch has the final one."""
    cols = [c for c in out.columns if c not in (*keys, "batch")]
    return out.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("v")).select(*keys, "v.*")


@plan(EV + "SELECT session_id, epoch_us(max(ts)) AS last_us, count(*) AS n_events, CASE WHEN bool_or(et = 'error' AND k = 0) THEN 'crashed' WHEN bool_or(et = 'purchase') THEN 'completed' ELSE 'running' END AS status FROM ev GROUP BY 1")
def stream_monitor(d: Tables):
    et, k = F.col("event_type"), F.col("k")
    s = _stream(d).withColumn("event_type", F.when((et == "error") & (k == 0), "session_crashed").when(et == "purchase", "session_end").otherwise(et))
    out = _latest(_result(d, S.monitor_sessions(s), "monitor", each=S.batch_files, mode="update"), SES)
    return out.select("session_id", F.unix_micros("last_ts").alias("last_us"), "n_events", "status")


class _Landing:
    """The events as files that land in the order of event time, an eighth of the time at once; two events far ahead come last, so
    that the watermark passes all others."""

    AT_ONCE = 8
    AHEAD = "-1"  # session of the events far ahead

    def __init__(self, d: Tables, name: str, kinds: list[str]):
        self.d, self.kinds, self.path = d, kinds, work_dir(d.spark, name)
        self.lo, hi = d.events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
        self.span = (hi - self.lo) // self.AT_ONCE + 1
        self.lateness = f"{self.span // 1_000_000 + 1} seconds"  # within what lands at once, order is open

    def place(self):
        """The number of the part that an event belongs to."""
        return F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - self.lo) / self.span)

    def put(self, which) -> None:
        self.d.events.where(which).write.mode("append").parquet(self.path)

    def part(self, k: int) -> None:
        self.put(self.place() == k)

    def ahead(self, days: int) -> None:
        kind = self.d.events.schema["ts"].dataType
        last = self.d.events.where(F.col("event_type").isin(self.kinds)).groupBy("event_type").agg(F.max_by(F.struct(*self.d.events.columns), "ts").alias("e")).select("e.*")
        moved = last.withColumns({"ts": (F.col("ts") + F.make_dt_interval(F.lit(days))).cast(kind), "user_id": F.lit(-1).cast(last.schema["user_id"].dataType)})
        moved.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, files: int = 4) -> DataFrame:
        return as_events(self.d.spark.readStream.schema(self.d.events.schema).option("maxFilesPerTrigger", files).parquet(self.path))


@plan(EV + """SELECT a.session_id, a.seq AS spawn_seq, b.seq AS resolve_seq FROM ev a
  LEFT JOIN ev b ON a.session_id = b.session_id AND a.k = b.k AND b.et = 'purchase' AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 12 HOUR WHERE a.et = 'view'""")
def stream_pair_obstacles(d: Tables):
    """Events land over several triggers, and the query is stopped and started between them; a spawn without a resolution
    comes out once the watermark has passed it."""
    land, root, keys = _Landing(d, "landing", ["view", "purchase"]), work_dir(d.spark, "pairs"), [*SES, "k"]
    steps = [[lambda k=k: land.part(k) for k in range(4)], [lambda k=k: land.part(k) for k in range(4, 8)], [lambda: land.ahead(60)], [lambda: land.ahead(120)]]
    for step in steps:
        for put in step:
            put()
        spawns = land.stream().where("event_type = 'view'").select(*keys, "ts", F.col("event_seq").alias("spawn_seq"))
        outcomes = land.stream().where("event_type = 'purchase'").select(*keys, "ts", F.col("event_seq").alias("resolve_seq"))
        out = S.run_available(d.spark, S.pair_obstacles_stream(spawns, outcomes, keys, "12 hours", land.lateness), "pairs", root=root)
    return d.spark.read.parquet(out).where(F.col("session_id") != land.AHEAD).select("session_id", "spawn_seq", "resolve_seq")


@plan(EV + """, w AS (SELECT session_id, et, unnest(generate_series(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') - INTERVAL 18 HOUR, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), INTERVAL 6 HOUR)) AS s FROM ev WHERE et IN ('error', 'purchase'))
  SELECT session_id, epoch_us(s) AS start_us, count(*) AS n, round(avg(CASE WHEN et = 'error' THEN 1.0 ELSE 0.0 END), 6) AS rate FROM w GROUP BY 1, 2""")
def stream_rolling_rate(d: Tables):
    s = _stream(d).where("event_type IN ('error', 'purchase')")
    df = S.rolling_rate_stream(s, SES, F.col("event_type") == "error", "24 hours", "6 hours", MONTH)
    out = _latest(_result(d, df, "rate", each=S.batch_files, mode="update"), ["session_id", "start"])
    return out.select("session_id", F.unix_micros("start").alias("start_us"), "n", F.round("rate", 6).alias("rate"))


@plan(EV + """SELECT session_id, epoch_us(date_trunc('day', ts)) AS start_us, count(*) AS n, round(avg(value), 8) AS mean_value, arg_max(value, (ts, seq)) AS last_value FROM ev GROUP BY 1, 2""")
def stream_downsample(d: Tables):
    df = S.downsample_stream(_stream(d), SES, "value", "1 day", MONTH, F.struct("ts", "event_seq"))
    out = _latest(_result(d, df, "ticks", each=S.batch_files, mode="update"), ["session_id", "start"])
    return out.select("session_id", F.unix_micros("start").alias("start_us"), "n", F.round("mean_value", 8).alias("mean_value"), "last_value")


@plan(EV + """, s AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) < 86400 THEN 0 ELSE 1 END AS fresh FROM ev),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY t, seq) AS stretch FROM s)
    SELECT session_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM g GROUP BY session_id, stretch""")
def stream_idle_gaps(d: Tables):
    # session windows grow, so they are final only in complete mode or past the watermark
    out = _result(d, S.idle_gaps_stream(_stream(d), SES, "1 day", MONTH), "gaps", each=S.batch_files, mode="complete")
    final = out.where(F.col("batch") == out.agg(F.max("batch")).first()[0])
    return final.select("session_id", F.unix_micros("start").alias("start_us"), F.unix_micros("last_ts").alias("last_us"), "n")


_SCORED = EV + """, s AS (SELECT session_id, seq, t, CASE et WHEN 'purchase' THEN 1 ELSE -1 END AS d FROM ev WHERE et IN ('purchase', 'error')),
  p AS (SELECT *, sum(d) OVER (PARTITION BY session_id ORDER BY t, seq) AS p FROM s)
"""


@plan(_SCORED + "SELECT session_id, seq AS event_seq, CAST(p - least(0, min(p) OVER (PARTITION BY session_id ORDER BY t, seq)) AS BIGINT) AS score, 0::BIGINT AS late FROM p")
def stream_clamped_score(d: Tables):
    s = _stream(d).where("event_type IN ('error', 'purchase')").withColumn("delta", F.when(F.col("event_type") == "purchase", 1).otherwise(-1))
    return _result(d, S.clamped_score_stream(s, SES, buckets=BUCKETS), "score").drop("t", "is_late")


@plan(EV + "SELECT session_id, seq AS event_seq, round(t - max(CASE WHEN et = 'error' THEN t END) OVER (PARTITION BY session_id ORDER BY t, seq), 4) AS since FROM ev")
def stream_time_since_last(d: Tables):
    s = _stream(d).withColumn("flag", F.col("event_type") == "error")
    out = _result(d, S.time_since_last_stream(s, SES, buckets=BUCKETS), "since")
    return out.select("session_id", "event_seq", F.round(F.nanvl("since", F.lit(None).cast("double")), 4).alias("since"))


@plan(EV + "SELECT session_id, epoch_us(max(ts)) AS last_us, count(*) AS n_events, CASE WHEN bool_or(et = 'error' AND k = 0) THEN 'crashed' WHEN bool_or(et = 'purchase' AND k = 1) THEN 'completed' ELSE 'running' END AS status FROM ev GROUP BY 1")
def stream_live_sessions(d: Tables):
    """S1 over four steps with stops between. Ended sessions, and those silent for a day, lose their state; the pieces of a session
    that goes on later add up to the whole."""
    land, root = _Landing(d, "live-landing", []), work_dir(d.spark, "live")
    et, k = F.col("event_type"), F.col("k")
    kind = F.when((et == "error") & (k == 0), "session_crashed").when((et == "purchase") & (k == 1), "session_end").otherwise(et)
    for step in range(4):
        land.put(F.floor(land.place() / 2) == step)
        live = S.monitor_live_sessions(land.stream(1_000_000).withColumn("event_type", kind), 86400.0, land.lateness)
        out = S.run_available(d.spark, live, "live", each=S.batch_files, mode="update", root=root)
    pieces = _latest(d.spark.read.parquet(out), [*SES, "begun_us"])
    worst = F.max_by("status", F.array_position(F.array(*[F.lit(s) for s in ("running", "completed", "aborted", "crashed")]), F.col("status")))
    return pieces.groupBy(*SES).agg(F.unix_micros(F.max("last_ts")).alias("last_us"), F.sum("n_events").alias("n_events"), worst.alias("status"))


_LATE = """, span AS (SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 8 + 1 AS span FROM ev),
  l AS (SELECT ev.*, ((epoch_us(ts) - lo) // span) // 2 + CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END AS step FROM ev, span WHERE et IN ('purchase', 'error')),
  m AS (SELECT session_id, step, max(t) AS mt FROM l GROUP BY 1, 2),
  o AS (SELECT l.*, EXISTS (SELECT 1 FROM m WHERE m.session_id = l.session_id AND m.step < l.step AND m.mt > l.t) AS is_late FROM l),
  g AS (SELECT *, t - lag(t) OVER (PARTITION BY session_id ORDER BY t, seq) > 172800 AS anew FROM o WHERE NOT is_late),
  r AS (SELECT *, count(*) FILTER (WHERE anew) OVER (PARTITION BY session_id ORDER BY t, seq) AS run, CASE et WHEN 'purchase' THEN 1 ELSE -1 END AS delta FROM g)
"""
IDLE = 2 * 86400.0


def _with_late_rows(d: Tables, name: str, build) -> DataFrame:
    """Events land in four steps, a tenth of each a step late; the query is stopped between them, and goes on from its checkpoint.
    The watermark waits for late rows, so none is dropped; runs end after two days of silence."""
    land, root = _Landing(d, f"{name}-landing", ["purchase", "error"]), work_dir(d.spark, name)
    late, step = F.get_json_object("props", "$.k").cast("int") % 10 == 3, F.floor(land.place() / 2)
    lateness = f"{4 * land.span // 1_000_000 + 1} seconds"
    for k in range(5):
        land.put(((step == k) & ~late) | ((step == k - 1) & late))
        s = land.stream(1_000_000).where("event_type IN ('error', 'purchase')")  # a step is one batch
        out = S.run_available(d.spark, build(s, lateness), name, root=root)
    return d.spark.read.parquet(out)


@plan(EV + _LATE + """, p AS (SELECT *, sum(delta) OVER (PARTITION BY session_id, run ORDER BY t, seq) AS p FROM r),
  z AS (SELECT session_id, seq, CAST(p - least(0, min(p) OVER (PARTITION BY session_id, run ORDER BY t, seq)) AS BIGINT) AS score, false AS is_late FROM p)
  SELECT session_id, seq AS event_seq, score, is_late FROM z UNION ALL SELECT session_id, seq, NULL, true FROM o WHERE is_late""")
def stream_score_runs(d: Tables):
    """S6 with late rows, runs that end, and timers."""

    def build(s: DataFrame, lateness: str) -> DataFrame:
        moves = s.withColumn("delta", F.when(F.col("event_type") == "purchase", 1).otherwise(-1))
        return S.clamped_score_stream(moves, SES, idle=IDLE, lateness=lateness, buckets=BUCKETS)

    out = _with_late_rows(d, "score-runs", build)
    return out.select("session_id", "event_seq", F.when(~F.col("is_late"), F.col("score")).alias("score"), "is_late")


@plan(EV + _LATE + """, s AS (SELECT session_id, seq, round(t - max(CASE WHEN et = 'error' THEN t END) OVER (PARTITION BY session_id, run ORDER BY t, seq), 4) AS since FROM r)
  SELECT session_id, seq AS event_seq, CASE WHEN tainted THEN NULL ELSE since END AS since, is_late FROM (
    SELECT s.*, false AS is_late, EXISTS (SELECT 1 FROM o WHERE o.is_late AND o.et = 'error' AND o.session_id = s.session_id) AS tainted FROM s
    UNION ALL SELECT session_id, seq, NULL, true, false FROM o WHERE is_late)""")
def stream_since_runs(d: Tables):
    """S7 with late rows, runs that end, and timers; flags of late rows count later on, so sessions that have some are left to the tests."""

    def build(s: DataFrame, lateness: str) -> DataFrame:
        return S.time_since_last_stream(s.withColumn("flag", F.col("event_type") == "error"), SES, idle=IDLE, lateness=lateness, buckets=BUCKETS)

    out = _with_late_rows(d, "since-runs", build)
    flags = d.ev.where("event_type = 'error'").select("session_id", "event_seq")
    tainted = out.where("is_late").join(flags, ["session_id", "event_seq"]).select("session_id").distinct().withColumn("tainted", F.lit(True))
    since = F.when(F.col("tainted").isNull(), F.nanvl("since", F.lit(None).cast("double")))
    return out.join(tainted, "session_id", "left").select("session_id", "event_seq", F.round(since, 4).alias("since"), "is_late")


@plan("""WITH RECURSIVE q AS (SELECT user_id, epoch_us(ts) / 1e6 AS t FROM events WHERE value > 20), f AS (SELECT user_id, min(t) AS t FROM q GROUP BY 1),
  kept(user_id, t) AS (SELECT user_id, t FROM f UNION ALL
    SELECT n.user_id, n.t FROM (SELECT k.user_id, (SELECT min(q.t) FROM q WHERE q.user_id = k.user_id AND q.t > k.t + 43200) AS t FROM kept k) n WHERE n.t IS NOT NULL)
  SELECT CAST(user_id AS VARCHAR) AS session_id, t FROM kept""")
def stream_debounce(d: Tables):
    return _result(d, S.debounce_stream(_stream(d).where("value > 20"), SES, 43200.0, buckets=BUCKETS), "debounce").select("session_id", "t")


@plan("SELECT DISTINCT CAST(user_id AS VARCHAR) AS session_id, event_type, date_trunc('day', ts) AS day FROM events")
def stream_dedupe(d: Tables):
    """Days on which a session had an event type: one row survives per key."""
    s = _stream(d).withColumn("day", F.date_trunc("day", "ts"))
    return _result(d, S.dedupe_stream(s, ["session_id", "event_type", "day"], MONTH), "dedupe").select("session_id", "event_type", F.col("day").cast("timestamp_ntz").alias("day"))


@plan(EV + """SELECT session_id, seq AS event_seq, CASE WHEN et = 'signup' THEN 'sync_error' WHEN et = 'error' THEN 'crash' ELSE 'bad_fit' END AS alert FROM ev
   WHERE (et = 'signup' AND k < 10) OR (et = 'error' AND k < 5) OR (et = 'view' AND k % 9 = 0)""")
def stream_alerts(d: Tables):
    et, k = F.col("event_type"), F.col("k")
    s = _stream(d).withColumn("event_type", F.when(et == "signup", "device_sync").when((et == "error") & (k < 5), "session_crashed").when(et == "view", "clip_video_metadata").otherwise(et))
    df = S.alerts(s, F.when(k < 10, "error").otherwise("ok"), F.when(k % 9 == 0, "fill").otherwise("contain"))
    return _result(d, df.select("session_id", "event_seq", "alert"), "alerts", each=S.batch_files).drop("batch")


@plan(_I + "SELECT e.session_id, e.seq AS sample_idx, i.label FROM ev e JOIN i ON i.session_id = e.session_id AND e.t >= i.t0 AND e.t < i.t1")
def stream_label_samples(d: Tables):
    s = _stream(d).select("session_id", F.col("event_seq").alias("sample_idx"), F.col("t").alias("wall"))
    each = lambda path: S.label_batches(_intervals(d), S.batch_files(path), SES, 6 * 3600.0)
    return _result(d, s, "label", each=each).select("session_id", "sample_idx", "label")
