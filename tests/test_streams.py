"""Streams over several landed files equal the batch result."""

import json

import pytest
from pyspark.sql import functions as F

from cohortwave.operators import joins as J, project as P
from cohortwave.schema import field
from cohortwave.sources import readers as R
from cohortwave.streaming import streams as S
from tests import study

TRIALS = "s STRING, ts TIMESTAMP, t DOUBLE, event_seq BIGINT, delta INT, flag BOOLEAN, v DOUBLE"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Four files in time order, one micro-batch each."""
    d = str(tmp_path_factory.mktemp("landed"))
    rows = [("a" if i % 3 else "b", i, (i * 7) % 3 - 1, i % 5 == 0, float(i)) for i in range(80)]
    for k in range(4):
        df = spark.createDataFrame(rows[k * 20 : (k + 1) * 20], "s STRING, i INT, delta INT, flag BOOLEAN, v DOUBLE")
        df.select("s", F.timestamp_seconds(F.col("i") + 1000).alias("ts"), F.col("i").cast("double").alias("t"), F.col("i").cast("bigint").alias("event_seq"), "delta", "flag", "v").coalesce(1).write.mode("append").parquet(d)
    return d, rows


def stream(spark, d):
    return spark.readStream.schema(TRIALS).option("maxFilesPerTrigger", 1).parquet(d)


def test_stateful_operators(spark, landed):
    d, rows = landed
    score, since, kept = {}, {}, set()
    state = {}
    for s, i, delta, flag, v in rows:
        sc, at, last = state.get(s, (0, None, float("-inf")))
        sc = max(0, sc + delta)
        at = i if flag else at
        if i > last + 4:
            last = i
            kept.add((s, i))
        state[s] = (sc, at, last)
        score[i], since[i] = sc, None if at is None else float(i - at)
    out = spark.read.parquet(S.run_available(spark, S.clamped_score_stream(stream(spark, d), ["s"]), "score"))
    assert {r.event_seq: (r.score, r.late) for r in out.collect()} == {i: (v, 0) for i, v in score.items()}
    out = spark.read.parquet(S.run_available(spark, S.time_since_last_stream(stream(spark, d), ["s"]), "since"))
    assert {r.event_seq: None if r.since is None or r.since != r.since else r.since for r in out.collect()} == since
    out = spark.read.parquet(S.run_available(spark, S.debounce_stream(stream(spark, d), ["s"], 4.0), "deb"))
    assert {(r.s, r.event_seq) for r in out.collect()} == kept


def test_late_rows_are_counted(spark, tmp_path):
    for k, ts in enumerate(([1.0, 5.0], [3.0, 6.0])):
        spark.createDataFrame([("a", t, int(t), 1) for t in ts], "s STRING, t DOUBLE, event_seq BIGINT, delta INT").coalesce(1).write.mode("append").parquet(str(tmp_path))
    df = spark.readStream.schema("s STRING, t DOUBLE, event_seq BIGINT, delta INT").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    out = spark.read.parquet(S.run_available(spark, S.clamped_score_stream(df, ["s"]), "late"))
    assert {r.t: (r.score, r.late) for r in out.collect()} == {1.0: (1, 0), 5.0: (2, 0), 3.0: (2, 1), 6.0: (3, 1)}


def test_ended_runs_are_forgotten_and_late_rows_are_marked(spark, tmp_path):
    """A silence ends a run, a timer drops its state, late rows are marked and counted, and a stop in between changes nothing."""
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    cols = "s STRING, t DOUBLE, event_seq BIGINT, delta INT, flag BOOLEAN"
    steps = [[("a", 0, 1), ("a", 10, 1), ("b", 5, 1)], [("a", 4, -1), ("a", 12, -1), ("a", 60, 1)], [("c", 500, 1)], [("c", 900, 1), ("a", 905, 1)]]
    held = {"score": [], "since": [], "deb": []}
    build = {
        "score": lambda df: S.clamped_score_stream(df, ["s"], idle=30.0, lateness="20 seconds"), "since": lambda df: S.time_since_last_stream(df, ["s"], idle=30.0, lateness="20 seconds"),
        "deb": lambda df: S.debounce_stream(df, ["s"], 8.0, lateness="20 seconds"),
    }
    for step in steps:
        rows = [(s, float(t), t, d, d > 0) for s, t, d in step]
        spark.createDataFrame(rows, cols).withColumn("ts", F.timestamp_seconds(F.col("t") + 1000)).coalesce(1).write.mode("append").parquet(src)
        for name, make in build.items():
            out = S.run_available(spark, make(spark.readStream.schema(f"{cols}, ts TIMESTAMP").parquet(src)), name, root=f"{root}/{name}")
            held[name].append({r.key.s for r in spark.read.format("statestore").load(f"{root}/{name}/checkpoint").select("key").collect()})
    read = lambda name: spark.read.parquet(f"{root}/{name}/result").collect()
    assert {(r.s, r.event_seq): (r.score, r.late, r.is_late) for r in read("score")} == {
        ("a", 0): (1, 0, False), ("a", 10): (2, 0, False), ("b", 5): (1, 0, False), ("a", 4): (2, 1, True), ("a", 12): (1, 1, False), ("a", 60): (1, 1, False),
        ("c", 500): (1, 0, False), ("c", 900): (1, 0, False), ("a", 905): (1, 0, False),
    }
    since = {(r.s, r.event_seq): (None if r.since is None or r.since != r.since else r.since, r.is_late) for r in read("since")}
    assert since[("a", 4)] == (None, True) and since[("a", 12)] == (2.0, False) and since[("a", 60)] == (0.0, False) and since[("c", 900)] == (0.0, False)
    assert {(r.s, r.event_seq) for r in read("deb")} == {("a", 0), ("a", 10), ("b", 5), ("a", 60), ("c", 500), ("c", 900), ("a", 905)}
    for name in held:
        assert {"a", "b"} <= held[name][0] and held[name][2] == {"c"}, name


def test_keys_that_share_state_give_the_same_rows(spark, tmp_path):
    """Few buckets for many keys: a call each, the same rows, and the same keys forgotten."""
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    cols = "s STRING, u INT, t DOUBLE, event_seq BIGINT, delta INT, flag BOOLEAN"
    build = {
        "score": lambda df, n: S.clamped_score_stream(df, ["s", "u"], idle=30.0, lateness="20 seconds", buckets=n), "since": lambda df, n: S.time_since_last_stream(df, ["s", "u"], idle=30.0, lateness="20 seconds", buckets=n),
        "deb": lambda df, n: S.debounce_stream(df, ["s", "u"], 8.0, lateness="20 seconds", buckets=n), "kept": lambda df, n: S.clamped_score_stream(df, ["s", "u"], buckets=n),
    }
    held = {}
    for step in range(4):
        at = [(i * 37 % 100 + step * 90 - (25 if i % 11 == 0 else 0), i) for i in range(200)]
        rows = [(None if i % 13 == 0 else f"k{i % 13}", i % 2 if i % 17 else None, float(t), step * 200 + i, (i * 7) % 3 - 1, i % 4 == 0) for t, i in at if (i % 13 + step) % 4]
        spark.createDataFrame(rows, cols).withColumn("ts", F.timestamp_seconds(F.col("t") + 1000)).coalesce(1).write.mode("append").parquet(src)
        for name, make in build.items():
            for n in (None, 3):
                S.run_available(spark, make(spark.readStream.schema(f"{cols}, ts TIMESTAMP").parquet(src), n), name, root=f"{root}/{name}-{n}")
    for name in build:
        one, shared = (sorted(map(str, spark.read.parquet(f"{root}/{name}-{n}/result").collect())) for n in (None, 3))
        assert one == shared and one, name
        state = lambda n: {w for r in spark.read.format("statestore").load(f"{root}/{name}-{n}/checkpoint").select("value.*").collect() for w in r[0].who}
        held[name] = state(None)
        assert state(3) == held[name] and spark.read.format("statestore").load(f"{root}/{name}-3/checkpoint").count() <= 3, name
    assert held["score"] < held["kept"]


def test_sessions_that_ended_or_fell_silent_are_dropped(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    cols = "session_id STRING, event_type STRING, task STRING, at INT"
    steps = [
        [("a", "session_start", "x", 0), ("a", "session_end", "y", 10), ("b", "key", "x", 5), ("d", "key", "x", None)], [("b", "key", "z", 40), ("c", "key", "x", 60)], [("c", "task_abort", "x", 500)],
        [("b", "session_crashed", "x", 900), ("c", "key", "w", 905)],
    ]
    held = []
    for step in steps:
        df = spark.createDataFrame(step, cols).withColumn("ts", F.timestamp_seconds(F.col("at") + 1000))
        df.coalesce(1).write.mode("append").parquet(src)
        live = S.monitor_live_sessions(spark.readStream.schema(f"{cols}, ts TIMESTAMP").parquet(src), 100.0, "20 seconds")
        out = S.run_available(spark, live, "live", each=S.batch_files, mode="update", root=root)
        held.append({r.key.session_id for r in spark.read.format("statestore").load(f"{root}/checkpoint").select("key").collect()})
    rows = spark.read.parquet(out).groupBy("session_id", "begun_us").agg(F.max_by(F.struct("n_events", "status", "task", F.unix_seconds("last_ts").alias("s")), "batch").alias("v")).collect()
    assert {(r.session_id, r.begun_us // 1_000_000 - 1000): (r.v.n_events, r.v.status, r.v.task, r.v.s - 1000) for r in rows} == {
        ("a", 0): (2, "completed", "y", 10), ("b", 5): (2, "running", "z", 40), ("c", 60): (3, "aborted", "w", 905), ("b", 900): (1, "crashed", "x", 900),
    }
    # a ended and is passed at 40; b is silent from 40 on; c's end is not passed yet when its last event comes
    assert held[0] == {"a", "b"} and held[1] == {"b", "c"} and held[2] == {"c"}, held
    assert "a" not in held[3] and "d" not in held[3]


def test_unmatched_spawns_come_out_after_the_watermark(spark, tmp_path):
    schema = "s STRING, trial INT, ts TIMESTAMP, kind STRING"
    files = [[("a", 1, 0, "spawn"), ("a", 1, 2, "resolved"), ("a", 2, 5, "spawn")], [("a", 9, 500, "spawn"), ("a", 9, 501, "resolved")], [("a", 10, 900, "spawn"), ("a", 10, 901, "resolved")]]
    for rows in files:
        df = spark.createDataFrame(rows, "s STRING, trial INT, i INT, kind STRING")
        df.select("s", "trial", F.timestamp_seconds(F.col("i") + 1000).alias("ts"), "kind").coalesce(1).write.mode("append").parquet(str(tmp_path))
    src = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    df = S.pair_obstacles_stream(src().where("kind = 'spawn'").drop("kind"), src().where("kind = 'resolved'").drop("kind"), ["s", "trial"], "10 seconds", "5 seconds")
    out = spark.read.parquet(S.run_available(spark, df, "pair"))
    got = {r.trial: r.resolved_ts is not None for r in out.collect()}
    assert got[1] is True and got[2] is False and got[9] is True


def test_windows_and_dedupe(spark, landed):
    d, rows = landed
    src = lambda: stream(spark, d)
    batch = spark.read.parquet(d)
    latest = lambda df, keys: df.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))
    for name, df, slide in (("rate", S.rolling_rate_stream(src(), ["s"], F.col("flag"), "15 seconds", "1 second"), "1 second"), ("ticks", S.downsample_stream(src(), ["s"], "v", "15 seconds"), "15 seconds")):
        out = latest(spark.read.parquet(S.run_available(spark, df, name, each=S.batch_files, mode="update")), ["s", "start"])
        want = batch.groupBy("s", F.window("ts", "15 seconds", slide)).count().select("s", "window.start", "count")
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    twice = src().union(src())
    assert spark.read.parquet(S.run_available(spark, S.dedupe_stream(twice, ["s", "event_seq"]), "dd")).count() == 80


def test_event_files(spark, tmp_path):
    root = study.build(tmp_path / "in")
    ev = R.intact(R.read_events_stream(spark, root))
    out = spark.read.parquet(S.run_available(spark, S.monitor_sessions(ev), "mon", each=S.batch_files, mode="update"))
    last = out.groupBy("session_id").agg(F.max_by("status", "batch").alias("status"), F.max_by("n_events", "batch").alias("n"))
    batch = R.intact(R.read_events(spark, root))
    assert {r.session_id: r.n for r in last.collect()} == {r.session_id: r["count"] for r in batch.groupBy("session_id").count().collect()}
    a = S.alerts(R.intact(R.read_events_stream(spark, root)), field("result", "string"), field("object_fit", "string")).select("session_id", "alert")
    got = spark.read.parquet(S.run_available(spark, a, "al", each=S.batch_files))
    assert sorted((r.session_id[:4], r.alert) for r in got.collect()) == [("P_01", "bad_fit"), ("P_02", "abort"), ("P_02", "bad_fit"), ("P_03", "crash")]


def test_live_samples_get_labels(spark, landed):
    d, rows = landed
    iv = spark.createDataFrame([("a", 0.0, 30.0, "x"), ("a", 30.0, 60.0, "y")], "s STRING, t0 DOUBLE, t1 DOUBLE, label STRING")
    s = stream(spark, d).withColumn("wall", F.col("t"))
    out = spark.read.parquet(S.run_available(spark, s, "lab", each=lambda p: S.label_batches(iv, S.batch_files(p), ["s"], 7.0)))
    want = J.label_samples(spark.read.parquet(d).withColumn("wall", F.col("t")), iv, ["s"], 7.0)
    key = lambda df: sorted((r.event_seq, r.label) for r in df.collect())
    assert key(out) == key(want)
