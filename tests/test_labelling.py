"""Recordings with known labels, from device time to windows and splits."""

import pytest
from pyspark.sql import functions as F

from cohortwave.operators import joins as J, labelling as B, project as P, stats as A
from cohortwave.sources import readers as R
from cohortwave.sources.readers import read_samples
from tests import study


@pytest.fixture(scope="module")
def samples(spark, tmp_path_factory):
    """60 s at 250 Hz with 8 channels; relative time starts at the sync."""
    path = str(tmp_path_factory.mktemp("recordings") / "r")
    ch = F.array(*[(F.col("id") % 250 + c).cast("float") for c in range(8)])
    spark.range(60 * 250).select(
        F.lit("r1").alias("recording_id"), F.lit("s1").alias("session_id"), F.lit("eeg").alias("device_role"), F.lit("d1").alias("device_id"), F.col("id").alias("sample_idx"),
        (F.col("id") / 250).alias("rel_sec"), ch.alias("ch"),
    ).write.parquet(path)
    return read_samples(spark, path)


@pytest.fixture(scope="module")
def sync(spark):
    return spark.createDataFrame([("s1", "eeg", "d1", 1000.0, "ok"), ("s1", "eeg", "d1", 900.0, "ok"), ("s1", "eeg", "d1", 2000.0, "error")], "session_id STRING, device_role STRING, device_id STRING, sync_time_host_utc DOUBLE, result STRING")


@pytest.fixture(scope="module")
def intervals(spark):
    rows = [("s1", 1000.0, 1010.0, "baseline"), ("s1", 1010.0, 1030.5, "stress"), ("s1", 1040.0, 1040.5, "stress")]
    df = spark.createDataFrame(rows, "session_id STRING, t0 DOUBLE, t1 DOUBLE, label STRING")
    pause = spark.createDataFrame([("s1", 1030.5, 1035.0, None)], "session_id STRING, t0 DOUBLE, t1 DOUBLE, label STRING")
    return B.labelled_intervals(("block", df), ("pause", pause))


def test_labels_are_half_open(samples, sync, intervals):
    aligned = J.align_samples(samples, sync)
    assert aligned.agg(F.min("wall")).first()[0] == 1000.0
    out = J.label_samples(aligned, intervals, bucket=7.0)
    n = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert n == {"baseline": 2500, "stress": 5125 + 125}
    assert out.where("wall = 1010.0").first().label == "stress"
    every = J.label_samples(aligned, intervals, bucket=7.0, keep_unlabelled=True)
    assert every.count() == 15000 and every.groupBy("sample_idx").count().where("count > 1").count() == 0
    assert B.overlapping_intervals(intervals, width=5.0).count() == 0
    rec = aligned.select("recording_id").distinct().withColumn("started_utc", F.lit(950.0))
    assert J.align_samples(samples, sync, rec).agg(F.min("wall")).first()[0] == 900.0


def test_windows_features_and_completeness(samples, sync, intervals):
    w = B.fixed_windows(intervals, 1.0, 0.5)
    assert {(r.label, r.n) for r in w.groupBy("t0", "label").agg(F.count("*").alias("n")).collect()} == {("baseline", 19), ("stress", 40)}
    holed = J.align_samples(samples, sync).where("NOT (sample_idx BETWEEN 500 AND 599)")
    s = B.slice_samples(holed, intervals, 1.0, 1.0, bucket=7.0)
    assert s.where("offset_sec < 0 OR offset_sec >= 1").count() == 0
    planned = B.fixed_windows(intervals, 1.0, 1.0).withColumn("device_id", F.lit("d1"))
    c = B.completeness(s.where("NOT (t0 = 1010 AND window_no = 4)"), planned, 250.0, 1.0)
    bad = c.where("NOT accepted").orderBy("t0").collect()
    assert [(r.t0, r.window_no, r.found) for r in bad] == [(1000.0, 2, 150), (1010.0, 4, 0)] and c.count() == 10 + 20
    f = A.window_features(s, ["t0", "window_no"])
    one = f.where("t0 = 1000 AND window_no = 0 AND channel = 3").first()
    assert (one.n, one.min, one.max) == (250, 3.0, 252.0) and one.mean == pytest.approx(127.5) and one.missing_share == 0.0
    expect = A.window_features(s.withColumn("want", F.lit(250)), ["t0", "window_no"], "want")
    assert expect.where("t0 = 1000 AND window_no = 2 AND channel = 0").first().missing_share == pytest.approx(0.4)
    base = f.where("t0 = 1000 AND window_no = 0").select("channel", "mean")
    fixed = B.baseline_correct(f, base, ["channel"])
    assert fixed.where("t0 = 1010 AND abs(mean_corrected) > 1e-9").count() == 0
    over = s.count()
    assert B.slice_samples(holed, intervals, 1.0, 0.5, bucket=7.0).count() > 1.9 * over - 500


def test_plan_has_no_nested_loop(samples, sync, intervals):
    plan = B.label_recordings(samples, sync, intervals, 1.0, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlapping_labels_are_an_error(samples, sync, intervals):
    twice = intervals.unionByName(intervals.where("t0 = 1010").withColumn("t0", F.lit(1015.0)))
    with pytest.raises(Exception, match="labels overlap"):
        B.label_recordings(samples, sync, twice, 1.0, 1.0).count()
    again = sync.unionByName(sync.where("sync_time_host_utc = 1000").withColumn("sync_time_host_utc", F.lit(5000.0)))  # synced anew after the recording
    rec = samples.select("recording_id").distinct().withColumn("started_utc", F.lit(1001.0))
    assert B.label_recordings(samples, again, intervals, 1.0, 1.0, recordings=rec).count() == B.label_recordings(samples, sync, intervals, 1.0, 1.0).count()
    drifting = sync.withColumn("device_rel_sec", F.lit(0.0)).where("sync_time_host_utc = 1000")
    assert B.label_recordings(samples, drifting, intervals, 1.0, 1.0, drift=True).count() == B.label_recordings(samples, sync, intervals, 1.0, 1.0).count()


def test_split_keeps_participants_together(spark, tmp_path):
    df = spark.range(2000).select(F.concat(F.lit("P"), F.col("id") % 200).alias("participant_id"), "id")
    s = B.participant_split(df, seed=3)
    assert s.groupBy("participant_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    n = {r.split: r.n for r in s.groupBy("split").agg(F.count_distinct("participant_id").alias("n")).collect()}
    assert sum(n.values()) == 200 and n["train"] > 130
    B.export_dataset(df, str(tmp_path / "out"), seed=0)  # an earlier export with another split must leave nothing behind
    B.export_dataset(df, str(tmp_path / "out"), seed=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("participant_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert back.count() == 2000 and back.where("split = 'train'").select("participant_id").distinct().count() == n["train"]


def test_session_package_to_dataset(spark, tmp_path):
    """Raw files to an exported dataset, as the README shows it."""
    root = study.build(tmp_path / "in")
    ev = P.assign_run_ordinal(R.intact(R.read_events(spark, root)))
    blocks = J.pair_blocks(ev).where("task = 'stress'")
    sync = J.expand_sync(R.read_manifests(spark, root))
    on_wall = blocks.withColumns({"t0": F.col("host_t0"), "t1": F.col("host_t1")})
    intervals = B.labelled_intervals(("block", P.label_policy(on_wall, "ordinal")))
    assert sorted(r.label for r in intervals.collect()) == ["0", "1", "2"]  # pauses have no label
    spark.range(400 * 10).select(
        F.concat(F.lit("r"), F.col("id") * 0).alias("recording_id"), F.lit("P_01_1700000000").alias("session_id"), F.lit("ear_eeg_out").alias("device_role"), F.lit("ear_eeg_out-1").alias("device_id"),
        F.col("id").alias("sample_idx"), (F.col("id") / 10).alias("rel_sec"), F.array(F.lit(1.0).cast("float")).alias("ch"),
    ).write.parquet(str(tmp_path / "samples"))
    w = B.label_recordings(R.read_samples(spark, str(tmp_path / "samples")), sync, intervals, 1.0, 1.0, 30.0)
    per = {r.label: r.n for r in w.groupBy("label").agg(F.count_distinct("t0", "window_no").alias("n")).collect()}
    length = {r.label: int(r.t1 - r.t0 + 1e-6) for r in intervals.collect()}
    assert per == length
    B.export_dataset(w.join(ev.select("session_id", "participant_id").distinct(), "session_id"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == w.count()
