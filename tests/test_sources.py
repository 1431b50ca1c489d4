"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from cohortwave import schema as S
from cohortwave.functions.scalars import safe_label, video_code
from cohortwave.operators import joins as J, layout as L
from cohortwave.plans import io_plans
from cohortwave.plans.registry import PLANS
from cohortwave.sources import readers as R, writers as W


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("stimuli")
    clips = [
        {"clip_id": f"clip_{i:02d}", "valence_group": g, "fine_grained_label": "joy", "title": f"VID_{i}", "language": "none", "file_path": "x", "duration_sec": 10.0 + i}
        for i, g in enumerate(["positive"] * 4 + ["neutral"] * 4 + ["negative"], 1)
    ]
    (d / "manifest.json").write_text(json.dumps({"_comment": "c", "clips": clips}, indent=2))
    fixed = {"_comment": "text", "positive": [{"clip_id": "clip_02", "title": "VID_2", "valence_score": 1.0, "arousal_score": None}, {"clip_id": "clip_99", "title": "VID_99", "valence_score": 1.0, "arousal_score": 2.0}, {"clip_id": "clip_01", "title": "VID_1", "valence_score": 1.0, "arousal_score": 2.0}], "neutral": [], "negative": []}
    (d / "fixed.json").write_text(json.dumps(fixed, indent=2))
    rows = [("VID_1", "joy", 5.0, 5.0), ("VID_2", "joy", 4.0, 7.0), ("VID_3", "joy", 4.0, 7.0), ("VID_5", "calm", 4.0, 3.0), ("VID_6", "calm", 4.0, 1.0), ("VID_7", "calm", 4.0, 1.0), ("VID_50", "Joy!", 1.0, 2.0)]
    text = "video_code,modal_emotion,valence_wsd,arousal_wsd,language_free,length_s,source_URL\n" + "".join(f"{a},{b},{c},{e},TRUE,12.5,http://x\n" for a, b, c, e in rows)
    (d / "meta.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (d / "manual.txt").write_text("# head\n\nVID_3, positive  # known\nVID_50, negative\nVID_5, positive\nVID_77, neutral\nbad line\nVID_1, sad\n")
    (d / "picks.txt").write_text("# how to\n[joy]\n#VID_310\t70.92\t1280x720\nVID_524\t62.98\t1280x720\n# VID_716\t58.3\t1280x540  <-- below\n\n[sadness]\nVID_600\t50.0\t1280x720\n")
    (d / "scenario.txt").write_text("0:00:00;sysmon;start\n0:01:05;sysmon;scales-1-failure;True\nnonsense\n1:00:00;sysmon;stop\n")
    (d / "P_1").mkdir()
    (d / "P_1" / "log.csv").write_text("t,kind,rt\n1.0,HIT,0.5\n2.0,MISS,\n")
    return d


def test_clip_files(spark, files):
    clips = R.read_clip_manifest(spark, str(files / "manifest.json"))
    assert clips.count() == 9 and clips.where("manifest_pos = 0").first().clip_id == "clip_01"
    fixed = R.read_fixed_clips(spark, str(files / "fixed.json"))
    assert [(r.valence_group, r.pos, r.clip_id) for r in fixed.orderBy("pos").collect()] == [("positive", 0, "clip_02"), ("positive", 1, "clip_99"), ("positive", 2, "clip_01")]
    # the missing listed id is not replaced; groups without a list come from the sample
    wants = clips.select(F.lit("p").alias("participant_id"), "valence_group").distinct()
    chosen = J.fixed_selection(clips, fixed, 2, L.seeded_sample(wants, clips, 2, 1).drop("draw", "participant_id"))
    got = {g: n for g, n in chosen.groupBy("valence_group").count().collect()}
    assert got == {"positive": 1, "neutral": 2, "negative": 1}


def test_metadata_and_ranking(spark, files):
    meta = R.read_clip_metadata(spark, str(files / "meta.csv"))
    assert meta.columns[0] == "video_code" and dict(meta.dtypes)["arousal_wsd"] == "double"
    with pytest.raises(ValueError, match="absent"):
        R.read_clip_metadata(spark, str(files / "meta.csv"), ("video_code", "absent"))
    clips = R.read_clip_manifest(spark, str(files / "manifest.json"))
    good, missing = J.enrich_clips(clips, meta)
    assert sorted(r.title for r in missing.collect()) == ["VID_4", "VID_8", "VID_9"]
    top = L.top_clips(good, 2)
    assert [(r.valence_group, r.title) for r in top.orderBy("valence_group", "rank").collect()] == [("neutral", "VID_6"), ("neutral", "VID_7"), ("positive", "VID_2"), ("positive", "VID_3")]
    assert R.emotion_labels(meta).where("code = 'VID_50'").first().emotion == "joy"


def test_manual_merge(spark, files):
    entries, rejects = R.read_manual_clips(spark, str(files / "manual.txt"))
    assert [(r.line_no, r.video_code) for r in entries.orderBy("line_no").collect()] == [(3, "VID_3"), (4, "VID_50"), (5, "VID_5"), (6, "VID_77")]
    assert [(r.line_no, r.error) for r in rejects.orderBy("line_no").collect()] == [(7, "arity"), (8, "group")]
    clips, fixed = R.read_clip_manifest(spark, str(files / "manifest.json")), R.read_fixed_clips(spark, str(files / "fixed.json"))
    place = F.concat_ws("/", F.lit("stimuli"), "modal_emotion", F.concat("video_code", F.lit(".mp4")))
    out = J.merge_manual_clips(clips, entries, R.read_clip_metadata(spark, str(files / "meta.csv")), fixed, F.col("language_free"), place)
    new = out["clips"].where("title = 'VID_50'").first()
    assert new.clip_id == "clip_10" and new.valence_group == "negative" and new.file_path == "stimuli/Joy!/VID_50.mp4"
    assert [r.video_code for r in out["errors"].collect()] == ["VID_77"]
    lists = {(r.valence_group, r.pos): r.title for r in out["fixed"].collect()}
    assert lists == {("positive", 0): "VID_3", ("negative", 0): "VID_50", ("neutral", 0): "VID_5"}


def test_text_formats(spark, files):
    p = R.read_sectioned_picks(spark, str(files / "picks.txt")).orderBy("line_no").collect()
    assert [(r.section, r.video_code, r.picked, r.height) for r in p] == [("joy", "VID_310", False, 720), ("joy", "VID_524", True, 720), ("joy", "VID_716", False, 540), ("sadness", "VID_600", True, 720)]
    s = R.read_scenario(spark, str(files / "scenario.txt")).orderBy("t_sec").collect()
    assert [(r.t_sec, r.cmd, r.value_text) for r in s] == [(0, "start", None), (65, "scales-1-failure", "True"), (3600, "stop", None)]
    log = R.read_task_log_csv(spark, str(files / "P_1" / "log.csv"), "t DOUBLE, kind STRING, rt DOUBLE")
    assert log.where("kind = 'HIT'").first().session_id == "P_1"


def test_labels(spark):
    df = spark.createDataFrame([("  Joy / Äpfel! ",), ("...",), ("",), ("a.b-c",), ("vid-007 VID_2",), (None,)], "s STRING")
    assert [r[0] for r in df.select(safe_label(F.col("s"))).collect()] == ["joy_äpfel", "unlabelled", "unlabelled", "a.b-c", "vid-007_vid_2", "unlabelled"]
    assert [r[0] for r in df.select(video_code(F.col("s"))).collect()] == ["", "", "", "", "VID_7", ""]


def test_links(spark):
    html = "<li><strong> VID_1.webm </strong> x <a class='d' href=\"u1\"></li><li><strong>VID_2.webm</strong>\n<a class='d' href=\"u2\"></li><li><strong>vid-001.webm</strong><a class='d' href=\"u3\"></li>"
    df = spark.createDataFrame([(1, html)], "page_id INT, html STRING")
    links = R.extract_links(df, r"(?s)<strong>\s*(\S+)\s*</strong>.*?class='d' href=\"([^\"]*)\"")
    assert [(r.name, r.url) for r in links.orderBy("pos").collect()] == [("VID_1.webm", "u1"), ("VID_2.webm", "u2"), ("vid-001.webm", "u3")]
    last = R.last_link_per_code(links, video_code(F.col("name")))
    assert {r.code: r.url for r in last.collect()} == {"VID_1": "u3", "VID_2": "u2"}


def test_curated_rewrite_keeps_other_sessions(spark, tmp_path):
    path = str(tmp_path / "t")
    W.write_curated(spark.createDataFrame([("a", 1), ("b", 2)], "session_id STRING, x INT"), path)
    for _ in range(2):
        W.write_curated(spark.createDataFrame([("a", 5), ("a", 6)], "session_id STRING, x INT"), path)
    assert sorted((r.session_id, r.x) for r in spark.read.parquet(path).collect()) == [("a", 5), ("a", 6), ("b", 2)]
    W.write_report(spark.createDataFrame([(1, "x")], "a INT, b STRING"), str(tmp_path / "r"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first().b == "x"


def test_curated_sessions_share_folders(spark, tmp_path):
    path, cols = str(tmp_path / "t"), "session_id STRING, x INT"
    rows = [(f"s{i}", i) for i in range(40)] + [(None, 7), ("s0", 100)]
    W.write_curated(spark.createDataFrame(rows, cols), path, buckets=4)
    new = [("s3", 5), ("s3", 6), ("late", 1), (None, 8)]
    for _ in range(2):
        W.write_curated(spark.createDataFrame(new, cols), path, buckets=4)
    back = spark.read.parquet(path)
    want = [r for r in rows if r[0] not in ("s3", None)] + new
    assert sorted(((r.session_id, r.x) for r in back.collect()), key=str) == sorted(want, key=str)
    assert len(list((tmp_path / "t").glob("*=*"))) <= 4 and back.schema["session_id"].dataType.simpleString() == "string"


def test_fixed_lists_go_on_from_file_to_file(spark, tmp_path):
    for part, clips in ((10, ["e"]), (2, ["c", "d"]), (1, ["a", "b"])):
        body = {"part": part, "positive": [{"clip_id": c} for c in clips], "negative": [{"clip_id": f"n{part}"}] if part != 2 else []}
        (tmp_path / f"{100 - part}.json").write_text(json.dumps(body, indent=1))
    listed = {(r.valence_group, r.pos): r.clip_id for r in R.read_fixed_clips(spark, str(tmp_path), part="part").collect()}
    assert listed == {**{("positive", i): c for i, c in enumerate("abcde")}, ("negative", 0): "n1", ("negative", 1): "n10"}


def test_fixed_clips_number_all_suppliers_of_a_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io_plans, "_LISTED", 30)
    rows = [(k, k % 5, k / 2) for k in range(1, 400) if k % 7]
    spark.createDataFrame(rows, "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE").write.parquet(str(tmp_path / "supplier.parquet"))
    out = PLANS["read_fixed_clips"](spark, str(tmp_path)).collect()
    groups = {0: "positive", 1: "negative", 2: "neutral"}
    want = {(groups[g], i): (f"clip_{k}", v) for g in groups for i, (k, _, v) in enumerate(r for r in rows if r[1] % 3 == g)}
    assert {(r.valence_group, r.pos): (r.clip_id, r.valence_score) for r in out} == want and len(out) == len(rows)


def test_a_hot_session_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(0, 400_000, 1, 16).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("session_id"), F.xxhash64("id").alias("x"))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    monkeypatch.setattr(W, "MOST_ROWS", 50_000)
    for size, least in (("64m", 3), ("256k", 4)):  # one task must still bound its files
        spark.conf.set(name, size)
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        try:
            W.write_curated(rows, path)
        finally:
            spark.conf.unset(name)
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        back = spark.read.parquet(path)
        per = {r.session_id: (r.n, r.most) for r in back.groupBy("session_id", F.input_file_name().alias("f")).count().groupBy("session_id").agg(F.count("*").alias("n"), F.max("count").alias("most")).collect()}
        assert per["hot"][0] >= least and per["hot"][1] <= 50_000
        few = [n <= 2 for s, (n, _) in per.items() if s != "hot"]  # those in the hot one's shuffle partition are spread with it
        assert len(few) == 40 and sum(few) >= 20
        assert back.count() == 400_000 and back.agg(F.sum(F.col("x").cast("decimal(38,0)"))).first() == rows.agg(F.sum(F.col("x").cast("decimal(38,0)"))).first()


def test_equal_readings_keep_the_order_of_the_file(spark, tmp_path):
    """A block end and the next start at one reading, over many splits of one file; torn and blank lines between."""
    names = ["block_end", "block_start", "session_crashed", "key"]
    want = []
    for s in ("a", "b"):
        (tmp_path / s).mkdir()
        lines = []
        for i in range(3000):
            et = names[(i * 7 + i // 5) % 4]
            lines.append(json.dumps({S.HOST: 5.0, "session_id": s, "event_type": et, S.PAY: {"n": i}}))
            want.append((s, i))
            if i % 97 == 0:
                lines += ["", "{\"torn"]
        (tmp_path / s / "events.jsonl").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("7000", "40000", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            ev = R.intact(R.read_events(spark, str(tmp_path)))
            got = ev.select("session_id", "event_seq", S.field("n", "int").alias("n"), "event_type").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len({(r.session_id, r.event_seq) for r in got}) == len(want)
        assert [(r.session_id, r.n) for r in sorted(got, key=lambda r: (r.session_id, r.event_seq))] == want
