"""Round trips: given tables are written in a format of the session package, in the shared folder, and read back."""

from pyspark.sql import DataFrame, functions as F

from cohortwave import schema as S
from cohortwave.functions.ordered import numbered, running
from cohortwave.plans.registry import plan
from cohortwave.plans.views import EV, Tables
from cohortwave.session import work_dir
from cohortwave.sources import readers as R, writers as W
from cohortwave.streaming.streams import run_available


def _write_text(lines: DataFrame, path: str) -> str:
    lines.write.text(path)
    return path


def _event_files(d: Tables) -> str:
    """The event table as event logs of ten folders; events with k mod 20 = 3 are torn in the middle."""
    root = work_dir(d.spark, "packages")
    log = d.ev.select(
        F.col("t").alias(S.HOST), F.col("t").alias(S.MONO), "session_id", F.concat(F.lit("P"), "session_id").alias("participant_id"), "task", F.col("k").alias("trial_index"), "event_type",
        F.struct("k", F.col("event_seq").alias("n")).alias(S.PAY), "k", F.pmod(F.col("session_id").cast("int"), F.lit(10)).alias("folder"),
    )
    line = F.to_json(F.struct(*[c for c in log.columns if c not in ("k", "folder")]))
    text = log.select("folder", F.when(F.col("k") % 20 == 3, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).otherwise(line).alias("value"))
    for i in range(10):
        text.where(F.col("folder") == i).select("value").write.text(f"{root}/p{i}/events.jsonl")
    return root


@plan(EV + """SELECT session_id, seq AS n, lag(seq) OVER (PARTITION BY session_id ORDER BY floor(t / 604800), (seq * 7919) % 1000003, seq) AS before FROM ev""")
def file_order(d: Tables):
    """Clocks that tick once a week: which event follows which is known only from the lines of a session's file."""
    root = work_dir(d.spark, "ticks")
    tick = F.floor(F.col("t") / 604800) * 604800.0
    lines = d.ev.select(F.pmod(F.col("session_id").cast("int"), F.lit(10)).alias("folder"), "session_id", tick.alias("tick"), ((F.col("event_seq") * 7919) % 1000003).alias("turn"), F.col("event_seq").alias("n"), "event_type")
    body = F.to_json(F.struct(F.col("tick").alias(S.HOST), "session_id", "event_type", F.struct("n").alias(S.PAY)))
    placed = lines.repartition("folder").sortWithinPartitions("folder", "session_id", "tick", "turn", "n")  # one file of each folder
    placed.select("folder", body.alias("value")).write.partitionBy("folder").text(root)
    ev = R.intact(R.read_events(d.spark, root, "*")).select("session_id", "ts", "event_seq", S.field("n", "bigint").alias("n"))
    return running(ev, ["session_id"], ["ts", "event_seq"], {"before": ("last", F.col("n"))}, inclusive=False).select("session_id", "n", "before")


_SEEN = "session_id, 'P' || session_id AS participant_id, et AS event_type, k AS trial_index, seq AS n, round(t, 3) AS t"


def _seen(ev: DataFrame) -> DataFrame:
    return ev.select("session_id", "participant_id", "event_type", "trial_index", S.field("n", "bigint").alias("n"), F.round(S.MONO, 3).alias("t"))


@plan(EV + f"SELECT {_SEEN} FROM ev WHERE k % 20 <> 3")
def read_events(d: Tables):
    return _seen(R.intact(R.read_events(d.spark, _event_files(d))))


@plan(EV + "SELECT CAST(CAST(session_id AS INT) % 10 AS INT) AS folder, count(*) AS torn, 0 AS before_epoch FROM ev WHERE k % 20 = 3 GROUP BY 1")
def torn_events(d: Tables):
    lost = R.torn(R.read_events(d.spark, _event_files(d)))
    return lost.groupBy(F.regexp_extract("source_file", r"/p(\d+)/", 1).cast("int").alias("folder")).agg(
        F.count("*").alias("torn"), F.count_if(F.col(S.HOST) < 0).cast("int").alias("before_epoch")  # Spark wants a parsed column beside the torn text
    )


@plan(EV + f"SELECT {_SEEN} FROM ev WHERE k % 20 <> 3")
def read_events_stream(d: Tables):
    return d.spark.read.parquet(run_available(d.spark, _seen(R.intact(R.read_events_stream(d.spark, _event_files(d)))), "events"))


@plan("SELECT 's' || n_nationkey AS session_id, n_name AS participant_id, n_regionkey / 2.0::DOUBLE AS demo_scale, n_nationkey % 3 AS ok_records, 'c' || n_regionkey AS mode FROM nation")
def read_manifests(d: Tables):
    record = F.struct(F.lit("eeg").alias("device_role"), F.lit("d").alias("device_id"), F.lit("ok").alias("result"))
    body = F.struct(
        F.concat(F.lit("s"), "n_nationkey").alias("session_id"), F.col("n_name").alias("participant_id"), (F.col("n_regionkey") / 2).alias("demo_scale"),
        F.create_map(F.lit("eeg"), F.array_repeat(record, F.col("n_nationkey") % 3)).alias("device_sync_records"), F.struct(F.concat(F.lit("c"), "n_regionkey").alias("mode")).alias("config_snapshot"),
    )
    root = work_dir(d.spark, "manifests")
    # a manifest is one object over several lines
    lines = d.nation.select(F.regexp_replace(F.to_json(body), ",", ",\n").alias("value"), "n_nationkey")
    lines.repartition(25, "n_nationkey").select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/s/session_manifest.json")
    m = R.read_manifests(d.spark, root)
    records = F.size(F.coalesce(F.try_element_at("device_sync_records", F.lit("eeg")), F.array()))
    return m.select("session_id", "participant_id", "demo_scale", records.alias("ok_records"), F.try_variant_get("config_snapshot", F.lit("$.mode"), "string").alias("mode"))


@plan("SELECT row_number() OVER (PARTITION BY p_partkey // 500 ORDER BY p_partkey) - 1 AS manifest_pos, 'clip_' || p_partkey AS clip_id, p_brand AS valence_group, CAST(p_size AS DOUBLE) AS duration_sec FROM part")
def read_clip_manifest(d: Tables):
    """A manifest for each 500 numbers of clips; a clip's position is that in its own file."""
    c = F.struct(F.concat(F.lit("clip_"), "clip_id").alias("clip_id"), "valence_group", "duration_sec")
    listed = d.clips.groupBy(F.floor(F.col("clip_id") / 500).alias("file")).agg(F.sort_array(F.collect_list(F.struct("manifest_pos", c.alias("c")))).alias("l"))
    text = F.to_json(F.struct(F.lit("a note").alias("_comment"), F.transform("l", lambda x: x["c"]).alias("clips")))
    path = work_dir(d.spark, "manifest")
    listed.select(F.regexp_replace(text, ",", ",\n").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return R.read_clip_manifest(d.spark, path).select(F.col("manifest_pos").cast("bigint").alias("manifest_pos"), "clip_id", "valence_group", "duration_sec")


_LISTED = 2000  # clips of one list in one file


@plan("""SELECT CASE s_nationkey % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS valence_group,
  row_number() OVER (PARTITION BY s_nationkey % 3 ORDER BY s_suppkey) - 1 AS pos, 'clip_' || s_suppkey AS clip_id, s_acctbal AS valence_score FROM supplier""")
def read_fixed_clips(d: Tables):
    """One list for each group over all suppliers, which goes on from file to file: a file holds the next places of every list."""
    item = F.struct(F.concat(F.lit("clip_"), "s_suppkey").alias("clip_id"), F.col("s_acctbal").alias("valence_score"))
    placed = numbered(d.supplier.withColumn("g", F.col("s_nationkey") % 3).where("g IS NOT NULL"), ["g"], ["s_suppkey", "s_acctbal"], "place")
    lists = [F.transform(F.sort_array(F.collect_list(F.when(F.col("g") == k, F.struct("place", item.alias("c"))))), lambda x: x["c"]).alias(g) for k, g in enumerate(("positive", "negative", "neutral"))]
    files = placed.groupBy(F.floor((F.col("place") - 1) / _LISTED).alias("part")).agg(*lists)
    path = work_dir(d.spark, "fixed")
    files.select(F.to_json(F.struct(F.lit("a note").alias("_comment"), "part", "positive", "negative", "neutral")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return R.read_fixed_clips(d.spark, path, part="part").select("valence_group", F.col("pos").cast("bigint").alias("pos"), "clip_id", "valence_score")


@plan("SELECT 'VID_' || c_custkey AS video_code, c_mktsegment AS modal_emotion, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS length_s FROM customer")
def read_clip_metadata(d: Tables):
    """Files of 500 rows; the first column name of each follows a byte-order mark; a length that is no number is null."""
    length = F.when(F.col("c_custkey") % 9 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    rows = d.customer.select(F.concat(F.lit("VID_"), "c_custkey").alias("\ufeffvideo_code"), F.col("c_mktsegment").alias("modal_emotion"), length.alias("length_s"))
    path = work_dir(d.spark, "metadata")
    rows.write.option("header", True).option("maxRecordsPerFile", 500).csv(path)
    return R.read_clip_metadata(d.spark, path)


@plan("SELECT 'log_' || s_nationkey AS session_id, s_suppkey AS t, s_name AS kind, s_acctbal AS rt FROM supplier")
def read_task_log(d: Tables):
    root = work_dir(d.spark, "logs")
    rows = d.supplier.select(F.concat(F.lit("log_"), "s_nationkey").alias("folder"), F.col("s_suppkey").alias("t"), F.col("s_name").alias("kind"), F.col("s_acctbal").alias("rt"))
    rows.repartition("folder").write.option("header", True).partitionBy("folder").csv(root)
    log = R.read_task_log_csv(d.spark, f"{root}/folder=*/*.csv", "t BIGINT, kind STRING, rt DOUBLE")
    return log.withColumn("session_id", F.replace("session_id", F.lit("folder="), F.lit("")))


@plan("SELECT 'r' || label AS recording_id, vec_id AS sample_idx, vec_id / 250.0::DOUBLE AS rel_sec, len(embedding) AS channels, round(embedding[1]::DOUBLE, 5) AS first FROM embeddings")
def read_samples(d: Tables):
    path = work_dir(d.spark, "samples")
    d.embeddings.select(
        F.concat(F.lit("r"), "label").alias("recording_id"), F.lit("s").alias("session_id"), F.lit("eeg").alias("device_role"), F.lit("d").alias("device_id"), F.col("vec_id").alias("sample_idx"),
        (F.col("vec_id") / 250).alias("rel_sec"), F.col("embedding").alias("ch"),
    ).write.parquet(path)
    s = R.read_samples(d.spark, path)
    return s.select("recording_id", "sample_idx", "rel_sec", F.size("ch").cast("bigint").alias("channels"), F.round(F.get("ch", F.lit(0)).cast("double"), 5).alias("first"))


_FOLDERS = 256  # sessions share them


@plan("""SELECT CAST(l_suppkey AS VARCHAR) AS session_id, sum(CASE WHEN l_suppkey % 2 = 0 THEN 2 ELSE 1 END * l_linenumber)::BIGINT AS x, count(*) AS n FROM lineitem GROUP BY 1""")
def write_curated(d: Tables):
    """Every session is written, then those of even suppliers again with new values."""
    path = work_dir(d.spark, "curated")
    rows = d.lineitem.select(F.col("l_suppkey").cast("string").alias("session_id"), F.col("l_linenumber").cast("bigint").alias("x"), "l_orderkey")
    W.write_curated(rows, path, buckets=_FOLDERS)
    W.write_curated(rows.where("cast(session_id AS INT) % 2 = 0").withColumn("x", F.col("x") * 2), path, buckets=_FOLDERS)
    return d.spark.read.parquet(path).groupBy(F.col("session_id").cast("string").alias("session_id")).agg(F.sum("x").alias("x"), F.count("*").alias("n"))


@plan("SELECT r_regionkey, r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2")
def write_report(d: Tables):
    path = work_dir(d.spark, "report")
    per = d.nation.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("nations"))
    W.write_report(d.region.join(per, "r_regionkey"), path, "csv")
    return d.spark.read.option("header", True).schema("r_regionkey INT, r_name STRING, nations BIGINT").csv(path)
