"""Readers of session packages, stimulus tables and sensor recordings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from cohortwave import schema as S
from cohortwave.functions.scalars import safe_label, strip, video_code

_CORRUPT = "_corrupt_record"
_RAW_EVENTS = T.StructType([*S.ENVELOPE.fields, T.StructField(_CORRUPT, T.StringType())])


_ROWS = (1 << 33) - 1  # the lower bits of Spark's row id number the rows of a partition


def _with_time(df: DataFrame, tie: Column) -> DataFrame:
    """Event time and the order of rows with equal clock readings."""
    return df.withColumns({"ts": F.timestamp_micros(F.round(F.col(S.HOST) * 1e6).cast("bigint")), "event_seq": tie})


def read_events(spark: SparkSession, root: str, file: str = "events.jsonl") -> DataFrame:
    """Every session's event log. A torn line is kept with its text in `_corrupt_record`.

    `event_seq` ascends with the lines of a file, so equal clock readings keep the order in which they were logged: where
    a line's split begins in the file, plus its place among the rows of its task. Splits begin further apart than a task has
    rows, as a task reads no more bytes than a split may have and a line is two bytes at least. It is a
    column from here on, so what is written keeps it; it is no identity, as other files have the same numbers.
    """
    raw = (
        spark.read.schema(_RAW_EVENTS)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(f"{root}/*/{file}")
    )
    line = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS))
    return _with_time(raw.withColumns({"source_file": F.col("_metadata.file_path"), "__line": line}), F.col("__line")).drop("__line")


def intact(events: DataFrame) -> DataFrame:
    return events.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def torn(events: DataFrame) -> DataFrame:
    return events.where(F.col(_CORRUPT).isNotNull()).select("source_file", _CORRUPT, S.HOST)


def read_events_stream(spark: SparkSession, root: str, max_files: int = 1000) -> DataFrame:
    """Event files as a stream; a file must be moved in whole, the source never re-reads a growing one. Streams know no
    row numbers, so equal clock readings are ordered by a hash of the row: always the same, but not that of the file."""
    raw = (
        spark.readStream.schema(_RAW_EVENTS)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("maxFilesPerTrigger", max_files)
        .json(f"{root}/*/events.jsonl")
    )
    return _with_time(raw, F.xxhash64("event_type", "block_index", "trial_index", F.to_json(F.col(S.PAY))))


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per session manifest, configuration kept as VARIANT."""
    return spark.read.schema(S.MANIFEST).option("multiLine", True).json(f"{root}/*/session_manifest.json")


def read_clip_manifest(spark: SparkSession, path: str) -> DataFrame:
    """I4: one row per clip with its position in the list."""
    df = spark.read.schema(f"clips ARRAY<STRUCT<{_struct(S.CLIP)}>>").option("multiLine", True).json(path)
    return df.select(F.posexplode("clips").alias("manifest_pos", "c")).select("manifest_pos", "c.*")


def read_fixed_clips(spark: SparkSession, path: str, groups: Sequence[str] = S.VALENCE_GROUPS, *, part: str | None = None) -> DataFrame:
    """Group and ordered clip ids. Only the group arrays are in the schema, so a comment key is ignored.

    With `part`, lists go on from file to file in the order of the number that each file has under that key, and positions count
    through. A file's place follows from the sizes of the lists before it, so the clips of a list need not meet in one task.
    """
    head = [] if part is None else [part]
    schema = ", ".join([*[f"`{p}` BIGINT" for p in head], *[f"{g} ARRAY<STRUCT<{_struct(S.FIXED_CLIP)}>>" for g in groups]])
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    pairs = ", ".join(f"'{g}', {g}" for g in groups)
    lists = df.selectExpr(*[f"`{p}`" for p in head], f"stack({len(groups)}, {pairs}) AS (valence_group, items)")
    clips = lists.select("valence_group", *head, F.posexplode("items").alias("pos", "c"))
    if part is not None:
        sizes = lists.groupBy("valence_group", part).agg(F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("__n"))
        before = F.sum("__n").over(W.partitionBy("valence_group").orderBy(part).rowsBetween(W.unboundedPreceding, -1))
        starts = sizes.select("valence_group", part, F.coalesce(before, F.lit(0)).alias("__before"))
        clips = clips.join(starts, ["valence_group", part]).withColumn("pos", F.col("__before") + F.col("pos"))
    return clips.select("valence_group", "pos", "c.*")


def _struct(ddl: str) -> str:
    return ", ".join(":".join(part.split(" ")) for part in ddl.split(", "))


def read_clip_metadata(spark: SparkSession, path: str, required: Sequence[str] = ("video_code", "modal_emotion")) -> DataFrame:
    """Clip metadata CSV (a byte-order mark is stripped); missing columns are named in the error."""
    df = spark.read.option("header", True).csv(path)
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"no {' and no '.join(missing)} among the columns of {path}")
    numeric = [c for c in ("valence_wsd", "arousal_wsd", "length_s") if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in numeric})


def emotion_labels(metadata: DataFrame) -> DataFrame:
    """Normalised code and label; rows without a code are dropped."""
    return metadata.select(video_code(F.col("video_code")).alias("code"), safe_label(F.col("modal_emotion")).alias("emotion")).where("code <> ''")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole small text files as (path, value)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


# What ends a line of text.
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def text_lines(texts: DataFrame, ident: str = "path", text: str = "value") -> DataFrame:
    """Lines with 1-based numbers; the final line break opens no extra line."""
    lines = F.col("__l")
    full = F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    return (
        texts.select(ident, F.split(text, _LINE_END).alias("__l"))
        .select(ident, F.posexplode(full).alias("__p", "line"))
        .select(ident, (F.col("__p") + 1).alias("line_no"), "line")
    )


def parse_manual_clips(texts: DataFrame, ident: str = "path", text: str = "value", groups: Sequence[str] = S.VALENCE_GROUPS) -> DataFrame:
    """`code, group` lines; `error` names what is wrong with a rejected line."""
    body = strip(F.substring_index("line", "#", 1))
    rows = text_lines(texts, ident, text).withColumn("body", body).where("body <> ''")
    two = F.length("body") - F.length(F.replace("body", F.lit(","), F.lit(""))) == 1
    return rows.select(
        ident,
        "line_no",
        F.when(two, strip(F.substring_index("body", ",", 1))).alias("video_code"),
        F.when(two, strip(F.substring_index("body", ",", -1))).alias("valence_group"),
    ).withColumn("error", F.when(F.col("valence_group").isNull(), F.lit("arity")).when(~F.col("valence_group").isin(*groups), F.lit("group")))


def read_manual_clips(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted entries and rejects with their line numbers."""
    rows = parse_manual_clips(read_texts(spark, path))
    return rows.where("error IS NULL").drop("error"), rows.where("error IS NOT NULL")


def parse_sectioned_picks(texts: DataFrame, ident: str = "path", text: str = "value") -> DataFrame:
    """I8: tab-separated candidates under their `[section]`; a leading `#` marks an unpicked one."""
    lines = text_lines(texts, ident, text)
    header = F.regexp_extract("line", r"^\[([^\]]+)\]\s*$", 1)
    w = W.partitionBy(ident).orderBy("line_no")  # one file's lines: already one row before the split
    marked = lines.withColumn("section", F.last(F.nullif(header, F.lit("")), ignorenulls=True).over(w))
    body = F.regexp_replace("line", r"^#\s*", "")
    cells = F.split(body, "\t")
    return marked.where((F.size(cells) >= 3) & F.col("section").isNotNull() & (header == "")).select(
        ident,
        "line_no",
        "section",
        F.trim(F.get(cells, F.lit(0))).alias("video_code"),
        F.get(cells, F.lit(1)).try_cast("double").alias("duration_sec"),
        F.regexp_extract(F.get(cells, F.lit(2)), r"^(\d+)x(\d+)", 1).try_cast("int").alias("width"),
        F.regexp_extract(F.get(cells, F.lit(2)), r"^(\d+)x(\d+)", 2).try_cast("int").alias("height"),
        (~F.startswith("line", F.lit("#"))).alias("picked"),
    )


def read_sectioned_picks(spark: SparkSession, path: str) -> DataFrame:
    return parse_sectioned_picks(read_texts(spark, path))


def read_task_log_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A task's own CSV log; the session is the name of the folder it was copied into."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .csv(path)
        .withColumn("session_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    )


def parse_scenario(lines: DataFrame, line: str = "value") -> DataFrame:
    """`H:MM:SS;plugin;cmd[;value]`; other lines are left out."""
    cells = F.split(F.col(line), ";")
    hms = F.split(F.get(cells, F.lit(0)), ":")
    part = [F.get(hms, F.lit(i)).try_cast("int") for i in range(3)]
    keep = [c for c in lines.columns if c != line]
    return lines.where(F.col(line).rlike(r"^\d+:\d{2}:\d{2};[^;]*;[^;]*(;.*)?$")).select(
        *keep,
        (part[0] * 3600 + part[1] * 60 + part[2]).alias("t_sec"),
        F.get(cells, F.lit(1)).alias("plugin"),
        F.get(cells, F.lit(2)).alias("cmd"),
        F.get(cells, F.lit(3)).alias("value_text"),
    )


def read_scenario(spark: SparkSession, path: str) -> DataFrame:
    return parse_scenario(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path")))


def scenario_line(t: Column, plugin: Column, cmd: Column, value: Column) -> Column:
    """I10, write side: seconds rounded half to even; a null value leaves its field out."""
    s = F.bround(t).cast("bigint")
    two = [F.lpad((F.floor(s / 60) % 60).cast("string"), 2, "0"), F.lpad((s % 60).cast("string"), 2, "0")]
    hms = F.concat_ws(":", F.floor(s / 3600).cast("string"), *two)
    return F.concat_ws(";", hms, plugin, cmd, value)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sensor recordings, one row per sample with an array of channels."""
    return spark.read.schema(S.SAMPLES).parquet(path)


def read_samples_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(S.SAMPLES).parquet(path)


def extract_links(pages: DataFrame, entry_re: str, name_group: int = 1, url_group: int = 2, page: str = "page_id", html: str = "html") -> DataFrame:
    """Every (name, url) pair of a page; one pattern holds both groups, so they stay paired."""
    found = [F.regexp_extract_all(F.col(html), F.lit(entry_re), F.lit(g)) for g in (name_group, url_group)]
    return pages.select(page, F.posexplode(F.arrays_zip(found[0].alias("name"), found[1].alias("url"))).alias("pos", "m")).select(
        page, "pos", "m.name", "m.url"
    )


def last_link_per_code(links: DataFrame, code: Column, page: str = "page_id", keys: Sequence[str] = ()) -> DataFrame:
    """Name and url per code; the last match in page order wins."""
    at = F.struct(page, "pos")
    return (
        links.withColumn("code", code)
        .where("code <> ''")
        .groupBy(*keys, "code")
        .agg(F.max_by("name", at).alias("name"), F.max_by("url", at).alias("url"))
    )
