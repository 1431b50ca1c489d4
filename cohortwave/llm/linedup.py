"""Line dedup on hashes alone: documents keep their texts, and get a compressed bitmap of the lines they keep."""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_BLANK)), _UPPER, _UPPER.lower())


def _row_id(text_col: str) -> Column:
    """Tells rows apart that share an id: positions of one text must not be applied to another."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _range(hex_hash: str, n: int) -> Column:
    """The one of `n` equal ranges that the leading 28 bits of a hash fall in, turned on by its slice."""
    lead = F.conv(F.substring(hex_hash, 1, 7), 16, 10).cast("bigint")
    return F.pmod(F.shiftright(lead * F.lit(n), 28) + F.col("slice"), F.lit(n)).cast("int")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 10) -> DataFrame:
    """(id, text_hash, kept_runs) of the documents that lose lines.

    A key of `least` code points or more that several documents hold keeps its lines in the smallest id only (a
    null id is larger than all others, and all rows without id are one document). `kept_runs` is the bitmap as
    runs: entry i is the number of kept lines between the dropped line i and the one before, so the bitmap has
    an entry per dropped line and lines after the last one stay. Documents that lose nothing have no row.
    Repeated rows share a bitmap; rows that share an id but not a text have one each.

    128-bit hashes are dealt out in equal ranges, each slice of the ids turned on by a partition, and sorted by hash,
    slice, document and position in each range; the first document of a slice streams past first, and later ones lose
    their lines. Only the first documents of the slices meet once more by hash. So one line in a third of all documents
    is split over all partitions, and then is one row per slice. Hashes are uniform, so the borders of the ranges follow
    by arithmetic, and texts are split once.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = line_key(F.col("line"))
    lines = (
        docs.select(F.col(id_col).alias("id"), _row_id(text_col).alias("text_hash"), F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"))
        .where(F.length(key) >= least)
        .select(F.md5(key).alias("hex"), F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("slice"), "id", "text_hash", "pos")
        .select(F.unhex("hex").alias("hash"), "slice", "id", "text_hash", "pos", _range("hex", n).alias("range"))
        .repartitionById(n, "range")
    )
    last = F.col("id").asc_nulls_last()
    in_slice = lines.withColumn("first", F.first("id").over(W.partitionBy("range", "hash", "slice").orderBy(last, "pos")))
    is_first = F.col("id").eqNullSafe(F.col("first"))
    # slices deal out ids: two documents of a slice are two documents of the key
    over = in_slice.where(is_first).withColumn("first", F.first("id").over(W.partitionBy("hash").orderBy(last, "pos")))
    dropped = in_slice.where(~is_first).union(over.where(~is_first)).select("id", "text_hash", "pos")
    at = dropped.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    before = F.concat(F.array(F.lit(-1)), F.slice("p", 1, F.size("p") - 1))
    return at.select("id", "text_hash", F.zip_with("p", before, lambda x, y: x - y - 1).alias("kept_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept) of every row of `docs`; a null or empty text is one empty line."""
    b = bitmaps.select(F.col("id").alias("b_id"), F.col("text_hash").alias("b_hash"), "kept_runs")
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), _row_id(text_col).alias("text_hash"))
    lines = lines_of(F.col("text"))
    flags = F.flatten(F.transform("kept_runs", lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False)))))
    marked = F.arrays_zip(lines.alias("line"), flags.alias("stays"))  # no flag beyond the last dropped line
    stay = F.transform(F.filter(marked, lambda z: F.coalesce(z["stays"], F.lit(True))), lambda z: z["line"])
    return d.join(b, F.col("id").eqNullSafe(F.col("b_id")) & (F.col("text_hash") == F.col("b_hash")), "left").select(
        F.col("id").alias(id_col),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("kept_runs"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("kept_runs").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")).alias("kept"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM lines),
owners AS (
  SELECT key, min(doc_id) AS lo FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE doc_id > lo)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE lo IS NULL OR doc_id = lo), '')) AS kept_sha256
FROM keyed LEFT JOIN owners USING (key)
GROUP BY doc_id
"""
