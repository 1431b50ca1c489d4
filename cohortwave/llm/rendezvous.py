"""Sharding by rendezvous hashing: every record goes to the shard that scores highest for its key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKETS = 1024


def _uniform(text: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest, the same in every engine."""
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the least -ln(u) / weight over uniform u of (key, shard): shares follow the weights, and a new
    shard only takes records for itself. The key is cast to text, null is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights) if w > 0])
    wait = F.transform(shards, lambda s: F.struct((-F.ln(_uniform(F.concat_ws(":", text, s["i"].cast("string")))) / s["w"]).alias("wait"), s["i"].alias("i")))
    return F.array_min(wait)["i"]


def assign(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) of every row.

    size: bytes of the text plus one (null: 1); text_crc32: of its UTF-8 bytes (null: 0). slot numbers the rows of a
    shard from 0 without gaps, in the order of (bucket of the key's digest, id, checksum, size); rows equal in all of these
    are interchangeable. `grown`: weights after a change, for grown_shard. Rows that share an id share a shard.
    Numbers come from the counts of `buckets` pieces of each shard, so no shard passes through one task.
    """
    key = F.col(id_col)
    bucket = F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 14, 8), 16, 10).cast("bigint"), F.lit(buckets))
    rows = docs.select(
        key.alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        rendezvous(key, weights).alias("shard"), (rendezvous(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"), bucket.alias("bucket"),
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = W.partitionBy("shard", "bucket").orderBy(F.col("id").asc_nulls_last(), "text_crc32", "size")
    numbered = rows.withColumn("k", F.row_number().over(within)).join(base, ["shard", "bucket"])
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("base") + F.col("k") - 1).cast("bigint").alias("slot"), "grown_shard")
