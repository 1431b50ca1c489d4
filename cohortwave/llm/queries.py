"""The registered queries of this subpackage: each applies one operator to its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortwave.llm import decontaminate, langid, linedup, merkle, minhash, mixing, passages, rendezvous, simhash, toxicity, training_order, turns, vptree


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    return langid.predictions(docs, model).select("doc_id", (langid.remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.index(table(spark, sf_dir, "documents"))


def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = linedup.apply_bitmaps(docs, linedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rendezvous.assign(table(spark, sf_dir, "documents"), [1.0] * 16, [1.0] * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(docs, model).select(
        "doc_id", (toxicity.remainder("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.leaf(*others, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    given = F.when(tampered, merkle.leaf(*others, merkle.lower_ascii(F.col("text"))))
    out = merkle.proofs(docs, "doc_id", "source", leaf, given=given).withColumn("folded", merkle.folded(F.coalesce("given", "leaf"), F.col("path")))
    return out.select(
        "doc_id", *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], merkle.proof_hash(F.col("path")).alias("proof_sha256"),
        merkle.as_hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.report(rows, turns.damaged(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_decontaminate, op3_langid, op4_training_order, op5_vptree, op6_passages, op7_line_bitmaps, op8_pareto_mix, op9_rendezvous, op10_toxicity,
        op11_minhash, op12_merkle, op13_turns,
    )
}
SQL: dict[str, str] = {"op7_line_bitmaps": linedup.SQL, "op8_pareto_mix": mixing.SQL, "op11_minhash": minhash.SQL, "op12_merkle": merkle.SQL, "op13_turns": turns.SQL}
