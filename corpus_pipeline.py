"""A corpus made ready for training, in stages that are each written and read again."""

from pyspark.sql import DataFrame, SparkSession

from cohortwave.llm import decontaminate, mixing, similar, toxicity, training_order
from cohortwave.session import keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from labelled ones among `docs`."""
    return toxicity.keep_clean(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group linked by 0.8 or more of their 5-word shingles."""
    return similar.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, errors included."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.copies(docs)


def write_training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards in the shared folder; a row for each record in them."""
    return training_order.index(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("training order", write_training_order),
]
#: Learned scores, shingle hashes and token ids are not SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
