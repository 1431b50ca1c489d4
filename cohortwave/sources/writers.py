"""Sinks."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F


MOST_ROWS = 5_000_000  # rows of one file


def write_curated(df: DataFrame, path: str, partition: str = "session_id", *, buckets: int | None = None) -> None:
    """Replace the partitions present in `df`, leave the others; a rerun gives the same table.

    Rows gather by partition value before the write, so each value gets few files. Sizes are those that Spark has
    measured in the shuffle: a value with more than `spark.sql.adaptive.advisoryPartitionSizeInBytes` is written by several tasks,
    small values share one; those in a large one's shuffle partition are spread with it. Without adaptive execution a value is one task, with files of `MOST_ROWS` rows at most.

    A value has a folder of its own, which is much for hundreds of thousands of small ones. With `buckets`, values whose hash
    falls in one bucket share a folder, `partition` is a column of the files, and the rows that a folder holds of other values are
    written again with the new ones. A table keeps its number of buckets, which is in the folders' name.
    """
    folder = partition
    if buckets is not None:
        folder = f"{partition}_of_{buckets}"
        df = df.withColumn(folder, F.pmod(F.xxhash64(F.col(partition).cast("string")), F.lit(buckets)).cast("int"))
        there = _table(df, path)
        if there is not None:
            new = df.select(F.col(partition).alias("__new")).distinct()
            others = there.join(df.select(folder).distinct(), folder, "left_semi").join(new, F.col(partition).eqNullSafe(F.col("__new")), "left_anti")
            df = df.unionByName(others, allowMissingColumns=True)
    gathered = df.hint("rebalance", F.col(folder))
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MOST_ROWS).partitionBy(folder).parquet(path)


def _table(df: DataFrame, path: str) -> DataFrame | None:
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A report as JSON lines or as CSV with a header."""
    w = df.write.mode("overwrite")
    w.json(path) if fmt == "json" else w.option("header", True).csv(path)


def write_dataset(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the whole dataset: what an earlier export left would put a participant on two sides. Rows gather by the
    partition columns first, so a folder gets few files."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
