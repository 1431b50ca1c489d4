"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "cohortwave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on; a cluster's own values win via `conf`."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # call sites of single column expressions are not recorded; plans build several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under `spark.checkpoint.dir`, which every executor must be able to reach.

    Only a local master may fall back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="cohortwave-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """`df` as a written table in the shared folder: a fact table that several operators read is
    computed once, and lost executors cost only the reading."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
