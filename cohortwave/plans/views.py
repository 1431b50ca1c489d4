"""The given tables seen as a study: users are sessions, orders are blocks, lines are trials.

Only names and types change here; every computation is an operator's.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwave.functions.ordered import Cuts
from cohortwave.schema import HOST, MONO, PAY

DAY = 86400.0


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.dir = spark, sf_dir.rstrip("/")
        self._found: dict[tuple, Cuts] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        setattr(self, name, df)  # the footer is read once
        return df

    def cuts(self, table: str = "ev", t: str = "t", tie: str | None = "event_seq") -> Cuts:
        """Cut points for ordered work on a table, sampled once per plan."""
        at = (table, t, tie)
        if at not in self._found:
            self._found[at] = Cuts(getattr(self, table), t, tie)
        return self._found[at]

    @cached_property
    def ev(self) -> DataFrame:
        return as_events(self.events)

    def study(self, types: dict[str, str], payload: Column | None = None) -> DataFrame:
        """Events in the log's shape, their types renamed by `types`."""
        et = F.coalesce(*[F.when(F.col("event_type") == a, F.lit(b)) for a, b in types.items()], F.col("event_type"))
        return self.ev.withColumn("event_type", et).withColumn(PAY, payload if payload is not None else F.try_parse_json("props"))

    @cached_property
    def trials(self) -> DataFrame:
        return as_trials(self.lineitem)

    @cached_property
    def clips(self) -> DataFrame:
        """Parts as clips: group = brand, score = price, duration = size."""
        return self.part.select(
            F.col("p_partkey").alias("clip_id"), F.col("p_brand").alias("valence_group"), F.col("p_type").alias("fine_grained_label"),
            F.col("p_retailprice").alias("arousal_score"), F.col("p_size").cast("double").alias("duration_sec"), F.col("p_partkey").alias("manifest_pos"),
            F.col("p_name").alias("name"),
        )


def as_events(events: DataFrame) -> DataFrame:
    """Event time in seconds; `k` is the property of the payload. The wall clock runs `k` ms ahead."""
    t = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("user_id").cast("string").alias("session_id"), F.lit("stress").alias("task"), F.lit(1).alias("run_ordinal"),
        F.lit(None).cast("int").alias("block_index"), F.lit(None).cast("string").alias("condition_label"), "event_type", t.alias(MONO),
        (t + k * F.lit(0.001)).alias(HOST), F.col("event_id").alias("event_seq"), F.col("ts").cast("timestamp").alias("ts"), t.alias("t"), k.alias("k"), "value", "props",
    )


def as_trials(lineitem: DataFrame) -> DataFrame:
    """Lines as trials: block = order, session = supplier, reaction time = quantity."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("session_id"), F.col("l_orderkey").alias("block_index"), F.col("l_linenumber").alias("trial_index"),
        F.col("l_partkey").alias("clip_id"), F.col("l_quantity").alias("rt_sec"), (F.col("l_returnflag") != "R").alias("correct"),
        (F.col("l_linestatus") == "O").alias("congruent"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
    )


# The same view for the SQL side.
EV = """WITH ev AS (
  SELECT CAST(user_id AS VARCHAR) AS session_id, event_type AS et, epoch_us(ts) / 1e6 AS t,
         epoch_us(ts) / 1e6 + CAST(json_extract_string(props, '$.k') AS INT) * 0.001::DOUBLE AS h,
         event_id AS seq, CAST(json_extract_string(props, '$.k') AS INT) AS k, value, ts, user_id
  FROM events)
"""
