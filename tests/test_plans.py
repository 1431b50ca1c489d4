"""Physical plans: pushdown, rank limits and the shape of ordered work."""

import pytest
from pyspark.sql import Window as W, functions as F

from cohortwave.functions import ordered as O
from cohortwave.operators import layout as L, project as P


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    spark.range(1000).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("session_id"), F.col("id").cast("double").alias("t"), F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"),
        F.rand(1).alias("v"), F.lit("wide").alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_type_filter_reaches_the_scan(stored):
    text = plan(P.filter_event_type(stored, "click").select("session_id", "t"))
    assert "PushedFilters: [In(event_type" in text or "EqualTo(event_type,click)" in text
    assert "unused" not in text


def test_rank_filters_are_limited_before_the_shuffle(stored):
    clips = stored.select(F.col("event_type").alias("valence_group"), F.col("v").alias("arousal_score"), F.col("t").alias("manifest_pos"))
    assert plan(L.top_clips(clips, 3)).count("WindowGroupLimit") == 2


def test_a_long_key_is_split(stored):
    out = O.running(stored.select("session_id", "t", "v"), ["session_id"], ["t"], {"s": ("sum", F.col("v"))}, 100.0)
    text = plan(out)
    assert "hashpartitioning(session_id" in text and "__slice" in text
    assert "partial_sum" in text  # slice totals are combined before they are shuffled
    assert "unused" not in text


def test_cuts_hold_slices_down_wherever_rows_lie(spark):
    """One clock at 0, a third of the rows in one hour, many rows at one reading: slices of the hot key stay even."""
    n = 60_000
    t = F.when(F.col("id") == 0, 0.0).when(F.col("id") % 3 == 0, 1.7e9 + F.rand(3) * 3600).when(F.col("id") % 10 == 1, 1.71e9).otherwise(1.6e9 + F.rand(4) * 3e7)
    df = spark.range(n).select(F.when(F.col("id") % 4 == 0, "other").otherwise("hot").alias("s"), t.alias("t"), F.col("id").alias("seq")).cache()
    cuts = O.Cuts(df, "t", "seq", slices=32)
    sizes = [r["count"] for r in df.groupBy("s", cuts.of("t", "seq").alias("slice")).count().collect()]
    assert len(cuts.points()) == 31 and max(sizes) < 2 * n / 32
    out = O.running(df, ["s"], ["t", "seq"], {"n": ("count", F.lit(1))}, cuts)
    assert out.groupBy("s").agg(F.max("n").alias("m"), F.count_distinct("n").alias("d")).where("m <> d").count() == 0
    alone = O.running(df, ["s"], ["t", "seq"], {"n": ("count", F.lit(1))})
    assert alone.join(out.withColumnRenamed("n", "n2"), ["s", "t", "seq"]).where("n <> n2").count() == 0


def test_cuts_of_nothing_and_of_other_units(spark):
    df = spark.createDataFrame([], "s STRING, t DOUBLE, seq BIGINT")
    assert O.running(df, ["s"], ["t", "seq"], {"n": ("count", F.lit(1))}).count() == 0
    df = spark.range(1000).select(F.lit("a").alias("s"), (F.col("id") / 10).alias("t"), F.col("id").alias("seq"))
    cuts = O.Cuts(df, "t", slices=16)
    ms = df.withColumn("ms", F.round(F.col("t") * 1000).cast("bigint"))
    assert ms.select((cuts.times(1000).of("ms") == cuts.of("t")).alias("same")).where("same").count() >= 990


def test_only_heavy_keys_are_cut(spark):
    """Of 3,000 small keys and one with a third of the rows, that one is cut; carried rows are as many as it has slices."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id") % 3000)
    df = spark.range(n).select(key.alias("s"), (F.col("id") % 977).cast("double").alias("t"), F.col("id").alias("seq")).cache()
    cuts = O.Cuts(df, "t", "seq", slices=64)
    heavy = cuts.heavy(["s"])
    assert list(heavy) == [(-1,)] and 16 <= len(heavy[(-1,)]) < 64
    at = df.withColumn("slice", cuts.of_heavy(["s"], "t", "seq"))
    assert at.where("s = -1").groupBy("slice").count().agg(F.max("count")).first()[0] < 4 * n / 64
    assert at.where("slice IS NOT NULL").select("s").distinct().count() == 1
    out = O.running(df, ["s"], ["t", "seq"], {"n": ("count", F.lit(1)), "m": ("last", F.col("seq"))}, cuts)
    want = df.withColumn("n2", F.row_number().over(W.partitionBy("s").orderBy("t", "seq")))
    assert out.join(want, "seq").where("n <> n2 OR m <> seq").count() == 0 and out.count() == n
    small = O.running(df.where("s >= 0"), ["s"], ["t", "seq"], {"n": ("count", F.lit(1))}, O.Cuts(df.where("s >= 0"), "t", "seq"))
    assert "Union" not in plan(small)  # nothing is carried where no key is cut


def test_keys_that_the_table_does_not_have(spark):
    """A run's number is found later than the table is sampled: the runs of a large session are cut, those of others not."""
    base = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "big").otherwise(F.col("id").cast("string")).alias("s"), F.col("id").cast("double").alias("t"), F.col("id").alias("seq"))
    rows = base.withColumn("run", F.floor(F.col("t") / 1500))
    for keys in (["s", "run"], ["run"]):
        out = O.running(rows, keys, ["t", "seq"], {"n": ("count", F.lit(1))}, O.Cuts(base, "t", "seq", slices=16))
        want = rows.withColumn("n2", F.row_number().over(W.partitionBy(*keys).orderBy("t", "seq"))).select("seq", "n2")
        assert out.join(want, "seq").where("n <> n2").count() == 0 and out.count() == 4000


def test_rolling_means_of_large_and_small_numbers(spark):
    whole = spark.createDataFrame([("a", i, 3_000_000_000 + i) for i in range(10)] + [("a", 20, (1 << 62) + 5), ("a", 21, None)], "s STRING, t BIGINT, v BIGINT")
    got = {r.t: r.m for r in O.rolling_mean(whole, ["s"], "t", 2, F.col("v"), "m").collect()}
    assert got[5] == 3_000_000_004 and got[0] == 3e9 and got[20] == float((1 << 62) + 5) and got[21] == float((1 << 62) + 5)
    real = spark.createDataFrame([("a", 0, 0.25), ("a", 1, 1e21), ("a", 2, -1e21), ("a", 3, 0.5), ("a", 9, 1e30), ("a", 20, 0.75)], "s STRING, t BIGINT, v DOUBLE")
    got = {r.t: r.m for r in O.rolling_mean(real, ["s"], "t", 3, F.col("v"), "m").collect()}
    assert got[0] == 0.25 and got[1] == (1e21 + 0.25) / 2 and got[3] == 0.75 / 4 and got[9] == 1e30 and got[20] == 0.75


def test_short_orders_are_drawn_in_the_row(spark):
    """Stimuli do not pass a shuffle; participants that come twice share one order, as a rank over all their rows gives it."""
    who = spark.createDataFrame([(1,), (2,), (2,), (None,), (3,)], "participant_id INT")
    out = O.shuffled(who, ["participant_id"], 20, 7, "k", "at")
    numbers = who.select("participant_id", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k"))
    want = O.by_hash(numbers, ["participant_id"], ["k"], 7, "at", ["participant_id"])
    assert sorted(map(str, out.select("participant_id", "k", "at").collect())) == sorted(map(str, want.select("participant_id", "k", "at").collect()))
    for df in (L.stroop_stimuli(who, ["red", "green", "blue"], 20, 0.15, 7), L.slot_order(who, ["schulte", "stroop"], 3, 7)):
        text = plan(df)
        assert text.count("Exchange") == 1 and "Window" not in text and "Sort " not in text
        assert text.index("Generate") < text.index("Exchange")  # children are printed below


def test_facts_of_heavy_keys_meet_their_rows_in_pieces(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, F.concat(F.lit("s"), F.col("id") % 7)).otherwise("b").alias("k"), F.col("id").cast("double").alias("v"))
    facts = df.groupBy("k").agg(F.max("v").alias("top"))
    cuts = O.Cuts(df, "v", slices=16)
    assert {k for k, in cuts.heavy(["k"])} == {"a", "b"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = O.join_per_key(df, facts, ["k"], cuts)
        assert "hashpartitioning(k" in plan(joined) and "__piece" in plan(joined)
        assert joined.count() == 30_000 and joined.distinct().count() == 30_000
        assert joined.where("top < v").count() == 0 and joined.columns == ["k", "v", "top"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    med = O.exact_median(df, ["k"], "v", "m", cuts)
    want = df.groupBy("k").agg(F.median("v").alias("m"))
    assert sorted(map(tuple, med.collect())) == sorted(map(tuple, want.collect()))
