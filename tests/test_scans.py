"""Sliced scans and the operators on them against plain loops, at slice widths from tiny to one slice."""

import bisect
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortwave.functions import ordered as O
from cohortwave.functions.permuted import place
from cohortwave.functions.scalars import eval_expression
from cohortwave.operators import joins as J, layout as L, quality as Q, windows as X

KEYS = ["s"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", round(rng.uniform(0, 100), 1), i, rng.choice([-1, 0, 1]), rng.random()) for i in range(600)]
    return rows, spark.createDataFrame(rows, "s STRING, t DOUBLE, seq BIGINT, d INT, v DOUBLE").repartition(3).cache()


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("width", [0.7, 13.0, 1000.0])
def test_running_kinds(data, width):
    rows, df = data
    want = {}
    for k, rs in by_key(rows).items():
        total, best, last, n = 0, None, None, 0
        for r in rs:
            total, best = total + r[3], r[4] if best is None else max(best, r[4])
            n += r[3] == 1
            before, last = last, r[4] if r[3] == 1 else last
            want[r[2]] = (total, best, last, n)
    flag = F.col("d") == 1
    out = O.running(df, KEYS, ["t", "seq"], {"a": ("sum", F.col("d")), "b": ("max", F.col("v")), "c": ("last", F.when(flag, F.col("v"))), "n": ("count", F.when(flag, 1))}, width)
    assert {r.seq: (r.a, r.b, r.c, r.n) for r in out.collect()} == want


@pytest.mark.parametrize("width", [0.7, 50.0])
def test_descending_exclusive(data, width):
    rows, df = data
    want = {}
    for k, rs in by_key(rows).items():
        for r, nxt in zip(rs, [*rs[1:], None]):
            want[r[2]] = nxt and nxt[2]
    out = O.running(df, KEYS, ["t", "seq"], {"nxt": ("last", F.col("seq"))}, width, inclusive=False, descending=True)
    assert {r.seq: r.nxt for r in out.collect()} == want


@pytest.mark.parametrize("width", [0.7, 13.0, 1000.0])
def test_clamped_score_equals_fold(data, width):
    rows, df = data
    want = {}
    for k, rs in by_key(rows).items():
        s = 0
        for r in rs:
            s = max(0, s + r[3])
            want[r[2]] = s
    out = O.clamped_cumsum(df, KEYS, ["t", "seq"], F.col("d"), "score", width)
    assert {r.seq: r.score for r in out.collect()} == want


@pytest.mark.parametrize("width", [1.5, 40.0])
def test_rolling_equals_pruned_list(data, width):
    rows, df = data
    want = {}
    for k, rs in by_key(rows).items():
        for r in rs:
            near = [round(x[4], 9) for x in rs if 0 <= round(r[1] * 10) - round(x[1] * 10) <= 15]
            want[r[2]] = round(sum(near) / len(near), 9)
    ms = df.withColumn("ms", F.round(F.col("t") * 10).cast("bigint"))
    out = O.rolling_mean(ms, KEYS, "ms", 15, F.round("v", 9), "m", width * 10)
    assert {r.seq: r.m for r in out.collect()} == {k: pytest.approx(v, abs=1e-8) for k, v in want.items()}


@pytest.mark.parametrize("width,gap", [(2.0, 1.0), (7.0, 0.35), (500.0, 3.0), (3.0, 3.0)])
def test_debounce_equals_loop(data, width, gap):
    rows, df = data
    want = set()
    for k, rs in by_key(rows).items():
        last = float("-inf")
        for r in rs:
            if r[3] >= 0 and r[1] > last + gap:
                last = r[1]
                want.add((k, r[1], r[2]))
    out = Q.debounce(df, KEYS, "t", gap, qualifies=F.col("d") >= 0, tie="seq", width=width)
    assert {tuple(r) for r in out.collect()} == want


def test_debounce_cuts_heavy_keys_only(spark, data):
    """Keys below a task's share are walked whole; the same events are kept as by slices of all keys."""
    rows, df = data
    cuts = O.Cuts(df, "t", slices=12)
    heavy = {k for k, in cuts.heavy(KEYS)}
    assert heavy and len({r[0] for r in rows} - heavy) > 0
    for gap in (0.35, 3.0):
        out, want = Q.debounce(df, KEYS, "t", gap, tie="seq", width=cuts), Q.debounce(df, KEYS, "t", gap, tie="seq", width=7.0)
        assert {tuple(r) for r in out.collect()} == {tuple(r) for r in want.collect()}
    whole = df.where(F.col("s").isin(*({r[0] for r in rows} - heavy)))
    sliced = whole.select(O.slices(whole, KEYS, ["t"], cuts).alias("x"))
    assert sliced.where("x IS NOT NULL").count() == 0


@pytest.mark.parametrize("forward,strict", [(False, False), (False, True), (True, False), (True, True)])
def test_asof(data, forward, strict):
    rows, df = data
    facts, points = df.where("d = 1"), df.where("d = 0").select("s", "t", "seq")
    want = {}
    for k, rs in by_key(rows).items():
        f = [r for r in rs if r[3] == 1]
        ts = [r[1] for r in f]
        for r in rs:
            if r[3] == 0:
                if forward:
                    i = (bisect.bisect_right if strict else bisect.bisect_left)(ts, r[1])
                    hit = f[i] if i < len(f) else None
                else:
                    i = (bisect.bisect_left if strict else bisect.bisect_right)(ts, r[1]) - 1
                    hit = f[i] if i >= 0 else None
                want[r[2]] = hit and hit[2]
    f = facts.select("s", F.col("t").alias("ft"), F.col("seq").alias("fseq"))
    out = O.asof_join(points, f, KEYS, "t", "ft", ["fseq"], 5.0, tie="fseq", forward=forward, strict=strict)
    assert {r.seq: r.fseq for r in out.collect()} == want


def test_range_join_has_no_nested_loop_and_no_duplicates(spark, data):
    rows, df = data
    iv = [("hot", a, a + w, a) for a, w in ((0.0, 5.0), (5.0, 0.5), (10.0, 33.3), (60.0, 40.0))]
    i = spark.createDataFrame(iv, "s STRING, t0 DOUBLE, t1 DOUBLE, name DOUBLE")
    out = O.range_join(df, i, KEYS, "t", "t0", "t1", 2.0)
    want = sorted((r[2], n) for r in rows for s, a, b, n in iv if r[0] == s and a <= r[1] < b)
    assert sorted((r.seq, r.name) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_exact_median(data):
    rows, df = data
    import statistics

    got = {r.s: r.m for r in O.exact_median(df, KEYS, "v", "m", 0.01).collect()}
    assert got == {k: pytest.approx(statistics.median(r[4] for r in rs)) for k, rs in by_key(rows).items()}


@pytest.mark.parametrize("kind", ["DOUBLE", "BIGINT", "DECIMAL(20,2)"])
def test_exact_median_of_long_short_and_tied_keys(spark, kind):
    # 60,000 rows are compressed by the summary; half of `tied` is one value
    long = spark.range(60_000).select(F.lit("long").alias("s"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("v"))
    tied = spark.range(30_001).select(F.lit("tied").alias("s"), F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    short = spark.createDataFrame([("one", 3), ("two", 4), ("two", 9), ("none", None)], "s STRING, v BIGINT")
    df = long.union(tied).union(short).withColumn("v", F.col("v").cast(kind)).repartition(5)
    got = {r.s: float(r.m) for r in O.exact_median(df, KEYS, "v", "m").collect()}
    assert got == {r.s: r.m for r in df.groupBy("s").agg(F.median(F.col("v").cast("double")).alias("m")).where("m IS NOT NULL").collect()}
    assert set(got) == {"long", "tied", "one", "two"}


def test_exact_median_ranks_only_the_middle(spark):
    df = spark.range(100_000).select(F.lit("a").alias("s"), F.rand(3).alias("v")).cache()
    seen = O.exact_median(df, KEYS, "v", "m")
    assert seen.first().m == df.agg(F.median("v")).first()[0]
    nan = spark.createDataFrame([("a", float("nan"))] * 3 + [("a", 1.0)] + [("b", float("nan")), ("b", 1.0), ("b", 2.0)], "s STRING, v DOUBLE")
    got = {r.s: r.m for r in O.exact_median(nan, KEYS, "v", "m").collect()}
    assert got["b"] == 2.0 and got["a"] != got["a"]


def plain_place(x, n, seed, *keys):
    number = lambda *cols: int(hashlib.md5("|".join(map(str, (seed, *cols))).encode()).hexdigest()[:15], 16)
    for r in range(32):
        other = (number(r, *keys) % n - x) % n
        if number(r, *keys, max(x, other)) % 2:
            x = other
    return x


@pytest.mark.parametrize("n", [1, 2, 7, 64, 301])
def test_places_are_a_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(place(F.col("id"), F.lit(n), 5, F.lit("p"))).collect()]
    assert sorted(got) == list(range(n)) and got == [plain_place(x, n, 5, "p") for x in range(n)]


def test_draws_are_even_distinct_and_follow_the_seed(spark):
    pool = spark.createDataFrame([("a", f"a{i}") for i in range(10)] + [("b", "b0"), ("b", "b1")], "valence_group STRING, clip_id STRING")
    wants = spark.range(2000).select(F.concat(F.lit("p"), "id").alias("participant_id"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("absent"))).alias("valence_group"))
    out = L.seeded_sample(wants, pool, {"a": 3, "b": 5}, 1)
    rows = [tuple(r) for r in out.select("participant_id", "valence_group", "draw", "clip_id").collect()]
    assert len(rows) == 2000 * 5 == len({(p, c) for p, _, _, c in rows})
    assert {d for _, g, d, _ in rows if g == "b"} == {1, 2}
    first = Counter(c for _, g, d, c in rows if (g, d) == ("a", 1))
    assert len(first) == 10 and max(abs(k - 200) for k in first.values()) < 60  # 200 each, 13 is one standard deviation
    again = L.seeded_sample(wants.repartition(5), pool.repartition(3), {"a": 3, "b": 5}, 1)
    assert {tuple(r) for r in again.select("participant_id", "valence_group", "draw", "clip_id").collect()} == set(rows)
    other = L.seeded_sample(wants, pool, 3, 2).where("valence_group = 'a'").select("participant_id", "valence_group", "draw", "clip_id")
    assert {tuple(r) for r in other.collect()} != {r for r in rows if r[1] == "a"}
    assert L.seeded_sample(wants, pool, 0, 1).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_chunks_and_interleaving(spark):
    items = spark.createDataFrame([("g", i) for i in range(10)] + [("h", i) for i in range(2)], "g STRING, i INT")
    got = L.chunk_evenly(items, 4, ["g"], ["i"], 3.0)
    sizes = {r.chunk: r["count"] for r in got.where("g = 'g'").groupBy("chunk").count().collect()}
    assert sizes == {0: 3, 1: 3, 2: 2, 3: 2}
    assert sorted(r.chunk for r in got.where("g = 'h'").collect()) == [0, 1]
    clips = spark.createDataFrame([("p", g, gi, f"{g}{k}") for gi, (g, n) in enumerate((("a", 3), ("b", 3), ("c", 4))) for k in range(n)], "participant_id STRING, valence_group STRING, group_index INT, clip_id STRING")
    b = L.interleaved_blocks(clips, 3, 9)
    assert sorted(r["count"] for r in b.groupBy("block").count().collect()) == [3, 3, 4]
    per = b.groupBy("valence_group", "block").count().groupBy("valence_group").agg((F.max("count") - F.min("count")).alias("d"))
    assert per.where("d > 1").count() == 0
    again = L.interleaved_blocks(clips.repartition(3), 3, 9)
    assert sorted(map(tuple, b.collect())) == sorted(map(tuple, again.collect()))


def test_expressions(spark):
    rng, rows = random.Random(3), []
    for _ in range(60):
        toks, v = [str(rng.randint(1, 99))], None
        v = float(toks[0])
        for _ in range(rng.randint(0, 4)):
            op, x = rng.choice("+-*/"), rng.randint(1, 9)
            toks += [op, str(x)]
            v = {"+": v + x, "-": v - x, "*": v * x, "/": v / x}[op]
        rows.append((" ".join(toks), v))
    df = spark.createDataFrame(rows, "e STRING, v DOUBLE")
    assert df.where(F.abs(eval_expression(F.col("e")) - F.col("v")) > 1e-9).count() == 0
    assert df.where(eval_expression(F.col("e")).isNull()).count() == 0


def test_drift_and_mask(spark):
    sync = spark.createDataFrame([("s", "d", 100.0, 0.0, "ok"), ("s", "d", 1101.0, 1000.0, "ok"), ("s", "d", 0.0, 500.0, "error"), ("s", "e", 50.0, 0.0, "ok")], "session_id STRING, device_id STRING, sync_time_host_utc DOUBLE, device_rel_sec DOUBLE, result STRING")
    x = spark.createDataFrame([("s", "d", 0.0), ("s", "d", 500.0), ("s", "d", 2000.0), ("s", "e", 10.0)], "session_id STRING, device_id STRING, rel_sec DOUBLE")
    got = {(r.device_id, r.rel_sec): r.wall for r in J.align_samples_multi(x, sync, width=100.0).collect()}
    assert got == {("d", 0.0): 100.0, ("d", 500.0): pytest.approx(600.5), ("d", 2000.0): pytest.approx(2102.0), ("e", 10.0): 60.0}
    rows = spark.createDataFrame([("s", 0.0, 1.0), ("s", 5.0, 6.0), ("s", 9.0, 9.5)], "s STRING, t0 DOUBLE, t1 DOUBLE")
    bad = spark.createDataFrame([("s", 0.5, 5.1), ("s", 2.0, 2.1)], "s STRING, t0 DOUBLE, t1 DOUBLE")
    assert [r.invalid for r in J.mask_invalid(rows, bad, KEYS, 0.0, width=1.0).orderBy("t0").collect()] == [True, True, False]


def test_camp_and_gauge(spark):
    spawns = spark.createDataFrame([("s", 1.0), ("s", 2.4), ("s", 2.9)], "s STRING, t DOUBLE")
    moves = spark.createDataFrame([("s", 2.0, False), ("s", 2.85, True)], "s STRING, t DOUBLE, blocked BOOLEAN")
    starts = spark.createDataFrame([("s", 0.9)], "s STRING, t0 DOUBLE")
    p = [round(r.nudge_probability, 6) for r in X.camp_exposure(spawns, moves, starts, 0.3, 0.2, 1.0, KEYS).orderBy("t").collect()]
    assert p == [0.0, 0.5, 1.0]
    assert X.camp_exposure(spawns, moves, starts, 0.0, 0.0, 1.0, KEYS).where("nudge_probability > 0").count() == 0
    assert X.camp_exposure(spawns, moves, starts, 0.3, 0.0, 1.0, KEYS).where("nudge_probability = 1").count() == 2
    g = spark.createDataFrame([("F1", 0.0), ("F1", 5.0), ("F2", 6.0), ("F1", 15.0)], "gauge STRING, t_sec DOUBLE")
    assert [r.gap_sec for r in X.gauge_gap_check(g, 10.0).collect()] == [5.0]


@pytest.mark.parametrize("width", [3.0, 1000.0])
def test_live_state_equals_loop(data, width):
    rows, df = data
    base = df.withColumns({"spawn_ms": F.col("t"), "resolve_ms": F.col("t") + F.col("v") * 10, "lane": F.col("seq") % 4, "fall_sec": F.col("v") / 50})
    hazards, moves = base.where("d = 1"), df.where("d = 0 AND v < 0.3").select("s", F.col("t").alias("client_ms"), (F.col("seq") % 4).alias("to_lane"), (F.col("v") < 0.1).alias("blocked"))
    ticks = df.where("d = -1").select("s", F.col("seq").alias("tick_id"), F.col("t").alias("t_ms"))
    want = {}
    for k, rs in by_key(rows).items():
        for r in rs:
            if r[3] == -1:
                own = [x[2] % 4 for x in rs if x[3] == 0 and 0.1 <= x[4] < 0.3 and x[1] <= r[1]]
                own_at = max([x[1] for x in rs if x[3] == 0 and 0.1 <= x[4] < 0.3 and x[1] <= r[1]], default=None)
                own = {x[2] % 4 for x in rs if x[3] == 0 and 0.1 <= x[4] < 0.3 and x[1] == own_at} or {2}
                live = [(x[2] % 4, x[1] + x[4] * 20 - r[1]) for x in rs if x[3] == 1 and x[1] <= r[1] < x[1] + x[4] * 10]
                want[r[2]] = (len(live), len({a for a, _ in live}), min((b for _, b in live), default=None), own, live)
    out = X.live_state(ticks, hazards, moves, 4, KEYS, width).collect()
    assert len(out) == len(want)
    for r in out:
        n, lanes, near, own, live = want[r.tick_id]
        assert (r.active_obstacle_count, r.blocked_lane_count) == (n, lanes) and r.own_lane in own
        assert r.nearest_time_to_collision_ms == (None if near is None else pytest.approx(near))
        mine = min((b for a, b in live if a == r.own_lane), default=None)
        assert r.own_lane_time_to_collision_ms == (None if mine is None else pytest.approx(mine))
