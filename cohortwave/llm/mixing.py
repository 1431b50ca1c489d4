"""Mixing sources to target weights: certain whole copies, and Pareto order sampling for the rest."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwave.session import keep

MOST = 3  # copies of a document, and a source's target in units of its size
BUCKETS = 4096
SEED = "mix-1"
CLOSINGS = 3
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    """Runs of other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _small(df: DataFrame, name: str) -> DataFrame:
    """A written table of one row per source; broadcast only where it is that small."""
    df = keep(df, name)
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def targets(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes. A target stops at
    `most` times its source's size, and the excess is shared by weight: the level l with
    sum(min(most * size, weight * l)) = total, found from running sums over the sources by size / weight.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    by_name = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (by_name % len(weights) + 1).cast("int")))
    order = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    level = weighed.withColumns(
        {
            "level": (F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
            "k": F.row_number().over(order),
        }
    )
    free = F.col("w") * F.col("level") <= most * F.col("source_size")  # the first such source has the level of all
    found = level.withColumn("l", F.min_by("level", F.when(free, F.col("k"))).over(everything))
    return found.select("source", "source_size", F.least(F.col("source_size") * float(most), F.col("w") * F.col("l")).alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: Sequence[float] = (5, 2, 1), most: int = MOST,
    importance: Column | None = None, seed: str = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """(id, source, size, source_size, target, copies) of every row; copies * size adds up to about the target of a source.

    A row of importance v (1 for all unless given, never negative) is due c = v * target / sum(v * size) copies, `most`
    at most: floor(c) for certain, and one more with probability p = c - floor(c). The sample has a fixed size in words:
    rows are taken by (u / (1 - u)) / (p / (1 - p)), u uniform by a digest of seed, id and size, as long as they fit into
    what certain copies leave of the target; then, CLOSINGS times, one more row of each source, the one that comes
    nearest to what is left, if that is nearer than none. So a source misses its target by half a row at most.

    Null texts have size 0 and take part with 0 words. Null sources are one source. Repeated rows are drawn one by one.
    Ranks come from sums over `buckets` pieces of each source's order, so no source passes through one task: the pieces
    hold equal shares of the rows of equal importance, however near a target is to a whole multiple of its source.
    """
    uniform = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size").cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), (importance if importance is not None else F.lit(1.0)).alias("v"))
    rows = keep(rows.withColumn("u", uniform), "sizes")
    shares = rows.groupBy("source").agg(F.sum(F.col("v") * F.col("size")).alias("mass"))
    goal = targets(rows, weights, most)
    goal = _small(goal.join(shares.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "targets")

    def per_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        return left.join(right.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")), how).drop("__s")

    due = F.least(F.lit(float(most)), F.when(F.col("mass") > 0, F.col("v") * F.col("target") / F.col("mass")).otherwise(0.0))
    p, odds = F.col("p"), F.col("u") / (1 - F.col("u"))
    # the odds of a row of equal importance: with them taken back, places of such rows are uniform again
    plain = F.least(F.lit(float(most)), F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    plain = plain - F.floor(plain)
    place = 1 - 1 / (1 + F.col("q") * F.when(plain > 0, plain / (1 - plain)).otherwise(1.0))
    ranked = (
        per_source(rows, goal).withColumn("due", due).withColumns({"certain": F.floor("due"), "p": F.col("due") - F.floor("due")})
        .withColumn("q", F.when((p > 0) & (F.col("size") > 0), odds / (p / (1 - p))))
        .withColumn("bucket", F.least(F.floor(place * buckets), F.lit(buckets - 1)).cast("int"))
    )
    drawable = F.col("q").isNotNull()
    sums = ranked.groupBy("source", "target", "bucket").agg(F.sum(F.when(drawable, F.col("size")).otherwise(0)).alias("s"), F.sum(F.col("certain") * F.col("size")).alias("c"))
    by_source = W.partitionBy("source")
    cut = sums.select(
        F.col("source").alias("s_"), F.col("bucket").alias("b_"), (F.col("target") - F.sum("c").over(by_source)).alias("need"),
        F.coalesce(F.sum("s").over(by_source.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    in_bucket = W.partitionBy("source", "bucket").orderBy("q", F.col("id").asc_nulls_last(), "size")
    drawn = (
        ranked.where(drawable).join(cut, F.col("source").eqNullSafe(F.col("s_")) & (F.col("bucket") == F.col("b_"))).drop("s_", "b_")
        .withColumns({"k": F.row_number().over(in_bucket), "cum": F.sum("size").over(in_bucket.rowsBetween(W.unboundedPreceding, 0))})
        .withColumn("take", (F.col("before") + F.col("cum") <= F.col("need")).cast("int"))
        .select("id", "source", "size", "source_size", "target", "certain", "take", "need", "bucket", "q", "k")
    )
    drawn = keep(drawn, "drawn")
    for _ in range(CLOSINGS):
        left = drawn.groupBy("source").agg((F.first("need") - F.sum(F.col("take") * F.col("size"))).alias("left"))
        miss = F.abs(F.col("left") - F.col("size"))
        last = (
            per_source(drawn.where("take = 0"), _small(left, "left")).where(miss < F.col("left"))
            .groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "q", "bucket", "k")).alias("x"))
        )
        last = _small(last.select(F.col("source").alias("s_"), F.col("x.bucket").alias("b_"), F.col("x.k").alias("k_"), F.lit(1).alias("last")), "last")
        met = drawn.join(last, F.col("source").eqNullSafe(F.col("s_")) & (F.col("bucket") == F.col("b_")) & (F.col("k") == F.col("k_")), "left")
        drawn = keep(met.withColumn("take", F.col("take") + F.coalesce("last", F.lit(0))).drop("s_", "b_", "k_", "last"), "drawn")
    cols = ["id", "source", "size", "source_size", "target"]
    return (
        drawn.select(*cols, (F.col("certain") + F.col("take")).alias("copies"))
        .union(ranked.where(~drawable).select(*cols, F.col("certain").alias("copies")))
        .withColumn("copies", F.col("copies").cast("bigint")).withColumnRenamed("id", id_col)
    )



def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: every row of `docs` as often as `mix` takes it, columns as they are."""
    mixed = mix(docs, id_col, text_col, source_col, **how)
    same = ["__i", "__s", "__w"]
    m = mixed.select(F.col(id_col).alias("__i"), F.col("source").alias("__s"), F.col("size").alias("__w"), F.col("copies").cast("int").alias("__n"))
    m = m.withColumn("__k", F.row_number().over(W.partitionBy(*same).orderBy(F.desc("__n"))))
    m = m.where("__n > 0").select(*[F.col(c).alias(f"{c}m") for c in [*same, "__k"]], "__n")
    # rows equal in id, source and size are drawn one by one, and told apart by their texts
    d = docs.withColumns({"__i": F.col(id_col), "__s": F.col(source_col), "__w": words(F.col(text_col))})
    d = d.withColumn("__k", F.row_number().over(W.partitionBy(*same).orderBy(F.xxhash64(text_col), text_col)))
    on = [F.col(c).eqNullSafe(F.col(f"{c}m")) for c in [*same, "__k"]]
    return d.join(m, on).withColumn("__n", F.explode(F.array_repeat(F.lit(1), F.col("__n")))).select(*docs.columns)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
lev AS (
  SELECT *, row_number() OVER o AS k,
         (sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM src WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)),
goal AS (
  SELECT source, source_size, least(source_size * {MOST}.0::DOUBLE,
         w * (SELECT arg_min(level, k) FROM lev WHERE w * level <= {MOST} * source_size)) AS target
  FROM lev),
due AS (
  SELECT z.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN least({MOST}.0::DOUBLE, g.target / g.source_size) ELSE 0 END AS c,
         (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u
  FROM sized z JOIN goal g ON z.source IS NOT DISTINCT FROM g.source),
odds AS (
  SELECT *, floor(c) AS certain, CASE WHEN c > floor(c) AND size > 0 THEN (u / (1 - u)) / ((c - floor(c)) / (1 - (c - floor(c)))) END AS q FROM due),
cum AS (
  SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS need,
         sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY q NULLS FIRST, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS run
  FROM odds),
took0 AS (SELECT *, (q IS NOT NULL AND run <= need)::INT AS take FROM cum)
"""
for _k in range(CLOSINGS):
    SQL += f"""
, gap{_k} AS (SELECT *, need - sum(take * size) OVER (PARTITION BY source) AS gone FROM took{_k}),
fits{_k} AS (SELECT *, q IS NOT NULL AND take = 0 AND abs(gone - size) < gone AS fits FROM gap{_k}),
near{_k} AS (SELECT *, row_number() OVER (PARTITION BY source, fits ORDER BY abs(gone - size), q, doc_id NULLS LAST, size) AS n FROM fits{_k}),
took{_k + 1} AS (SELECT * EXCLUDE (take, gone, fits, n), take + (fits AND n = 1)::INT AS take FROM near{_k})
"""
SQL += f"SELECT doc_id, size, source_size, target, (size * (certain + take))::BIGINT AS taken FROM took{CLOSINGS}"
