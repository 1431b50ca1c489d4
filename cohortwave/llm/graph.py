"""Connected components as joins, for links that are too many for one machine."""

from pyspark.sql import DataFrame, functions as F

from cohortwave.session import keep


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: `large` moves the larger neighbours of every node, else the smaller ones and the node."""
    near = _both_ways(edges)
    if not large:
        near = near.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    moved = near.where("v > u") if large else near
    out = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of `edges` (u, v: bigint) reaches: (node, root), nodes of some edge that are no root.

    Alternates large-star and small-star steps, which need about log(n) rounds even on long chains, until every node
    hangs on one root. Every round is a written table, so nothing is recomputed when an executor is lost, and a node
    with very many neighbours is only a key of a pre-aggregated minimum and of a join that can be split. The driver
    sees two yes-or-no answers per round.
    """
    at = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while True:
        at = keep(_star(_star(at, True), False), "stars")
        hanging = at.join(at.select(F.col("u").alias("v")), "v", "left_semi")
        torn = at.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if hanging.isEmpty() and torn.isEmpty():
            return at.select(F.col("u").alias("node"), F.col("v").alias("root"))
