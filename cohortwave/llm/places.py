"""Numbering the rows of groups in order, without a task that sees a whole group."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwave.session import keep


def placed(rows: DataFrame, group: str, order: Sequence[str], name: str, pos: str = "pos", size: str = "n") -> tuple[DataFrame, DataFrame]:
    """(placed, table): `rows` with `pos`, the place (from 0) of a row in its group by `order` (nulls first), and `size`, the
    rows of its group; and the rows as they were written. Both have `at`, which names a row.

    `group` must not be null. Rows that are equal in `order` come in any one order, which is kept. Rows are dealt out in
    ranges of (group, order, row of the input), so neither a group nor a value with a third of all rows is one task;
    ranges are counted, and a row's place is its place in the range plus what the ranges before hold. The ranges are a
    written table: a task that runs again numbers the same rows alike.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [group, *order, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    at = keep(ranged.drop("__tie").withColumn("at", F.monotonically_increasing_id()), name)
    dealt = at.withColumn("__part", F.shiftrightunsigned("at", 33))
    runs = dealt.groupBy(group, "__part").agg(F.min("at").alias("__lo"), F.count("*").alias("__rows"))
    whole = W.partitionBy(group)
    before = F.coalesce(F.sum("__rows").over(whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(group, "__part", (before - F.col("__lo")).alias("__shift"), F.sum("__rows").over(whole).alias(size))
    return dealt.join(starts, [group, "__part"]).withColumn(pos, F.col("at") + F.col("__shift")).drop("__part", "__shift"), at
