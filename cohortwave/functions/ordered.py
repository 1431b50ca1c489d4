"""Ordered computations that stay parallel inside one key.

A plain window puts all rows of a key into one task, so one session holding a third of the
data would stall the job. Keys that hold more than a task's share of a table are cut into slices of
their order column, at cut points of their own that hold the number of rows per slice down wherever
rows lie (`Cuts`). Slice totals are pre-aggregated before any shuffle, a window over the few totals gives
each slice the state it starts from, and that state enters the slice as one extra leading row. Rows shuffle
once, by (key, slice); all other keys are plain windows.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

_ROW, _SLICE = "__row", "__slice"


_SAMPLED = 32  # sampled rows per slice; sizes then stray from their mean by about 1 / sqrt of it
_MOST = 512  # slices of a table: the sample, and all cut points together, stay bounded at any number of partitions
_LOWEST = -(1 << 62)  # slice of rows without a place, which come first
_EVERY = ("every row",)


class Cuts:
    """Slices of nearly equal row counts for the keys that need them.

    A table has `slices` shares: twice as many as there are shuffle partitions, 16 at least and 512 at most. A bounded sample
    of rows (32 for each share) tells which keys hold more than one; they are cut at quantiles of their own sampled
    rows, taken with `tie`, the next order column, so that equal values are cut too. A slice thus has about one share at most,
    and so has every other key. The sample is found once per object and set of keys, by a pass over these columns.
    Keys that the table does not have are left out: a session's runs are cut if the session is large. `scale` serves
    orders in other units.
    """

    def __init__(self, df: DataFrame, t: str, tie: str | None = None, slices: int | None = None, scale: float | None = None):
        self.df, self.t, self.tie, self.scale = df, t, tie, scale
        self.slices = slices or min(_MOST, max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        self._samples: dict[tuple[str, ...], list[Row]] = {}

    def times(self, scale: float) -> "Cuts":
        other = Cuts(self.df, self.t, self.tie, self.slices, scale)
        other._samples = self._samples
        return other

    def _sample(self, keys: tuple[str, ...]) -> list[Row]:
        if keys not in self._samples:
            # rows are picked by their place in the files, so that many equal values weigh as much as they are
            picked = self.df.select(
                F.col(self.t).alias("t"), (F.col(self.tie) if self.tie else F.lit(0)).alias("o"), F.struct(*keys).alias("k") if keys else F.lit(None).alias("k"), F.xxhash64(F.monotonically_increasing_id()).alias("h")
            )
            rows = picked.orderBy("h").limit(_SAMPLED * self.slices).select("t", "o", "k").collect()
            self._samples[keys] = sorted((r for r in rows if r.t is not None), key=lambda r: (r.t, r.o is not None, r.o or 0))
        return self._samples[keys]

    def _quantiles(self, rows: list[Row], n: int) -> list[tuple]:
        at = sorted({len(rows) * i // n for i in range(1, n)}) if rows else []
        return [(rows[i].t * self.scale if self.scale else rows[i].t, rows[i].o) for i in at]

    def points(self) -> list[tuple]:
        """Cut points of all rows together."""
        return self._quantiles(self._sample(()), self.slices)

    def heavy(self, keys: Sequence[str]) -> dict[tuple, list[tuple]]:
        """Cut points of each key with more than one share of the rows; of all rows where the table has none of `keys`."""
        known = tuple(k for k in keys if k in self.df.columns)
        if not known:
            return {_EVERY: self.points()}
        rows = self._sample(known)
        held: dict[tuple, list[Row]] = {}
        for r in rows:
            held.setdefault(tuple(r.k), []).append(r)
        share = max(1.0, len(rows) / self.slices)
        return {k: self._quantiles(own, -(-len(own) // max(1, int(share)))) for k, own in held.items() if len(own) > share}

    def _place(self, points: list[tuple], order: Sequence[str | Column]) -> Column:
        """How many of the points are not above a row: a binary search in nested CASE, which Spark compiles."""
        cols = [F.col(c) if isinstance(c, str) else c for c in order]
        tied = self.tie is not None and len(order) > 1 and order[1] == self.tie

        def passed(t, o) -> Column:
            if not tied:
                return cols[0] >= F.lit(t)
            return (cols[0] > F.lit(t)) | ((cols[0] == F.lit(t)) & (F.coalesce(cols[1] >= F.lit(o), F.lit(False)) if o is not None else F.lit(True)))

        def search(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(passed(*points[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

        return search(0, len(points)).cast("bigint")

    def of(self, *order: str | Column) -> Column:
        """Slice of a row by the cut points of all rows; rows without a place are in the first."""
        return self._place(self.points(), order)

    def of_heavy(self, keys: Sequence[str], *order: str | Column) -> Column:
        """Slice of a row of a heavy key, null for all other keys."""
        heavy = self.heavy(keys)
        if _EVERY in heavy:
            return self._place(heavy[_EVERY], order)
        known = [k for k in keys if k in self.df.columns]
        out = None
        for values, points in heavy.items():
            same = F.lit(True)
            for k, v in zip(known, values):
                same = same & F.col(k).eqNullSafe(F.lit(v))
            out = out.when(same, self._place(points, order)) if out is not None else F.when(same, self._place(points, order))
        return F.lit(None).cast("bigint") if out is None else out


#: Width of equal slices of the order column, or cut points; None finds cut points from the rows themselves.
Slicing = float | Cuts | None


def slice_id(t: str | Column, width: "float | Cuts") -> Column:
    if isinstance(width, Cuts):
        return width.of(t)
    return F.floor((F.col(t) if isinstance(t, str) else t) / F.lit(width))


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: Slicing) -> Column:
    """Slice of a row; null for the rows of keys that are not cut."""
    if width is None:
        width = Cuts(df, order[0], order[1] if len(order) > 1 else None)
    return width.of_heavy(keys, *order) if isinstance(width, Cuts) else F.coalesce(slice_id(order[0], width), F.lit(_LOWEST))


def _directed(cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in cols]


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, tuple[str, Column]],
    width: Slicing = None,
    *,
    slice_by: Column | None = None,
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Add running aggregates over `order` per `keys`.

    `aggs` maps an output name to (kind, expression) with kind one of sum, count, min, max and
    last (latest non-null). `order` must be a total order and is sliced by `width` (see Slicing)
    unless `slice_by`, a non-decreasing function of it, is given. `inclusive=False`
    leaves the current row out; `descending` runs from the end.
    """
    kinds = {n: k for n, (k, _) in aggs.items()}
    val = {n: f"__v_{n}" for n in aggs}
    rows = df.withColumns(
        {
            _SLICE: F.coalesce(slice_by.cast("bigint"), F.lit(_LOWEST)) if slice_by is not None else slices(df, keys, order, width),
            **{
                val[n]: F.when(e.isNotNull(), F.lit(1)).cast("bigint") if k == "count" else e
                for n, (k, e) in aggs.items()
            },
        }
    )
    pos = F.struct(*order)
    latest = F.min_by if descending else F.max_by
    total = {
        "sum": F.sum,
        "count": F.sum,
        "min": F.min,
        "max": F.max,
        "last": lambda c: latest(c, F.when(F.col(c).isNotNull(), pos)),
    }
    over = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}

    totals = rows.where(F.col(_SLICE).isNotNull()).groupBy(*keys, _SLICE).agg(*[total[kinds[n]](val[n]).alias(val[n]) for n in aggs])
    before = W.partitionBy(*keys).orderBy(*_directed([_SLICE], descending)).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*keys, _SLICE, *[over[kinds[n]](val[n]).over(before).alias(val[n]) for n in aggs], F.lit(0).alias(_ROW))

    w = (
        W.partitionBy(*keys, _SLICE)
        .orderBy(F.col(_ROW).asc(), *_directed(order, descending))
        .rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    )
    out = {n: over[kinds[n]](val[n]).over(w) for n in aggs}
    out = {n: F.coalesce(c, F.lit(0).cast("bigint")) if kinds[n] == "count" else c for n, c in out.items()}
    return (
        rows.withColumn(_ROW, F.lit(1))
        .unionByName(carry, allowMissingColumns=True)
        .withColumns(out)
        .where(F.col(_ROW) == 1)
        .drop(_ROW, _SLICE, *val.values())
    )


def rolling_mean(df: DataFrame, keys: Sequence[str], t: str, span: float, value: Column, out: str, width: Slicing = None) -> DataFrame:
    """Mean of `value` over rows with `now - t <= span`, rows of the same time included.

    Each row enters the sum at `t` and leaves it after `t + span`, so the mean is one running sum
    over that line. Unlike a sliding frame it does not re-add a window per row, however dense the
    key. Sums are exact, so a row that left leaves nothing behind: integers are summed as decimals without places, other
    values below 1e18 as decimals of 18 places (smaller parts are cut off), and those from 1e18 on, which are whole
    numbers, apart from them without places. A sum of 1e38 or more is an error.
    """
    kind = dict(df.select(value.alias("v")).dtypes)["v"]
    whole = kind in ("int", "bigint", "smallint", "tinyint", "boolean")
    large = F.lit(False) if whole else F.abs(value) >= F.lit(1e18)
    given = value.cast("int") if kind == "boolean" else value
    v = given.cast("decimal(20,0)") if whole else F.when(large, F.lit(0)).otherwise(given).cast("decimal(38,18)")
    big = F.when(large, given).otherwise(F.lit(0)).cast("decimal(38,0)")
    n, none = F.when(given.isNotNull(), F.lit(1)).otherwise(0), F.lit(None)
    at = F.col(t)
    # at one time: rows enter, then the points are read, then rows leave
    enter = F.struct(at.alias("at"), F.lit(0).alias("k"), v.alias("v"), big.alias("b"), n.alias("n"))
    read = F.struct(at.alias("at"), F.lit(1).alias("k"), none.cast("int").alias("v"), none.cast("int").alias("b"), none.cast("int").alias("n"))
    leave = F.struct((at + F.lit(span)).alias("at"), F.lit(2).alias("k"), (-v).alias("v"), (-big).alias("b"), (-n).alias("n"))
    line = df.select(*keys, F.struct(*df.columns).alias("__p"), F.explode(F.array(enter, read, leave)).alias("e")).select(
        *keys, F.col("e.at").alias("__at"), F.col("e.k").alias("__k"), F.col("e.v").alias("__v"), F.col("e.b").alias("__b"), F.col("e.n").alias("__n"), F.when(F.col("e.k") == 1, F.col("__p")).alias("__p")
    )
    sums = running(line, keys, ["__at", "__k"], {"__s": ("sum", F.col("__v")), "__l": ("sum", F.col("__b")), "__c": ("sum", F.col("__n"))}, width).where("__k = 1")
    return sums.select("__p.*", F.when(F.col("__c") > 0, (F.coalesce(F.col("__s").cast("double"), F.lit(0.0)) + F.col("__l").cast("double")) / F.col("__c")).alias(out))


def clamped_cumsum(df: DataFrame, keys: Sequence[str], order: Sequence[str], delta: Column, out: str, width: Slicing = None) -> DataFrame:
    """Running sum that is floored at 0 after every step.

    Equals `P - min(0, min P)` with P the plain running sum; the pair (sum, lowest prefix) of a
    slice combines with that of the slices before it.
    """
    rows = df.withColumns({_SLICE: slices(df, keys, order, width), "__d": delta})
    local = W.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    totals = (
        rows.where(F.col(_SLICE).isNotNull()).select(*keys, _SLICE, "__d", F.sum("__d").over(local).alias("__p"))
        .groupBy(*keys, _SLICE)
        .agg(F.sum("__d").alias("__d"), F.min("__p").alias("__p"))
    )
    before = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    start = totals.withColumn("__c", F.coalesce(F.sum("__d").over(before), F.lit(0)))
    carry = start.select(
        *keys,
        _SLICE,
        F.col("__c").alias("__d"),
        F.coalesce(F.min(F.col("__c") + F.col("__p")).over(before), F.lit(0)).alias("__low"),
        F.lit(0).alias(_ROW),
    )
    w = W.partitionBy(*keys, _SLICE).orderBy(_ROW, *order).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn(_ROW, F.lit(1))
        .unionByName(carry, allowMissingColumns=True)
        .withColumn("__p", F.sum("__d").over(w))
        .withColumn("__low", F.min(F.coalesce("__low", "__p")).over(w))
        .where(F.col(_ROW) == 1)
        .withColumn(out, F.col("__p") - F.least(F.lit(0), F.col("__low")))
        .drop(_ROW, _SLICE, "__d", "__p", "__low")
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, *, width: Slicing = None, slice_by: Column | None = None) -> DataFrame:
    """1-based row number per key (a running count, so a large key stays split)."""
    return running(df, keys, order, {out: ("count", F.lit(1))}, width, slice_by=slice_by)


DIGEST_BITS = 60


def digest(seed: int, *cols: str | Column) -> Column:
    """A number of 60 bits from the MD5 of `seed|a|b|...`, the same in every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, DIGEST_BITS // 4), 16, 10).cast("bigint")


def by_hash(df: DataFrame, keys: Sequence[str], ident: Sequence[str], seed: int, out: str, where_group: Sequence[str] = ()) -> DataFrame:
    """1-based position in a seeded pseudo-random order per key.

    The order is that of a digest, whose top bits slice each key evenly.
    """
    rows = df.withColumn("__h", digest(seed, *where_group, *ident))
    return numbered(rows, keys, ["__h", *ident], out, slice_by=F.shiftright("__h", DIGEST_BITS - 10)).drop("__h")


def shuffled(df: DataFrame, keys: Sequence[str], n: int, seed: int, ident: str, out: str) -> DataFrame:
    """Numbers 0 to `n - 1` (`ident`) for each row of `df`, and their 1-based position in a seeded pseudo-random order per key.

    The same positions as `by_hash` over the numbers, but a key's few numbers are sorted in its row: what is shuffled are the keys, not their
    numbers. Rows with equal keys share one order, in which each number comes as often as there are rows.
    """
    # keys meet before they are counted, so a task holds its share of them and not those of a whole file
    rows = df.select(*keys).repartition(*keys).groupBy(*keys).agg(F.count("*").alias("__copies"))
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(digest(seed, *keys, k).alias("h"), k.alias("k"))))
    each = rows.select(*keys, "__copies", F.posexplode(ranked).alias("__at", "__r"))
    each = each.select(*keys, "__copies", "__at", F.col("__r.k").alias(ident), F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies")).alias("__copy"))
    return each.select(*keys, ident, (F.col("__at") * F.col("__copies") + F.col("__copy")).alias(out))


def join_per_key(df: DataFrame, facts: DataFrame, keys: Sequence[str], cuts: Cuts) -> DataFrame:
    """Rows with the one row of `facts` for their key. Rows of a heavy key are dealt into pieces, and its fact is repeated for
    each, so that no task gets all of a key; the fact of any other key is there once. Where the table of `cuts` lacks one of the
    keys, none is known to be heavy."""
    pieces = F.lit(1)
    for values, points in (cuts.heavy(keys) if set(keys) <= set(cuts.df.columns) else {}).items():
        same = F.lit(True)
        for k, v in zip(keys, values):
            same = same & F.col(k).eqNullSafe(F.lit(v))
        pieces = F.when(same, F.lit(len(points) + 1)).otherwise(pieces)
    plain = [c for c, kind in df.dtypes if "<" not in kind and kind != "variant"]
    dealt = df.withColumn("__piece", F.pmod(F.xxhash64(*plain), pieces).cast("int"))
    repeated = facts.withColumn("__piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return dealt.join(repeated, [*keys, "__piece"]).drop("__piece")


def asof_join(
    points: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    t_point: str,
    t_fact: str,
    values: Sequence[str],
    width: Slicing = None,
    *,
    tie: str | None = None,
    tolerance: float | None = None,
    forward: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Each point with the latest fact at or before it (`forward`: earliest at or after it).

    Facts and points are put on one time line and the last fact is carried along, so no pairs
    are formed. `strict` excludes facts at the very time of the point.
    """
    # at equal time the row that must be seen first in reading direction sorts first
    fact_rank = 1 if strict != forward else 0
    p = points.select(
        *keys, F.col(t_point).alias("__t"), F.lit(1 - fact_rank).alias("__k"), F.lit(None).cast("bigint").alias("__tie"), F.struct(*points.columns).alias("__p")
    )
    f = facts.select(
        *keys,
        F.col(t_fact).alias("__t"),
        F.lit(fact_rank).alias("__k"),
        (F.col(tie) if tie else F.lit(None)).cast("bigint").alias("__tie"),
        F.struct(F.col(t_fact).alias("__ft"), *values).alias("__f"),
    )
    line = running(
        f.unionByName(p, allowMissingColumns=True),
        keys,
        ["__t", "__k", "__tie"],
        {"__hit": ("last", F.col("__f"))},
        width,
        descending=forward,
    ).where(F.col("__p").isNotNull())
    hit = F.col("__hit")
    if tolerance is not None:
        hit = F.when(F.abs(F.col("__t") - F.col("__hit.__ft")) <= tolerance, hit)
    return line.select("__p.*", hit.alias("__hit")).select("*", *[F.col(f"__hit.{v}").alias(v) for v in values]).drop("__hit")


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    t: str,
    t0: str,
    t1: str,
    bucket: float,
    *,
    how: str = "inner",
    closed: bool = False,
) -> DataFrame:
    """Points with the intervals that hold them, `t0 <= t < t1` (`closed`: `t <= t1`).

    Intervals are cut into time buckets and both sides meet on (keys, bucket), so the join is an
    equi-join that spreads one long key over many tasks. A point has one bucket: no duplicates.
    """
    cut = intervals.withColumn("__b", F.explode(F.sequence(slice_id(t0, bucket), slice_id(t1, bucket))))
    i = cut.select(*[F.col(k).alias(f"__i_{k}") for k in keys], *[c for c in cut.columns if c not in keys])
    p = points.withColumn("__pb", slice_id(t, bucket))
    on = F.col("__pb") == F.col("__b")
    for k in keys:
        on = on & (F.col(k) == F.col(f"__i_{k}"))
    inside = (F.col(t) >= F.col(t0)) & ((F.col(t) <= F.col(t1)) if closed else (F.col(t) < F.col(t1)))
    return p.join(i, on & inside, how).drop("__pb", "__b", *[f"__i_{k}" for k in keys])


_NARROW = 1000  # a quantile summary is off by one in so many of a key's rows at most


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str, width: Slicing = None) -> DataFrame:
    """Exact median per key in two passes.

    A quantile summary of each key, whose error of rank is bounded, gives a range of values that holds the middle, about
    0.6 % of the rows. The second pass leaves out the rows above it, pre-aggregates those below to one count, and ranks only
    the distinct values inside by running counts. A key whose middle is not inside (the bound forbids it) is an error,
    not another result. NaN is the largest value; rows with a null value or key take no part.
    """
    cuts = width if isinstance(width, Cuts) else Cuts(df, value)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"))
    v, off = F.col("__v").cast("double"), 3 / _NARROW
    found = rows.groupBy(*keys).agg(F.percentile_approx(v, [0.5 - off, 0.5 + off], _NARROW).alias("__q"), F.count("*").alias("__size"))
    found = found.select(*keys, "__size", F.col("__q")[0].alias("__from"), F.col("__q")[1].alias("__to"))
    inside = join_per_key(rows, found, keys, cuts).where(v <= F.col("__to")).select(*keys, "__size", F.when(v >= F.col("__from"), F.col("__v")).alias("__v"))
    counts = inside.groupBy(*keys, "__v").agg(F.count("*").alias("__n"), F.max("__size").alias("__size"))
    cum = running(counts, keys, ["__v"], {"__cum": ("sum", F.col("__n"))}, width)
    low, high = F.floor((F.col("__size") + 1) / 2), F.floor(F.col("__size") / 2) + 1
    # rows below the range are one row without a value, which comes first
    mid = cum.where((F.col("__cum") >= low) & (F.col("__cum") - F.col("__n") < high) | F.col("__v").isNull()).groupBy(*keys).agg(
        ((F.min("__v") + F.max("__v")) / 2).alias("__m"), F.max("__cum").alias("__top"), F.coalesce(F.max(F.when(F.col("__v").isNull(), F.col("__cum"))), F.lit(0)).alias("__below"), F.max("__size").alias("__size")
    )
    held = (F.col("__below") < low) & (F.col("__top") >= high)
    return mid.select(*keys, F.when(held, F.col("__m")).otherwise(F.raise_error(F.lit("the middle is outside of its range")).cast("double")).alias(out))
