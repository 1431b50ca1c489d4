"""Structured Streaming versions of the live operators, over event files that landed whole."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cohortwave.functions.ordered import range_join
from cohortwave.session import work_dir


def monitor_sessions(stream: DataFrame) -> DataFrame:
    """Per session the last event time, its task, the number of events and the status so far (update mode)."""
    has = lambda *types: F.bool_or(F.col("event_type").isin(*types))
    return stream.groupBy("session_id").agg(
        F.max("ts").alias("last_ts"),
        F.max_by("task", "ts").alias("task"),
        F.count("*").alias("n_events"),
        F.when(has("session_crashed"), "crashed").when(has("session_aborted", "task_abort"), "aborted").when(has("session_end"), "completed").otherwise("running").alias("status"),
    )


_ENDS = {"session_end": 1, "session_aborted": 2, "task_abort": 2, "session_crashed": 4}


def monitor_live_sessions(stream: DataFrame, silence: float, lateness: str) -> DataFrame:
    """S1 with state that goes: as `monitor_sessions`, for sessions that are alive (update mode, a row for each change).

    A session that has ended is dropped as soon as the watermark, which waits for `lateness`, has passed its last event; one
    without an end after `silence` seconds more. Events after that begin a new piece of the session, told apart by
    `begun_us`, so numbers of events add up over pieces. Rows are reduced to a handful of numbers batch by batch, whatever the
    session holds; rows without a time take no part.
    """

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        begun, last, task, n, ends, until = state.get if state.exists else (None, None, None, 0, 0, 0)
        first = begun
        for pdf in pdfs:
            at = pdf["us"].to_numpy("int64")
            newest, oldest = int(at.argmax()), int(at.min())
            first = oldest if first is None or begun is None and oldest < first else first
            if last is None or at[newest] > last:
                last, task = int(at[newest]), pdf["task"].iloc[newest]
            n += len(at)
            ends |= int(np.bitwise_or.reduce(pdf["ends"].to_numpy("int64")))
        until = max(last // 1000 + (0 if ends else int(silence * 1000)), state.getCurrentWatermarkMs()) + 1
        state.update((first, last, task, n, ends, until))
        state.setTimeoutTimestamp(until)
        status = "crashed" if ends & 4 else "aborted" if ends & 2 else "completed" if ends else "running"
        yield pd.DataFrame({"session_id": [key[0]], "begun_us": [first], "last_us": [last], "task": [task], "n_events": [n], "status": [status]})

    ends = F.coalesce(*[F.when(F.col("event_type") == kind, F.lit(bit)) for kind, bit in _ENDS.items()], F.lit(0))
    rows = stream.where("ts IS NOT NULL").withWatermark("ts", lateness).select("session_id", "task", "ts", F.unix_micros("ts").alias("us"), ends.alias("ends"))
    live = rows.groupBy("session_id").applyInPandasWithState(
        run, "session_id string, begun_us bigint, last_us bigint, task string, n_events bigint, status string", "begun bigint, last bigint, task string, n bigint, ends int, until bigint", "update", GroupStateTimeout.EventTimeTimeout
    )
    return live.withColumn("last_ts", F.timestamp_micros("last_us")).drop("last_us")


def pair_obstacles_stream(spawns: DataFrame, outcomes: DataFrame, keys: list[str], within: str, lateness: str = "1 minute") -> DataFrame:
    """Spawns with their resolution inside `within`; an unmatched spawn is emitted once the
    watermark shows that none can follow. Both sides carry `ts`; `outcomes` has other columns unique."""
    s = spawns.withWatermark("ts", lateness)
    o = outcomes.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.col("ts").alias("resolved_ts"), *[c for c in outcomes.columns if c not in (*keys, "ts")]).withWatermark("resolved_ts", lateness)
    on = (F.col("resolved_ts") >= F.col("ts")) & (F.col("resolved_ts") <= F.col("ts") + F.expr(f"interval {within}"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__o_{k}"))
    return s.join(o, on, "left").drop(*[f"__o_{k}" for k in keys])


def rolling_rate_stream(outcomes: DataFrame, keys: list[str], hit: Column, size: str = "15 seconds", slide: str = "1 second", lateness: str = "1 minute") -> DataFrame:
    """S3: share of hits in hopping windows."""
    return (
        outcomes.withWatermark("ts", lateness)
        .groupBy(*keys, F.window("ts", size, slide))
        .agg(F.count("*").alias("n"), F.avg(hit.cast("double")).alias("rate"))
        .select(*keys, F.col("window.start").alias("start"), "n", "rate")
    )


def downsample_stream(ticks: DataFrame, keys: list[str], value: str, size: str = "1 second", lateness: str = "1 minute", order: Column | None = None) -> DataFrame:
    """Mean and last value per tumbling window."""
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy(*keys, F.window("ts", size))
        .agg(F.count("*").alias("n"), F.avg(value).alias("mean_value"), F.max_by(value, order if order is not None else F.col("ts")).alias("last_value"))
        .select(*keys, F.col("window.start").alias("start"), "n", "mean_value", "last_value")
    )


def idle_gaps_stream(stream: DataFrame, keys: list[str], gap: str, lateness: str = "1 minute") -> DataFrame:
    """Stretches of activity split by a silence of `gap`."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(*keys, F.session_window("ts", gap))
        .agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))
        .select(*keys, F.col("session_window.start").alias("start"), "last_ts", "n")
    )


Columns = dict[str, np.ndarray]
Step = Callable[[Columns, tuple | None], tuple[np.ndarray | slice, Columns, tuple]]


def _by_key(stream: DataFrame, keys: list[str], cols: list[str], result: dict[str, str], kept: dict[str, str], step: Step, idle: float | None, lateness: str | None, buckets: int | None) -> DataFrame:
    """`step` takes one key's rows of a micro-batch, ordered by time, and what it kept of the key; it gives which of these rows
    come out, what is added to them and what to keep.

    With `lateness` the stream needs an event time `ts`, and a key is forgotten by a timer once the watermark is `idle`
    seconds past its last row. Rows behind the watermark are dropped by Spark, which counts them in
    `numRowsDroppedByWatermark`. Without `lateness` a key is kept for ever. `maxFilesPerTrigger` bounds what a key brings at once.

    A call to Python costs milliseconds however few the rows. With many keys of a few rows each, `buckets` lets keys whose
    hash falls in one bucket share a call, a state row and a timer; rows and what is forgotten stay the same. The
    number must stay as it was when a query goes on from its checkpoint.
    """
    types = dict(stream.dtypes)
    head = ", ".join(f"`{k}` {types[k]}" for k in keys)
    timed = lateness is not None
    group = list(keys) if buckets is None else ["__bucket"]

    def run(_: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {who: tuple(v) for who, *v in zip(*state.get)} if state.exists else {}
        now, seen, out = state.getCurrentWatermarkMs() if timed else 0, {}, None
        if not state.hasTimedOut:
            pdf = pd.concat(list(pdfs), ignore_index=True)
            code, whose = pd.factorize(pdf["__who"].to_numpy())
            order = np.lexsort((pdf["event_seq"].to_numpy(), pdf["t"].to_numpy(), code))
            pdf, code = pdf.take(order), code[order]
            begins = np.flatnonzero(np.diff(code, prepend=-1))
            newest = np.fmax.reduceat(pdf["__ms"].to_numpy(), begins) if timed else begins
            given, place, taken, added = {c: pdf[c].to_numpy() for c in cols}, np.arange(len(pdf)), [], []
            for a, b, ms in zip(begins.tolist(), [*begins[1:].tolist(), len(pdf)], newest.tolist()):
                who = whose[code[a]]
                *old, until = held.get(who, (0,))
                rows, more, new = step({c: v[a:b] for c, v in given.items()}, tuple(old) or None)
                taken.append(place[a:b][rows])
                added.append(more)
                seen[who] = (*new, max(until, int(ms + idle * 1000), now + 1) if timed else until)
            out = pdf[[*keys, "t", "event_seq"]].iloc[np.concatenate(taken)].assign(**{c: np.concatenate([m[c] for m in added]) for c in result})
        held = {who: v for who, v in held.items() if not timed or v[-1] >= now} | seen
        if held:
            state.update(([*held], *map(list, zip(*held.values()))))
            if timed:
                state.setTimeoutTimestamp(max(min(v[-1] for v in held.values()), now + 1))
        else:
            state.remove()
        if out is not None:
            yield out

    rows = stream.withWatermark("ts", lateness).withColumn("__ms", F.unix_millis("ts")) if timed else stream
    rows = rows.select(*keys, *cols, F.to_json(F.struct(*keys)).alias("__who"), *(["ts", "__ms"] if timed else []), *([] if buckets is None else [F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")]))
    added = "".join(f", {c} {kind}" for c, kind in result.items())
    state = ", ".join(f"{c} array<{kind}>" for c, kind in {"who": "string", **kept, "until": "bigint"}.items())
    return rows.groupBy(*group).applyInPandasWithState(
        run, f"{head}, t double, event_seq bigint{added}", state, "append", GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout
    )


def _stretches(t: np.ndarray, last: float, idle: float | None) -> Iterator[tuple[slice, bool]]:
    """Rows in time order as slices without a silence of more than `idle`; True for those that begin anew."""
    if idle is None or not len(t):
        yield slice(0, len(t)), False
        return
    cuts = np.flatnonzero(np.diff(t, prepend=last) > idle).tolist()
    for a, b in zip([0, *cuts], [*cuts, len(t)]):
        if a < b:
            yield slice(a, b), a in cuts


def clamped_score_stream(trials: DataFrame, keys: list[str], *, idle: float | None = None, lateness: str | None = None, buckets: int | None = None) -> DataFrame:
    """The clamped score as trials arrive. `trials` has `t`, `event_seq` and `delta` (-1, 0, 1).

    Rows are ordered by event time within a batch. A row older than one already scored cannot be
    placed any more: it is marked by `is_late`, counted in `late` and leaves the score alone. With `idle`
    a run ends after so many seconds of silence, and the score begins at 0 again; `lateness` lets state go then.
    """

    def step(rows: Columns, kept: tuple | None) -> tuple[np.ndarray | slice, Columns, tuple]:
        score, last, late = kept or (0, -np.inf, 0)
        t = rows["t"]
        m = int(np.searchsorted(t, last, side="left"))
        scores, lates = np.full(len(t), score, "int64"), np.full(len(t), late + m, "int64")
        lates[:m] = late + 1 + np.arange(m)
        delta = rows["delta"].astype("int64")[m:]
        for part, anew in _stretches(t[m:], last, idle):
            at = (0 if anew else score) + np.cumsum(delta[part])
            # the sum so far, lifted by how far it has ever been below 0
            at -= np.minimum(np.minimum.accumulate(at), 0) if len(at) else 0
            scores[m:][part] = at
            score = int(at[-1]) if len(at) else score
        if m < len(t):
            last = float(t[-1])
        return slice(None), {"score": scores, "late": lates, "is_late": np.arange(len(t)) < m}, (score, last, late + m)

    return _by_key(
        trials, keys, ["t", "event_seq", "delta"], {"score": "bigint", "late": "bigint", "is_late": "boolean"}, {"score": "bigint", "last": "double", "late": "bigint"}, step, idle, lateness, buckets
    )


def time_since_last_stream(stream: DataFrame, keys: list[str], *, idle: float | None = None, lateness: str | None = None, buckets: int | None = None) -> DataFrame:
    """Seconds since the last flagged row. `stream` has `t`, `event_seq` and boolean `flag`.

    A row older than one already seen gets no answer, is marked by `is_late` and counted in `late`; its flag holds for rows that
    follow. `idle` and `lateness` as in `clamped_score_stream`: a flag is forgotten after a silence.
    """

    def step(rows: Columns, kept: tuple | None) -> tuple[np.ndarray | slice, Columns, tuple]:
        start, last, late = kept or (-np.inf, -np.inf, 0)
        t = rows["t"]
        m = int(np.searchsorted(t, last, side="left"))
        flagged = np.where(rows["flag"].astype(bool), t, -np.inf)
        start = max(start, flagged[:m].max(initial=-np.inf))
        lates = np.full(len(t), late + m, "int64")
        lates[:m] = late + 1 + np.arange(m)
        at = np.full(len(t), -np.inf)
        for part, anew in _stretches(t[m:], last, idle):
            at[m:][part] = np.maximum.accumulate(np.maximum(flagged[m:][part], -np.inf if anew else start))
            start = at[m:][part][-1] if len(at[m:][part]) else start
        if m < len(t):
            last = float(t[-1])
        since = np.where(np.isneginf(at), np.nan, t - at)
        return slice(None), {"since": since, "late": lates, "is_late": np.arange(len(t)) < m}, (float(start), last, late + m)

    return _by_key(
        stream, keys, ["t", "event_seq", "flag"], {"since": "double", "late": "bigint", "is_late": "boolean"}, {"at": "double", "last": "double", "late": "bigint"}, step, idle, lateness, buckets
    )


def debounce_stream(stream: DataFrame, keys: list[str], min_gap: float, *, lateness: str | None = None, buckets: int | None = None) -> DataFrame:
    """The debounce rule with the last kept time as state. With `lateness` the state goes once no row can come that it
    would hold back, so nothing else changes."""

    def step(rows: Columns, kept: tuple | None) -> tuple[np.ndarray | slice, Columns, tuple]:
        (last,), keep, t = kept or (-np.inf,), [], rows["t"]
        i = int(np.searchsorted(t, last + min_gap, side="right"))
        while i < len(t):
            keep.append(i)
            last = float(t[i])
            i = int(np.searchsorted(t, last + min_gap, side="right"))
        return np.array(keep, "int64"), {}, (float(last),)

    return _by_key(stream, keys, ["t", "event_seq"], {}, {"last": "double"}, step, min_gap, lateness, buckets)


def dedupe_stream(stream: DataFrame, keys: list[str], lateness: str = "10 minutes") -> DataFrame:
    """Events that landed twice are dropped while the watermark remembers them."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def alerts(stream: DataFrame, result: Column, object_fit: Column) -> DataFrame:
    """Rows somebody must look at: failed sync, crash, abort, badly fitted playback."""
    kind = (
        F.when((F.col("event_type") == "device_sync") & (result != "ok"), "sync_error")
        .when(F.col("event_type") == "session_crashed", "crash")
        .when(F.col("event_type").isin("session_aborted", "task_abort"), "abort")
        .when((F.col("event_type") == "clip_video_metadata") & (object_fit != "contain"), "bad_fit")
    )
    return stream.withColumn("alert", kind).where("alert IS NOT NULL")


def label_batches(intervals: DataFrame, sink: Callable[[DataFrame, int], None], keys: list[str] = ["session_id"], bucket: float = 60.0) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that labels each batch of aligned samples against closed intervals."""

    def run(batch: DataFrame, batch_id: int) -> None:
        i = intervals.select(*keys, "t0", "t1", "label")
        sink(range_join(batch, i, keys, "wall", "t0", "t1", bucket).drop("t0", "t1"), batch_id)

    return run


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` sink: each batch replaces its own folder, so a retried batch counts once."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_available(spark: SparkSession, df: DataFrame, name: str, *, each: Callable[[str], Callable[[DataFrame, int], None]] | None = None, mode: str = "append", root: str | None = None) -> str:
    """Process what has landed, then stop. Returns the folder of the Parquet result.

    Result and checkpoint live under `spark.checkpoint.dir`, or in `root`, where a query goes on from where it
    stopped; `each` builds a foreachBatch function from the result folder.
    """
    root = root or work_dir(spark, name)
    w = df.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).outputMode(mode)
    out = f"{root}/result"
    w = w.foreachBatch(each(out)) if each else w.format("parquet").option("path", out)
    q = w.start()
    q.awaitTermination()
    return out
