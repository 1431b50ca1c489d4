"""Slicing and labelling of sensor recordings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortwave.functions.ordered import Slicing, digest, range_join, running
from cohortwave.operators.joins import align_samples, align_samples_multi
from cohortwave.sources.writers import write_dataset


def labelled_intervals(*sources: tuple[str, DataFrame], keys: Sequence[str] = ("session_id",), exclusive: bool = False, width: Slicing = None) -> DataFrame:
    """L1: one interval table on the wall clock from (name, frame) pairs with `t0`, `t1`, `label`.

    Rows without a label (pauses, ratings) drop out. With `exclusive` the job fails where intervals of a session overlap.
    """
    out = None
    for name, df in sources:
        part = df.where("label IS NOT NULL").select(*keys, F.col("t0").cast("double").alias("t0"), F.col("t1").cast("double").alias("t1"), F.col("label").cast("string").alias("label"), F.lit(name).alias("source"))
        out = part if out is None else out.unionByName(part)
    return without_overlaps(out, keys, width) if exclusive else out


def baseline_source(baselines: DataFrame) -> DataFrame:
    """L1: finished baselines (J3) as a source, all labelled `baseline`."""
    return baselines.where("NOT truncated").select("session_id", F.col("host_t0").alias("t0"), F.col("host_t1").alias("t1"), F.lit("baseline").alias("label"))


def playback_source(playbacks: DataFrame, clips: DataFrame, label: str = "valence_group") -> DataFrame:
    """L1: playbacks as a source, labelled by their clip; failed and truncated ones get no label, nor do clips that no table knows."""
    known = clips.select("clip_id", F.col(label).alias("__label"))
    return playbacks.join(known, "clip_id", "left").select(
        "session_id", F.col("host_t0").alias("t0"), F.col("host_t1").alias("t1"), F.when(F.col("outcome") == "played", F.col("__label")).alias("label")
    )


def overlapping_intervals(intervals: DataFrame, keys: Sequence[str] = ("session_id",), width: Slicing = None, order: Sequence[str] = ("t0", "t1")) -> DataFrame:
    """L1: intervals that begin before an earlier one of the session has ended; must be empty."""
    r = running(intervals, keys, list(order), {"__end": ("max", F.col("t1"))}, width, inclusive=False)
    return r.where(F.col("t0") < F.col("__end")).drop("__end")


def fixed_windows(intervals: DataFrame, length: float, hop: float) -> DataFrame:
    """L2: windows of `length` every `hop`, fully inside their interval; the remainder is dropped."""
    last = F.floor((F.col("t1") - F.col("t0") - F.lit(length)) / F.lit(hop) + F.lit(1e-9))
    return intervals.where(last >= 0).withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumns(
        {"w0": F.col("t0") + F.col("window_no") * F.lit(hop), "w1": F.col("t0") + F.col("window_no") * F.lit(hop) + F.lit(length)}
    )


def slice_samples(samples: DataFrame, intervals: DataFrame, length: float, hop: float, keys: Sequence[str] = ("session_id",), bucket: float = 60.0) -> DataFrame:
    """L3: aligned samples by labelled window, with their position in it.

    One bucketed join finds a sample's interval; its windows follow by arithmetic, so the far
    larger window table is never joined. Overlapping windows repeat a sample once per window.
    """
    i = intervals.select(*keys, "t0", "t1", "label")
    s = range_join(samples, i, keys, "wall", "t0", "t1", bucket)
    since = F.col("wall") - F.col("t0")
    lo = F.greatest(F.lit(0).cast("bigint"), F.floor((since - F.lit(length)) / F.lit(hop)))
    hi = F.floor(since / F.lit(hop)) + 1
    last = F.floor((F.col("t1") - F.col("t0") - F.lit(length)) / F.lit(hop) + F.lit(1e-9))
    w0 = F.col("t0") + F.col("window_no") * F.lit(hop)
    return (
        s.where(last >= 0)
        .withColumn("__last", last)
        .withColumn("window_no", F.explode(F.sequence(lo, hi)))
        .where((F.col("window_no") <= F.col("__last")) & (F.col("wall") >= w0) & (F.col("wall") < w0 + F.lit(length)))
        .withColumn("offset_sec", F.col("wall") - w0)
        .drop("__last")
    )


def completeness(sliced: DataFrame, windows: DataFrame, rate_hz: float, length: float, keys: Sequence[str] = ("session_id", "device_id", "t0", "window_no"), threshold: float = 0.95) -> DataFrame:
    """L4: samples found against the nominal number; windows below the threshold are rejected.

    `windows` lists what was planned (fixed windows, for each device expected), so a window that no sample fell
    into is there with 0.
    """
    want = rate_hz * length
    found = sliced.groupBy(*keys).agg(F.count("*").alias("found"))
    return windows.select(*keys).join(found, list(keys), "left").withColumn("found", F.coalesce("found", F.lit(0))).withColumns(
        {"completeness": F.col("found") / F.lit(want), "accepted": F.col("found") / F.lit(want) >= threshold}
    )


def baseline_correct(features: DataFrame, baseline: DataFrame, on: Sequence[str], feature: str = "mean", mode: str = "minus") -> DataFrame:
    """Feature minus, or over, that of the baseline; `baseline` has one row per `on`."""
    b = baseline.select(*on, F.col(feature).alias("__base"))
    x = F.col(feature)
    fixed = x - F.col("__base") if mode == "minus" else F.try_divide(x, F.col("__base"))
    return features.join(b, list(on), "left").withColumn(f"{feature}_corrected", fixed).drop("__base")


def participant_split(df: DataFrame, who: str = "participant_id", shares: dict[str, int] | None = None, seed: int = 0) -> DataFrame:
    """Split by a hash of the participant, so nobody is on two sides. Shares are percentages."""
    shares = shares or {"train": 80, "valid": 10, "test": 10}
    slot, upper, out = F.pmod(digest(seed, who), F.lit(100)), 0, None
    for name, share in shares.items():
        upper += share
        out = F.when(slot < upper, name) if out is None else out.when(slot < upper, name)
    return df.withColumn("split", out)


def export_dataset(windows: DataFrame, path: str, who: str = "participant_id", seed: int = 0, shares: dict[str, int] | None = None) -> None:
    """Parquet by split and participant."""
    write_dataset(participant_split(windows, who, shares, seed), path, ["split", who])


def without_overlaps(intervals: DataFrame, keys: Sequence[str] = ("session_id",), width: Slicing = None) -> DataFrame:
    """L1: the same intervals; the job fails on one that begins before an earlier one of the session has ended."""
    r = running(intervals, keys, ["t0", "t1"], {"__end": ("max", F.col("t1"))}, width, inclusive=False)
    message = F.concat(F.lit("labels overlap at "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.col("t0").cast("string")))
    # a filter, as a column might not be asked for
    return r.where(F.when(F.col("t0") < F.col("__end"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop("__end")


def label_recordings(
    samples: DataFrame, sync: DataFrame, intervals: DataFrame, length: float, hop: float, bucket: float = 60.0, *, recordings: DataFrame | None = None, drift: bool = False, width: Slicing = None
) -> DataFrame:
    """Raw recordings to labelled windows: J14 (with `recordings`, the sync at or before each start) or, with `drift`, J15, then L3.

    Overlapping labels are an error.
    """
    wall = align_samples_multi(samples, sync, width=width) if drift else align_samples(samples, sync, recordings)
    return slice_samples(wall, without_overlaps(intervals), length, hop, bucket=bucket)
