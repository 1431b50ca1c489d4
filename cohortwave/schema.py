"""Schemas of the session package and the column groups the operators key on."""

from pyspark.sql import Column, functions as F, types as T

HOST = "timestamp_host_utc"
MONO = "timestamp_monotonic"
PAY = "event_payload_json"

RUN = ["session_id", "task", "run_ordinal"]
BLOCK = [*RUN, "block_index"]
TRIAL = [*BLOCK, "trial_index"]
ORDER = [MONO, "event_seq"]

ENVELOPE = T.StructType(
    [
        T.StructField(HOST, T.DoubleType()),
        T.StructField(MONO, T.DoubleType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("participant_id", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("block_index", T.IntegerType()),
        T.StructField("trial_index", T.IntegerType()),
        T.StructField("condition_label", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField(PAY, T.VariantType()),
    ]
)

SYNC_RECORD = T.StructType(
    [
        T.StructField("device_role", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("sync_time_host_utc", T.DoubleType()),
        T.StructField("result", T.StringType()),
        T.StructField("detail", T.StringType()),
        # device-side counter at sync; absent in today's packages, needed for drift correction
        T.StructField("device_rel_sec", T.DoubleType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("participant_id", T.StringType()),
        T.StructField("created_at_utc", T.DoubleType()),
        T.StructField("demo_scale", T.DoubleType()),
        T.StructField("rng_seed", T.DoubleType()),
        T.StructField("device_sync_records", T.MapType(T.StringType(), T.ArrayType(SYNC_RECORD))),
        T.StructField("config_snapshot", T.VariantType()),
    ]
)

CLIP = "clip_id STRING, valence_group STRING, fine_grained_label STRING, title STRING, language STRING, file_path STRING, duration_sec DOUBLE"
FIXED_CLIP = "clip_id STRING, title STRING, valence_score DOUBLE, arousal_score DOUBLE"

SAMPLES = (
    "recording_id STRING, session_id STRING, device_role STRING, device_id STRING, "
    "sample_idx BIGINT, rel_sec DOUBLE, ch ARRAY<FLOAT>"
)

# Fixed values of the data model.
VALENCE_GROUPS = ("positive", "negative", "neutral")
PRACTICE_TASK = "familiarization"
MIN_HEIGHT = 720
DURATION_TOLERANCE_SEC = 3.0
NEAR_MISS_SEC = 0.3
ROLLING_SEC = 15
STAI_POSITIVE = ("stai_calm", "stai_relaxed", "stai_content")
STAI_NEGATIVE = ("stai_tense", "stai_upset", "stai_worried")
PANAS_POSITIVE = ("panas_active", "panas_alert", "panas_attentive", "panas_determined", "panas_inspired")
PANAS_NEGATIVE = ("panas_afraid", "panas_ashamed", "panas_hostile", "panas_nervous", "panas_upset")


def field(name: str, type_: str, col: str = PAY) -> Column:
    """One payload field as `type_`; null when the key is missing or does not convert."""
    return F.try_variant_get(F.col(col), f"$.{name}", type_)
