"""Set operations and de-duplication."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.schema import MONO, PAY, field


def union_sessions(*frames: DataFrame) -> DataFrame:
    """Main and single-task sessions as one study table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_conditions(trials: DataFrame, keys: Sequence[str], label: str = "valence_group") -> DataFrame:
    """Sorted distinct labels per block; labels are first made distinct, so lists stay label-sized."""
    return trials.select(*keys, label).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list(label)).alias("condition_labels"))


def latest_answers(answers: DataFrame, order: Column, item: str = "item_id", value: str = "value", session: str = "session_id", rules: DataFrame | None = None) -> DataFrame:
    """Last answer per session and item. `rules` (item_id, enabled, parent, equals) come from the
    questionnaire: disabled items go, and a conditional one goes when its parent's last answer differs.
    Rules that name a session hold for that session only, others for all."""
    last = answers.groupBy(session, item).agg(F.max_by(value, order).alias(value))
    if rules is None:
        return last
    own = [session] if session in rules.columns else []
    r = rules.select(*own, F.col("item_id").alias(item), "enabled", "parent", "equals")
    up = last.select(session, F.col(item).alias("parent"), F.col(value).alias("__parent_value"))
    return (
        last.join(r, [*own, item], "left")
        .join(up, [session, "parent"], "left")
        .where(F.coalesce("enabled", F.lit(True)) & (F.col("parent").isNull() | F.coalesce(F.col("__parent_value") == F.col("equals"), F.lit(False))))
        .select(session, item, value)
    )


_SHOW = "show_if:struct<field:string,equals:string>"
_ITEMS = f"array<struct<id:string,type:string,enabled:boolean,options:array<string>,scale_min:double,scale_max:double,items:array<struct<id:string>>,fields:array<struct<id:string,enabled:boolean,options:array<string>,{_SHOW}>>>>"


def questionnaire_rules(manifests: DataFrame) -> DataFrame:
    """One rule per answerable item: enabled flag, condition, options and scale, from the configuration."""
    it = manifests.select("session_id", F.explode(F.try_variant_get("config_snapshot", F.lit("$.questionnaire.items"), _ITEMS)).alias("i"))
    on = F.coalesce("i.enabled", F.lit(True))
    none = F.lit(None).cast("string")
    plain = it.where("i.fields IS NULL AND i.items IS NULL").select(
        "session_id", F.col("i.id").alias("item_id"), on.alias("enabled"), none.alias("parent"), none.alias("equals"), F.col("i.options").alias("options"), "i.scale_min", "i.scale_max"
    )
    multi = it.where("i.items IS NOT NULL").select("session_id", on.alias("enabled"), "i.scale_min", "i.scale_max", F.explode("i.items").alias("x")).select(
        "session_id", F.col("x.id").alias("item_id"), "enabled", none.alias("parent"), none.alias("equals"), F.lit(None).cast("array<string>").alias("options"), "scale_min", "scale_max"
    )
    fields = it.where("i.fields IS NOT NULL").select("session_id", on.alias("on"), F.explode("i.fields").alias("x")).select(
        "session_id", F.col("x.id").alias("item_id"), (F.col("on") & F.coalesce("x.enabled", F.lit(True))).alias("enabled"), F.col("x.show_if.field").alias("parent"),
        F.col("x.show_if.equals").alias("equals"), F.col("x.options").alias("options"), F.lit(None).cast("double").alias("scale_min"), F.lit(None).cast("double").alias("scale_max"),
    )
    return plain.unionByName(multi).unionByName(fields)


def answers(ev: DataFrame) -> DataFrame:
    """Questionnaire rows; values stay text, numbers are cast where they are used."""
    return ev.where("event_type = 'questionnaire_response'").select(
        "session_id", MONO, "event_seq", field("item_id", "string").alias("item_id"), field("value", "string").alias("value"), field("rt", "double").alias("rt_sec")
    )


def dedupe_events(ev: DataFrame, keys: Sequence[str] = ("session_id", MONO, "event_type", "block_index", "trial_index"), payload: str = PAY) -> DataFrame:
    """U4: exact duplicates after a second ingest of the same file."""
    return ev.withColumn("__h", F.sha2(F.to_json(F.col(payload)) if dict(ev.dtypes)[payload] == "variant" else F.col(payload), 256)).dropDuplicates([*keys, "__h"]).drop("__h")


def repeat_exposure(shown: DataFrame, who: str = "participant_id", clip: str = "clip_id", session: str | None = "session_id") -> DataFrame:
    """Clips a participant saw more than once, and in how many sessions."""
    extra = [F.count_distinct(session).alias("sessions")] if session else []
    return shown.groupBy(who, clip).agg(F.count("*").alias("times"), *extra).where("times > 1")
