"""Ranking, sampling and presentation layout. Pseudo-random orders are hash orders of one seed."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwave.functions.ordered import Slicing, by_hash, digest, numbered, shuffled
from cohortwave.functions.permuted import place
from cohortwave.operators.joins import fixed_selection
from cohortwave.operators.windows import chunk_of


def _first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    # a rank filter right above row_number lets Spark cut each partition to k rows before the shuffle
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def top_clips(clips: DataFrame, n: int, group: str = "valence_group", score: str = "arousal_score", position: str = "manifest_pos", ascending_groups: Sequence[str] = ("neutral",)) -> DataFrame:
    """`n` clips per group, highest score first, lowest first in `ascending_groups`; ties keep list order."""
    signed = F.when(F.col(group).isin(*ascending_groups), F.col(score)).otherwise(-F.col(score))
    return _first_k(clips, [group], [signed.asc_nulls_last(), F.col(position)], n)


def shortest_k(clips: DataFrame, k: int, group: str = "valence_group", duration: str = "duration_sec", position: str = "manifest_pos") -> DataFrame:
    """The `k` shortest clips per group."""
    return _first_k(clips, [group], [F.col(duration).asc_nulls_last(), F.col(position)], k)


def seeded_sample(wants: DataFrame, pool: DataFrame, n: int | Mapping[str, int], seed: int, who: str = "participant_id", group: str = "valence_group", ident: str = "clip_id") -> DataFrame:
    """`n` items of the group's pool for each row (`who`, `group`) of `wants`; the same seed gives the same sample.

    Pools are numbered once, in the order of `ident`. A draw is sent to its place by a permutation that (`who`, `group`) picks,
    and meets the item by an equi-join on (`group`, place): what is made are the draws, never all items of all participants.
    A pool with fewer items is drawn whole.
    """
    if isinstance(n, Mapping):
        most = F.coalesce(*[F.when(F.col(group) == g, F.lit(v)) for g, v in n.items()], F.lit(0))
    else:
        most = F.lit(n)
    sizes = pool.groupBy(group).agg(F.count("*").alias("__size"))
    drawn = wants.join(sizes, group).withColumn("__n", F.least(most, "__size")).where("__n > 0")
    drawn = drawn.withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
    drawn = drawn.withColumn("__at", place(F.col("draw") - 1, F.col("__size"), seed, who, group) + 1).drop("__n", "__size")
    return drawn.join(numbered(pool, [group], [ident], "__at"), [group, "__at"]).drop("__at")


def interleaved_blocks(selected: DataFrame, num_blocks: int, seed: int, who: str = "participant_id", group: str = "valence_group", group_index: str = "group_index", ident: str = "clip_id") -> DataFrame:
    """T4: shuffled clip `i` of group `g` goes to block `(i + g) mod num_blocks`, then each block is shuffled."""
    placed = by_hash(selected, [who, group], [ident], seed, "__i", [who]).withColumn(
        "block", F.pmod(F.col("__i") - 1 + F.col(group_index), F.lit(num_blocks)).cast("int")
    )
    return by_hash(placed.drop("__i"), [who, "block"], [ident], seed + 1, "position", [who])


def interleave_in_order(selected: DataFrame, order: Sequence[str], num_blocks: int, keys: Sequence[str], group_index: str, width: Slicing = None) -> DataFrame:
    """T4's placement rule on an order that is given instead of drawn."""
    n = numbered(selected, keys, order, "__i", width=width)
    return n.withColumn("block", F.pmod(F.col("__i") - 1 + F.col(group_index), F.lit(num_blocks)).cast("int")).drop("__i")


def grouped_blocks(selected: DataFrame, seed: int, who: str = "participant_id", group: str = "valence_group", ident: str = "clip_id") -> DataFrame:
    """T5: one block per group, in shuffled group order; clips shuffled inside."""
    order = by_hash(selected.select(who, group).distinct(), [who], [group], seed, "block", [who]).withColumn("block", (F.col("block") - 1).cast("int"))
    return by_hash(selected.join(order, [who, group]), [who, "block"], [ident], seed + 1, "position", [who])


def chunk_evenly(items: DataFrame, k: int, keys: Sequence[str], order: Sequence[str], width: Slicing = None) -> DataFrame:
    """`k` chunks in order, the first `n mod k` of them one larger (the rule of ntile, on split keys)."""
    n = numbered(items, keys, order, "__pos", width=width)
    size = items.groupBy(*keys).agg(F.count("*").alias("__n"))
    joined = n.join(size, list(keys)) if keys else n.withColumn("__n", size.scalar())
    return joined.withColumn("chunk", chunk_of(F.col("__pos") - 1, F.col("__n"), k)).drop("__pos", "__n")


def slot_order(participants: DataFrame, games: Sequence[str], per_game: int, seed: int, who: str = "participant_id") -> DataFrame:
    """Which game comes in which slot, `per_game` of each, shuffled per participant."""
    slots = F.flatten(F.array(*[F.array_repeat(F.lit(g), per_game) for g in games]))
    drawn = shuffled(participants, [who], len(games) * per_game, seed, "__k", "slot")
    return drawn.select(who, F.get(slots, F.col("__k")).alias("game"), (F.col("slot") - 1).cast("int").alias("slot"))


def stroop_stimuli(participants: DataFrame, colors: Sequence[str], n_trials: int, congruent_fraction: float, seed: int, keys: Sequence[str] = ("participant_id",)) -> DataFrame:
    """Word and ink per stimulus; `round(n * fraction)` (half to even) of them are congruent."""
    n_con = F.bround(F.lit(n_trials) * F.lit(congruent_fraction)).cast("int")
    out = shuffled(participants, keys, n_trials, seed, "__k", "trial_index").withColumns({"congruent": F.col("__k") < n_con, "trial_index": (F.col("trial_index") - 1).cast("int")})
    palette = F.array(*[F.lit(c) for c in colors])
    ink = F.pmod(digest(seed + 1, *keys, "__k"), F.lit(len(colors)))
    step = F.when(F.col("congruent"), F.lit(0)).otherwise(F.pmod(digest(seed + 2, *keys, "__k"), F.lit(len(colors) - 1)) + 1)
    return (
        out.withColumns({"__ink": ink, "__word": F.pmod(ink + step, F.lit(len(colors)))})
        .withColumns({"ink_color": F.get(palette, F.col("__ink").cast("int")), "word": F.get(palette, F.col("__word").cast("int"))})
        .drop("__k", "__ink", "__word")
    )


def sart_table(participants: DataFrame, font_sizes: Sequence[float], reps: int, seed: int, *, fixed_order: bool = False, omit_count: int | None = 3, omit_numbers: Sequence[int] = (3,), who: str = "participant_id") -> DataFrame:
    """Number and size per trial: each repetition is the full factorial, re-shuffled, or size-major when fixed."""
    if omit_count is not None and not 1 <= omit_count <= 8:
        raise ValueError("omit_count must be between 1 and 8")
    cell = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("font_size"), F.lit(k).alias("number")) for s in font_sizes for k in range(1, 10)]))
    rows = (
        participants.select(who, F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
        .select(who, "rep", cell.alias("c"))
        .select(who, "rep", "c.*")
    )
    sizes = F.array(*[F.lit(float(s)) for s in font_sizes])
    major = rows.withColumn("__k", (F.array_position(sizes, F.col("font_size")) - 1) * 9 + F.col("number"))
    if fixed_order:
        placed = major.withColumn("__pos", F.col("__k"))
    else:
        placed = by_hash(major, [who, "rep"], ["__k"], seed, "__pos", [who, "rep"])
    if omit_count is None:
        omits = F.array(*[F.lit(k) for k in sorted(set(omit_numbers))])
    else:
        # nine numbers sorted by their hash: a fixed-size array, computed in the row
        ranked = F.array_sort(F.array(*[F.struct(digest(seed + 1, who, F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(1, 10)]))
        omits = F.array_sort(F.slice(F.transform(ranked, lambda x: x["k"]), 1, omit_count))
    return placed.select(
        who, "rep", (F.col("rep") * 9 * len(font_sizes) + F.col("__pos") - 1).cast("int").alias("trial_index"), "number", "font_size",
        omits.alias("omit_numbers"),
    ).withColumn("is_omit", F.array_contains("omit_numbers", F.col("number")))


def clip_schedule(participants: DataFrame, clips: DataFrame, per_group: Mapping[str, int], seed: int, *, num_blocks: int = 3, structure: str = "interleaved", fixed: DataFrame | None = None, groups: Sequence[str] | None = None, who: str = "participant_id") -> DataFrame:
    """Clip order for a whole cohort. Participants fan out by group and draw from each group's clips.

    `groups` gives the order of groups, which rotates their clips over blocks (else that of `per_group`). Fixed lists
    are cut before the join, so it yields only clips that are shown.
    """
    groups = F.posexplode(F.array(*[F.lit(g) for g in (groups or per_group)]))
    wants = participants.select(who, groups.alias("group_index", "valence_group"))
    pool = clips
    if fixed is not None:
        listed = fixed_selection(clips, fixed, dict(per_group))
        pool = listed.unionByName(clips.join(fixed.select("valence_group").distinct(), "valence_group", "left_anti"))
    sel = seeded_sample(wants, pool, dict(per_group), seed, who).drop("draw")
    if structure == "interleaved":
        return interleaved_blocks(sel, num_blocks, seed + 10, who)
    return grouped_blocks(sel, seed + 10, who)


def cohort_schedule(participants: DataFrame, clips: DataFrame, config: Mapping, seed: int, fixed: DataFrame | None = None, who: str = "participant_id") -> dict[str, DataFrame]:
    """Every pre-generated order of a cohort, from the protocol configuration."""
    emo, att, sart = config["emotion_task"], config["attention_focus_task"], config["sart_task"]
    groups, per = list(emo["valence_groups"]), emo["clips_per_group"]  # one number serves all groups
    per_group = {g: per if isinstance(per, int) else per.get(g, 0) for g in groups}
    return {
        "clips": clip_schedule(
            participants, clips, per_group, seed, num_blocks=emo.get("num_blocks", len(groups)), structure=emo.get("block_structure", "grouped_by_valence"), groups=groups,
            fixed=fixed if emo.get("clip_selection_mode") == "fixed" else None, who=who,
        ),
        "slots": slot_order(participants, ["schulte", "stroop"], att["trials_per_game"], seed + 100, who),
        "stroop": stroop_stimuli(
            slot_order(participants, ["schulte", "stroop"], att["trials_per_game"], seed + 100, who).where("game = 'stroop'"),
            [c["name"] for c in att["stroop"]["colors"]], att["stroop"]["trials_per_block"], att["stroop"].get("congruent_fraction", 0.5), seed + 200, [who, "slot"],
        ),
        "sart": sart_table(participants, sart["font_sizes"], sart["reps"], seed + 300, fixed_order=sart.get("fixed_order", False), omit_count=sart.get("omit_count"), who=who),
    }
