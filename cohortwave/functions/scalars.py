"""Scalar functions over columns."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.functions.ordered import range_join
from cohortwave.schema import PANAS_NEGATIVE, PANAS_POSITIVE, RUN, STAI_NEGATIVE, STAI_POSITIVE


# The characters Unicode counts as white space.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(s: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(s, F.lit(_SPACES))


def safe_label(s: Column) -> Column:
    """a label usable as a folder name; letters and digits of any script, `_`, dot and dash survive."""
    joined = F.regexp_replace(F.lower(strip(s)), r"[^\p{L}\p{N}_.-]+", "_")
    return F.coalesce(F.nullif(F.btrim(joined, F.lit("._")), F.lit("")), F.lit("unlabelled"))


def video_code(s: Column) -> Column:
    """first VID code, any case and separator, as `VID_<int>`; empty when there is none."""
    digits = F.regexp_extract(F.coalesce(s, F.lit("")), r"(?i)VID[_-]?(\d+)", 1)
    plain = F.regexp_replace(digits, r"^0+(?=\d)", "")
    return F.when(digits == "", F.lit("")).otherwise(F.concat(F.lit("VID_"), plain))


def eval_expression(expr: Column) -> Column:
    """value of a space-separated expression, read left to right without precedence.

    A fold over the tokens that remembers the pending operator.
    """
    start = F.struct(F.lit(None).cast("double").alias("v"), F.lit("").alias("op"))

    def step(acc: Column, tok: Column) -> Column:
        v, op, x = acc["v"], acc["op"], tok.try_cast("double")
        value = F.when(op == "", x).when(op == "+", v + x).when(op == "-", v - x).when(op == "*", v * x).when(op == "/", F.try_divide(v, x))
        return F.when(tok.isin("+", "-", "*", "/"), F.struct(v.alias("v"), tok.alias("op"))).otherwise(F.struct(value.alias("v"), op.alias("op")))

    return F.aggregate(F.split(expr, " "), start, step, lambda acc: acc["v"])


def answer_audit(df: DataFrame, expression: str = "expression", answer: str = "correct_answer", given: str = "participant_answer", logged: str = "correct") -> DataFrame:
    """recomputed answer per trial and whether the logged answer and verdict agree with it."""
    value = F.col("recomputed")
    return df.withColumn("recomputed", eval_expression(F.col(expression))).withColumns(
        {
            "answer_ok": F.abs(value - F.col(answer)) < 1e-9,
            "verdict_ok": F.coalesce(F.col(given) == F.col(answer), F.lit(False)) == F.col(logged),
            "operator": F.get(F.split(expression, " "), F.lit(1)),
            "two_digit_first": F.length(F.get(F.split(expression, " "), F.lit(0))) == 2,
        }
    )


def operand_mix(audited: DataFrame, keys: Sequence[str], target: float | None = None) -> DataFrame:
    """share of two-digit first operands and of each operator per key, next to the configured share."""
    return audited.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(F.col("two_digit_first").cast("double")).alias("two_digit_share"),
        *[F.avg((F.col("operator") == op).cast("double")).alias(f"share_{name}") for op, name in (("+", "add"), ("-", "sub"), ("*", "mul"), ("/", "div"))],
        F.lit(target).cast("double").alias("target_two_digit_share"),
    )


#: Tasks whose rows come from the shell's page, which keeps one clock through a session.
SHELL_TASKS = ("preparation", "familiarization", "debrief")


def clock_key(task: Column, run_ordinal: Column) -> tuple[Column, Column]:
    """(task, run) of the browser clock that stamped a row: the shell's pages share one, every run has its own."""
    shell = task.isin(*SHELL_TASKS)
    return F.when(shell, "shell").otherwise(task), F.when(shell, F.lit(0)).otherwise(run_ordinal)


def client_to_host(ev: DataFrame, fit: DataFrame, client_ms: str = "client_ms", fallback: str = "timestamp_monotonic", keys: Sequence[str] = RUN) -> DataFrame:
    """browser time on the host's monotonic clock; the receipt time where no fit exists."""
    f = fit.select(*[F.col(k).alias(f"__f_{k}") for k in keys], "slope", "intercept")
    clock = dict(zip(("task", "run_ordinal"), clock_key(F.col("task"), F.col("run_ordinal")))) if {"task", "run_ordinal"} <= set(keys) else {}
    rows = ev.withColumns({f"__k_{k}": clock.get(k, F.col(k)) for k in keys})
    on = [F.col(f"__k_{k}") == F.col(f"__f_{k}") for k in keys]
    mapped = F.col("slope") * F.col(client_ms) + F.col("intercept")
    return rows.join(f, on, "left").withColumns({"host_t": F.coalesce(mapped, F.col(fallback)), "clock_fitted": mapped.isNotNull()}).select(*ev.columns, "host_t", "clock_fitted")


def stai6_score(score=lambda item: F.col(item)) -> Column:
    """sum of the six 1-4 items with calm, relaxed and content reversed; null if one is missing."""
    return sum((F.lit(5) - score(i) for i in STAI_POSITIVE), F.lit(0)) + sum((score(i) for i in STAI_NEGATIVE), F.lit(0))


def panas_scores(score=lambda item: F.col(item)) -> tuple[Column, Column]:
    """positive and negative affect sums of the ten-item short form."""
    return sum((score(i) for i in PANAS_POSITIVE), F.lit(0)), sum((score(i) for i in PANAS_NEGATIVE), F.lit(0))


def pivot_items(answers: DataFrame, keys: Sequence[str], items: Sequence[str], item: str = "item_id", value: str = "value") -> DataFrame:
    """One numeric column per item; a conditional maximum keeps it a single partial aggregation."""
    return (
        answers.where(F.col(item).isin(*items))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col(item) == i, F.col(value).try_cast("double"))).alias(i) for i in items])
    )


def prefix_matches(submissions: DataFrame, drops: DataFrame, keys: Sequence[str], bucket: float, text: str = "participant_answer", answer: str = "correct_answer") -> DataFrame:
    """per wrong commit, the live drops whose answer starts with what was typed.

    Answers are opened into their prefixes, so text and prefix meet in the join key.
    """
    whole = F.col(answer).cast("string")
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.length(whole), F.lit(1))), lambda n: F.substring(whole, F.lit(1), n))
    d = drops.withColumn("__typed", F.explode(prefixes))
    s = submissions.withColumn("__typed", F.col(text).cast("string"))
    return range_join(s, d, [*keys, "__typed"], "t", "t0", "t1", bucket).drop("__typed")
