"""Passages that repeat: sentences and lines are hashed, the earliest occurrence keeps them."""

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwave.llm.words import small_batches, text_of
from cohortwave.session import keep

_CUT = re.compile(r"\n|[.!?]+(?=\s)")
_WORD = re.compile(r"[^\W_]+")
SHORT = 6  # a unit of fewer words is known by its neighbours too
LEAST = 16  # words of a passage, whichever documents keep them
# Scripts without blanks between words: Thai, Lao, Myanmar, Khmer, kana and ideographs.
_UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_LENGTH = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")


def units(text: str) -> Iterator[tuple[bytes, int, int, int]]:
    """(digest, start, end, words) of every sentence or line that has words, in order.

    Digests are of lower-case words only. A unit of fewer than SHORT words counts as equal only between equal
    neighbours, so that "And." in two texts says nothing, and yet a whole passage is found. In scripts without blanks
    every code point counts as a word.
    """
    ends = [m.end() for m in _CUT.finditer(text)] + [len(text)]
    found, start = [], 0
    for end in ends:
        unit = text[start:end].lower()
        words = _WORD.findall(unit)
        if words:
            found.append((" ".join(words), start, end, len(words) if unit.isascii() else len(_LENGTH.findall(unit))))
        start = end
    for i, (key, start, end, n) in enumerate(found):
        if n < SHORT:
            key = "\n".join((found[i - 1][0] if i else "", key, found[i + 1][0] if i + 1 < len(found) else ""))
        yield xxhash.xxh3_128_digest(key.encode()), start, end, n


def _text_hash(text_col: str) -> Column:
    """Tells texts of rows apart that share an id."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def all_units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, id, text_hash, unit, start, end, words); a few thousand rows at a time leave the worker."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    names = ["digest", "id", "text_hash", "unit", "start", "end", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []

            def out() -> pa.RecordBatch:
                digest, row, unit, start, end, words = zip(*rows)
                rows.clear()
                row = pa.array(row)
                ints = [pa.array(c, pa.int32()) for c in (unit, start, end, words)]
                return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), b.column(0).take(row), b.column(1).take(row), *ints], names=names)

            for row, t in enumerate(b.column(2)):
                for k, (digest, start, end, n) in enumerate(units(text_of(t.as_py()))):
                    rows.append((digest, row, k, start, end, n))
                    if len(rows) >= 20_000:
                        yield out()
            if rows:
                yield out()

    source = small_batches(docs).select(F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(run, f"digest binary, id {kind}, text_hash bigint, unit int, start int, end int, words int")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST) -> DataFrame:
    """(id, text_hash, start, end, words, units, kept_in): passages to remove, in code points of the text as it is.

    Of a unit that occurs more than once the first occurrence stays, by (id, text_hash, position); a null id is the
    latest. All others are repeats, also in the document that keeps it and in a text that repeats itself. A passage is a
    run of neighbouring repeats of at least `least` words in all, whichever documents keep them; `kept_in` lists the ids
    of those documents, without null. Shorter runs (stock lines) are left alone. Null and empty texts have no units. Rows that share id
    and text are one document: they give their passages once, and are no repeats of each other.

    Digests are counted before they are shuffled, and only repeated ones are joined back, so a passage in a third
    of all documents is one row of the small side of a join whose large side can be split.
    """
    rows = keep(all_units(docs, id_col, text_col), "units")
    # written tables, so that either side of a join has its own exchange and Spark can split a frequent digest
    often = keep(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "often")
    again = keep(rows.join(often, "digest"), "again")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "unit")
    held = again.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    shared = keep(held.where(~F.col("first").eqNullSafe(F.col("last"))).select("digest", "first"), "shared")
    repeats = again.join(shared, "digest").where(~place.eqNullSafe(F.col("first"))).withColumn("lo", F.col("first.id")).drop("digest", "first")
    repeats = repeats.dropDuplicates(["id", "text_hash", "unit"])
    run = F.col("unit") - F.row_number().over(W.partitionBy("id", "text_hash").orderBy("unit"))
    runs = repeats.withColumn("run", run).groupBy("id", "text_hash", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").cast("int").alias("words"), F.count("*").cast("int").alias("units"), F.sort_array(F.collect_set("lo")).alias("kept_in")
    )
    return runs.where(F.col("words") >= least).select(F.col("id").alias(id_col), "text_hash", "start", "end", "words", "units", "kept_in")


def cut_out(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the passages of `spans` (id, text_hash, start, end) taken out of their texts."""
    cuts = spans.groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__cuts"))
    text = F.col(text_col)
    # what stays lies between the end of a cut and the start of the next
    starts = F.concat(F.array(F.lit(0)), F.transform("__cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("__cuts", lambda c: c["start"]), F.array(F.length(text)))
    rest = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a)), "")
    return (
        docs.join(cuts, F.col(id_col).eqNullSafe(F.col("__id")) & (_text_hash(text_col) == F.col("__hash")), "left")
        .withColumn(text_col, F.when(F.col("__cuts").isNull(), text).otherwise(rest)).select(*docs.columns)
    )
