"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly in tiles."""

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwave.llm.graph import components
from cohortwave.llm.words import small_batches
from cohortwave.session import keep

SEED = 42
_FIELD = 7  # bits that hold one population count in a class code


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles (repeats count) of a UTF-8 text; 0 without words."""
    words = raw.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 15):  # bounded memory for very long texts
        part = h[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((ones * 2 > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _text_hash(text_col: str) -> Column:
    """Tells rows apart that share an id, or have none."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp bigint) of every row. A null or empty text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in b.column(2)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["id", "text_hash", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("text"))
    return small_batches(rows).mapInArrow(run, f"id {kind}, text_hash bigint, fp bigint")


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with at most `radius` differing bits: exclusive-or and bit count, a strip of rows at a time."""
    left, right = [], []
    step = max(1, (1 << 18) // max(1, len(b)))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius)
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of n positions reaches over the links (i, j)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def tile_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is within `radius` between two tiles (or inside one): a star for each group that the
    links of the pair form, so a group of n texts costs n edges and no connection is lost."""
    i, j = close_pairs(left.view(np.uint64), right.view(np.uint64), radius)
    if not len(i):
        return left[:0], left[:0]
    both, where = np.unique(np.concatenate([left[i], right[j]]), return_inverse=True)
    root = spanning(len(both), where[: len(i)], where[len(i) :])
    member = root != np.arange(len(both))
    return both[member], both[root[member]]


def _class(fp: Column, parts: int) -> Column:
    """Code of the population counts of `parts` equal parts of the fingerprint."""
    width = 64 // parts
    mask = (1 << width) - 1
    code = F.lit(0).cast("bigint")
    for k in range(parts):
        part = F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit(mask).cast("bigint")) if parts > 1 else fp
        code = code + F.bit_count(part).cast("bigint") * (1 << (_FIELD) * k)
    return code


def links(fps: DataFrame, radius: int = 2, parts: int = 4, tile: int = 2048) -> DataFrame:
    """Edges (u, v) that connect all fingerprints (column fp, distinct) within `radius` bits of each other.

    Fingerprints are put in classes by the population counts of `parts` parts, classes are cut into tiles of
    about `tile` rows. Two fingerprints within the radius have counts that differ by no more in sum, so only
    tiles of such classes meet (a tile with one part: the population counts of whole fingerprints); they are
    compared exactly, all against all. There are at most (64 / parts + 1) ** parts classes whatever the input.
    """
    classes = fps.withColumn("c", _class(F.col("fp"), parts))
    sizes = classes.groupBy("c").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("n"))
    tiles = keep(
        classes.join(F.broadcast(sizes), "c").withColumn("k", F.pmod(F.xxhash64("fp"), "n").cast("int")).groupBy("c", "k").agg(F.collect_list("fp").alias("fps")), "tiles"
    )
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    codes = sorted({sum(x << (_FIELD) * k for k, x in enumerate(d)) for d in near})
    codes = [c for c in codes if c >= 0]  # each pair of classes once, by the larger code
    right = (
        tiles.select("c", "k", F.col("fps").alias("b"))
        .withColumn("d", F.explode(F.array(*[F.lit(c).cast("bigint") for c in codes])))
        .select((F.col("c") - F.col("d")).alias("c"), "d", F.col("k").alias("kb"), "b")
        .join(F.broadcast(sizes), "c")
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .where("d > 0 or k <= kb")
        .select("c", "k", "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                u, v = tile_links(x.values.to_numpy(), y.values.to_numpy(), radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return small_batches(tiles.join(right, ["c", "k"]).select("fps", "b")).mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, radius: int = 2, parts: int = 4, tile: int = 2048) -> DataFrame:
    """(id, fp, component_id): the component of a row is the smallest id that it reaches over fingerprints that differ in
    `radius` bits or fewer.

    Equal fingerprints meet once, as one node, so a group of any number of copies adds no pairs. Rows without words
    have fingerprint 0 and link like others. Repeated rows stay as they are. A null id counts as larger than any
    other and names a component (as null) only where no row has one. An empty table gives no rows. Other columns
    of `docs` are not looked at.
    """
    return classes(docs, id_col, text_col, shingle=shingle, radius=radius, parts=parts, tile=tile).select(F.col("id").alias(id_col), "fp", "component_id")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, radius: int = 2, parts: int = 4, tile: int = 2048) -> DataFrame:
    """(id, text_hash, fp, root, component_id): as near_duplicates, with the fingerprint that names the component."""
    rows = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("lo"))
    star = components(links(nodes.select("fp"), radius, parts, tile))
    rooted = nodes.join(star, nodes.fp == star.node, "left").select("fp", "lo", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("lo").alias("component_id"))
    named = keep(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(named, "fp").select("id", "text_hash", "fp", "root", "component_id")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of `docs` for each component, of the id that names it; of several with that id the one of the least text hash."""
    found = classes(docs.select(id_col, text_col), id_col, text_col, **how).where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = found.groupBy("root").agg(F.first("id").alias("__id"), F.min("text_hash").alias("__hash")).drop("root")
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (_text_hash(text_col) == F.col("__hash"))
    marked = docs.join(kept, same).withColumn("__k", F.row_number().over(W.partitionBy("__id", "__hash").orderBy(F.lit(0))))
    return marked.where("__k = 1").select(*docs.columns)
