"""Similarity of whole shingle sets: the exact last step of near-duplicate search.

Sets are sorted 64-bit hashes. They are made of texts again, and only of those that have to be compared.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.llm.graph import components
from cohortwave.llm.words import small_batches
from cohortwave.session import keep

SEED = 42
TILE_ROWS = 2048  # marks that are compared at a time
TILE_SHINGLES = 1 << 17  # shingles of the documents of a tile, on the mean
_SIEVE_BITS = 1 << 25
_BITMAP = 1 << 15  # bits in a bitmap of Spark's aggregate

#: Tells which of many marks may belong to sets similar to that of one mark; the number is that of the bucket's band.
Alike = Callable[[np.ndarray, np.ndarray, int], np.ndarray]


def grams(raw: bytes, n: int) -> tuple[Iterator[bytes], int]:
    """The word shingles of a UTF-8 text and their number; the whole sequence where there are fewer words."""
    words = raw.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if len(words) < n:
        return iter([b" ".join(words)] if words else []), min(1, len(words))
    return map(b" ".join, zip(*(words[i:] for i in range(n)))), len(words) - n + 1


def shingle_set(raw: bytes, n: int) -> np.ndarray:
    """The distinct XXH64 of all word shingles, sorted; none without words."""
    found, count = grams(raw, n)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in found), dtype=np.uint64, count=count))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets share `percent` of their union."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both * 100 >= percent * (len(a) + len(b) - both)


def text_hash(text_col: str) -> Column:
    """Tells rows apart that share an id, or have none."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("text"))


def sieved(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of `texts` that may be in `wanted` (id, text_hash): a bit is set for the hash of each wanted row.

    The bitmaps are at most 1,024 rows of 4 KB whatever the number of rows, so they may be broadcast; the more are wanted,
    the more others pass. It saves the shuffle of texts that the join after it would drop."""
    bit = F.pmod(F.xxhash64("id", "text_hash"), F.lit(_SIEVE_BITS))
    at = wanted.select(F.floor(bit / _BITMAP).alias("s_map"), (bit % _BITMAP).alias("s_bit"))
    maps = at.groupBy("s_map").agg(F.bitmap_construct_agg("s_bit").alias("s_bits"))
    put = texts.withColumns({"s_map": F.floor(bit / _BITMAP), "s_bit": bit % _BITMAP}).join(F.broadcast(maps), "s_map")
    byte = F.conv(F.hex(F.substring("s_bits", F.floor(F.col("s_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return put.where(F.call_function("bit_get", byte, (F.col("s_bit") % 8).cast("int")) == 1).drop("s_map", "s_bit", "s_bits")


def sets_of(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(node, held): the shingles of `wanted` (node, id, text_hash), from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [shingle_set(t.as_py() or b"", n).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held, pa.binary())], names=["node", "held"])

    at = wanted.select("node", F.col("id").alias("w_id"), F.col("text_hash").alias("w_hash"))
    found = sieved(texts, wanted).join(at, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))).select("node", "text")
    return keep(small_batches(found).mapInArrow(run, "node bigint, held binary").dropDuplicates(["node"]), "sets")


def check_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [linked(np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64), percent) for x, y in zip(b.column("a"), b.column("b"))]
            yield b.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("held").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("held").alias("b")), "v")
    return small_batches(both.select("u", "v", "a", "b")).mapInArrow(run, "u bigint, v bigint")


def sizes_may(a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def _marks(rows: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(r["mark"] for r in rows), dtype=np.uint8).reshape(len(rows), -1)


def candidates(left: list[dict], right: list[dict] | None, k: int, alike: Alike, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of `left` the places in `right` (None: later in `left` itself) of sets that may be similar, by size and mark."""
    own = right is None
    right = left if own else right
    a, b = _marks(left), _marks(right)
    n, root = (np.array([r[c] for r in right], dtype=np.int64) for c in ("n", "root"))
    for i, r in enumerate(left):
        first = i + 1 if own else 0
        at = np.flatnonzero(sizes_may(r["n"], n[first:], percent) & (root[first:] != r["root"])) + first
        if len(at):
            at = at[alike(a[i], b[at], k)]
            if len(at):
                yield i, at


def tile_links(left: list[dict], right: list[dict] | None, k: int, alike: Alike, percent: int) -> Iterator[tuple[int, int]]:
    """Links between two tiles of (node, root, n, mark, held), or inside one: candidates that neither `root` nor a link
    found before connects, compared by their whole sets. So two groups get one link, however many pairs they have."""
    own, right = right is None, left if right is None else right
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, at in candidates(left, None if own else right, k, alike, percent):
        a = np.frombuffer(left[i]["held"], dtype=np.uint64)
        for j in at:
            u, v = find(left[i]["root"]), find(right[j]["root"])
            if u != v and linked(a, np.frombuffer(right[j]["held"], dtype=np.uint64), percent):
                root[max(u, v)] = min(u, v)
                yield left[i]["node"], right[j]["node"]


def _tile_pairs(rows: DataFrame, fields: list[str], weight: Column, most: int) -> DataFrame:
    """(bucket, k, same, a, b): tiles of about `most` in `weight` of each bucket, each with itself and those before it."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.sum(weight) / F.lit(most)).cast("int").alias("tiles"))
    dealt = rows.join(sizes, "bucket").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    tiles = keep(dealt.groupBy("bucket", "k", "tile").agg(F.collect_list(F.struct(*fields)).alias("rows")), "tiles")
    left = tiles.select("bucket", "k", "tile", F.col("rows").alias("a"))
    right = tiles.select("bucket", F.explode(F.sequence(F.lit(0), "tile")).alias("tile"), F.col("tile").alias("other"), F.col("rows").alias("b"))
    return left.join(right, ["bucket", "tile"]).select("bucket", "k", (F.col("tile") == F.col("other")).alias("same"), "a", "b")


def rest_links(apart: DataFrame, marks: DataFrame, texts: DataFrame, places: DataFrame, n: int, alike: Alike, percent: int) -> DataFrame:
    """Links (u, v) between members (bucket, k, node, root, n) of a bucket that are in different groups.

    Buckets are cut into tiles, and pairs of tiles compared by numpy: first by the marks (node, mark) alone, which gives the members
    that have a candidate; then those by their whole sets. Either gives rows as many as a tile has at most, so no task
    holds a bucket, and no pairs are made of it.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, k, same, a, b in zip(*(batch.column(c) for c in ("bucket", "k", "same", "a", "b"))):
                left, right = a.as_py(), None if same.as_py() else b.as_py()
                hit = set()
                for i, at in candidates(left, right, k.as_py(), alike, percent):
                    hit.add(left[i]["node"])
                    hit.update((right or left)[j]["node"] for j in at)
                if hit:
                    yield pa.RecordBatch.from_arrays([pa.array([bucket.as_py()] * len(hit), pa.int64()), pa.array(sorted(hit), pa.int64())], names=["bucket", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, same, a, b in zip(*(batch.column(c) for c in ("k", "same", "a", "b"))):
                found = list(tile_links(a.as_py(), None if same.as_py() else b.as_py(), k.as_py(), alike, percent))
                if found:
                    u, v = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    marked = apart.join(marks, "node")
    pairs = _tile_pairs(marked, ["node", "root", "n", "mark"], F.lit(1), TILE_ROWS)
    hits = keep(small_batches(pairs).mapInArrow(thin, "bucket bigint, node bigint").distinct(), "hits")
    sets = sets_of(texts, places.join(hits.select("node").distinct(), "node"), n)
    full = marked.join(hits, ["bucket", "node"]).join(sets, "node")
    pairs = _tile_pairs(full, ["node", "root", "n", "mark", "held"], F.col("n"), TILE_SHINGLES)
    return keep(small_batches(pairs).mapInArrow(run, "u bigint, v bigint"), "rest")


def rooted(nodes: DataFrame, members: DataFrame, star: DataFrame, texts: DataFrame, n: int, alike: Alike, percent: int) -> DataFrame:
    """(node, root) of the nodes that similar sets link, by buckets whose members may be similar.

    `nodes` has (node, at: struct with id and text_hash, n, mark), `members` (bucket, k, node), `star` (u, v) leads from
    members to one leader of their bucket. What leads to a leader is checked first, so that a group of near copies hangs
    together after as many comparisons as it has members; what a bucket then still holds in different groups is
    compared in tiles, all with all.
    """
    places, marks = nodes.select("node", "at.id", "at.text_hash"), nodes.select("node", "mark")
    first = sets_of(texts, places.join(star.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "node"), n)
    near = keep(check_pairs(star, first, percent), "near")
    hung = members.join(components(near), "node", "left").select("bucket", "k", "node", F.coalesce("root", "node").alias("root"))
    now = keep(hung.join(nodes.select("node", "n"), "node"), "hung")
    torn = now.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    rest = rest_links(keep(now.join(torn, "bucket", "left_semi"), "apart"), marks, texts, places, n, alike, percent)
    return components(near.union(rest))
