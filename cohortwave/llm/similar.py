"""Near-duplicates by the Jaccard similarity of word shingles: SimHash tiles find candidates, whole sets decide."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwave.llm import wholesets
from cohortwave.llm.graph import components
from cohortwave.llm.simhash import spanning
from cohortwave.llm.words import small_batches
from cohortwave.session import keep

#: Differing bits of candidates, in the first half of a fingerprint and in both. Sets of 80 % similarity differ in 10 and 19
#: on the mean (12 and 24 where they have five shingles), unrelated ones in 32 and 64.
RADIUS, BOTH = 18, 33
TILE = 1 << 14  # fingerprints of a tile
_AT_A_TIME = 1 << 18  # pairs that are compared at a time
_EDGES = 1 << 20  # links that are held before they are put together


def fingerprint(raw: bytes, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted; two words of 64 majority bits of their 128-bit hashes)."""
    found, count = wholesets.grams(raw, n)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), dtype=np.uint8).reshape(count, 16)
    names, first = np.unique(np.ascontiguousarray(h[:, :8]).view(np.uint64).ravel(), return_index=True)
    ones = np.zeros(128, dtype=np.int64)
    for at in range(0, len(first), 1 << 14):  # bounded memory for very long texts
        ones += np.unpackbits(h[first[at : at + (1 << 14)]], axis=1).sum(axis=0, dtype=np.int64)
    return names, np.packbits(ones * 2 > len(first)).view(np.uint64)


def fingerprints(texts: DataFrame, kind: str, n: int) -> DataFrame:
    """(id, text_hash, key, n, f1, f2): key names the set of shingles (128 bits), n is its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, halves = [], [], np.empty((b.num_rows, 2), dtype=np.uint64)
            for i, t in enumerate(b.column(2)):
                names, halves[i] = fingerprint(t.as_py() or b"", n)
                keys.append(xxhash.xxh3_128_digest(names.tobytes()))
                sizes.append(len(names))
            f = halves.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1])], names=["id", "text_hash", "key", "n", "f1", "f2"])

    return small_batches(texts).mapInArrow(run, f"id {kind}, text_hash bigint, key binary, n bigint, f1 bigint, f2 bigint")


def _star(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups that links make, each as links to its smallest place."""
    both, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    root = spanning(len(both), at[: len(i)], at[len(i) :])
    member = root != np.arange(len(both))
    return both[member], both[root[member]]


def tile_stars(a: dict[str, np.ndarray], b: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (member, leader) that put together what is close between two tiles: exclusive-or and bit counts of all pairs,
    a strip at a time; of the links only a star for each group is held, so near copies in any number take no more."""
    nodes = np.concatenate([a["node"], b["node"]])
    u = v = np.empty(0, dtype=np.int64)
    step = max(1, _AT_A_TIME // max(1, len(b["f1"])))
    for at in range(0, len(a["f1"]), step):
        i, j = np.nonzero(np.bitwise_count(a["f1"][at : at + step, None] ^ b["f1"][None, :]) <= RADIUS)
        i += at
        near = np.bitwise_count(a["f1"][i] ^ b["f1"][j]) + np.bitwise_count(a["f2"][i] ^ b["f2"][j]) <= BOTH
        near &= wholesets.sizes_may(a["n"][i], b["n"][j], percent) & (a["node"][i] != b["node"][j])
        u, v = np.concatenate([u, i[near]]), np.concatenate([v, j[near] + len(a["f1"])])
        if len(u) > _EDGES:
            u, v = _star(u, v)
    # a node that is in both tiles is one
    names, place = np.unique(nodes, return_inverse=True)
    u, v = _star(place[u], place[v])
    return names[u], names[v]


def candidate_stars(nodes: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) that put together all nodes (node, n, f1, f2) whose fingerprints and sizes are close.

    Sizes are cut into bands in the ratio that `percent` allows, so only tiles of one band or two neighbouring ones meet.
    Tiles are stretches of a band in the order of population counts, by counts of (band, population count), of which there
    are a few thousand at most; tile pairs whose population counts differ by more than the radius are skipped.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    placed = nodes.where("n > 0").withColumns({"band": band, "pop": F.bit_count("f1")})
    counts = placed.groupBy("band", "pop").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(W.partitionBy("band").orderBy("pop").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("band", "pop", "c", before.alias("before"))
    ordered = placed.join(F.broadcast(starts), ["band", "pop"]).withColumn("tile", F.floor((F.col("before") + F.pmod(F.xxhash64("node"), "c")) / TILE))
    tiles = keep(ordered.groupBy("band", "tile").agg(F.collect_list(F.struct("node", "n", "f1", "f2")).alias("rows"), F.min("pop").alias("lo"), F.max("pop").alias("hi")), "tiles")
    meta = tiles.select("band", "tile", "lo", "hi")
    left = meta.select("band", "tile", "lo", "hi", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("o_band"))
    right = meta.select(F.col("band").alias("o_band"), F.col("tile").alias("o_tile"), F.col("lo").alias("o_lo"), F.col("hi").alias("o_hi"))
    pairs = left.join(right, "o_band").where("(o_band > band OR o_tile <= tile)").where(f"lo - o_hi <= {RADIUS} AND o_lo - hi <= {RADIUS}")
    full = pairs.select("band", "tile", "o_band", "o_tile").join(tiles.select("band", "tile", F.col("rows").alias("a")), ["band", "tile"])
    full = full.join(tiles.select(F.col("band").alias("o_band"), F.col("tile").alias("o_tile"), F.col("rows").alias("b")), ["o_band", "o_tile"])
    dealt = full.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "band", "tile", "o_band", "o_tile").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                a, b = ({c: s.values.field(c).to_numpy().view(np.uint64 if c[0] == "f" else np.int64) for c in ("node", "n", "f1", "f2")} for s in (x, y))
                u, v = tile_stars(a, b, percent)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(u)], names=["u", "v"])

    return keep(small_batches(dealt).mapInArrow(run, "u bigint, v bigint").distinct(), "stars")


def alike(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Marks are both halves of a fingerprint."""
    x = np.bitwise_count(a.view(np.uint64)[None, :] ^ np.ascontiguousarray(b).view(np.uint64))
    return (x[:, 0] <= RADIUS) & (x.sum(axis=1) <= BOTH)


def roots(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(no_id, id, text_hash, root) for each set of shingles, of the least of its rows; sets of one root are linked by similar
    ones. Equal sets are one node, so copies in any number have no pairs; a group of candidates is a bucket of
    `wholesets.rooted`."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = wholesets.text_rows(docs, id_col, text_col)
    rows = keep(fingerprints(texts, kind, shingle), "fingerprints")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    named = rows.groupBy("key").agg(F.min(at).alias("at"), *[F.first(c).alias(c) for c in ("n", "f1", "f2")])
    nodes = keep(named.withColumn("node", F.monotonically_increasing_id()), "nodes")
    star = candidate_stars(nodes, percent)
    grouped = components(star)
    members = keep(grouped.select(F.col("root").alias("bucket"), F.lit(0).alias("k"), "node").union(grouped.select("root", F.lit(0), "root").distinct()), "members")
    # unhex of hex digits: the bytes of a mark are compared with each other only
    mark = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("f1", "f2")])
    root = wholesets.rooted(nodes.select("node", "at", "n", mark.alias("mark")), members, star, texts, shingle, alike, percent)
    return nodes.join(root, "node", "left").select("at.*", F.coalesce("root", "node").alias("root"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of `docs` for each group linked by a Jaccard similarity of `percent` or more: the one of the smallest id (a
    null id is the largest), then of the least text hash.

    Null and empty texts and those without words are one group. Of repeated rows one stays. Very long texts are hashed in
    parts. An empty table gives no rows. Other columns are kept as they are, but for names that begin with `__kept_`,
    which are not allowed.
    """
    found = roots(docs, id_col, text_col, shingle, percent)
    kept = keep(found.groupBy("root").agg(F.min(F.struct("no_id", "id", "text_hash")).alias("k")).select(F.col("k.id").alias("__kept_id"), F.col("k.text_hash").alias("__kept_hash")), "kept")
    same = F.col(id_col).eqNullSafe(F.col("__kept_id")) & (wholesets.text_hash(text_col) == F.col("__kept_hash"))
    marked = docs.join(kept, same).withColumn("__kept_row", F.row_number().over(W.partitionBy("__kept_id", "__kept_hash").orderBy(F.lit(0))))
    return marked.where("__kept_row = 1").select(*docs.columns)
