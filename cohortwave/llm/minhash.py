"""MinHash near-duplicates: minima of many universal hashes in bands, signatures, then whole sets of word shingles."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortwave.llm import wholesets
from cohortwave.llm.words import small_batches
from cohortwave.session import keep

SEED = 42
BANDS, ROWS = 24, 5
#: A pair of 85 % meets in none of the bands with a chance of (1 - 0.85 ** 5) ** 24 = 8e-7.
MINIMA = BANDS * ROWS
_rng = np.random.default_rng(SEED)
#: h(x) = the upper half of a * x + b: strongly universal for 32-bit x.
A, B = _rng.integers(1 << 64, size=(2, MINIMA), dtype=np.uint64)
_AT_A_TIME = 4096  # shingles whose hashes are held at a time


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each hash over the shingles."""
    low = np.full(MINIMA, (1 << 32) - 1, dtype=np.uint32)
    x = found >> np.uint64(32)
    for at in range(0, len(x), _AT_A_TIME):
        values = (A[:, None] * x[None, at : at + _AT_A_TIME] + B[:, None]) >> np.uint64(32)
        np.minimum(low, values.min(axis=1).astype(np.uint32), out=low)
    return low


def agree(same: np.ndarray, percent: int) -> np.ndarray:
    """Whether signatures agree in as many places as sets of `percent` similarity may: five deviations less than on the mean.

    Such a pair is passed over with a chance below 1e-6."""
    p = percent / 100
    return same.sum(axis=-1) >= MINIMA * p - 5 * np.sqrt(MINIMA * p * (1 - p))


def alike(percent: int) -> wholesets.Alike:
    """Signatures that agree enough, in the first band that they have in common: elsewhere they are not looked at again."""

    def of(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        same = a.view(np.uint32)[None, :] == np.ascontiguousarray(b).view(np.uint32)
        return agree(same, percent) & (same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == k)

    return of


def _signed(texts: DataFrame, kind: str, shingle: int) -> DataFrame:
    """(id, text_hash, key, n, mark): key names the set (128 bits), n is its size, mark its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, sigs = [], [], []
            for t in b.column(2):
                found = wholesets.shingle_set(t.as_py() or b"", shingle)
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(len(found))
                sigs.append(signature(found).tobytes() if len(found) else None)
            columns = [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "key", "n", "mark"])

    return small_batches(texts).mapInArrow(run, f"id {kind}, text_hash bigint, key binary, n bigint, mark binary")


def _check_signatures(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint32).reshape(-1, MINIMA) for k in ("a", "b"))
            yield b.select(["u", "v"]).filter(pa.array(agree(a == c, percent)))

    both = pairs.join(marks.select(F.col("node").alias("u"), F.col("mark").alias("a")), "u").join(marks.select(F.col("node").alias("v"), F.col("mark").alias("b")), "v")
    return small_batches(both.select("u", "v", "a", "b")).mapInArrow(run, "u bigint, v bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, percent: int = 85) -> DataFrame:
    """(id, text_hash, n_shingles, node, root) of every row: `root` is the node that names its group, a group being all
    rows that links of at least `percent` Jaccard similarity connect; both are null for rows without words, which link
    with nothing.

    Rows with equal sets are one node, so a group of any number of copies has no pairs. Nodes that agree in a band of
    their minima share a bucket. Signatures of a member and its bucket's leader are compared, then whole sets; see
    `wholesets.rooted` for what is in different groups after that.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    texts = wholesets.text_rows(docs, id_col, text_col)
    rows = keep(_signed(texts, kind, shingle), "signatures")
    at = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    named = rows.where("n > 0").groupBy("key").agg(F.min(at).alias("at"), F.first("n").alias("n"), F.first("mark").alias("mark"))
    nodes = keep(named.withColumn("node", F.monotonically_increasing_id()), "nodes")
    band = [F.xxhash64(F.lit(k), F.substring("mark", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(BANDS)]
    bands = nodes.select("node", "n", F.posexplode(F.array(*band)).alias("k", "bucket"))
    led = keep(bands.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("leader"), F.count("*").alias("c")).where("c > 1").drop("c"), "leaders")
    members = keep(bands.join(led, "bucket"), "members")
    may = F.least("n", "leader.n") * 100 >= F.greatest("n", "leader.n") * percent
    star = members.where((F.col("node") != F.col("leader.node")) & may).select(F.col("leader.node").alias("u"), F.col("node").alias("v")).distinct()
    pairs = keep(_check_signatures(star, nodes.select("node", "mark"), percent), "pairs")
    root = wholesets.rooted(nodes, members.select("bucket", "k", "node"), pairs, texts, shingle, alike(percent), percent)
    owned = nodes.join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    return rows.join(owned, "key", "left").select("id", "text_hash", F.col("n").alias("n_shingles"), "node", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: `component_id` is the smallest id that it reaches, `kept` whether
    it is its own.

    A null, empty or blank text has no shingles and links with nothing, so it is its own component. A null id counts as
    larger than any other and names a component (as null) only where no row has one; such a row is kept. Repeated rows
    stay as they are and are all kept or all not. Very long texts are hashed in parts. An empty table gives no rows.
    Other columns of `docs` are not looked at.
    """
    found = keep(classes(docs, id_col, text_col, shingle=shingle, percent=percent), "classes")
    least = found.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"))
    out = found.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM worded),
nodes AS (SELECT list_sort(s) AS s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY ALL),
held AS (SELECT node, n, unnest(s) AS g FROM nodes),
shared AS (SELECT a.node AS u, b.node AS v, a.n + b.n AS total, count(*) AS c FROM held a JOIN held b ON a.g = b.g AND a.node < b.node GROUP BY ALL),
links AS (SELECT u, v FROM shared WHERE 100 * c >= 85 * (total - c)),
ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT node AS u, node AS v FROM nodes UNION SELECT r.u, w.v FROM reach r JOIN ways w ON r.v = w.u),
least AS (SELECT u AS node, min(v) AS root FROM reach GROUP BY u)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM sets LEFT JOIN nodes ON nodes.s = list_sort(sets.s) LEFT JOIN least USING (node)
"""
