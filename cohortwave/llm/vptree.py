"""Nearest neighbours by inner product: a vantage-point tree per shard, relaxed pruning, exact scores."""

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwave.llm.words import small_batches
from cohortwave.session import keep

_NODE = [("start", "i4"), ("end", "i4"), ("inner", "i4"), ("outer", "i4"), ("vantage", "i4"), ("lo", "f8", 2), ("hi", "f8", 2)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in double precision; that of two vectors does not depend on where they stand, so equal vectors tie."""
    return np.einsum("qd,pd->qp", a, b, optimize=False)


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = 128, seed: int = 3) -> dict[str, np.ndarray]:
    """A tree over distances of vectors extended by sqrt(m^2 - |x|^2), m the largest norm: of all these the one nearest
    to a query (extended by 0) has the largest inner product with it. A node keeps the range of distances from its
    vantage point for either half, so equal distances may be split."""
    x = vectors.astype(np.float64)
    square = (x * x).sum(axis=1)
    most = square.max()
    y = np.concatenate([x, np.sqrt(np.maximum(most - square, 0))[:, None]], axis=1)
    rng, order, nodes = np.random.default_rng(seed), np.arange(len(x)), []

    def grow(start: int, end: int) -> int:
        at = len(nodes)
        node = np.zeros((), _NODE)
        node["start"], node["end"], node["inner"], node["outer"] = start, end, -1, -1
        nodes.append(node)
        if end - start > leaf:
            own = order[start:end]
            tries = rng.choice(own, min(8, len(own)), replace=False)
            sample = y[rng.choice(own, min(64, len(own)), replace=False)]
            spread = [np.linalg.norm(sample - y[t], axis=1).var() for t in tries]
            v = tries[int(np.argmax(spread))]
            d = np.linalg.norm(y[own] - y[v], axis=1)
            by = np.argsort(d, kind="stable")
            order[start:end], d = own[by], d[by]
            mid = len(d) // 2
            node["vantage"], node["lo"], node["hi"] = v, (d[0], d[mid]), (d[mid - 1], d[-1])
            node["inner"] = grow(start, start + mid)
            node["outer"] = grow(start + mid, end)
        return at

    grow(0, len(x))
    nodes = np.array(nodes, dtype=_NODE)
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    nodes["vantage"] = place[nodes["vantage"]]
    return {"ids": ids[order], "vectors": vectors[order], "nodes": nodes, "most": np.array(most)}


def search(tree: dict[str, np.ndarray], ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), the k best for each query, its own id left out; score -inf where there are fewer.

    A half whose distances from the vantage point keep it `bound` away from the query is skipped if
    factor * bound > the distance of the k-th best so far. With factor 1 nothing nearer can be skipped.
    """
    x, nodes, most = tree["vectors"].astype(np.float64), tree["nodes"], float(tree["most"])
    q = queries.astype(np.float64)
    reach = (q * q).sum(axis=1) + most
    top_s, top_i = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)

    def visit(at: int, on: np.ndarray) -> None:
        node = nodes[at]
        if not len(on):
            return
        if node["inner"] < 0:
            own = tree["ids"][node["start"] : node["end"]]
            s = products(q[on], x[node["start"] : node["end"]])
            s[ids[on][:, None] == own] = -np.inf
            better = (s >= top_s[on, -1:]).any(axis=1)
            on, s = on[better], s[better]
            i = np.concatenate([top_i[on], np.where(np.isneginf(s), np.iinfo(np.int64).max, own[None, :])], axis=1)
            s = np.concatenate([top_s[on], s], axis=1)
            best = np.lexsort((i, -s), axis=-1)[:, :k]
            top_s[on], top_i[on] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)
            return
        d = np.sqrt(np.maximum(reach[on] - 2 * products(q[on], x[node["vantage"]][None])[:, 0], 0))
        bound = np.maximum(np.maximum(node["lo"] - d[:, None], d[:, None] - node["hi"]), 0)
        near = bound[:, 0] <= bound[:, 1]

        def wanted(part: np.ndarray, side: int) -> np.ndarray:
            tau = np.sqrt(np.maximum(reach[on[part]] - 2 * top_s[on[part], -1], 0))  # infinite while fewer than k are known
            return on[part][factor * bound[part, side] <= tau * (1 + 1e-12) + 1e-12]

        inner, outer = int(node["inner"]), int(node["outer"])
        visit(inner, wanted(near, 0))
        visit(outer, wanted(~near, 1))
        visit(outer, wanted(near, 1))
        visit(inner, wanted(~near, 0))

    visit(0, np.arange(len(q)))
    return top_i, top_s


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    to = io.BytesIO()
    np.savez(to, **arrays)
    return to.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as z:
        return {name: z[name] for name in z.files}


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim) of the rows with an id and a vector that is not zero and has only finite components."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    return rows.where(~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("v"))


def nearest(
    vectors: DataFrame, is_query, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding", factor: float = 1.5,
    shard_rows: int = 8192, block_rows: int = 256, leaf: int = 128,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets `is_query` (a condition on `id`) its k nearest by inner product.

    Rows are dealt to shards of about `shard_rows` by a hash of id and vector and each shard becomes one tree, a row of
    bounded size; queries are packed in blocks of about `block_rows`, which meet every shard. A shard and a block are
    searched at a time, so equal or frequent vectors make no task larger. Each shard gives its k best for a query,
    scored exactly; ties go to the smaller id. Null, zero, non-finite vectors and rows without id take no part, vectors of
    another length are no candidates, rows that share the query's id are its own. A query without candidates has no row.
    """
    rows = keep(usable(vectors, id_col, vector_col), "vectors")
    wide = "f4" if dict(rows.dtypes)["v"] == "array<float>" else "f8"
    n, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_rows))

    def arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_list()).astype(wide)

    def plant(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [_pack(build(*arrays(pdf), leaf))]})

    def parcel(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, v = arrays(pdf)
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [_pack({"ids": ids, "vectors": v})]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, block in zip(b.column(0), b.column(1)):
                ask = _unpack(block.as_py())
                ids, scores = search(_unpack(tree.as_py()), ask["ids"], ask["vectors"], k, factor)
                hit = ~np.isneginf(scores)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ask["ids"], hit.sum(axis=1))), pa.array(ids[hit]), pa.array(scores[hit])], names=["query_id", "vec_id", "score"])

    trees = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")).groupBy("dim", "shard").applyInPandas(plant, "dim int, shard int, tree binary")
    asked = rows.where(is_query).dropDuplicates(["id", "v"]).withColumn("block", F.pmod(F.xxhash64("id", "v", F.lit(1)), F.lit(blocks)).cast("int"))
    packed = asked.groupBy("dim", "block").applyInPandas(parcel, "dim int, block int, queries binary")
    pairs = keep(trees, "trees").join(packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))), ["dim", "shard"])
    found = small_batches(pairs.select("tree", "queries")).mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
