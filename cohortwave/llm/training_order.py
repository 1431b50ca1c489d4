"""Training-order materialisation: token sequences in the order of a keyed permutation, in files of a fixed stride."""

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from cohortwave.llm.words import small_batches, text_of
from cohortwave.session import keep, work_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"  # in the folder of public tokenizers
END = 50256  # ends a document, and fills up the last sequence of a task
PIECE = 400_000  # code points that are encoded at a time
ROUNDS = 6
LEVEL = 6  # of compression on the way; the shards are plain
GAP = 2  # bytes between records: two zeros
SPANS = "array<struct<doc_id:bigint,at:bigint,n:int>>"


def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of the whole text and END; very long texts in pieces, which still decode to the text."""
    parts = [enc.encode_to_numpy(text[i : i + PIECE]).astype("<u2") for i in range(0, len(text), PIECE)]
    return np.concatenate([*parts, np.array([END], "<u2")])


class Packer:
    """Concatenates documents and cuts them into sequences of a fixed length."""

    def __init__(self, length: int):
        self.length, self.now, self.used, self.spans, self.ready = length, np.full(length, END, "<u2"), 0, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(self.length - self.used, len(ids) - at)
            self.now[self.used : self.used + n] = ids[at : at + n]
            self.spans.append({"doc_id": doc_id, "at": at, "n": n})
            self.used, at = self.used + n, at + n
            if self.used == self.length:
                self.flush()

    def flush(self) -> None:
        if self.used:
            self.ready.append((self.now.tobytes(), self.spans))
            self.now, self.used, self.spans = np.full(self.length, END, "<u2"), 0, []


def sequences(docs: DataFrame, length: int = 1024, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(task, k, ids, spans): sequences of `length` token ids, 16 bits each, and the pieces of documents they hold.

    Every document is encoded whole and followed by END; a null or empty text is END alone. Documents follow each other
    over sequences without padding; only a task's last sequence is filled up.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, k = encoder(path), Packer(length), 0
        task = TaskContext.get().partitionId()
        fields = [pa.field("task", pa.int32()), pa.field("k", pa.int64()), pa.field("ids", pa.binary()), pa.field("spans", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])))]

        def out() -> pa.RecordBatch:
            nonlocal k
            rows, packer.ready = packer.ready, []
            k += len(rows)
            cols = [[task] * len(rows), list(range(k - len(rows), k)), [r for r, _ in rows], [s for _, s in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=pa.schema(fields))

        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                packer.add(i.as_py(), encode(enc, text_of(t.as_py())))
                if len(packer.ready) >= 512:
                    yield out()
        packer.flush()
        yield out()

    rows = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"task int, k bigint, ids binary, spans {SPANS}")


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A permutation of 0..n-1 that the key picks: a balanced Feistel network on the next even number of bits, walked
    on from any value beyond n (at most four times as many values, so a few steps)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def mixed(v: np.ndarray, r: int) -> np.ndarray:
        h = v + np.uint64((key + (r + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(31))) & mask

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for r in range(ROUNDS):
            left, right = right, left ^ mixed(right, r)
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while len(far := np.nonzero(out >= np.uint64(n))[0]):
        out[far] = once(out[far])
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """Where things lie: shard files of `per_shard` records (the last one may be shorter), `stride` bytes each."""

    path: str
    total: int
    length: int
    per_shard: int
    key: int

    @property
    def stride(self) -> int:
        return 2 * self.length + GAP

    def locate(self, slot: int) -> tuple[int, int]:
        """Shard and byte offset of a slot: a reader that stopped there goes on there."""
        return slot // self.per_shard, slot % self.per_shard * self.stride


def materialise(docs: DataFrame, path: str, *, key: int = 20240607, length: int = 1024, per_shard: int = 4096, vocabulary: str | None = None, **cols) -> tuple[Layout, DataFrame]:
    """Write the sequences of `docs` to `path` in training order; the layout, and (slot, sequence, spans) of every sequence.

    Sequences are numbered through the tasks that made them, from their counts; the keyed permutation turns numbers into
    slots. A partition is the range of slots of one shard and is sorted and written by Spark's own committed writer, so
    part-<shard> holds its records in order at a fixed stride whatever tasks are repeated. Token ids are shuffled once.
    An empty table gives no shard and no row.
    """
    spark = docs.sparkSession
    stored = work_dir(spark, "sequences")
    # blocks of many sequences compress better than one; each is compressed alone only for the shuffle
    zstd = {"compression": "zstd", "parquet.compression.codec.zstd.level": str(LEVEL)}
    sequences(docs, length, vocabulary, **cols).write.options(**zstd).parquet(stored)
    made = spark.read.parquet(stored)
    counts = made.groupBy("task").agg(F.count("*").alias("n"))
    base = keep(counts.select("task", F.coalesce(F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"), "n"), "tasks")
    total = base.agg(F.sum("n")).first()[0] or 0
    layout = Layout(path, total, length, per_shard, key)

    @F.arrow_udf("bigint")
    def slot_of(number: pa.Array) -> pa.Array:
        return pa.array(permute(number.to_numpy(), total, key))

    @F.arrow_udf("binary")
    def squeezed(ids: pa.Array) -> pa.Array:
        c = zstandard.ZstdCompressor(level=LEVEL)
        return pa.array([c.compress(x.as_buffer()) for x in ids], pa.binary())

    def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([d.decompress(x.as_buffer()) for x in b.column(0)], pa.binary())], names=["ids"])

    placed = made.join(base.drop("n"), "task").withColumn("sequence", F.col("base") + F.col("k")).withColumn("slot", slot_of("sequence"))
    if total:
        shards = -(-total // per_shard)
        dealt = placed.select("slot", squeezed("ids").alias("ids")).repartitionById(shards, F.floor(F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot")
        records = dealt.select("ids").mapInArrow(open_up, "ids binary")
        records.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\0" * GAP).text(path)
    return layout, placed.select("slot", "sequence", "spans")


def read_shards(spark: SparkSession, layout: Layout, start: int = 0) -> DataFrame:
    """(slot, shard, byte_offset, ids binary) of all records from the slot `start` on, read from the files."""
    per, stride, width = layout.per_shard, layout.stride, 2 * layout.length
    schema = "slot bigint, shard int, byte_offset bigint, ids binary"
    if not layout.total:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1)):
                data = content.as_buffer()
                for lo in range(0, len(data), stride * 512):
                    at = range(lo, min(len(data), lo + stride * 512), stride)
                    rows = [(shard * per + x // stride, shard, x, data[x : x + width].to_pybytes()) for x in at if shard * per + x // stride >= start]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))], names=["slot", "shard", "byte_offset", "ids"])

    files = small_batches(spark.read.format("binaryFile").load(layout.path))
    shard = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("int")
    return files.select(shard.alias("shard"), "content").where(F.col("shard") >= start // per).mapInArrow(run, schema)


def index(docs: DataFrame, path: str | None = None, **how) -> DataFrame:
    """Materialise `docs` and list the written records: (slot, shard, byte_offset, sequence, n_tokens, crc32, doc_ids)."""
    spark = docs.sparkSession
    layout, rows = materialise(docs, path or work_dir(spark, "training-order"), **how)
    stored = read_shards(spark, layout).select("slot", "shard", "byte_offset", F.crc32("ids").alias("crc32"))
    held = rows.select(
        "slot", "sequence", F.aggregate("spans", F.lit(0), lambda a, s: a + s["n"]).alias("n_tokens"), F.transform("spans", lambda s: s["doc_id"]).alias("doc_ids")
    )
    return stored.join(held, "slot").select("slot", "shard", "byte_offset", "sequence", "n_tokens", "crc32", "doc_ids")
