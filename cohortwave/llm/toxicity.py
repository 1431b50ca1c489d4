"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly."""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.llm.words import TypeTable, code_points, in_parts, numbers, small_batches

WORD = re.compile(r"\w+")
SHORTEST, LONGEST = 3, 6  # code points of a subword, word ends included
WINDOW, STEP = 16, 8  # words of a bag, and from one bag to the next
TURNS = 6  # first rounds: one bag in so many at a time
SMOOTH = 40  # subwords without meaning in each bag: a very short text is no purer than a sentence
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of the words between word ends, and the position of each one's word."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = code_points("".join(f"<{w}>" for w in words)).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(c))  # code points to the end of the word
    grams, owners, h = [], [], np.zeros(len(c), np.uint64)
    for n in range(1, LONGEST + 1):
        h = h[: len(c) - n + 1] * _BASE + c[n - 1 :]
        if n >= SHORTEST:
            at = np.nonzero(left[: len(h)] >= n)[0]
            mixed = (h[at] ^ (h[at] >> np.uint64(29))) * _BASE
            grams.append((mixed >> np.uint64(64 - buckets)).astype(np.int32))
            owners.append(owner[at])
    return np.concatenate(grams), np.concatenate(owners)


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bags of a text of n words; one empty bag for a text without words."""
    start = np.arange(0, max(1, n - WINDOW + STEP), STEP)
    return start, np.minimum(start + WINDOW, n)


def fresh(at: np.ndarray) -> np.ndarray:
    """Whether each word (by number) is missing among the STEP words before it: a bag averages what it says, not how
    often it says it, so that one word over and over does not outweigh a sentence."""
    order = np.lexsort((np.arange(len(at)), at))
    new = np.ones(len(at), bool)
    gap, same = np.diff(order), at[order][1:] == at[order][:-1]
    new[order[1:][same & (gap <= STEP)]] = False
    return new


def bag_sums(per_word: np.ndarray) -> np.ndarray:
    """Sums of the rows of `per_word` over every bag."""
    start, end = windows(len(per_word))
    run = np.concatenate([np.zeros((1, per_word.shape[1])), np.cumsum(per_word, axis=0)])
    return run[end] - run[start]


@dataclass
class Model:
    """gain: what a subword adds to the log-odds of label 1 when it is the whole bag; bias: those of an empty bag."""

    gain: np.ndarray
    bias: float
    bits: int

    def per_type(self, words: list[str]) -> np.ndarray:
        """For each word the gain of its subwords and their number."""
        out = np.zeros((len(words), 2))
        for at in range(0, len(words), 5_000):  # keeps temporary arrays small
            grams, owner = subwords(part := words[at : at + 5_000], self.bits)
            n = len(part)
            out[at : at + n, 0], out[at : at + n, 1] = np.bincount(owner, weights=self.gain[grams], minlength=n), np.bincount(owner, minlength=n)
        return out

    def score(self, at: np.ndarray, rows: np.ndarray) -> float:
        """The most toxic bag decides, so that a few words count as much in a long text as in a short one."""
        per_word = rows[at]
        per_word[~fresh(at), 0] = 0
        s = bag_sums(per_word)
        z = s[:, 0] / (s[:, 1] + SMOOTH) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z.max(), -40, 40))))


def fit(texts: list[str], labels: list[int], *, bits: int = 17, dim: int = 8, rounds: int = 60, seed: int = 7) -> Model:
    """Embeddings of subwords and softmax weights by full-batch momentum descent, all drawn from one seed.

    The first tenth of the rounds learns from all bags of a text alike, a sixth of them at a time, the rest from the bag that looks most
    toxic in each, which is what scoring looks at. Without texts of both labels every score is the share of label 1.
    """
    y = np.asarray(labels, dtype=int)
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(1 << bits), float(np.log((share + 1e-6) / (1 - share + 1e-6))), bits)
    number = numbers()
    texts_at = [np.fromiter(map(number.__getitem__, words_of(t)), np.int64) for t in texts]
    types = list(number)
    grams, per_type = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    for at in range(0, len(types), 10_000):  # keeps the driver's memory low
        g, owner = subwords(part := types[at : at + 10_000], bits)
        grams.append(g[np.argsort(owner, kind="stable")])  # those of a type side by side
        per_type.append(np.bincount(owner, minlength=len(part)))
    grams, per_type = np.concatenate(grams), np.concatenate(per_type)
    first = np.concatenate([[0], np.cumsum(per_type)])
    spans = [windows(len(at)) for at in texts_at]
    base = np.concatenate([[0], np.cumsum([len(at) for at in texts_at])])
    lo = np.concatenate([s + x for (s, _), x in zip(spans, base)])
    hi = np.concatenate([e + x for (_, e), x in zip(spans, base)])
    doc = np.repeat(np.arange(len(texts)), [len(s) for s, _ in spans])
    words = np.concatenate(texts_at)
    new = np.concatenate([fresh(at) for at in texts_at])
    run = np.concatenate([[0], np.cumsum(per_type[words])])
    size = run[hi] - run[lo] + SMOOTH

    rng = np.random.default_rng(seed)
    E, V, b = rng.normal(0, 0.1, (1 << bits, dim)), rng.normal(0, 0.1, (dim, 2)), np.zeros(2)
    speed, most = [np.zeros_like(x) for x in (E, V, b)], [1e-12] * 3
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    bags = np.bincount(doc)

    def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())

    def sums(of: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Rows `at` of `values` added up by `of`, a column at a time."""
        return np.stack([np.bincount(of, weights=v[at], minlength=n) for v in np.ascontiguousarray(values.T)], axis=1)

    for r in range(rounds):
        if r < rounds // 10:
            pick = np.arange(r % TURNS, len(doc), TURNS)
            w = (weight / bags)[doc[pick]]
        else:
            gain = np.add.reduceat((E @ (V[:, 1] - V[:, 0])).astype(np.float32)[grams], first[:-1])
            run = np.concatenate([[0], np.cumsum(gain[words] * new)])
            order = np.lexsort((-(run[hi] - run[lo]) / size, doc))
            pick = order[np.concatenate([[True], np.diff(doc[order]) > 0])]
            w = weight[doc[pick]]
        n = hi[pick] - lo[pick]
        at = ranges(lo[pick], n)
        bag = np.repeat(np.arange(len(pick)), n)[new[at]]
        types, word = np.unique(words[at[new[at]]], return_inverse=True)
        n = per_type[types]
        gram, of = grams[ranges(first[types], n)], np.repeat(np.arange(len(types)), n)
        # forward: sums of embeddings per type, averages per bag, softmax
        mean = sums(bag, sums(of, E, gram, len(types)), word, len(pick)) / size[pick, None]
        z = mean @ V + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        # backward: all occurrences of a subword add up before they meet its embedding
        g = (p - np.eye(2)[y[doc[pick]]]) * w[:, None]
        down = sums(gram, sums(word, g / size[pick, None], bag, len(types)), of, 1 << bits)
        for k, (now, d, step) in enumerate(((E, down @ V.T, 0.3), (V, mean.T @ g, 0.05), (b, g.sum(axis=0), 0.05))):
            most[k] = max(most[k], np.abs(d).max())  # steps are measured by the steepest slope so far and fade with it
            speed[k] = 0.9 * speed[k] - step * d / most[k]
            now += speed[k]
    return Model(E @ (V[:, 1] - V[:, 0]), float(b[1] - b[0]), bits)


def remainder(id_col: str, n: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def train(docs: DataFrame, labels: DataFrame, *, most: tuple[int, int] = (1500, 1000), longest: int = 200_000, held_out: int = 5, **how) -> Model:
    """Learn from a bounded sample of the labelled rows whose id's CRC-32 is not divisible by `held_out`.

    `most`: rows with label 0 and with label 1, those first by a hash of the id; texts beyond `longest` bytes are
    not learned from. So the driver holds at most sum(most) texts, whatever the input.
    """
    known = labels.where("toxic in (0, 1)").where(remainder("doc_id", held_out) != 0).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    first = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in enumerate(most)]
    picked = docs.select("doc_id", "text").join(F.broadcast(first[0].union(first[1])), "doc_id").where(F.octet_length("text") <= longest)
    # rows may share an id; one text of each is enough, and no more than were picked
    rows = sorted(picked.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect(), key=lambda r: (r.doc_id, r.toxic))
    return fit([r.text for r in rows], [r.toxic for r in rows], **how)


def scored(model: Model, table: TypeTable, texts: pa.Array) -> Iterator[float]:
    for part in in_parts(texts):
        for at in table.look_up([words_of(t) for t in part]):
            yield model.score(at, table.rows)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score in 0..1) of every row, from its whole text. A null text, or one without words, is an empty bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TypeTable(model.per_type)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(scored(model, table, b.column(1))), pa.float64())], names=["id", "score"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score below the threshold, all columns kept; texts are read once and not shuffled.

    Columns may have any names: the score is found from the text alone and leaves no column behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TypeTable(model.per_type)
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col))
            yield b.filter(pa.array([s < threshold for s in scored(model, table, texts)], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)
