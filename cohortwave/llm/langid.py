"""Language ID: unigram pieces of a fixed vocabulary, all segmentations of a word summed."""

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwave.llm.words import TypeTable, code_points, in_parts, small_batches

LETTERS = regex.compile(r"\p{L}+")
VOCABULARY = "piece_bpe_32k.model"  # in the folder of public tokenizers
RESCALE = 20  # letters after which sums of products of probabilities are scaled, so that none vanishes however long a word is
CELLS = 1 << 16  # letters of words that are worked on together; a longer word is alone
UNKNOWN = 1e-7  # probability of a letter that no piece has, alike in all languages
_START = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
UNDECIDED = "und"


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, with the vocabulary's mark for the start of a word."""
    return [_START + w for w in LETTERS.findall(text.lower())]


def pieces_of(path: str) -> list[str]:
    """Lower-case pieces of letters of a vocabulary, and their single letters."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {p for i in range(sp.get_piece_size()) if (p := sp.id_to_piece(i).lower()) and LETTERS.fullmatch(p.removeprefix(_START) or "a")}
    return sorted(pieces | {c for p in pieces for c in p})


def parts_of(words: list[str]) -> Iterator[list[int]]:
    """Places of words in parts of about CELLS letters, like lengths together."""
    part: list[int] = []
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if part and (len(part) + 1) * len(words[i]) > CELLS:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


class Lattice:
    """Places of all pieces in words: positions are cut out by a rolling hash and found in a table of hashes."""

    def __init__(self, pieces: list[str]):
        h = np.array([self._hash(code_points(p).astype(np.uint64)) for p in pieces], dtype=np.uint64)
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        assert len(np.unique(self.hashes)) == len(pieces), "two pieces share a hash"
        self.bits = 20
        self.first = np.searchsorted(self.hashes >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        self.deepest = int(np.diff(self.first).max())
        self.longest = max(map(len, pieces))

    @staticmethod
    def _step(h, c):
        return (h ^ c) * _BASE ^ ((h ^ c) * _BASE >> np.uint64(31))

    @classmethod
    def _hash(cls, points: np.ndarray) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in points:
            h = cls._step(h, c)
        return h[0]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number for every hash, -1 for none."""
        at = self.first[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
        out = np.full(len(h), -1)
        for k in range(self.deepest):
            i = np.minimum(at + k, len(self.hashes) - 1)
            out = np.where(self.hashes[i] == h, self.order[i], out)
        return out

    def fits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and for each word, place and size (less one) the piece that begins there: -1 for an unknown letter, -2
        for none."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        wide = int(size.max(initial=0))
        grid = np.zeros((len(words), wide), np.uint64)
        grid[np.arange(wide) < size[:, None]] = code_points("".join(words))
        out = np.full((len(words), wide, min(wide, self.longest)), -2, np.int32)
        h = np.zeros_like(grid)
        for n in range(1, out.shape[2] + 1):
            h = self._step(h[:, : wide - n + 1], grid[:, n - 1 :])
            inside = np.arange(wide - n + 1) + n <= size[:, None]
            piece = self.find(h[inside])
            out[:, : wide - n + 1, n - 1][inside] = piece if n == 1 else np.where(piece < 0, -2, piece)
        return size, out


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    pieces: list[str]
    prob: np.ndarray  # a row per piece, the last one for unknown letters; a column per language

    def __post_init__(self):
        self._lattice: Lattice | None = None

    def __getstate__(self):
        return self.__dict__ | {"_lattice": None}

    @property
    def lattice(self) -> Lattice:
        if self._lattice is None:
            self._lattice = Lattice(self.pieces)
        return self._lattice

    def sums(self, size: np.ndarray, piece: np.ndarray, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(values, logs): exp(logs) * values[word, place, language] is the summed probability of all segmentations of the
        letters before a place, or with `back` of those from it. Each language is scaled by itself."""
        words, wide, longest = piece.shape
        prob = np.concatenate([self.prob[:-1], np.zeros((1, self.prob.shape[1])), self.prob[-1:]])  # -2: none, -1: unknown
        value = np.zeros((words, wide + 1, prob.shape[1]))
        logs = np.zeros_like(value)
        value[np.arange(words), size if back else 0] = 1
        for step in range(1, wide + 1):
            i = wide - step if back else step
            live = np.nonzero(size > i if back else size >= i)[0]
            n = np.arange(1, min(longest, step) + 1)
            fit = piece[live, i, : len(n)] if back else piece[live[:, None], i - n, n - 1]
            # few sizes fit; one letter always does, so every row has a first one
            row, k = np.nonzero(fit != -2)
            part = value[live[row], i + n[k] if back else i - n[k]] * prob[fit[row, k]]
            value[live, i] = np.add.reduceat(part, np.searchsorted(row, np.arange(len(live))), axis=0) if len(live) else 0
            logs[live, i] = logs[live, i + 1 if back else i - 1]
            if step % RESCALE == 0:
                near = slice(i, i + longest + 1) if back else slice(max(0, i - longest), i + 1)
                scale = value[live, i][:, None]
                value[live, near] /= scale
                logs[live, near] += np.log(scale)
        return value, logs

    def per_type(self, words: list[str]) -> np.ndarray:
        """log P(word | language) for each word."""
        out = np.zeros((len(words), self.prob.shape[1]))
        for part in parts_of(words):
            size, piece = self.lattice.fits([words[i] for i in part])
            value, logs = self.sums(size, piece)
            k = np.arange(len(size))
            out[part] = np.log(value[k, size]) + logs[k, size]
        return out

    def expected(self, words: list[str], count: np.ndarray) -> np.ndarray:
        """How often each piece is expected in segmentations drawn by their probability, by language (count: likewise)."""
        out = np.zeros_like(self.prob)
        for part in parts_of(words):
            size, piece = self.lattice.fits([words[i] for i in part])
            (a, la), (b, lb), k = self.sums(size, piece), self.sums(size, piece, back=True), np.arange(len(size))
            whole = (np.log(a[k, size]) + la[k, size])[:, None]
            for n in range(1, piece.shape[2] + 1):
                ends = a.shape[1] - n
                here = piece[:, :ends, n - 1]
                row, at = np.nonzero(here != -2)
                p = here[row, at]
                share = a[row, at] * self.prob[p] * b[row, at + n] * np.exp(la[row, at] + lb[row, at + n] - whole[row, 0])
                np.add.at(out, p, share * count[np.array(part)[row]])
        return out

    def decide(self, at: np.ndarray, rows: np.ndarray) -> tuple[str, float]:
        """The likeliest language and its posterior; equal ones by name."""
        if not len(at) or not self.langs:
            return UNDECIDED, 0.0
        z = rows[at].sum(axis=0) + np.log(self.prior)
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        return self.langs[best], float(min(1.0, p[best] / p.sum()))


def fit(texts: list[str], langs: list[str], vocabulary: str, rounds: int = 3, smooth: float = 0.1) -> Model:
    """Piece probabilities by expectation-maximisation, from uniform ones, and shares of texts as priors."""
    pieces = pieces_of(vocabulary)
    names = sorted(set(langs))
    counts = [Counter() for _ in names]
    for t, g in zip(texts, langs):
        counts[names.index(g)].update(words_of(t))
    types = sorted(set().union(*counts))
    count = np.array([[c[w] for c in counts] for w in types], dtype=float).reshape(len(types), len(names))
    share = np.array([langs.count(g) for g in names], dtype=float) / max(1, len(langs))
    m = Model(names, share, pieces, np.full((len(pieces) + 1, len(names)), 1 / len(pieces)))
    m.prob[-1] = UNKNOWN
    for _ in range(rounds if types else 0):
        got = m.expected(types, count)[:-1] + smooth
        m.prob[:-1] = got / got.sum(axis=0)
    return m


def remainder(id_col: str, n: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def vocabulary_path(folder: str = "/opt/tokenizers", name: str = VOCABULARY) -> str:
    return os.path.join(folder, name)


def train(docs: DataFrame, *, held_out: tuple[int, int] = (4, 2), most: int = 300, longest: int = 20_000, vocabulary: str | None = None, **how) -> Model:
    """Learn from the texts of rows with a language, less those whose id's CRC-32 leaves `held_out`.

    A bounded sample, the only one: of each language `most` rows, those first by a hash of the id, of texts of at most
    `longest` bytes, or the shortest text where a language has no such one. Every language is learned; rows without id
    are not learned from. Shares of languages are those of all rows.
    """
    known = docs.where("lang is not null and text is not null").where(remainder("doc_id", held_out[0]) != held_out[1])
    sizes = known.groupBy("lang").count().collect()
    long = F.octet_length("text") > longest
    order = [long, F.when(long, F.octet_length("text")), F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")]
    first = known.where("doc_id is not null").select("doc_id", "lang", F.xxhash64("text").alias("h"), long.alias("long"), F.row_number().over(W.partitionBy("lang").orderBy(*order)).alias("k"))
    picked = first.where((F.col("k") <= most) & (~F.col("long") | (F.col("k") == 1))).select("doc_id", "lang", "h").distinct()
    # ids first, then their texts: no more texts than are learned from are moved; `most` rows a language may be broadcast
    rows = sorted(known.join(F.broadcast(picked), ["doc_id", "lang"]).where(F.xxhash64("text") == F.col("h")).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    model = fit([r.text for r in rows], [r.lang for r in rows], vocabulary or vocabulary_path(), **how)
    counts = {r.lang: r["count"] for r in sizes}
    total = np.array([counts[g] for g in model.langs], dtype=float)
    model.prior = total / max(1.0, total.sum())
    return model


def predictions(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row from its whole text; 'und' and 0 where the text is null or has no letter (of
    Unicode's categories L), or nothing was learned. Repeated rows are scored each, an empty table gives no rows, other
    columns are not looked at. A word of any length is one sum over all its segmentations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TypeTable(model.per_type)
        for b in batches:
            found = [model.decide(at, table.rows) for part in in_parts(b.column(1)) for at in table.look_up([words_of(t) for t in part])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())], names=["id", "lang_pred", "score"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    out = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
