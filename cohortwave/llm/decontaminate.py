"""Benchmark decontamination: exact hits of pieces, verified by bit-parallel edit distance."""

import bisect
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cohortwave.llm.words import small_batches, text_of

RATE = 0.08  # errors that are allowed for each code point of a normalised item
LEAST = 20  # code points of a normalised item; shorter ones ("yes", "one of them") are in any text and say nothing
BLOCK_BYTES = 8 << 20  # of item texts that are searched for in one pass over the documents
_NO_WORD = re.compile(r"[\W_]+")
_WORD = re.compile(r"[^\W_]+")


def normalise(text: str) -> str:
    """Lower-case words with one blank between them."""
    return _NO_WORD.sub(" ", text.lower()).strip()


def distance(pattern: str, text: str, most: int) -> tuple[int, int]:
    """(errors, end) of the best match of the pattern anywhere in the text, the leftmost end of equal ones; errors above
    `most` if there is none. Myers' bit-parallel algorithm: one column of the distance matrix is two integers."""
    m = len(pattern)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, (most + 1, -1)
    for at, c in enumerate(text):
        eq = equal.get(c, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(h | up) & full, up & h
        score += bool(plus & high) - bool(minus & high)
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(v | plus)) & full, plus & v & full
        if score < best[0]:
            best = score, at + 1
    return best


class Matcher:
    """All pieces of a block of items in one automaton. Items match whole words: both sides are searched with a blank
    at either end."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, least: int = LEAST):
        self.items = [(i, f" {t} ", int(rate * len(t))) for i, t in ((i, normalise(t)) for i, t in items) if len(t) >= max(1, least)]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            cuts = [len(t) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(t[a:b], []).append((n, a))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, errors) of the best match in each place where an item occurs; offsets in normalised text.

        Of k + 1 pieces one stands unchanged wherever at most k errors are made, so no occurrence is missed.
        """
        if not self.items or not text:
            return []
        text = f" {text} "
        near: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for n, a in where:
                near.setdefault(n, set()).add(end + 1 - size - a)
        out = []
        for n, starts in near.items():
            item, t, k = self.items[n]
            spans: list[list[int]] = []
            for s in sorted(starts):
                lo, hi = max(0, s - k), min(len(text), s + len(t) + k)
                if spans and s - spans[-1][2] <= 2 * k:
                    spans[-1][1:] = [hi, s]
                else:
                    spans.append([lo, hi, s])
            for lo, hi, _ in spans:
                if (at := text.find(t, lo, hi)) >= 0:
                    out.append((item, at, at + len(t) - 2, 0))
                    continue
                errors, end = distance(t, text[lo:hi], k)
                if errors <= k:
                    back = distance(t[::-1], text[lo : lo + end][::-1], k)[1]
                    start = max(0, lo + end - back - 1)
                    out.append((item, start + (text[start + 1] == " "), min(lo + end, len(text) - 1) - 1, errors))
        return sorted(out, key=lambda x: (x[1:], x[0] is None, str(x[0])))


def original(text: str, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The same matches with offsets in the text as it is, widened to whole words."""
    words, at, starts = [m.span() for m in _WORD.finditer(text)], 0, []
    for a, b in words:
        starts.append(at)
        at += len(text[a:b].lower()) + 1

    def word(pos: int) -> int:
        return max(0, bisect.bisect_right(starts, pos) - 1)

    return [(i, words[word(s)][0], words[word(e - 1)][1], d) for i, s, e, d in spans]


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about `most` bytes, dealt by a hash of the id; the driver holds one at a time."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // most))
    for k in range(n if size else 0):
        yield [(r.id, r.text) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()]


def matches(docs: DataFrame, items: DataFrame, *, rate: float = RATE, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", most: int = BLOCK_BYTES) -> DataFrame:
    """(doc id, item_id, start, end, errors): every place of a document, in code points of its text, that holds an item
    with at most rate * length errors (inserted, lost or changed letters of the normalised texts), from word border to
    word border. Items of fewer than `least` code points match nothing: they would be found in most texts.

    Documents are read once for each block of items, whole and without a shuffle. Items without a word, null items and null
    or empty documents match nothing. Items with the same text all match, also those without id; repeated documents are reported each.
    An empty table on either side gives no rows. Other columns are not looked at.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    item_kind = items.select("item_id").schema[0].dataType.simpleString()
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    source = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = f"{id_col} {kind}, item_id {item_kind}, start int, end int, errors int"

    def search(block: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Matcher(block, rate, least)
            for b in batches:
                rows = []
                for row, t in enumerate(b.column(1)):
                    text = text_of(t.as_py())
                    if found := finder.find(normalise(text)):
                        rows += [(row, *x) for x in original(text, found)]
                if rows:
                    row, item, start, end, errors = zip(*rows)
                    ids = b.column(0).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(item, item_type), *[pa.array(c, pa.int32()) for c in (start, end, errors)]], names=[id_col, "item_id", "start", "end", "errors"])

        return source.mapInArrow(run, schema)

    parts = [search(b) for b in blocks(items, most=most)]
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.union(p)
    return out


def keep_clean(docs: DataFrame, items: DataFrame, *, rate: float = RATE, least: int = LEAST, text_col: str = "text", most: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` that hold no item (see `matches`), all columns kept."""

    def keep_by(block: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Matcher(block, rate, least)
            for b in batches:
                texts = b.column(b.schema.get_field_index(text_col))
                yield b.filter(pa.array([not finder.find(normalise(text_of(t.as_buffer().to_pybytes() if t.is_valid else None))) for t in texts], pa.bool_()))

        return run

    for b in blocks(items, most=most):
        docs = small_batches(docs).mapInArrow(keep_by(b), docs.schema)
    return docs
