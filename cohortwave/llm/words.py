"""Word types of one task: a word is worked out once, texts are then sums over numbers."""

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Types held at a time; the table starts anew beyond it. Bounds a task's memory and has no influence on results.
MOST_TYPES = 100_000


#: Bytes of texts that go to a Python worker at a time.
BATCH = "8m"


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows, in a session that hands them to Python workers in small batches: a batch is held by the JVM and
    by the worker at once, so its size counts several times in an executor's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    return df


def text_of(raw: bytes | None) -> str:
    return raw.decode("utf-8", "replace") if raw else ""


def in_parts(column: pa.Array, most: int = 1 << 19) -> Iterator[list[str]]:
    """The texts of a column a few at a time, so that only about `most` bytes of them are held as words."""
    part, held = [], 0
    for t in column:
        raw = t.as_buffer().to_pybytes() if t.is_valid else b""
        part.append(text_of(raw))
        held += len(raw)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part
    pa.default_memory_pool().release_unused()


def numbers() -> defaultdict:
    """A dictionary that numbers new keys in order."""
    d: defaultdict = defaultdict()
    d.default_factory = d.__len__
    return d


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


class TypeTable:
    """Values per word type (one row each), found by `values` for the types not seen before."""

    def __init__(self, values: Callable[[list[str]], np.ndarray]):
        self.values, self.number, self.rows = values, numbers(), None

    def look_up(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text, the numbers of its words; `rows` then has the values of each number."""
        if len(self.number) > MOST_TYPES:
            self.number, self.rows = numbers(), None
        old = len(self.number)
        at = [np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
        if len(self.number) > old or self.rows is None:
            new = self.values(list(self.number)[old:])
            self.rows = new if self.rows is None else np.concatenate([self.rows, new])
        return at
