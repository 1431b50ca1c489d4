"""Helpers for `mapInArrow` over partitions that Spark has sorted by a key."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, from batches sorted by them; holds one group at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tbl = pa.Table.from_batches([*held, batch])
        new = np.zeros(tbl.num_rows - 1, dtype=bool)
        for k in keys:
            col = tbl.column(k)
            a, b = col.slice(1), col.slice(0, tbl.num_rows - 1)
            new |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy()
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for lo, hi in zip(cuts, cuts[1:]):
            yield tbl.slice(lo, hi - lo)
        held = tbl.slice(cuts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def packed(tables: Iterator[pa.Table], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Small results gathered into batches worth sending."""
    pile, n = [], 0
    for t in tables:
        pile.append(t)
        n += t.num_rows
        if n >= rows:
            yield from pa.concat_tables(pile).combine_chunks().to_batches()
            pile, n = [], 0
    if pile:
        yield from pa.concat_tables(pile).combine_chunks().to_batches()


def repeat_keys(tbl: pa.Table, keys: list[str], n: int) -> list[pa.Array]:
    return [tbl.column(k).take(pa.array(np.zeros(n, dtype="int64"))).combine_chunks() for k in keys]
