"""Draws without repetition from numbered pools, as column expressions."""

from pyspark.sql import Column, functions as F

from cohortwave.functions.ordered import digest

ROUNDS = 32


def place(draw: Column, size: Column, seed: int, *keys: str | Column) -> Column:
    """Where draw `0 <= draw < size` falls in a pool of `size`: a permutation of its places for each value of `keys`.

    A swap-or-not shuffle (Hoang, Morris, Rogaway 2012): each round pairs place x with (k - x) mod size, for a key k of the
    round, and one digest of the larger of both tells whether the two change places. That is a permutation for
    every size, so no walk out of a larger domain is needed, and one draw costs the same in any pool.
    """

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(digest(seed, r, *keys), size) - x, size)
        return F.when(digest(seed, r, *keys, F.greatest(x, other)) % 2 == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), draw.cast("bigint"), swap)
