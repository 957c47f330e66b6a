"""A seeded hash of whole numbers that other SQL engines can compute too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A prime below 2^31, so that no product of two remainders leaves 64 bits, and the constants of the rounds.
PRIME = 2147483647
ROUNDS = ((48271, 69621, 12345), (40692, 16807, 777))


def mixed(value: Column, seed: int = 0) -> Column:
    """A number from 0 to PRIME - 1: two rounds of a quadratic map of the value's remainder. Never overflows.

    The rounds run over an array of constants, so that each binds the last one's value: written out, a filter that is pushed
    down would hold a copy of the value for every use of it."""
    rounds = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit((seed % PRIME) * b + c).cast("long").alias("c"))
                       for a, b, c in ROUNDS])
    return F.aggregate(rounds, F.pmod(value.cast("long"), F.lit(PRIME)),
                       lambda x, r: F.pmod(F.pmod(x * x, F.lit(PRIME)) + x * r["a"] + r["c"], F.lit(PRIME)))


def share_of(place: Column, share: float) -> Column:
    """True for about `share` of the hashes, in steps of a millionth."""
    return F.pmod(place, F.lit(1_000_000)) < round(share * 1_000_000)
