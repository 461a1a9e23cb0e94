"""Permutations by arithmetic, and amounts of money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.hashing import uniform_int

#: Primes above 2^31: coprime to every population up to that size.
PRIMES = (2147483659, 2147483693, 2147483713, 2147483743, 2147483777, 2147483783)


def times_mod(a: Column, x: Column, n: Column, most: int) -> Column:
    """a * x mod n for 0 <= a, x < n <= most: in longs while the product fits one,
    in decimals beyond (up to 10^18)."""
    if most < 1 << 31:
        return F.pmod(a.cast("bigint") * x.cast("bigint"), n.cast("bigint"))
    wide = F.pmod(a.cast("decimal(18,0)") * x.cast("decimal(18,0)"), n.cast("decimal(18,0)"))
    return wide.cast("bigint")


def shuffle_index(seed: int, stream: str, index: Column, n: Column, key: Column, most: int) -> Column:
    """Position of ``index`` in a permutation of 0..n-1 chosen per ``key``.

    n (at most ``most``) may be any size up to 2^31: the primes are larger,
    hence coprime to it.
    """
    prime = F.element_at(
        F.array(*[F.lit(p) for p in PRIMES]),
        uniform_int(seed, stream + " factor", 1, len(PRIMES), key).cast("int"),
    )
    size = F.greatest(n, F.lit(1)).cast("bigint")
    start = F.pmod(F.xxhash64(F.lit(seed), F.lit(stream + " start"), key), size)
    return F.pmod(times_mod(F.pmod(prime, size), index, size, most) + start, size)


def discount(policy: Column, order: Column, rate: Column, most: Column, amount: Column) -> Column:
    """What a usage takes off: a capped percentage, a fixed amount, or nothing."""
    percent = F.least(F.floor(order * F.coalesce(rate, F.lit(0)) / 100), F.coalesce(most, F.lit(10**9)))
    return (
        F.when(policy == "PERCENT_CAPPED", percent)
        .when(policy == "FIXED_AMOUNT", F.coalesce(amount, F.lit(0)))
        .otherwise(0)
        .cast("int")
    )
