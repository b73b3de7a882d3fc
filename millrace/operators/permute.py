"""A seeded permutation of row numbers, so that an order needs no sort and a cut no ranking.

The numbers below ``rows`` are written as a pair ``(number mod a, number div a)`` with ``a`` about
the square root of ``rows``. A Feistel network changes one half at a time by a function of the
other, which can be undone and so is a permutation of all pairs. The few pairs at or above ``rows``
are walked on along their cycle until they fall below.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.columns import let

ROUNDS = 6
PRIME = 2_147_483_647  # products of two remainders stay in a bigint
WALK = 12


def constants(seed: int) -> list[tuple[int, int, int]]:
    """Factor, summand and the epoch's factor of each round."""
    def number(n: int, part: str) -> int:
        return int(hashlib.md5(f"{seed}:{n}:{part}".encode()).hexdigest()[:7], 16) + 1

    return [tuple(number(n, part) for part in "abc") for n in range(ROUNDS)]


def _once(number: Column, epoch: Column, a: int, b: int, seed: int) -> Column:
    rounds = F.array(*(
        F.struct(F.lit(n % 2 == 0).alias("low"), *(F.lit(v).cast("bigint").alias(k) for k, v in zip("fse", c, strict=True)))
        for n, c in enumerate(constants(seed))
    ))

    def tossed(value: Column, k: Column) -> Column:
        return let((value % PRIME * k["f"] + k["s"] + epoch * k["e"]) % PRIME, lambda t: t * t % PRIME)

    def step(halves: Column, k: Column) -> Column:
        low, high = halves["low"], halves["high"]
        return F.struct(
            F.when(k["low"], (low + tossed(high, k)) % a).otherwise(low).alias("low"),
            F.when(k["low"], high).otherwise((high + tossed(low, k)) % b).alias("high"),
        )

    start = F.struct((number % a).alias("low"), F.call_function("div", number, F.lit(a).cast("bigint")).alias("high"))
    return F.aggregate(rounds, start, step, lambda halves: halves["high"] * a + halves["low"])


def permuted(number: Column, rows: int, seed: int, epoch: Column) -> Column:
    """The place of row ``number`` (from 0) among ``rows`` in the order of ``seed`` and ``epoch``."""
    number, epoch = number.cast("bigint"), epoch.cast("bigint")
    a = math.isqrt(max(rows, 1) - 1) + 1
    b = -(-rows // a)
    once = _once(number, epoch, a, b, seed)
    beyond = a * b - rows
    if beyond == 0:
        return once
    # At most ``beyond`` steps; in a large table no cycle stays above for twelve of them.
    steps = F.array_repeat(F.lit(0), min(beyond, WALK))
    walked = F.aggregate(steps, once, lambda at, _: F.when(at >= rows, _once(at, epoch, a, b, seed)).otherwise(at))
    if beyond <= WALK:
        return walked
    return let(walked, lambda at: F.when(at < rows, at).otherwise(F.raise_error("a row number did not fall below the rows")))
