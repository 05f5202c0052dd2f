"""A filter of bounded size over 64-bit names: it lets all wanted names through, and few others while it is not full."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 26
SHIFTS = (0, 19, 38)


def sieve_of(names: DataFrame, name: Column, most_bits: int = MOST_BITS, bits_each: int = 16) -> np.ndarray:
    """The filter as 64-bit words, 8 MB at most by default.

    Names are well mixed hashes, so three ranges of their own bits are their places. Beyond some millions
    of names more and more others pass; what passes has to be judged exactly by the caller.
    """
    names = names.select(name.alias("name"))
    n, bits = names.count(), 1 << 12
    while bits < bits_each * n and bits < most_bits:
        bits *= 2
    spots = F.explode(F.array(*[F.shiftrightunsigned("name", s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS])).alias("spot")
    one = F.expr("shiftleft(1L, cast(spot % 64 as int))")
    words = names.select(spots).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(one).alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[np.asarray(words.column("word"))] = np.asarray(words.column("mask")).view(np.uint64)
    return out


def passes(words: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names the filter lets through."""
    top = np.uint64(len(words) * 64 - 1)
    through = np.ones(len(names), bool)
    for shift in SHIFTS:
        spot = names >> np.uint64(shift) & top
        through &= (words[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return through
