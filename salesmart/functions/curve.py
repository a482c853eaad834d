"""A space-filling order over several columns, so that files are narrow in each of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.keys import KEY_BITS

CURVE_BITS = 10


def of_key(key: Column, bits: int = CURVE_BITS) -> Column:
    """The leading bits of a key, which is evenly spread; second keys and NULL are the ends."""
    lead = F.least(F.shiftright(key, KEY_BITS - bits), F.lit((1 << bits) - 1))
    return F.coalesce(lead, F.lit(0)).cast("bigint")


def of_day(day: Column, bits: int = CURVE_BITS) -> Column:
    """A day's place in its year; NULL is the first."""
    place = F.floor((F.dayofyear(day) - 1) * (1 << bits) / 366)
    return F.coalesce(place, F.lit(0)).cast("bigint")


def interleaved(places: Sequence[Column], bits: int = CURVE_BITS) -> Column:
    """Z-order: the bits of all places in turn, the leading ones first."""
    n = len(places)
    terms = [
        F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * n + n - 1 - i)
        for bit in range(bits)
        for i, place in enumerate(places)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), terms)
