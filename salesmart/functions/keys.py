"""Surrogate keys computed from the row itself."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = chr(31)


def encode(*values: Column) -> Column:
    """One text that differs whenever any value differs, NULL and '' included.

    A present value gets a leading ``v``, a NULL is ``n``; a separator inside
    a value is doubled, so it cannot be taken for the border of two values.
    """
    parts = []
    for value in values:
        text = F.replace(value.cast("string"), F.lit(SEPARATOR), F.lit(SEPARATOR * 2))
        parts.append(F.coalesce(F.concat(F.lit("v"), text), F.lit("n")))
    return F.concat_ws(SEPARATOR, *parts)


KEY_BITS = 60
# Colliding members that are told apart by expressions in the row; beyond that keys are too short.
MOST_SECOND_KEYS = 20_000


def _number(digest: Column, first: int) -> Column:
    """60 bits of a digest, from one of its hexadecimal digits on."""
    return F.conv(F.substring(digest, first, 15), 16, 10).cast("bigint")


@dataclass(frozen=True)
class Keys:
    """How keys are computed from a tuple, wherever the tuple stands.

    Equal tuples get equal keys in every run: 60 bits of a digest. Of two different members of
    a dimension with one key, all but one get a *second key* from other bits of the digest,
    beyond the range of first keys. ``second`` lists these members, as (dimension, key, second
    number). It is kept with the tables, so that a key that was given once stays, and is so
    short that each row looks it up by itself: keys need no join with or without it.

    ``whole`` names dimensions of more such members than can be listed: all of their members
    have their second key.

    ``bits`` shortens the first keys, for tests.
    """

    bits: int = KEY_BITS
    second: tuple[tuple[str, int, int], ...] = ()
    whole: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if len(self.second) > MOST_SECOND_KEYS:
            raise ValueError(f"{len(self.second)} colliding members: keys of {self.bits} bits are too short")

    def numbers(self, *values: Column) -> tuple[Column, Column]:
        """First and second number of a tuple."""
        digest = F.md5(encode(*values).cast("binary"))
        return F.shiftright(_number(digest, 1), KEY_BITS - self.bits), _number(digest, 17)

    def surrogate(self, dimension: str, *values: Column) -> Column:
        first, second = self.numbers(*values)
        if dimension in self.whole:
            return second + F.lit(1 << KEY_BITS)
        own = [(key, number) for name, key, number in self.second if name == dimension]
        if not own:
            return first
        # Few rows get as far as the second comparison, and only those that are listed to the third.
        keys, numbers = (sorted({pair[i] for pair in own}) for i in (0, 1))
        pairs = [F.struct(*(F.lit(n).cast("bigint") for n in pair)) for pair in own]
        listed = first.isin(*keys) & second.isin(*numbers) & F.struct(first, second).isin(*pairs)
        return F.when(listed, second + F.lit(1 << KEY_BITS)).otherwise(first)

    def lookup(self, dimension: str, value: Column) -> Column:
        """Key of a single-valued lookup; NULL refers to nothing."""
        return F.when(value.isNotNull(), self.surrogate(dimension, value))

    def extended(self, members: Iterable[tuple[str, int, int]]) -> Keys:
        return replace(self, second=tuple(sorted({*self.second, *members})))

    def widened(self, dimensions: Iterable[str]) -> Keys:
        whole = tuple(sorted({*self.whole, *dimensions}))
        listed = tuple(member for member in self.second if member[0] not in whole)
        return replace(self, second=listed, whole=whole)


PLAIN = Keys()


def surrogate_key(*values: Column) -> Column:
    """60-bit key of a tuple: equal tuples get equal keys in every run.

    Because the key depends on nothing but the tuple, a foreign key is computed
    where the row stands, with no lookup join.
    """
    return PLAIN.numbers(*values)[0]


def lookup_key(value: Column) -> Column:
    """Key of a single-valued lookup; NULL refers to nothing."""
    return F.when(value.isNotNull(), surrogate_key(value))


def row_digest(*columns: str) -> Column:
    """Digest of a group of rows, an aggregate: the same for the same rows in any order.

    A sum of 64-bit hashes; a row that is there twice counts twice. The sum is exact, so that
    digests of parts add up to that of the whole. NULL and '' give different hashes, as the
    place of a value does.
    """
    places = [columns[i : i + 60] for i in range(0, len(columns), 60)]
    absent = [
        reduce(Column.bitwiseOR, (F.col(c).isNull().cast("bigint") * (1 << i) for i, c in enumerate(part)))
        for part in places
    ]
    return F.sum(F.xxhash64(*columns, *absent).cast("decimal(20,0)"))
