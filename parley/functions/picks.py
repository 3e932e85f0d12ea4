"""Seeded choices as expressions: the same row gets the same choice in any plan.

A choice is a number from the md5 of seed, key and salt, joined by ``|``; its
first eight hex digits modulo the number of options.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def number(key: Column, salt: str, seed: int = SEED) -> Column:
    """A number from 0 to 2^32 - 1."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def below(n: int | Column, key: Column, salt: str, seed: int = SEED) -> Column:
    """A number from 0 to n - 1."""
    return F.pmod(number(key, salt, seed), F.lit(n) if isinstance(n, int) else n).cast("int")


def between(low: int, high: int, key: Column, salt: str, seed: int = SEED) -> Column:
    """A whole number from low to high, both included."""
    return F.lit(low) + below(high - low + 1, key, salt, seed)


def one_of(options: list[str] | list[Column], key: Column, salt: str, seed: int = SEED) -> Column:
    """One of the options."""
    return F.get(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), below(len(options), key, salt, seed))


def from_bank(bank: list[list[str]], key: Column, salt: str, seed: int = SEED) -> Column:
    """A text of a bank: one of its groups, then one of the group, so long groups weigh no more."""
    groups = F.array(*[F.array(*[F.lit(x) for x in g]) for g in bank])
    group = F.get(groups, below(len(bank), key, salt, seed))
    return F.get(group, below(F.size(group), key, f"{salt}/variant", seed))


def shuffled(items: Column, key: Column, salt: str, seed: int = SEED) -> Column:
    """The items of an array of strings in a seeded order; equal items stay side by side."""
    marked = F.transform(items, lambda x: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.lit(salt), x).cast("binary")).alias("h"), x.alias("x")))
    return F.transform(F.array_sort(marked), lambda s: s["x"])
