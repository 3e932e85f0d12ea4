"""URL filters: explicit rules, then a Bloom filter cascade of listed hosts.

The cascade is exact on the corpus's own universe of keys. Level 0 encodes the
listed keys; the next encodes those other keys of the universe that level 0
lets through; the one after that the listed keys which that one lets through;
and so on until a level lets nothing wrong through. A key's level of the first
miss tells its side. Keys are split by hash into shards of a bounded number of
keys, each with its own cascade, built where its keys meet; rows are never
joined with keys: they are judged by the broadcast cascades, in as many passes
over groups of shards as keep each broadcast within a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.session import cut, ship

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with its path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Keys of the universe per shard, about; bytes of cascades per broadcast.
SHARD_KEYS = 1_000_000
BROADCAST_BYTES = 256 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls; the first of equally long ones."""
    name = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if name is None else (name, verdict)


class Level:
    """One Bloom filter: bits, number of probes, and a salt."""

    def __init__(self, keys: np.ndarray, rate: float, salt: int) -> None:
        self.probes = max(1, round(-np.log2(rate)))
        size = max(64, int(np.ceil(len(keys) * self.probes / np.log(2))))
        self.salt, bits = salt, np.zeros(size, bool)
        for at in self._at(keys, size):
            bits[at] = True
        self.size, self.bits = size, np.packbits(bits)

    def _at(self, keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            a = (keys ^ np.uint64(self.salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            a ^= a >> np.uint64(32)
            b = a * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
            b ^= b >> np.uint64(29)
            for k in range(self.probes):
                yield (a + np.uint64(k) * b) % np.uint64(size)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._at(keys, self.size):
            out &= (self.bits[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        return out


def build(listed: np.ndarray, others: np.ndarray) -> list[Level]:
    """Levels that tell ``listed`` from ``others`` without error; the sets must be disjoint."""
    levels: list[Level] = []
    inside, outside = listed, others
    while len(inside):
        rate = min(0.5, max(len(inside), 1) / (len(outside) * 2**0.5)) if not levels and len(outside) else 0.5
        levels.append(Level(inside, rate, len(levels) + 1))
        inside, outside = outside[levels[-1].has(outside)], inside
    return levels


def member(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Whether each key, of the universe that the levels were built over, is listed."""
    out = np.zeros(len(keys), bool)
    at = np.arange(len(keys))
    for k, level in enumerate(levels):
        hit = level.has(keys[at])
        out[at[~hit]] = k % 2 == 1
        at = at[hit]
    out[at] = len(levels) % 2 == 1
    return out


def key_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 42)


def cascades(universe: DataFrame) -> DataFrame:
    """``shard, n_shards, cascade`` from the universe's distinct ``key, listed`` rows.

    Keys are taken by their 64-bit hash; two keys of one hash on different
    sides (one chance in 10^19 a pair) fail the build and are not passed over.
    """
    import pickle

    n = max(1, -(-universe.count() // SHARD_KEYS))
    keyed = universe.select(F.xxhash64("key").alias("h"), "listed").withColumn("shard", F.pmod("h", F.lit(n)).cast("int"))

    def make(key: tuple, table: pa.Table) -> pa.Table:
        h, listed = table.column("h").to_numpy().view(np.uint64), table.column("listed").to_numpy(zero_copy_only=False).astype(bool)
        inside, outside = np.unique(h[listed]), np.unique(h[~listed])
        if len(np.intersect1d(inside, outside)):
            raise ValueError("two keys on different sides share a hash")
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n_shards": pa.array([n], pa.int32()), "cascade": pa.array([pickle.dumps(build(inside, outside))], pa.binary())})

    return keyed.groupBy("shard").applyInArrow(make, "shard int, n_shards int, cascade binary")


def mark(rows: DataFrame, key: str, built: DataFrame, into: str = "listed") -> DataFrame:
    """Add ``into``: whether ``key`` is listed, by the cascades of ``built`` (stored).

    Exact for the keys of the universe; nothing is said of others.
    """
    import pickle

    spark = rows.sparkSession
    rows = rows.drop(into)
    out = T.StructType([*rows.schema.fields, T.StructField(into, T.BooleanType())])
    sizes = built.select("shard", "n_shards", F.length("cascade").alias("n")).orderBy("shard").collect()
    passes: list[list[int]] = [[]]
    total = 0
    for r in sizes:
        if total and total + r["n"] > BROADCAST_BYTES:
            passes, total = [*passes, []], 0
        passes[-1].append(r["shard"])
        total += r["n"]
    n = sizes[0]["n_shards"] if sizes else 1

    def judged(part: list[int], part_rows: DataFrame) -> DataFrame:
        blobs = {r["shard"]: bytes(r["cascade"]) for r in built.filter(F.col("shard").isin(part)).collect()} if part else {}
        shared = spark.sparkContext.broadcast(blobs)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            levels = {k: pickle.loads(v) for k, v in shared.value.items()}
            for b in batches:
                keys = np.array([key_of(x or "") for x in b.column(key).to_pylist()], np.uint64)
                shard = np.array([int(x) % n for x in keys.view(np.int64)], np.int64)
                found = np.zeros(len(keys), bool)
                for k in np.unique(shard):
                    at = np.flatnonzero(shard == k)
                    found[at] = member(levels.get(int(k), []), keys[at])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], names=[*b.schema.names, into])

        return part_rows.mapInArrow(run, out)

    if len(passes) == 1:
        return judged(passes[0], rows)
    of = F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(""))), F.lit(n)).cast("int")
    # One pass is stored before the next is broadcast, so the bound holds for all of them together.
    made = [cut(judged(p, rows.filter(of.isin(p)))) for p in passes]
    made.append(judged([], rows.filter(~of.isin([s for p in passes for s in p]))))
    return _union(made)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole


def insecure(pages: DataFrame) -> DataFrame:
    """``key, listed`` of all hosts: listed are those that no page reaches by https."""
    return pages.select(F.col("host").alias("key"), F.col("url").startswith("https://").alias("safe")).groupBy("key").agg((~F.max("safe")).alias("listed"))


def judge(pages: DataFrame, rules=RULES, universe=insecure) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``page_id, url``.

    Where no rule fits, a listed host is blocked and any other allowed.
    ``universe`` makes the distinct ``key, listed`` rows of all hosts. A null url
    or one without ``://`` has an empty host and path, and is allowed; repeated
    rows are judged each; other columns are ignored.
    """
    ship(pages.sparkSession)
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    built = cut(cascades(universe(parts.filter("host <> ''"))))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    marked = mark(parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule")), "host", built)
    return marked.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("listed") & (F.col("host") != ""), "block").otherwise("allow")).alias("verdict"))
