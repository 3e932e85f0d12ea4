"""Removal of boilerplate lines by the spread of their sites.

A line is boilerplate when it stands in documents of at least ``MIN_SITES``
distinct sites. Spread is first estimated: a HyperLogLog sketch of the sites
per line hash, built before the shuffle and merged by the aggregation, so a
line that a third of all documents share is 32 bytes per task. Lines whose
estimate is near the threshold get exact distinct counts, in two steps
(distinct pairs of line and site, then their number).

A line that fewer rows have than the threshold can't be spread; most lines go
that way, after one aggregation. Documents are rewritten where they are, no
text is shuffled: the hashes to drop are broadcast while their number is within
a bound; beyond it they come by a join on the text's hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.session import cut, free, ship

MIN_SITES = 10
#: Relative standard deviation of the sketches: 32 registers, so up to a third of them an
#: estimate is at most a fifth too high, and one of less than a third of the truth is a matter of 10^-7.
RSD = 0.2
#: Estimates from MIN_SITES / NEAR to MIN_SITES * NEAR are near the threshold.
NEAR = 3
#: For ``cleaned``: a document with more than this percentage of its characters in boilerplate lines may be a copy.
COPY_PERCENT = 50
#: Boilerplate line hashes up to which they are broadcast (8 bytes each).
BROADCAST_LINES = 1_000_000
#: Parts of a text's hash beyond that.
SALTS = 32
WORD = re.compile(r"[^\x20\x09-\x0d]")


def _hashes(text: Column) -> Column:
    """Distinct hashes of the lines that have a word."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` (hash): the lines that at least ``min_sites`` distinct sites have.

    Rows without a site count for none; lines without a word don't count.
    """
    lines = docs.filter(F.col(site).isNotNull()).select(F.xxhash64(site).alias("site"), F.explode(_hashes(F.col("text"))).alias("line"))
    counts = lines.groupBy("line").agg(F.count("*").alias("n"), F.approx_count_distinct("site", RSD).alias("about"))
    counts = cut(counts.filter((F.col("n") >= min_sites) & (F.col("about") * NEAR >= min_sites)).select("line", "about"))
    sure = counts.filter(F.col("about") > min_sites * NEAR).select("line")
    near = counts.filter(F.col("about") <= min_sites * NEAR).select("line")
    near = F.broadcast(near) if counts.count() <= BROADCAST_LINES else near
    exact = lines.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("n_sites"))
    return sure.union(exact.filter(F.col("n_sites") >= min_sites).select("line"))


def strip(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, names: tuple[str, str] = ("n_lines", "n_removed"), keep_copies: bool = False) -> DataFrame:
    """``docs``, all columns and rows, with boilerplate lines taken out of ``text``.

    Adds ``n_lines`` (lines of the text as it came) and ``n_removed``, by the
    names given, in place of columns of these names. Null texts stay null, with
    no lines; a text of nothing but boilerplate becomes empty. All copies of a
    line go, wherever they stand, in repeated rows too. With ``keep_copies`` a
    document that is boilerplate for more than ``COPY_PERCENT`` of its
    characters (line feeds apart) stays whole if another row has the same text:
    its lines are at many sites because it is, and document dedup keeps one.
    """
    ship(docs.sparkSession)
    docs = docs.drop(*names)
    key, drop_name, copied_name = (free([*docs.columns, *names], c) for c in ("key", "drop", "copied"))
    found = cut(boilerplate(docs, site, min_sites))
    n = found.count()
    out = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(r["line"] for r in found.collect())) if n <= BROADCAST_LINES else None
    drop = None if shared else drop_name
    if drop:
        hits = docs.select(F.xxhash64("text").alias(key), F.explode(_hashes(F.col("text"))).alias("line")).distinct()
        hits = hits.join(found, "line").groupBy(key).agg(F.collect_set("line").alias(drop))
        docs = _spread(docs.withColumn(key, F.xxhash64("text")), hits, key)
    if keep_copies:
        # Few texts are mostly boilerplate: their hashes are counted, and those of more than one row come back.
        over = docs.mapInArrow(lambda batches: _over(batches, shared, drop, key), f"{key} long")
        copied = cut(over.groupBy(key).agg(F.count("*").alias(copied_name)).filter(F.col(copied_name) > 1))
        docs = docs.withColumn(key, F.xxhash64("text"))
        docs = docs.join(F.broadcast(copied), key, "left").drop(key) if copied.count() <= BROADCAST_LINES else _spread(docs, copied, key)
    return docs.mapInArrow(lambda batches: _rewrite(batches, shared, drop, names, copied_name if keep_copies else None), out)


def _spread(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Left join on a text's hash, where a third of all rows may have one text, or none: each key has ``SALTS`` parts."""
    salt = free([*docs.columns, *found.columns], "salt")
    docs = docs.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    found = found.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return docs.join(found, [key, salt], "left").drop(key, salt)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _kept(text: str | None, known: frozenset) -> tuple[list[str], list[str]]:
    """All lines of a text, and those that stay."""
    lines = [] if text is None else text.split("\n")
    return lines, [x for x in lines if _signed(xxhash.xxh64_intdigest(x.encode(), 42)) not in known or WORD.search(x) is None] if known else lines


def _mostly(lines: list[str], kept: list[str]) -> bool:
    """Whether more than ``COPY_PERCENT`` of the characters would go."""
    return sum(map(len, lines)) * (100 - COPY_PERCENT) > sum(map(len, kept)) * 100


def _over(batches: Iterator[pa.RecordBatch], shared, column: str | None, key: str) -> Iterator[pa.RecordBatch]:
    """Hashes of the texts, of each row, that are mostly boilerplate."""
    known = shared.value if shared else frozenset()
    for b in batches:
        drops = b.column(column).to_pylist() if column else None
        texts = b.column(b.schema.get_field_index("text"))
        keys = []
        for k in range(b.num_rows):
            text = texts[k].as_py()
            if _mostly(*_kept(text, known if drops is None else frozenset(drops[k] or ()))):
                keys.append(_signed(xxhash.xxh64_intdigest(text.encode(), 42)))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], names=[key])


def _rewrite(batches: Iterator[pa.RecordBatch], shared, column: str | None, added: tuple[str, str], copied: str | None) -> Iterator[pa.RecordBatch]:
    known = shared.value if shared else frozenset()
    for b in batches:
        texts, n_lines, n_removed = [], [], []
        drops = b.column(column).to_pylist() if column else None
        at = b.schema.get_field_index("text")
        for k in range(b.num_rows):
            text = b.column(at)[k].as_py()
            if drops is not None:
                known = frozenset(drops[k] or ())
            lines, kept = _kept(text, known)
            if copied and b.column(copied)[k].is_valid and _mostly(lines, kept):
                kept = lines
            texts.append(text if len(kept) == len(lines) else "\n".join(kept))
            n_lines.append(len(lines))
            n_removed.append(len(lines) - len(kept))
        columns = [c if i != at else pa.array(texts, pa.string()) for i, c in enumerate(b.columns) if b.schema.names[i] not in (column, copied)]
        names = [x for x in b.schema.names if x not in (column, copied)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=[*names, *added])


def cleaned(docs: DataFrame) -> DataFrame:
    """``strip`` with the columns of ``docs`` alone; a column ``n_chars`` follows the new text.

    Only a text that another row has too is left whole: what nothing else
    holds loses its boilerplate lines, however many they are.
    """
    columns = docs.columns
    out = strip(docs, names=(free(columns, "n_lines"), free(columns, "n_removed")), keep_copies=True).select(*[F.col(f"`{c}`") for c in columns])
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
