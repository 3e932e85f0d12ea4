"""Order-bound operators: islands, numbering, offset and limit, lookups, dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import cut


def islands(rows: DataFrame, within: list[str], order: list[str], keys: list[str], into: str = "island") -> DataFrame:
    """Number the runs of equal ``keys`` from 0, in order, within each ``within`` (such as a file).

    Nulls are equal to each other. A key that comes again later starts a new run.
    """
    w = Window.partitionBy(*within).orderBy(*order)
    changed = ~F.struct(*keys).eqNullSafe(F.lag(F.struct(*keys)).over(w))
    return rows.withColumn("_new", F.when(F.lag(F.lit(1)).over(w).isNull(), 0).otherwise(changed.cast("int"))).withColumn(into, F.sum("_new").over(w)).drop("_new")


def gather(rows: DataFrame, within: list[str], order: list[str], island: str = "island", first: tuple[str, ...] = (), last: tuple[str, ...] = (), items: tuple[str, ...] = ()) -> DataFrame:
    """One row per island: ``first`` and ``last`` values, and the ordered array ``items`` of structs."""
    row = F.struct(*order, *[c for c in dict.fromkeys((*first, *last, *items)) if c not in order])
    out = rows.groupBy(*within, island).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    out = out.withColumns({c: F.element_at("_rows", 1)[c] for c in first} | {c: F.element_at("_rows", -1)[c] for c in last})
    if items:
        out = out.withColumn("items", F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in items])))
    return out.drop("_rows")


def without_last(rows: DataFrame, within: list[str], island: str = "island") -> DataFrame:
    """Leave out the last island of each ``within``."""
    return rows.withColumn("_m", F.max(island).over(Window.partitionBy(*within))).filter(F.col(island) < F.col("_m")).drop("_m")


def _ranked(rows: DataFrame, order: list[str | Column], by: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows with their keys, the keys with their rank (``_r``, from 1, within ``by``), and the names of the keys.

    Keys alone are range-partitioned and stored, so both passes see the same
    parts; each part is ranked by itself and shifted by the sizes of those
    before. There is no window over all rows, nor over all of one ``by``.
    """
    keys = [f"_k{k}" for k in range(len(by) + len(order))]
    keyed = rows.withColumns(dict(zip(keys, [F.col(o) if isinstance(o, str) else o for o in (*by, *order)])))
    own, last = keys[: len(by)], keys[len(by) :]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    stored = cut(keyed.select(keys).repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    w = Window.partitionBy(*own).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per part
    shift = stored.groupBy("_part", *own).agg(F.count("*").alias("_n"))
    shift = shift.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_s{c}") for c in own], F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_shift"))
    # Parts, and one row more for each border between values of ``by``.
    same = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in own]]
    within = F.row_number().over(Window.partitionBy("_part", *own).orderBy(*last))
    ranked = stored.withColumn("_in", within).join(F.broadcast(shift) if not own else shift, _all(same))
    return keyed, ranked.select(*[F.col(k).alias(f"_r{k}") for k in keys], (F.col("_shift") + F.col("_in")).alias("_r")), keys


def _all(conditions: list[Column]) -> Column:
    whole = conditions[0]
    for c in conditions[1:]:
        whole = whole & c
    return whole


def _with_rank(keyed: DataFrame, ranked: DataFrame, keys: list[str]) -> DataFrame:
    return keyed.join(ranked, _all([F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys])).drop(*keys, *[f"_r{k}" for k in keys])


def number(rows: DataFrame, order: list[str | Column], into: str = "idx", start: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """Number rows in order, within each value of ``by`` if it is given; ``order`` and ``by`` must tell rows apart."""
    return _with_rank(*_ranked(rows, order, list(by))).withColumn(into, (F.col("_r") + (start - 1)).cast("bigint")).drop("_r")


def counter(rows: DataFrame, by: str, order: list[str], into: str = "n") -> DataFrame:
    """Count from 1 within each value of ``by``, in order; a value that most rows have is no one task's."""
    return number(rows, order, into, 1, (by,))


def window_of(rows: DataFrame, order: list[str], start: int = 0, most: int = 0, mode: str = "reference") -> DataFrame:
    """Offset and limit over rows in order: from the ``start``-th on (1-based), ``most`` of them (0: all).

    Mode ``reference`` gives one row more for a start of 1 and above. Ranks
    decide, so rows stay where they are, however many are passed over or taken.
    """
    first = max(start - 1, 0)
    keyed, ranked, keys = _ranked(rows, order, [])
    ranked = ranked.filter(F.col("_r") > first)
    if most:
        ranked = ranked.filter(F.col("_r") <= first + most + (1 if mode == "reference" and start >= 1 else 0))
    return _with_rank(keyed, ranked, keys).drop("_r")


def source_cap(rows: DataFrame, order: list[str], most: int, mode: str = "reference") -> DataFrame:
    """The first ``most`` rows; one more in mode ``reference``."""
    return window_of(rows, order, 1, most, mode)


def chain(*parts: DataFrame) -> DataFrame:
    """Rows of several tables, one after the other, with ``part`` (0-based) as a leading order key."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("part", F.lit(k))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def override(rows: DataFrame, other: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Left lookup: the last row of ``other`` per key, by ``order``, replaces all ``columns`` of its match.

    Which side is small is for the planner to know; nothing is broadcast here.
    """
    latest = other.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_o"))
    own = F.struct(*columns)
    out = rows.join(latest, key, "left").withColumn("_o", F.coalesce("_o", own))
    return out.withColumns({c: F.col("_o")[c] for c in columns}).drop("_o")


def constant_map(value: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """A value's entry in a fixed table; null, or the default, where there is none."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(entries, value)
    return found if default is None else F.coalesce(found, default)


def dedup(examples: DataFrame, order: list[str]) -> DataFrame:
    """The first example, in order, of each prompt and generation joined without a mark between.

    A null prompt or generation counts as an empty one. Nulls in ``order`` come first.
    """
    digest = F.sha2(F.concat(F.coalesce("prompt", F.lit("")), F.coalesce("generation", F.lit(""))).cast("binary"), 512)
    # Only digests and places are compared; the texts of copies are not sorted.
    first = examples.groupBy(digest.alias("_d")).agg(F.min(F.struct(*order)).alias("_first"))
    return examples.withColumn("_d", digest).join(first, "_d").filter(F.struct(*order).eqNullSafe(F.col("_first"))).drop("_d", "_first")
