"""What the readers share: where data lies, places of rows, registry, rejects.

A reader is a function ``(spark, root) -> DataFrame`` with an explicit schema
and the columns ``file`` and ``row`` (place in the file) that order its rows.
Rows that can't be read as asked are left out; ``rejects(name, …)`` gives them
with a reason.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.sources import csv_blocks

Reader = Callable[..., DataFrame]
READERS: dict[str, Reader] = {}
_REJECTS: dict[str, Callable[..., DataFrame]] = {}
ROOT_CONF, ROOT_ENV = "spark.parley.data", "PARLEY_DATA"


def data_root(spark: SparkSession) -> str:
    """Folder of the sources: the session's ``spark.parley.data``, else the environment's, else ``data``."""
    return spark.conf.get(ROOT_CONF, None) or os.environ.get(ROOT_ENV) or "data"


def reader(name: str) -> Callable[[Reader], Reader]:
    """Register a reader under the name of its folder."""
    def add(f: Reader) -> Reader:
        READERS[name] = f
        return f

    return add


def rejecting(name: str) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _REJECTS[name] = f
        return f

    return add


def read(spark: SparkSession, name: str, root: str | None = None, **options) -> DataFrame:
    if name not in READERS:
        raise ValueError(f"unknown source {name!r}; there are {', '.join(sorted(READERS))}")
    return READERS[name](spark, f"{root or data_root(spark)}/{name}", **options)


def rejects(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """``file, row, reason`` of what a reader left out; empty for readers that leave out nothing."""
    if name not in _REJECTS:
        return spark.createDataFrame([], "file string, row bigint, reason string")
    return _REJECTS[name](spark, f"{root or data_root(spark)}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names at least one file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "%20", " "), "/"), -1)


def placed(df: DataFrame) -> DataFrame:
    """Add ``file`` and ``row``: rows of files that are read whole, in the order of the scan."""
    return df.withColumn("file", F.col("_metadata.file_path")).withColumn("row", F.monotonically_increasing_id())


def placed_rows(df: DataFrame) -> DataFrame:
    """Add ``file`` and ``row``, the place in a Parquet file, from 0."""
    return df.withColumn("file", F.col("_metadata.file_path")).withColumn("row", F.col("_metadata.row_index"))


def placed_blocks(df: DataFrame) -> DataFrame:
    """Add ``file`` and ``row``, the place from 0 in a file that is read in blocks.

    A first pass counts the rows of each block; those of the blocks before it shift a block's own.
    """
    at = df.select(*df.columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    shift = at.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    shift = shift.select("file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return at.join(F.broadcast(shift), ["file", "_block"]).select(*df.columns, "file", (F.col("_id") + F.col("_shift")).alias("row"))


def json_lines(spark: SparkSession, path: str, schema: str, array: bool = False) -> DataFrame:
    """Rows of JSON Lines, or of files that hold one array each; broken lines become rows of nulls."""
    df = spark.read.schema(schema).option("multiLine", array).option("mode", "PERMISSIVE").json(path)
    return placed(df) if array else placed_blocks(df)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, doubled quotes, line feeds inside quotes and fields of any length; empty fields are empty texts."""
    names = StructType.fromDDL(schema).fieldNames()
    d = csv_blocks.records(spark, path, names)
    d = d.withColumn("_v", F.from_csv("text", F.lit(schema), {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}))
    return d.select(*[F.coalesce(F.col("_v").getField(n), F.lit("")).alias(n) for n in names], "file", "row")


def documents(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``file, value``: whole texts of files, UTF-8, without byte order mark, line ends as line feeds."""
    df = spark.read.option("recursiveFileLookup", recursive).text(path, wholetext=True)
    clean = F.regexp_replace(F.regexp_replace("value", "^\\uFEFF", ""), "\\r\\n?", "\n")
    return df.select(F.col("_metadata.file_path").alias("file"), clean.alias("value"))

