"""Examples from a stream of episodes: the same expressions, and dedup with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import picks
from parley.operators import filters, windowing
from parley.schema import TURNS


def read_episodes(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A stream of JSON Lines files of ``identifier, turns, at`` episodes."""
    return spark.readStream.schema(f"identifier string, turns {TURNS}, at timestamp").option("maxFilesPerTrigger", max_files).json(path)


def examples(episodes: DataFrame, budget: int = windowing.BUDGET, fmt: str = "markers", policy: str = "reference", delay: str = "1 hour", seed: int = picks.SEED) -> DataFrame:
    """Examples without refusals; of equal ones within ``delay`` of each other one stays."""
    made = windowing.examples(episodes, budget, fmt, policy, seed).filter(~filters.refuses(F.col("generation")))
    made = made.withColumn("digest", F.sha2(F.concat("prompt", "generation").cast("binary"), 512))
    return made.withWatermark("at", delay).dropDuplicatesWithinWatermark(["digest"]).drop("digest")


def start(stream: DataFrame, path: str, checkpoint: str):
    """Write a stream of examples as JSON Lines, once per example."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
