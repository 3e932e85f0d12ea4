"""Conversations to episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import picks, templates
from parley.schema import UNNAMED

#: Opening instructions for conversations without one.
SYSTEM = (
    "%{You are|Act as} a helpful assistant.",
    "%{Answer|Reply to} the user's %{questions|messages}.",
    "Enter assistant mode.",
)
ROLES = {"assistant": "model", "user": "user", "system": "system"}


def from_messages(messages: DataFrame, seed: int = picks.SEED) -> DataFrame:
    """``identifier, turns`` and ``ord`` of ``conv_id, turn, role, text`` rows.

    Rows of other roles or without a text or turn don't count. A conversation that does not
    start with the system's turn gets one, chosen by its id.
    """
    kind = F.when(F.col("role") == "assistant", "model").otherwise(F.col("role"))
    rows = messages.filter(F.col("role").isin(*ROLES) & F.col("text").isNotNull() & F.col("turn").isNotNull())
    each = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("utterance"), kind.alias("kind")))).alias("t"))
    said = F.transform("t", lambda t: F.struct(t["utterance"].alias("utterance"), t["kind"].alias("kind"), F.lit(UNNAMED).alias("name")))
    opening = F.array(F.struct(picks.from_bank(templates.bank(SYSTEM), F.col("conv_id"), "system", seed).alias("utterance"), F.lit("system").alias("kind"), F.lit(UNNAMED).alias("name")))
    starts = F.get("t", F.lit(0))["kind"] == "system"
    return each.select(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("identifier"), F.when(starts, said).otherwise(F.concat(opening, said)).alias("turns"), F.col("conv_id").alias("ord"))
