"""Episodes to examples: token budgets, context windows, prompts.

A window is the system turn and a slice of the turns after it. The fold over
an episode carries indices and sums only; texts are touched once, to count
their tokens, and once more, to join a prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import formats, hints, picks, text

BUDGET = 2048
#: Tokens kept free for placeholders that are filled in later.
RESERVE = 32
POLICIES = ("reference", "sliding")
_STATE = "struct<start:int,n:bigint,failed:boolean,out:array<struct<start:int,end:int>>>"


def windows(kinds: Column, costs: Column, budget: int, policy: str = "reference") -> Column:
    """``start, end`` of the context of every model turn that fits (indices from 0; the system turn is 0).

    ``sliding`` evicts the oldest turns until the new one fits and fails where
    the system turn and the new one are too much. ``reference`` evicts one turn
    at most: it fails if room is then left, or nothing is there to evict, and
    else goes on, over budget if need be. After a failure nothing more comes.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    ordinal = F.when(F.size(kinds) > 1, F.sequence(F.lit(1), F.size(kinds) - 1)).otherwise(F.array().cast("array<int>"))
    first = F.struct(F.lit(1).alias("start"), F.get(costs, F.lit(0)).cast("bigint").alias("n"), F.lit(False).alias("failed"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(s: Column, i: Column) -> Column:
        cost = F.get(costs, i).cast("bigint")
        over = s["n"] + cost > budget
        if policy == "reference":
            gone = F.coalesce(F.get(costs, s["start"]), F.lit(0)).cast("bigint")
            failed = over & ((s["start"] >= i) | (s["n"] - gone + cost < budget))
            start = F.when(over, s["start"] + 1).otherwise(s["start"])
            n = F.when(over, s["n"] - gone).otherwise(s["n"]) + cost
        else:
            room = F.lit(budget) - F.get(costs, F.lit(0)) - cost
            failed = room < 0
            # The longest run of turns just before this one that leaves room for it.
            back = F.aggregate(
                F.when(s["start"] < i, F.sequence(i - 1, s["start"], F.lit(-1))).otherwise(F.array().cast("array<int>")),
                F.struct(i.alias("start"), F.lit(0).cast("bigint").alias("sum"), F.lit(True).alias("on")),
                lambda b, k: F.when(b["on"] & (b["sum"] + F.get(costs, k) <= room), F.struct(k.alias("start"), (b["sum"] + F.get(costs, k)).alias("sum"), F.lit(True).alias("on"))).otherwise(F.struct(b["start"].alias("start"), b["sum"].alias("sum"), F.lit(False).alias("on"))),
            )
            start = F.when(over, back["start"]).otherwise(s["start"])
            n = F.when(over, F.get(costs, F.lit(0)) + back["sum"]).otherwise(s["n"]) + cost
        emit = F.get(kinds, i) == "model"
        span = F.struct(start.cast("int").alias("start"), i.cast("int").alias("end"))
        out = F.when(emit, F.concat(s["out"], F.array(span))).otherwise(s["out"])
        kept = F.struct(s["start"].alias("start"), s["n"].alias("n"), F.lit(True).alias("failed"), s["out"].alias("out"))
        moved = F.struct(start.cast("int").alias("start"), n.cast("bigint").alias("n"), F.lit(False).alias("failed"), out.alias("out"))
        return F.when(s["failed"] | failed, kept).otherwise(moved)

    return F.aggregate(ordinal, first.cast(_STATE), lambda s, i: step(s, i).cast(_STATE), lambda s: s["out"])


def examples(episodes: DataFrame, budget: int = BUDGET, fmt: str = "markers", policy: str = "reference", seed: int = picks.SEED) -> DataFrame:
    """``prompt, generation, identifier`` of every model turn, with its place ``ex`` in the episode.

    Other columns of the episodes stay. Episodes that are null, empty, or do
    not start with the system's turn give no example. A prompt in the format of
    markers that does not start with the system's marker ends the job.
    """
    name, as_text, lead_in = formats.lookup(fmt)
    rest = [c for c in episodes.columns if c not in ("identifier", "turns")]
    fine = episodes.filter((F.size("turns") > 0) & (F.get("turns", F.lit(0))["kind"] == "system"))
    read = fine.withColumn("_said", F.transform("turns", as_text))
    read = read.withColumn("_cost", F.transform("_said", text.token_estimate)).withColumn("_kind", F.transform("turns", lambda t: t["kind"]))
    each = read.select("*", F.posexplode(windows(F.col("_kind"), F.col("_cost"), budget - RESERVE, policy)).alias("ex", "_w"))
    last = F.get("turns", F.col("_w.end"))
    past = F.slice("_said", F.col("_w.start") + 1, F.col("_w.end") - F.col("_w.start"))
    prompt = F.concat(F.get("_said", F.lit(0)), F.array_join(past, ""), lead_in(last))
    if name == "markers":
        prompt = F.when(prompt.startswith("<|system|>"), prompt).otherwise(F.raise_error(F.concat(F.lit("a prompt does not start with the system's turn: "), F.left(prompt, F.lit(200)))))
    reply = text.strip(last["utterance"])
    each = each.select(*rest, "ex", F.concat_ws("-", "identifier", F.col("ex").cast("string")).alias("identifier"), prompt.alias("prompt"), F.concat(reply, F.lit(formats.ENDINGS.get(name, ""))).alias("generation"))
    key = F.col("identifier")
    filled = F.replace(F.col("prompt"), F.lit("{{response_style_str}}"), hints.style(F.col("generation"), key, seed))
    filled = F.replace(filled, F.lit("{{response_length_str}}"), hints.length(F.col("generation"), key, seed))
    return each.withColumn("prompt", filled).select("prompt", "generation", "identifier", *rest, "ex")
