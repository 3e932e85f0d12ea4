"""Row types that all parts share.

An episode is a row ``identifier, turns`` whose first turn is the system's; an
example is a row ``identifier, prompt, generation``. Both carry ``ord``, the
place of the row in the whole build, since order has meaning: file, row in the
file, part of the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TURN = "struct<utterance:string,kind:string,name:string>"
TURNS = f"array<{TURN}>"
KINDS = ("system", "user", "model")
#: Name that a turn has where none is given.
UNNAMED = "<BOT>"


def turn(utterance: Column | str, kind: str | Column, name: Column | None = None) -> Column:
    """One turn from its parts; strings are column names for the utterance and literals for the kind."""
    text = F.col(utterance) if isinstance(utterance, str) else utterance
    what = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(text.cast("string").alias("utterance"), what.alias("kind"), (F.lit(UNNAMED) if name is None else name).alias("name"))


def turns(*each: Column) -> Column:
    return F.array(*each)
