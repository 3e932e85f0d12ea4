"""Folds that cut long texts into chunks, as expressions with small states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions import text as T

_PARTS = "struct<done:array<string>,cur:string,n:bigint>"
_TOLD = "array<struct<kind:string,text:string>>"


def _state(done: Column, cur: Column, n: Column, kind: str = _PARTS) -> Column:
    return F.struct(done.alias("done"), cur.alias("cur"), n.alias("n")).cast(kind)


def _empty(kind: str = "array<string>") -> Column:
    return F.array().cast(kind)


def remerge(message: Column, target: Column | int, mark: str = "<br/><br/>") -> Column:
    """Split at ``mark`` and merge neighbours again while both have at most ``target`` words.

    Words are counted on what was merged, where the mark glues the words around it.
    """
    target = F.lit(target) if isinstance(target, int) else target
    parts = F.split(message, f"\\Q{mark}\\E", -1)

    def step(s: Column, p: Column) -> Column:
        n = T.word_count(p)
        merged = F.concat(s["cur"], F.lit(mark), p)
        return F.when(s["cur"].isNull(), _state(s["done"], p, n)).when(s["n"] + n <= target, _state(s["done"], merged, T.word_count(merged))).otherwise(_state(F.concat(s["done"], F.array(s["cur"])), p, n))

    return F.aggregate(parts, _state(_empty(), F.lit(None), F.lit(0)), step, lambda s: F.array_compact(F.concat(s["done"], F.array(s["cur"]))))


def paragraphs(story: Column, more_than: int = 250, keep_rest: bool = False) -> Column:
    """Chunks of whole paragraphs, each cut once it has over ``more_than`` words; the rest is dropped unless kept."""
    def step(s: Column, p: Column) -> Column:
        cur, n = F.concat(s["cur"], F.lit("\n\n"), p), s["n"] + T.word_count(p)
        return F.when(n > more_than, _state(F.concat(s["done"], F.array(T.strip(cur))), F.lit(""), F.lit(0))).otherwise(_state(s["done"], cur, n))

    def end(s: Column) -> Column:
        return F.when(F.lit(keep_rest) & (s["n"] > 0), F.concat(s["done"], F.array(T.strip(s["cur"])))).otherwise(s["done"])

    return F.aggregate(F.split(story, "\n\n", -1), _state(_empty(), F.lit(""), F.lit(0)), step, end)


def adventure(story: Column, at_least: int = 300, markers: tuple[str, ...] = ("<|startoftext|>", "<|endoftext|>"), keep_rest: bool = False) -> Column:
    """``kind, text`` turns of a text adventure.

    Lines that start with ``> `` are the user's, and come out before the text
    that is being gathered; the rest is the model's, cut at ``at_least`` words.
    Blank commands are skipped, and the unfinished rest is dropped unless kept.
    """
    kind = f"struct<done:{_TOLD},cur:string,n:bigint>"
    item = lambda k, t: F.array(F.struct(F.lit(k).alias("kind"), t.alias("text")))

    def step(s: Column, line: Column) -> Column:
        said = T.strip(F.replace(line, F.lit("> "), F.lit("")))
        told = line
        for m in markers:
            told = T.literal(told, m, "")
        cur, n = F.concat(s["cur"], T.strip(told), F.lit("\n")), s["n"] + T.word_count(told)
        model = F.when(n >= at_least, _state(F.concat(s["done"], item("model", T.squeeze_newlines(cur, 3))), F.lit(""), F.lit(0), kind)).otherwise(_state(s["done"], cur, n, kind))
        return F.when(line.startswith("> "), F.when(said == "", s.cast(kind)).otherwise(_state(F.concat(s["done"], item("user", said)), s["cur"], s["n"], kind))).otherwise(model)

    def end(s: Column) -> Column:
        return F.when(F.lit(keep_rest) & (s["n"] > 0), F.concat(s["done"], item("model", T.squeeze_newlines(s["cur"], 3)))).otherwise(s["done"])

    return F.aggregate(T.lines(story), _state(_empty(_TOLD), F.lit(""), F.lit(0), kind), step, end)
