"""Records of CSV files that are read in blocks, so that no task has to read a whole file.

A block begins with a line, which may lie inside quotes. A first pass says, for
each block, how many records it begins and whether it ends inside quotes, for
either way that it may begin and each kind of line end. From these few numbers
the driver tells how each block begins; a second pass cuts the records.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import ship

_INSIDE = re.compile(rb'[^"]*+(?:""[^"]*+)*+')
LF, CRLF, CR = range(3)
_STARTS = [(kind, opened) for kind in (LF, CRLF, CR) for opened in (False, True)]


def _kind(line: bytes) -> int:
    """The line ends of a file, by the first one that it has."""
    at = line.find(b"\r")
    return LF if at < 0 else CRLF if at == len(line) - 1 else CR


def _parts(line: bytes, kind: int) -> list[bytes]:
    """What a line without its line feed is, where the file has this kind of line ends."""
    return line.split(b"\r") if kind == CR else [line[:-1]] if kind == CRLF and line.endswith(b"\r") else [line]


def _opened(line: bytes, opened: bool) -> bool:
    """Whether quotes are open after a line, if they are before it. What follows closed quotes runs up to the comma."""
    at = 0
    while True:
        if opened or line.startswith(b'"', at):
            at = _INSIDE.match(line, at if opened else at + 1).end()
            if at >= len(line):
                return True
            opened = False
        at = line.find(b",", at) + 1
        if not at:
            return False


def _step(line: bytes, kind: int, opened: bool) -> tuple[bool, int]:
    """Whether quotes are open after a line, and the records that begin in it."""
    n = 0
    for p in _parts(line, kind):
        n += bool(p) and not opened
        opened = _opened(p, opened) if b'"' in p else opened
    return opened, n


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: ends and counts for each of ``_STARTS``, the kind of its first line, the record at its start."""
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [at[0]], "block": [at[1]], "opened": [[s[0] for s in states]], "n": [[s[1] for s in states]], "kind": pa.array([kind], pa.int32()), "head": pa.array([b"\n".join(head)], pa.binary())})

    at = None
    for file, block, line in _lines(batches):
        if (file, block) != at:
            if at:
                yield row()
            at, kind, states, head, reading = (file, block), _kind(line), [(opened, 0) for _, opened in _STARTS], [], block == 0
            inside = False
        if reading:
            for p in _parts(line, kind):
                if reading and (p or inside):
                    head.append(p)
                    inside = _opened(p, inside)
                    reading = inside
        if b'"' not in line and b"\r" not in line:
            if line:
                states = [(opened, n + (not opened)) for opened, n in states]
            continue
        known = {}
        for k, (opened, n) in enumerate(states):
            key = (_STARTS[k][0] if b"\r" in line else LF, opened)
            if key not in known:
                known[key] = _step(line, *key)
            states[k] = (known[key][0], n + known[key][1])
    if at:
        yield row()


def _cutter(starts: dict[tuple[str, int], tuple[int, bool, int]]):
    """Records of blocks; ``split`` are those that another block begins or may go on with."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, at, held = [], 0, None, []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": pa.array([o[0] for o in out], pa.string()), "rec": pa.array([o[1] for o in out], pa.int64()), "block": pa.array([o[2] for o in out], pa.int64()), "split": pa.array([o[3] for o in out], pa.bool_()), "text": pa.array([o[4] for o in out], pa.binary())})

        for file, block, line in _lines(batches):
            if (file, block) != at:
                if held:
                    out.append((*_placed(at, rec), True, b"\n".join(held)))
                at = (file, block)
                kind, opened, n = starts[at]
                rec, held, torn = n - 1, [], opened
            for p in _parts(line, kind):
                if not opened:
                    if not p:
                        continue
                    rec += 1
                held.append(p)
                opened = _opened(p, opened) if b'"' in p else opened
                if not opened:
                    text = b"\n".join(held)
                    out.append((*_placed(at, rec), torn, text))
                    size += len(text)
                    held, torn = [], False
            if size > 1 << 20 or len(out) > 5000:
                yield flush()
                out, size = [], 0
        if held:
            out.append((*_placed(at, rec), True, b"\n".join(held)))
        if out:
            yield flush()

    return cut


def _placed(at: tuple[str, int], rec: int) -> tuple[str, int, int]:
    return at[0], rec, at[1]


def records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """``text, file, row``: the records of CSV files after their headers, which must have these names, with their place from 0."""
    ship(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    found = lines.mapInArrow(_survey, "file string, block bigint, opened array<boolean>, n array<bigint>, kind int, head binary").collect()  # one small row per block
    fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    starts, file, torn = {}, None, False
    for b in sorted(found, key=lambda r: (r["file"], r["block"])):
        if b["file"] != file:
            file, kind, opened, n = b["file"], b["kind"], False, 0
            header = next(csv.reader([bytes(b["head"]).decode("utf-8", "replace").removeprefix("﻿")]), [])
            if list(map(fold, header)) != list(map(fold, names)):
                raise ValueError(f"the header of {file} is {header}, not {names}")
        starts[file, b["block"]] = (kind, opened, n)
        k = _STARTS.index((kind, opened))
        opened, n = b["opened"][k], n + b["n"][k]
        torn |= opened
    each = lines.mapInArrow(_cutter(starts), "file string, rec bigint, block bigint, split boolean, text binary")
    place = ["file", (F.col("rec") - 1).alias("row")]
    out = each.filter("not split and rec > 0").select(F.col("text").cast("string").alias("text"), *place)
    if torn:
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", F.col("text").cast("string").alias("t")))), lambda s: s["t"])
        out = out.union(each.filter("split and rec > 0").groupBy("file", "rec").agg(F.array_join(pieces, "\n").alias("text")).select("text", *place))
    return out
