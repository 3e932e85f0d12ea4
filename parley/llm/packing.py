"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are encoded and end with one separator id; longer ones are cut so
that only their first piece is shorter than a sequence. Pieces are packed in
bulk-synchronous supersteps, from long to short, by classes of length (more
than a half of a sequence, more than a quarter, and so on):

1. Pieces of the class and gaps (what is free in sequences) are range-sorted
   together by size, largest first.
2. A sweep over that order matches each piece with its successor, the smallest
   gap that holds it. Pieces that ask for one gap are told apart by their rank:
   the first takes it, the next takes the next larger gap that is left. A sweep
   is a matching of brackets, gaps open and pieces close; every task sweeps its
   own range, and what is left of the ranges, one piece or gap a level each, is
   matched across them by level.
3. Gaps are updated, and the sweep is repeated with the pieces that are left,
   as long as it places a good part of them.
4. What fits nowhere opens new sequences, in best-fit order within each task.

A gap that holds several pieces of the class whatever their lengths takes part
as so many gaps. A class so needs a number of sweeps that the sequence size
bounds, not the data. Each row is a piece or a gap; none is gathered anywhere,
and a task holds ``ROWS`` rows or so. The driver sees one row of totals a step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.bpe import compiled
from parley.llm.session import cut, ship

SIZE = 1024
SEPARATOR = 2
#: Pieces and gaps of one task, about.
ROWS = 250_000
#: A sweep is repeated if it placed at least one in so many of the pieces before it.
WORTH = 8
PIECE = ["pid", "doc_id", "piece", "start", "length", "ids_crc32"]


def pieces(docs: DataFrame, path: str, size: int = SIZE, separator: int = SEPARATOR) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every row of ``doc_id, text``.

    A null or empty text is a piece of the separator alone. Only the first
    piece of a cut document is shorter than ``size``.
    """
    ship(docs.sparkSession)
    last = int(separator).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = compiled(path)
        for batch in batches:
            doc, k, start, length, crc = [], [], [], [], []
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for row, i in enumerate(ids):
                raw = coder.encode(texts[row].as_py()) + last
                n = len(raw) // 4
                at = 0
                for piece in range(-(-n // size)):
                    m = (n - 1) % size + 1 if piece == 0 else size
                    doc.append(i)
                    k.append(piece)
                    start.append(at)
                    length.append(m)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + m)]))
                    at += m
            yield pa.RecordBatch.from_arrays([pa.array(doc, batch.schema.field("doc_id").type), pa.array(k, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], size: int = SIZE) -> tuple[np.ndarray, int]:
    """Best fit decreasing into new sequences, for ``counts[length]`` pieces of each length below ``size``.

    Equal pieces are one run, sequences with one gap and history another.

    Rows of the result: length, first rank, number of ranks, first sequence,
    offset; rank r of a length goes to sequence ``first + r - rank``. Also the
    number of sequences.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by gap: (first sequence, number)
    slots: list[tuple[int, int, int, int, int]] = []
    made = 0
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left, gap = 0, counts[length], length
        while left:
            while gap < size and not gaps[gap]:
                gap += 1
            if gap < size:
                first, number = gaps[gap].pop()
                take = min(left, number)
                if take < number:
                    gaps[gap].append((first + take, number - take))
                slots.append((length, rank, take, first, size - gap))
                gaps[gap - length].append((first, take))
                rank, left, gap = rank + take, left - take, max(length, gap - length) if gap - length >= length else gap
                continue
            each = size // length
            for per, number in ((each, left // each), (left % each, 1)):
                if per and number:
                    for k in range(per):
                        slots.append((length, rank + k * number, number, made, k * length))
                    gaps[size - per * length].append((made, number))
                    made, rank = made + number, rank + per * number
            left = 0
    return np.array(slots, dtype=np.int64).reshape(-1, 5), made


def brackets(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Match gaps (0) and pieces (1), given by size from the largest on, gaps first among equal sizes.

    Places of the matched gaps and of their pieces, and the level of each row:
    at one level gaps and pieces take turns, so a gap's piece is the next row of its level.
    """
    level = np.cumsum(1 - 2 * kind) + kind
    by = np.argsort(level, kind="stable")
    a, b = by[:-1], by[1:]
    fit = (level[a] == level[b]) & (kind[a] == 0) & (kind[b] == 1)
    return a[fit], b[fit], level


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match the rows of one range: ``to`` is a piece's sequence, ``rest`` what a gap has left."""
    table = pa.Table.from_batches(list(batches))
    if not table.num_rows:
        return
    size, kind, seq = (table.column(c).to_numpy() for c in ("size", "kind", "seq"))
    gap, piece, level = brackets(kind.astype(np.int64))
    to, rest = np.full(len(size), -1, np.int64), np.where(kind == 0, size, 0)
    to[piece] = seq[gap]
    rest[gap] -= size[piece]
    free = np.ones(len(size), bool)
    free[gap] = free[piece] = False
    table = table.append_column("to", pa.array(to, pa.int64(), mask=to < 0)).append_column("rest", pa.array(rest)).append_column("free", pa.array(free))
    table = table.append_column("level", pa.array(level)).append_column("range", pa.array(np.full(len(size), TaskContext.get().partitionId(), np.int32)))
    yield from table.to_batches(max_chunksize=50_000)


def sweep(todo: DataFrame, gaps: DataFrame, most: int, rows: int = ROWS) -> DataFrame:
    """One superstep, stored: rows of pieces (``kind`` 1; ``to``, null if none fits) and of gaps (0; ``rest``).

    ``todo`` has the columns of ``PIECE``, none longer than ``most``; ``gaps``
    has ``seq, gap``. A gap of several times ``most`` is so many rows.
    """
    n = F.greatest(F.lit(1), F.floor(F.col("gap") / most)).cast("int")
    slots = F.concat(F.array(F.col("gap") - (n - 1) * most), F.array_repeat(F.lit(most).cast("long"), n - 1))
    slots = gaps.select("seq", F.posexplode(slots).alias("slot", "size"))
    none = [F.lit(None).cast(t).alias(c) for c, t in todo.select(PIECE).dtypes]
    items = slots.select("size", F.lit(0).alias("kind"), "seq", "slot", *none)
    items = items.union(todo.select(F.col("length").alias("size"), F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("seq"), F.lit(0).alias("slot"), *PIECE))
    order: list[Column] = [-F.col("size"), F.col("kind"), F.xxhash64("seq", "pid", "slot"), F.col("seq"), F.col("pid"), F.col("slot")]
    parts = max(1, -(-items.count() // rows))
    types = ", ".join(f"{c} {t}" for c, t in items.dtypes)
    swept = items.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_sweep, f"{types}, to long, rest long, free boolean, level long, range int")
    swept = cut(swept)
    if parts == 1:  # one range: nothing lies across
        return swept
    # Levels go on from range to range; of each, a range has one free piece before one free gap at most.
    shift = swept.groupBy("range").agg(F.sum(1 - 2 * F.col("kind")).alias("net"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per task
    shift = shift.select("range", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("shift"))
    w = Window.partitionBy("level").orderBy("range", F.desc("kind"))
    left = swept.filter("free").join(shift, "range").withColumn("level", F.col("level") + F.col("shift"))
    left = left.withColumns({"_to": F.when((F.col("kind") == 1) & (F.lag("kind").over(w) == 0), F.lag("seq").over(w)), "_use": F.when((F.col("kind") == 0) & (F.lead("kind").over(w) == 1), F.lead("size").over(w))})
    left = left.withColumns({"to": F.col("_to"), "rest": F.col("rest") - F.coalesce("_use", F.lit(0))})
    return cut(swept.filter("not free").union(left.select(swept.columns)))


def opened(todo: DataFrame, n: int, size: int, rows: int = ROWS) -> DataFrame:
    """Pieces in sequences of their own, stored: ``to`` (the id of the sequence's first piece), and ``rest`` in its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        table = table.sort_by([("length", "descending"), ("pid", "ascending")])
        length, pid = table.column("length").to_numpy(), table.column("pid").to_numpy()
        kinds, counts = np.unique(length, return_counts=True)
        slots, made = plan(dict(zip(kinds.tolist(), counts.tolist())), size)
        start = {int(k): int(np.searchsorted(-length, -k)) for k in kinds}
        seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for k, rank, number, first, at in slots.tolist():
            a = start[k] + rank
            seq[a : a + number], offset[a : a + number] = np.arange(first, first + number), at
        name = np.zeros(made, np.int64)
        name[seq[offset == 0]] = pid[offset == 0]
        used = np.bincount(seq, length, made).astype(np.int64)
        table = table.append_column("to", pa.array(name[seq])).append_column("rest", pa.array(size - used[seq], pa.int64(), mask=offset > 0))
        yield from table.to_batches(max_chunksize=50_000)

    todo = todo.select(PIECE)
    types = ", ".join(f"{c} {t}" for c, t in todo.dtypes)
    return cut(todo.repartition(max(1, -(-n // rows)), F.xxhash64("pid")).mapInArrow(run, f"{types}, to long, rest long"))


def place(parts: DataFrame, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """Add ``sequence_id, offset`` to a stored table of pieces (see ``pieces``) with a unique ``pid`` each."""
    parts = parts.select(PIECE)
    half = F.col("length") * 2 > size
    alone = parts.filter(half).withColumn("to", F.col("pid"))
    placed = [alone.filter(F.col("length") < size)]
    pool = alone.select(F.col("to").alias("seq"), (size - F.col("length")).alias("gap")).filter("gap > 0")
    # At most ``size`` lengths, whatever the input.
    known = {r["length"]: r["n"] for r in parts.filter(~half).groupBy("length").agg(F.count("*").alias("n")).collect()}
    most = size // 2
    while most:
        low = most // 2
        n = sum(k for x, k in known.items() if low < x <= most)
        least = min((x for x in known if low < x <= most), default=0)
        todo = parts.filter((F.col("length") > low) & (F.col("length") <= most))
        parked, active = [], pool
        while n:
            parked.append(active.filter(F.col("gap") < least))
            done = sweep(todo, active.filter(F.col("gap") >= least), most, rows)
            fits = done.filter("kind = 1")
            placed.append(fits.filter("to is not null").select(*PIECE, "to"))
            todo, was = fits.filter("to is null"), n
            active = done.filter("kind = 0").groupBy("seq").agg(F.sum("rest").alias("gap")).filter("gap > 0")
            n, least = todo.agg(F.count("*"), F.min("length")).first()
            if n and (was - n) * WORTH < was:
                new = opened(todo, n, size, rows)
                placed.append(new.select(*PIECE, "to"))
                parked.append(new.filter("rest > 0").select(F.col("to").alias("seq"), F.col("rest").alias("gap")))
                n = 0
            if not n:
                parked.append(active)
        if parked:
            pool = cut(_union(parked).coalesce(max(1, -(-sum(known.values()) // rows), int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
        most = low
    whole = alone.filter(F.col("length") == size).select(*PIECE[1:], F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # A sequence holds ``size`` pieces at most: that bounds the window.
    before = Window.partitionBy("to").orderBy(F.desc("length"), "pid").rowsBetween(Window.unboundedPreceding, -1)
    rest = _union(placed).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return rest.select(*PIECE[1:], F.col("to").alias("sequence_id"), "offset").union(whole)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole


def pack(docs: DataFrame, path: str, size: int = SIZE, separator: int = SEPARATOR) -> DataFrame:
    """Pack every row of ``doc_id, text``; see ``pieces`` and ``place``.

    Null and empty texts are packed as the separator alone; repeated rows are
    packed each; an empty table gives no row. Other columns are ignored. The
    encoded pieces (numbers only, no text) are cut into the shared checkpoint
    folder, so their ``pid`` does not depend on a second run of the encoder.
    """
    return place(cut(pieces(docs, path, size, separator).withColumn("pid", F.monotonically_increasing_id())), size)
