"""Nearest neighbours by vantage-point trees, one per shard.

Rows are split by the hash of their id into shards of a bounded number of
rows; each shard's tree is built once, where its rows meet, and stored. A
search sends queries in blocks of bounded size to every shard. In a tree,
whole groups of queries walk together: at a node they are parted by the side
of the median sphere they lie on, visit that side first, and then the other
unless the triangle inequality shows that nothing nearer can lie there. The
inequality is relaxed by ``factor``: at one it is exact, above one a side is
left out sooner (less work, less recall).
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.session import cut, ship

#: Rows per shard, about; rows of a leaf; queries per broadcast block.
SHARD_ROWS, LEAF, BLOCK = 16_384, 256, 8_192
K = 10
EVERY = 100


class Tree:
    """Ids and vectors in leaf order, and nodes: vantage point, radius, children."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, float, int, int, int, int]] = []  # row, radius, inner, outer, start, end
        self.order = order
        self._build(0, len(ids))

    def _build(self, start: int, end: int) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, start, end))
        if end - start > LEAF:
            part = self.order[start:end]
            # The row farthest from the part's first: spreads the distances, and is no matter of chance.
            far = part[np.argmax(((self.vectors[part] - self.vectors[part[0]]) ** 2).sum(1))]
            d = np.sqrt(((self.vectors[part] - self.vectors[far]) ** 2).sum(1))
            by = np.argsort(d, kind="stable")
            self.order[start:end] = part[by]
            half = len(part) // 2
            radius = float(d[by[half]])
            inner = self._build(start, start + half)
            outer = self._build(start + half, end)
            self.nodes[me] = (int(far), radius, inner, outer, start, end)
        return me

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors.astype(np.float32) if (self.vectors == self.vectors.astype(np.float32)).all() else self.vectors, order=self.order, nodes=np.array(self.nodes))
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(raw)) as z:
            tree.ids, tree.vectors, tree.order = z["ids"], z["vectors"].astype(np.float64), z["order"]
            tree.nodes = [(int(a), b, int(c), int(d), int(e), int(f)) for a, b, c, d, e, f in z["nodes"]]
        return tree

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the k nearest of each query but itself; -1 and infinity where there are fewer."""
        best_d, best_i = np.full((len(q), k), np.inf), np.full((len(q), k), -1, np.int64)
        id_of = np.append(self.ids, np.iinfo(np.int64).max)

        def leaf(at: np.ndarray, start: int, end: int) -> None:
            rows = self.order[start:end]
            v = self.vectors[rows]
            for part in np.array_split(at, max(1, -(-len(at) * len(rows) // 200_000))):
                d = np.sqrt(((q[part][:, None, :] - v[None]) ** 2).sum(2))
                d[self.ids[rows][None, :] == q_ids[part][:, None]] = np.inf
                d, i = np.hstack([best_d[part], d]), np.hstack([best_i[part], np.broadcast_to(rows, d.shape)])
                i[np.isinf(d)] = -1
                by = np.lexsort((id_of[i], d), axis=1)[:, :k]
                best_d[part], best_i[part] = np.take_along_axis(d, by, 1), np.take_along_axis(i, by, 1)

        def walk(node: int, at: np.ndarray) -> None:
            row, radius, inner, outer, start, end = self.nodes[node]
            if row < 0:
                leaf(at, start, end)
                return
            d = np.sqrt(((q[at] - self.vectors[row]) ** 2).sum(1))
            near = d < radius
            slack = 1e-9 * (1 + radius)
            for side, first, other in ((near, inner, outer), (~near, outer, inner)):
                mine = at[side]
                if len(mine):
                    walk(first, mine)
                    gap = np.abs(d[side] - radius)
                    go = mine[gap * factor <= best_d[mine, -1] + slack]
                    if len(go):
                        walk(other, go)

        if len(self.ids) and len(q):
            walk(0, np.arange(len(q)))
        return best_i, best_d


def valid(rows: DataFrame) -> DataFrame:
    """``vec_id, v`` (array of double) of the rows whose vector takes part.

    Left out are null ids, and vectors that are null, empty, zero, or hold a
    null or non-finite component. Of rows that repeat an id one stays, that
    with the smallest vector.
    """
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", v.alias("v"), bad.alias("bad"))
    return rows.filter(~F.coalesce("bad", F.lit(True))).filter(F.exists("v", lambda x: x != 0)).select("vec_id", "v")


def index(points: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``dim, shard, tree`` from ``vec_id, v``; every row is in one tree of its dimension."""
    n = max(1, -(-points.count() // shard_rows))
    keyed = points.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias("shard"))

    def make(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        vectors = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        by = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[by], vectors[by]
        first = np.append(True, ids[1:] != ids[:-1])
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([Tree(ids[first], vectors[first]).dump()], pa.binary())})

    return keyed.groupBy("dim", "shard").applyInArrow(make, "dim int, shard int, tree binary")


def search(trees: DataFrame, queries: DataFrame, k: int = K, factor: float = 1.0, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows of each ``vec_id, v`` query, but its own.

    Euclidean distance in double precision, ties to the smaller id; of queries
    with one id the smallest vector counts. The driver and each executor hold
    one block of queries at a time, and the stored trees are read once for it.
    """
    spark = trees.sparkSession
    n = max(1, -(-queries.count() // block))
    queries = cut(queries.groupBy("vec_id", F.size("v").alias("dim")).agg(F.min("v").alias("v")).withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(n))))
    found = None
    for b in range(n):
        # About ``block`` rows of one size each, whatever the number of queries.
        rows = queries.filter(F.col("b") == b).select("vec_id", "dim", "v").toArrow()
        dims = rows.column("dim").to_numpy()
        parts = {int(d): rows.filter(pa.array(dims == d)) for d in np.unique(dims)}
        shared = spark.sparkContext.broadcast({d: (t.column("vec_id").to_numpy(), t.column("v").combine_chunks().flatten().to_numpy().reshape(-1, d)) for d, t in parts.items()})
        part = trees.select("dim", "tree").mapInArrow(_searcher(shared, k, factor), "query_id long, vec_id long, score double")
        ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
        part = cut(ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        shared.destroy()
        found = part if found is None else found.union(part)
    return found


def _searcher(shared, k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, raw in zip(batch.column("dim").to_pylist(), batch.column("tree")):
                if dim not in shared.value:
                    continue
                tree = Tree.load(raw.as_py())
                ids, q = shared.value[dim]
                at, _ = tree.search(ids, q, k, factor)
                one, col = np.nonzero(at >= 0)
                rows = at[one, col]
                # The distance itself, summed in order of the components.
                exact = np.sqrt(np.add.accumulate((q[one] - tree.vectors[rows]) ** 2, axis=1)[:, -1])
                yield pa.RecordBatch.from_arrays([pa.array(ids[one]), pa.array(tree.ids[rows]), pa.array(exact)], names=["query_id", "vec_id", "score"])

    return run


def neighbours(rows: DataFrame, k: int = K, factor: float = 1.0, every: int = EVERY) -> DataFrame:
    """Search all valid rows for those whose id is divisible by ``every`` (see ``valid``, ``search``)."""
    ship(rows.sparkSession)
    points = valid(rows)
    trees = cut(index(points))
    return search(trees, points.filter(F.pmod("vec_id", F.lit(every)) == 0), k, factor)
