"""Quality classifier: hashed word n-gram logistic regression, FTRL-proximal.

A text is a sparse vector of shares: of its words and word pairs, and of pairs
of word forms. A form is what a word looks like (case, digits, symbols around
it) and how it recurs: the same as the word before, or part of a run of three
words that the text had before. All are hashed into ``DIM`` weights. Training
takes one pass after the other over a bounded sample, updating weights by
follow-the-regularised-leader; a score is the dot product through a sigmoid.

Only the text is an input of a score. Labels of held-out rows are never read
for training: those whose crc32 of doc_id, as text, leaves 0 modulo ``FOLDS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.session import ship

DIM = 1 << 18
FOLDS = 5
THRESHOLD = 0.3
#: Labelled documents that are fitted at most: those with the smallest hash of their doc_id.
SAMPLE = 4_000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 2.0, 1.0, 0.0005, 0.0001
#: Words whose hash and form a worker remembers.
CACHE = 120_000
_MASK = np.uint64(DIM - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is never learnt from; null ids are held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(True))


class _Words(dict):
    """Hash (upper 56 bits) and form (lower 8) of each word."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        code = ((zlib.crc32(raw) << 24 ^ zlib.crc32(raw[::-1]) & 0xFFFFFF) << 8 | _form(word)) & (1 << 63) - 1
        self[word] = code
        return code


def _form(word: str) -> int:
    last = word[-1]
    ending = _ENDINGS.get(last, 0 if last.isalnum() else 4)
    core = word[:-1] if ending else word
    if core.isalpha():
        mixed = many = 0
    else:
        mixed = (1 if any(map(str.isalpha, core)) else 2) if any(map(str.isdigit, core)) else 0
        many = any(not c.isalnum() for c in core)
    case = 3 if core.isupper() and len(core) > 1 else 1 if core.islower() else 2 if core[:1].isupper() else 0
    return case | ending << 2 | mixed << 5 | many << 7


_ENDINGS = {",": 1, ";": 1, ":": 1, ".": 2, "?": 2, "…": 2, "!": 3}
_words = _Words()


def features(text: str | None) -> np.ndarray:
    """Indices of the hashed features of a text, each as often as it occurs; none for a text without words."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    code = np.fromiter(map(_words.__getitem__, words), np.int64, n).astype(np.uint64)
    h, form = code >> np.uint64(8), code & np.uint64(255)
    with np.errstate(over="ignore"):
        pair = h[:-1] * _A + h[1:] * _B
        recur = np.zeros(n, np.uint64)
        recur[1:][h[1:] == h[:-1]] = 1
        if n > 2:
            three = pair[:-1] + h[2:] * _C
            order = np.argsort(three, kind="stable")
            again = np.flatnonzero(three[order[1:]] == three[order[:-1]])
            recur[order[again + 1]] |= np.uint64(2)
        look = (form << np.uint64(2) | recur) + np.uint64(1)
        parts = [h * _A, pair, look * _C, (look[:-1] * _A ^ look[1:]) * _C]
        parts = [(p >> np.uint64(23) ^ p >> np.uint64(47)) & _MASK for p in parts]
    return np.concatenate(parts).astype(np.int64)


def weigh(index: np.ndarray, weights: np.ndarray, bias: float) -> float:
    """Score of a text from 0 to 1; a text without words has the bias alone."""
    z = bias + (4.0 * float(weights[index].sum()) / len(index) if len(index) else 0.0)
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def fit(examples: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """FTRL-proximal over (indices, label) examples; no example gives a model that scores one half."""
    z, n = np.zeros(DIM), np.zeros(DIM)
    bz = bn = 0.0
    sparse = []
    for index, label in examples:
        at, count = np.unique(index, return_counts=True)
        sparse.append((at, 4.0 * count / max(len(index), 1), label))

    def solve(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, label in sparse:
            w = solve(z[at], n[at])
            bias = -bz / ((BETA + bn**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -30, 30)))
            g = (p - label) * x
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - s * w
            n[at] += g * g
            bg = float(p - label)
            bz += bg - ((bn + bg * bg) ** 0.5 - bn**0.5) / ALPHA * bias
            bn += bg * bg
    return solve(z, n).astype(np.float32), -bz / ((BETA + bn**0.5) / ALPHA)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights and bias, from at most ``sample`` labelled documents outside the held-out fold.

    Rows with a null id or label do not count; several labels of one document
    count as their largest. Features are made where the documents are; only
    they meet in the one task that fits them, in the order of a hash.
    """
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    known = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers: of a proven size.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = [features(t).astype("<i4").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("doc_id"), b.column("quality"), pa.array(vectors, pa.binary())], names=["h", "doc_id", "quality", "x"])
        _words.clear()  # a worker that waits for its next task should hold little

    kind = docs.schema["doc_id"].dataType.simpleString()
    vectors = rows.select("h", "doc_id", "quality", "text").mapInArrow(make, f"h long, doc_id {kind}, quality int, x binary")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = sorted((h, str(i), x, q) for b in batches for h, i, q, x in zip(*(c.to_pylist() for c in b.columns)))
        w, bias = fit([(np.frombuffer(x, "<i4").astype(np.int64), q) for _, _, x, q in examples])
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([bias])], names=["w", "bias"])

    model = vectors.repartition(1).mapInArrow(learn, "w binary, bias double").first()
    if model is None:  # nothing to learn from, and the plan came out empty
        return np.zeros(DIM, np.float32), 0.0
    return np.frombuffer(model["w"], np.float32), model["bias"]


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", into: str = "score") -> DataFrame:
    """Add ``into`` (double) to every row; null and empty texts are scored by the bias."""
    ship(docs.sparkSession)
    docs = docs.drop(into)
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))  # DIM numbers, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b0 = shared.value
        for b in batches:
            scores = [weigh(features(t), w, b0) for at in range(0, b.num_rows, 256) for t in b.column(text).slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, into])
        _words.clear()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``doc_id, text``.

    Empty and null texts are scored too. Without labels all scores are one
    half. Repeated rows are scored each; other columns are ignored.
    """
    scored = score(docs.select("doc_id", "text"), *train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose predicted label is 1."""
    columns = docs.columns
    name = "score"
    while name in columns:
        name = f"_{name}"
    return score(docs, *train(docs, labels), into=name).filter(F.col(name) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in columns])

