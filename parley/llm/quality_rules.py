"""Quality rules: base counts, then a linear-chain CRF over a document's lines.

The base rules count words, symbols, repeated lines and repeated windows of
words. Documents that pass them are labelled line by line: a linear-chain
conditional random field with two states, content and boilerplate, is decoded
by Viterbi, and the share of words in content lines decides retention.

The field is trained here, by gradient ascent on the conditional likelihood
(forward-backward), on the lines of a bounded sample of labelled documents.
Lines have labels of their own: boilerplate is a line that a line before it
repeats, one that many sites share (see ``line_dedup``; not in a document that
consists of such lines, which is a copy), and every line of a bad document; all
others are content. So one document can hold both, and the weights of going
from one state to the other are learnt. Lines are seen through what any
language has: length, case, symbols, digits, ending, recurrence of words and
lines, place in the document; and through their words, hashed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import line_dedup
from parley.llm.session import ship

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DIGIT = re.compile("[0-9]")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Least share of a document's words in lines that the field calls content.
CONTENT_SHARE = 0.5
#: Labelled documents that the field is fitted on at most: the fit is bounded, the verdicts are not.
SAMPLE = 1_500
STEPS, RATE, L2 = 60, 0.3, 2e-3
#: Weights of hashed words, and how much the mean of a line's words counts.
BUCKETS, WORDS = 1 << 10, 4.0
CACHE = 120_000
LINKS = ("http://", "https://", "www.", "@")
N_LOOKS = 25
N_FEATURES = N_LOOKS + BUCKETS


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        raw = word.encode("utf-8", "surrogatepass")
        self[word] = h = zlib.crc32(raw) << 31 ^ zlib.crc32(raw[::-1])
        return h


_hashes = _Hashes()


def hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    h = np.fromiter(map(_hashes.__getitem__, words), np.int64, len(words)).astype(np.uint64)
    with np.errstate(over="ignore"):
        h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def repeated(h: np.ndarray, window: int = WINDOW) -> int:
    """Of the hashed words, those in a window of ``window`` words found twice or more, the first one included."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        code = np.zeros(n, np.uint64)
        for k in range(window):
            code = code * np.uint64(0xD6E8FEB86659FD93) + h[k : k + n]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    return Lines(text or "").base()


class Lines:
    """The lines of a text that have a word; no word goes beyond a line."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.lines = [(x, w) for x in text.split("\n") if (w := WORD.findall(x))]
        self.lengths = np.array([len(w) for _, w in self.lines], np.int64)
        self.words = [w for _, ws in self.lines for w in ws]
        self.hashes = hashes(self.words)

    def base(self) -> tuple[int, int, int, int, int, bool]:
        again, n = repeated(self.hashes), len(self.words)
        dup = len(self.lines) - len({x for x, _ in self.lines})
        return n, sum(map(len, self.words)), sum(map(self.text.count, SYMBOLS)), dup, again, n < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * n

    def looks(self) -> np.ndarray:
        """What each line looks like: ``N_LOOKS`` flags."""
        x = np.zeros((len(self.lines), N_LOOKS), np.float32)
        seen: set[str] = set()
        for k, (line, words) in enumerate(self.lines):
            n, chars = len(words), len(line)
            symbols = sum(map(line.count, SYMBOLS))
            distinct = len(set(words))
            f = [0, 1 if n <= 2 else 2 if n <= 5 else 3 if n <= 12 else 4 if n <= 40 else 5]
            last = words[-1][-1]
            f.append(6 if last in ".?…" else 7 if last in "!" else 8 if last in ",;:" else 9 if last.isalnum() else 10)
            f += [11] * line[:1].isupper() + [12] * line.isupper()
            f += [13] * (symbols > 0) + [14] * (symbols > 0.1 * n) + [15] * (symbols > 0.5 * n)
            f += [16] * (line.count("!") > 0.5 * n) + [17] * (len(DIGIT.findall(line)) > 0.2 * chars)
            f += [18] * any(u in line for u in LINKS)
            f += [19] * (n > 5 and distinct < 0.7 * n) + [20] * (n > 5 and distinct < 0.4 * n)
            f += [21] * (sum(map(eq, words, words[1:])) > 0.2 * n)
            f += [22] * (line in seen) + [23] * (k == 0) + [24] * (k == len(self.lines) - 1)
            seen.add(line)
            x[k, f] = 1
        return x

    def buckets(self) -> np.ndarray:
        """The bucket of each word."""
        return (self.hashes >> np.uint64(20) & np.uint64(BUCKETS - 1)).astype(np.int64)

    def score(self, emit: np.ndarray) -> np.ndarray:
        """Emissions of each line: of its look, and of the mean of its words."""
        return emissions(self.looks(), self.buckets(), self.lengths, emit)

    def states(self, bad: bool, shared: frozenset[int]) -> list[int]:
        """The labels that training takes: 0 content, 1 boilerplate. ``shared``: hashes of lines of many sites."""
        seen: set[str] = set()
        spread = [_signed(xxhash.xxh64_intdigest(x.encode(), 42)) in shared for x, _ in self.lines] if shared else [False] * len(self.lines)
        copied = 2 * sum(spread) > len(spread)
        return [int(bad or x in seen or (s and not copied) or bool(seen.add(x))) for (x, _), s in zip(self.lines, spread)]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def emissions(looks: np.ndarray, buckets: np.ndarray, lengths: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Scores (lines x states); words lie side by side, ``lengths`` of them a line."""
    if not len(lengths):
        return np.zeros((0, 2))
    starts = np.cumsum(lengths) - lengths
    return looks @ emit[:N_LOOKS] + WORDS * np.add.reduceat(emit[N_LOOKS:][buckets], starts) / lengths[:, None]


Example = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def likelihood(examples: list[Example], emit: np.ndarray, move: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood a line of the labels, and its gradient, by forward-backward.

    An example is a document: looks, buckets and lengths of its lines, and their states.
    All lines lie side by side, so memory follows their number, and documents step together.
    """
    examples = sorted(examples, key=lambda e: -len(e[3]))
    looks, buckets, lengths, y = (np.concatenate(c) for c in zip(*examples))
    sizes = np.array([len(e[3]) for e in examples])
    starts = np.cumsum(sizes) - sizes
    score = emissions(looks, buckets, lengths, emit)
    forward, backward = score.copy(), np.zeros_like(score)
    live = [starts[: np.searchsorted(-sizes, -t)] + t for t in range(sizes[0])]  # the t-th lines, of documents that have one
    for t in range(1, sizes[0]):
        at = live[t]
        forward[at] += np.logaddexp.reduce(forward[at - 1, :, None] + move, axis=1)
    for t in range(sizes[0] - 1, 0, -1):
        at = live[t]
        backward[at - 1] = np.logaddexp.reduce(move + (score[at] + backward[at])[:, None, :], axis=2)
    total = np.repeat(np.logaddexp.reduce(forward[starts + sizes - 1], axis=1), sizes)
    inner = np.ones(len(y), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    n = len(y)
    value = score[np.arange(n), y].sum() + move[y[at - 1], y[at]].sum() - total[starts].sum()
    off = -np.exp(forward + backward - total[:, None])
    off[np.arange(n), y] += 1
    both = np.exp(forward[at - 1, :, None] + move + (score + backward)[at, None, :] - total[at, None, None]).sum(0)
    to = -both
    np.add.at(to, (y[at - 1], y[at]), 1)
    share = np.repeat(WORDS * off / lengths[:, None], lengths, axis=0)
    g = np.concatenate([looks.T @ off, np.stack([np.bincount(buckets, share[:, s], BUCKETS) for s in (0, 1)], axis=1)])
    return value / n, g / n, to / n


def fit(examples: list[Example]) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (features x states) and transitions, by ascent with adaptive steps and a quadratic penalty.

    Without lines everything is content.
    """
    emit, move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    examples = [e for e in examples if len(e[3])]
    if not examples:
        emit[0, 0] = 1
        return emit, move
    square = [np.full_like(emit, 1e-8), np.full_like(move, 1e-8)]
    for _ in range(STEPS):
        _, *slopes = likelihood(examples, emit, move)
        for k, w in enumerate((emit, move)):
            g = slopes[k] - L2 * w
            square[k] += g * g
            w += RATE * g / np.sqrt(square[k])
    return emit, move


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best states of a document's lines, from their emissions; content where states tie."""
    score = scores.tolist()
    (m00, m01), (m10, m11) = move.tolist()
    a, b = score[0]
    back: list[tuple[int, int]] = []
    for s0, s1 in score[1:]:
        from0, from1 = (a + m00, b + m10), (a + m01, b + m11)
        k0, k1 = int(from0[1] > from0[0]), int(from1[1] > from1[0])
        a, b = from0[k0] + s0, from1[k1] + s1
        back.append((k0, k1))
    state = int(b > a)
    out = [state]
    for k in reversed(back):
        state = k[state]
        out.append(state)
    return np.array(out[::-1])


def content_share(text: Lines, emit: np.ndarray, move: np.ndarray) -> float:
    """Share of the words that stand in content lines; 0 without words."""
    n = text.lengths
    return float(n[viterbi(text.score(emit), move) == 0].sum() / n.sum()) if len(n) else 0.0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The field, from at most ``sample`` labelled documents (those with the smallest hash of doc_id), whole.

    Lines of many sites are found over all documents; a table without
    ``source`` has none.
    """
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    known = known.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers: of a proven size.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("h", "quality", "text")
    if "source" in docs.columns:
        shared = line_dedup.boilerplate(docs.select("source", "text"))
        hits = rows.select("h", F.explode(line_dedup._hashes(F.col("text"))).alias("line")).join(shared, "line").groupBy("h").agg(F.collect_set("line").alias("shared"))
        rows = rows.join(hits, "h", "left")
    else:
        rows = rows.withColumn("shared", F.lit(None).cast("array<long>"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for q, text, shared in zip(*(b.column(c).to_pylist() for c in ("quality", "text", "shared"))):
                t = Lines(text or "")
                out.append((np.packbits(t.looks().astype(bool), axis=1).tobytes(), t.buckets().astype("<i2").tobytes(), t.lengths.astype("<i4").tobytes(), bytes(t.states(not q, frozenset(shared or ())))))
            yield pa.RecordBatch.from_arrays([b.column("h"), *(pa.array([o[k] for o in out], pa.binary()) for k in range(4))], names=["h", "looks", "buckets", "lengths", "y"])
        _hashes.clear()

    lines = rows.select("h", "quality", "text", "shared").mapInArrow(make, "h long, looks binary, buckets binary, lengths binary, y binary")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(x for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
        emit, move = fit([_example(*x[1:]) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array([emit.tobytes()], pa.binary()), pa.array([move.tobytes()], pa.binary())], names=["emit", "move"])

    model = lines.repartition(1).mapInArrow(learn, "emit binary, move binary").first()
    if model is None:  # nothing to learn from, and the plan came out empty
        return fit([])
    return np.frombuffer(model["emit"]).reshape(-1, 2), np.frombuffer(model["move"]).reshape(2, 2)


def _example(looks: bytes, buckets: bytes, lengths: bytes, y: bytes) -> Example:
    flags = np.unpackbits(np.frombuffer(looks, np.uint8).reshape(len(y), -(-N_LOOKS // 8)), axis=1, count=N_LOOKS).astype(np.float32)
    return flags, np.frombuffer(buckets, "<i2").astype(np.int64), np.frombuffer(lengths, "<i4").astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every row of ``doc_id, text``.

    Null and empty texts have no words and fail the base rules. Repeated rows
    are judged each; other columns are ignored. Whole texts are read, of any
    length and number of lines; where both states of a line score the same it is
    content. ``content_share`` is null where the base rules have decided.
    """
    emit, move = train(docs, labels)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for at in range(0, b.num_rows, 256):
                for text in b.column("text").slice(at, 256).to_pylist():
                    lines = Lines(text or "")
                    counts = lines.base()
                    share = None if counts[-1] else content_share(lines, emit, move)
                    rows.append((*counts, share is not None and share >= CONTENT_SHARE, share))
            columns = list(zip(*rows)) if rows else [()] * 8
            types = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=["doc_id", *NAMES])
        _hashes.clear()  # a worker that waits for its next task should hold little

    return docs.mapInArrow(run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double")


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]
