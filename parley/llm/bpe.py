"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes tokens for every new word; a vectorised test
decides for each adjacent pair whether byte-pair merging would ever put a
token across their border. A proposal whose pairs all pass *is* the result of
the merges; only the other words are merged exactly, with a heap.

The pair test undoes the merges of both tokens from the latest one on. At each
step the two parts that touch must have no merge that comes before the one
undone last; otherwise merging would have joined them first.

Nulls and empty texts give no ids. Texts of any length are taken whole; a word
is merged in O(n log n), so one enormous word is no hazard.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.session import ship

#: The split of byte-level BPE files that name ByteLevel with use_regex.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: The same split, in the form that the compiled encoder runs without going back.
COMPILED = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Code points for which this regex module and the library's engine may belong
#: to different Unicode versions; texts that hold one are split by the library.
UNSURE = regex.compile(r"[^\x00-՗]")
#: Texts with only these characters and no doubled white space are cut with
#: plain string operations: a border lies before every space and around every
#: line feed, wherever the pattern above is applied.
ODD = re.compile("[^\n\x20-\x7e\xa1-\u0557]")
DOUBLED = ("  ", " \n", "\n ", "\n\n")
#: Pieces and words remembered per worker, in each of two generations.
CACHE = 80_000
#: Characters of text that are looked up together.
BLOCK = 1_000_000
#: Bytes by which the possible lengths of a token are looked up, and those to try for other bytes.
START, SHORT = 4, (3, 2, 1)
#: Bytes of a word up to which it is merged together with others, and words of one such table.
WIDE, ROWS = 64, 4096
_NONE = np.int64(1) << 40


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    return table


class Memory:
    """What was learned of the latest words, in two generations of bounded size."""

    def __init__(self, learn) -> None:
        self.learn, self.young, self.old = learn, {"": b""}, {}

    def of(self, lists: list[list[str]]) -> dict[str, bytes]:
        """A mapping that has all of these words."""
        if len(self.young) > CACHE:
            self.young, self.old = {"": b""}, self.young
        missing = set().union(*lists).difference(self.young)
        if missing:
            new = [w for w in missing if w not in self.old]
            self.young.update((w, self.old[w]) for w in missing if w in self.old)
            self.young.update(zip(new, self.learn(new)))
        return self.young


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        spec = load(path)
        self.path, model = path, spec["model"]
        alphabet = byte_alphabet()
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab: dict[str, int] = model["vocab"]
        # Tokens are renumbered inside: the 256 bytes, then one per merge in order of rank.
        order = {c: b for c, b in alphabet.items()}
        left, right, token = list(range(256)), list(range(256)), [bytes([b]) for b in range(256)]
        ids = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        pairs: dict[tuple[int, int], int] = {}
        twice: set[int] = set()
        for a, b in merges:
            new = len(token)
            pairs[order[a], order[b]] = new
            if a + b in order:  # a second way to one token: never trusted without exact merging
                twice.add(order[a + b])
                pairs[order[a], order[b]] = new
            order.setdefault(a + b, new)
            left.append(order[a])
            right.append(order[b])
            token.append(to_bytes(a + b))
            ids.append(vocab[a + b])
        self.pairs, self.token = {a << 32 | b: t for (a, b), t in pairs.items()}, token
        self.left, self.right = np.array(left), np.array(right)
        self.ids = np.array(ids, dtype="<u4")
        keys = np.array(list(self.pairs), dtype=np.int64)
        at = np.argsort(keys)
        self._keys, self._made = keys[at], np.array(list(self.pairs.values()), dtype=np.int64)[at]
        sound = self.compatible(self.left[256:], self.right[256:], np.arange(256, len(token), dtype=np.int64))
        self.sound = np.concatenate([np.ones(256, bool), sound])
        for t in range(256, len(token)):
            self.sound[t] &= self.sound[left[t]] and self.sound[right[t]] and t not in twice
        self.known = {b: t for t, b in enumerate(token) if self.sound[t]}
        lengths: dict[bytes, set[int]] = {}
        for b in self.known:
            if len(b) >= START:
                lengths.setdefault(b[:START], {3, 2, 1}).add(len(b))
        same = {(3, 2, 1): (3, 2, 1)}
        #: The lengths that are worth a look-up, longest first, by the bytes that come next.
        self.lengths = {b: same.setdefault(k, k) for b, n in lengths.items() for k in [tuple(sorted(n, reverse=True))]}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with strip or word conditions are not supported")
        self._added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        #: By public id: bytes and decimal digits.
        size = max([*ids, *self.added.values()]) + 1
        self.bytes_of, self.digits_of = [b""] * size, [str(k) for k in range(size)]
        for i, b in zip(ids, token):
            self.bytes_of[i] = b
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.words = Memory(self.learn)
        self.pieces = Memory(self._learn_pieces)
        self._library = None

    # -- verification ------------------------------------------------------
    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether merging keeps a border between each ``a[i]`` and ``b[i]``.

        Only merges that come before ``limit[i]`` count, if it is given.
        """
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        bound = np.full(len(a), _NONE) if limit is None else limit.astype(np.int64)
        while len(at):
            key = (x << 32) | y
            k = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1) if len(self._keys) else np.zeros(len(key), int)
            made = np.where(self._keys[k] == key, self._made[k], _NONE) if len(self._keys) else np.full(len(key), _NONE)
            bad = made < bound
            out[at[bad]] = False
            go = ~bad
            at, x, y = at[go], x[go], y[go]
            # Undo the later of the two tokens; a byte cannot be undone, then it is the other's turn.
            first = x > y
            nx, ny = self.right[x], self.left[y]
            turn_x = np.where(first, nx != x, (ny == y) & (nx != x))
            turn_y = np.where(first, (nx == x) & (ny != y), ny != y)
            bound = np.where(turn_x, x, y + 1)
            x, y = np.where(turn_x, nx, x), np.where(turn_y, ny, y)
            live = turn_x | turn_y
            at, x, y, bound = at[live], x[live], y[live], bound[live]
        return out

    def propose(self, word: bytes) -> list[int] | None:
        """Greedy longest match; None if a token that must not be trusted is needed."""
        known, lengths, out, i, n = self.known, self.lengths, [], 0, len(word)
        while i < n:
            for step in lengths.get(word[i : i + START], SHORT):
                if i + step <= n and (t := known.get(word[i : i + step])) is not None:
                    break
            out.append(t)
            i += step
        return out

    def merge(self, word: bytes) -> list[int]:
        """The merges themselves, lowest rank first, leftmost on ties."""
        tokens, pairs, none = list(word), self.pairs, int(_NONE)
        n = len(tokens)
        if n <= 64:
            ranks = [pairs.get(a << 32 | b, none) for a, b in zip(tokens, tokens[1:])]
            while ranks and (t := min(ranks)) < none:
                i = ranks.index(t)
                tokens[i : i + 2] = [t]
                del ranks[i]
                if i:
                    ranks[i - 1] = pairs.get(tokens[i - 1] << 32 | t, none)
                if i < len(ranks):
                    ranks[i] = pairs.get(t << 32 | tokens[i + 1], none)
            return tokens
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(t, i) for i in range(n - 1) if (t := pairs.get(tokens[i] << 32 | tokens[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            t, i = heapq.heappop(heap)
            if tokens[i] < 0 or (j := after[i]) >= n or pairs.get(tokens[i] << 32 | tokens[j]) != t:
                continue
            tokens[i], tokens[j] = t, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (u := pairs.get(t << 32 | tokens[after[i]])) is not None:
                    heapq.heappush(heap, (u, i))
            if (h := before[i]) >= 0 and (u := pairs.get(tokens[h] << 32 | t)) is not None:
                heapq.heappush(heap, (u, h))
        return [t for t in tokens if t >= 0]

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """``merge`` of each word: all words make their next merge at once, those of up to ``WIDE`` bytes."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        while order and len(words[order[-1]]) > WIDE:
            k = order.pop()
            out[k] = np.array(self.merge(words[k]), dtype=np.int64)
        for at in range(0, len(order), ROWS):
            some = order[at : at + ROWS]
            tokens = self._merge_rows([words[k] for k in some])
            left = tokens >= 0
            flat, ends = tokens[left], np.cumsum(left.sum(1))
            for k, a, b in zip(some, [0, *ends.tolist()], ends.tolist()):
                out[k] = flat[a:b]
        return out

    def _merge_rows(self, words: list[bytes]) -> np.ndarray:
        """A row of tokens for each word; -1 where a token went into the one before it or the word is over."""
        lengths = np.array([len(w) for w in words])
        rows, wide = len(words), int(lengths.max(initial=0)) + 2
        # A place before the word and one after it, which never merge, stand for its ends.
        filled = np.arange(wide) - 1
        filled = (filled >= 0) & (filled < lengths[:, None])
        tokens = np.full((rows, wide), -1, dtype=np.int64)
        tokens[filled] = np.frombuffer(b"".join(words), np.uint8)
        made = np.full((rows, wide), _NONE)
        both = filled[:, :-1] & filled[:, 1:]
        made[:, :-1][both] = self._rank(tokens[:, :-1][both], tokens[:, 1:][both])
        before = np.tile(np.arange(-1, wide - 1), (rows, 1))
        after = np.tile(np.arange(1, wide + 1), (rows, 1))
        live = np.arange(rows)
        while len(live):
            i = made[live].argmin(1)  # the first of equals is the leftmost
            t = made[live, i]
            go = t < _NONE
            live, i, t = live[go], i[go], t[go]
            j = after[live, i]
            k, h = after[live, j], before[live, i]
            tokens[live, i], tokens[live, j], made[live, j] = t, -1, _NONE
            after[live, i], before[live, k] = k, i
            made[live, i], made[live, h] = self._rank(t, tokens[live, k]), self._rank(tokens[live, h], t)
        return tokens

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What each pair of tokens merges to; ``_NONE`` if it doesn't or one of them is -1."""
        if not len(self._keys):
            return np.full(len(a), _NONE)
        key = (a << 32) | b
        k = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[k] == key, self._made[k], _NONE)

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of words: propose, verify all adjacent pairs at once, merge only those that fail."""
        raw = [w.encode() for w in words]
        proposed = [self.propose(b) for b in raw]
        lengths = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        inner = np.ones(max(len(flat) - 1, 0), bool)
        inner[ends[:-1] - 1] = False
        at = np.flatnonzero(inner)
        pair, back = np.unique((flat[at] << 32) | flat[at + 1], return_inverse=True)
        wrong = ~self.compatible(pair >> 32, pair & 0xFFFFFFFF)[back] if len(at) else np.zeros(0, bool)
        failing = np.unique(np.searchsorted(ends, at[wrong], side="right")).tolist()
        public, cuts = self.ids[flat].tobytes(), [0, *(4 * ends).tolist()]
        out = [public[a:b] for a, b in zip(cuts, cuts[1:])]
        for k, tokens in zip(failing, self.merge_all([raw[k] for k in failing])):
            out[k] = self.ids[tokens].tobytes()
        return out

    def _learn_pieces(self, pieces: list[str]) -> list[bytes]:
        # Letters, also after a space, are one word by the pattern.
        split = [[p] if (p[1:] if p[:1] == " " else p).isalpha() and ODD.search(p) is None else self.split(p) for p in pieces]
        ids = self.words.of(split)
        return [b"".join(map(ids.__getitem__, s)) for s in split]

    # -- texts -------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """The words that are merged apart."""
        if UNSURE.search(text) is None:
            return PATTERN.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def cut(self, text: str) -> list[str]:
        """Pieces of one or a few words; their ids side by side are the text's."""
        if ODD.search(text) or text.endswith((" ", "\n")) or any(d in text for d in DOUBLED):
            return self.split(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def encode_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        block: list[list] = []
        size = 0
        for text in texts:
            parts = self._added.split(text) if text and self._added and self._added.search(text) else [text or ""]
            block.append([self.cut(p) if k % 2 == 0 else self.added[p] for k, p in enumerate(parts)])
            size += len(text or "")
            if size > BLOCK:
                yield from self._encode_block(block)
                block, size = [], 0
        yield from self._encode_block(block)

    def _encode_block(self, block: list[list]) -> Iterator[bytes]:
        ids = self.pieces.of([p for parts in block for p in parts if isinstance(p, list)])
        for parts in block:
            yield b"".join(b"".join(map(ids.__getitem__, p)) if isinstance(p, list) else p.to_bytes(4, "little") for p in parts)

    def forget(self) -> None:
        """Empty the memories: a worker that waits for its next task should hold little."""
        self.words, self.pieces = Memory(self.learn), Memory(self._learn_pieces)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(next(self.encode_batch([text])), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Compiled:
    """The ids of ``Codec``, by compiled encoders of the same vocabulary and with none of its tables.

    For operators that need ids but no tokens, such as packing. One encoder
    takes texts of the characters that both compiled encoders split alike;
    texts with others, with added tokens, or too deep for that encoder's
    pattern go to the library that defines the ids.
    """

    def __init__(self, path: str) -> None:
        spec = load(path)
        self.path, self._library, self._coder = path, None, None
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        ids = [vocab[m] for m in made]
        # It takes ids for ranks: they must rise with the merges, after those of the bytes.
        if len(set(made)) == len(made) and ids == sorted(ids) and max(vocab[c] for c in alphabet) < min(ids, default=1 << 31):
            import tiktoken

            ranks = {bytes([b]): vocab[c] for c, b in alphabet.items()} | {bytes(map(alphabet.__getitem__, m)): vocab[m] for m in made}
            self._coder = tiktoken.Encoding("own", pat_str=COMPILED, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers; none for a null."""
        if not text:
            return b""
        if self._coder is not None and UNSURE.search(text) is None and not any(a in text for a in self.added):
            try:
                return self._coder.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
            except ValueError:  # the pattern's stack is bounded
                pass
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.no_truncation()
            self._library.no_padding()
        return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def load(path: str) -> dict:
    """A vocabulary file, if it is one of plain byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
        raise ValueError("only plain byte-level BPE files are supported")
    return spec


_codecs: dict[str, Codec] = {}
_compiled: dict[str, Compiled] = {}


def codec(path: str) -> Codec:
    """One codec per vocabulary file and worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def compiled(path: str) -> Compiled:
    """One compiled encoder per vocabulary file and worker process."""
    if path not in _compiled:
        _compiled[path] = Compiled(path)
    return _compiled[path]


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add ``into`` (array of int): the ids of ``text``; null and empty texts give an empty array."""
    return _map(docs, path, text, [(into, pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))], _ids)


def decode(docs: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add ``into`` (string): the text of ``ids``; a null array gives an empty text."""
    return _map(docs, path, ids, [(into, pa.string(), T.StringType())], _texts)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``doc_id, text``: number of ids, digest of the ids, digest of what they decode to.

    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256``
    over the decoded text in UTF-8. Null and empty texts have no ids. Repeated
    rows are encoded each. Only the two columns are read.
    """
    new = [("n_tokens", pa.int64(), T.LongType()), ("ids_sha256", pa.string(), T.StringType()), ("decoded_sha256", pa.string(), T.StringType())]
    return _map(docs.select("doc_id", "text"), path, "text", new, _digests).drop("text")


def _ids(coder: Codec, texts: list[str | None]) -> list[list]:
    return [[np.frombuffer(b, "<u4").astype("i4") for b in coder.encode_batch(texts)]]


def _texts(coder: Codec, ids: list[list[int] | None]) -> list[list]:
    return [[coder.decode(x or []) for x in ids]]


def _digests(coder: Codec, texts: list[str | None]) -> list[list]:
    n, of_ids, of_text = [], [], []
    for raw in coder.encode_batch(texts):
        ids = np.frombuffer(raw, "<u4").tolist()
        n.append(len(ids))
        of_ids.append(hashlib.sha256(",".join(map(coder.digits_of.__getitem__, ids)).encode()).hexdigest())
        of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
    return [n, of_ids, of_text]


def _map(docs: DataFrame, path: str, column: str, new: list, work) -> DataFrame:
    ship(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name not in {n for n, _, _ in new}]
    docs = docs.select([F.col(f"`{f.name}`") for f in rest])
    out = T.StructType([*docs.schema.fields, *(T.StructField(name, kind) for name, _, kind in new)])
    types = [t for _, t, _ in new]
    drop = column if work is _digests else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            made = []
            for k in range(0, batch.num_rows, 256):  # bounds what lives at once, however long the texts
                made.append(work(coder, batch.column(column).slice(k, 256).to_pylist()))
            columns = [pa.array([x for part in made for x in part[i]], t) for i, t in enumerate(types)]
            kept = [pa.nulls(batch.num_rows, pa.string()) if f.name == drop else c for f, c in zip(batch.schema, batch.columns)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*batch.schema.names, *(n for n, _, _ in new)])
        coder.forget()

    return docs.mapInArrow(run, out)
