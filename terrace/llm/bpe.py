"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of bytes is cut in halves down to short leaves, the leaves are merged
by rank, and neighbours are joined up the tree.  A join re-encodes a window
around the boundary and widens it until the tokens on both of its edges are
stable against their outer neighbours.

Why that is enough: call two tokens stable if the merges, run on their joined
bytes alone, give back exactly the two.  If every adjacent pair of a token
sequence is stable, the sequence is the encoding of all its bytes.  Merges
inside a token depend on its own bytes only as long as no merge crosses its
edges, and the order in which "lowest rank first, leftmost on ties" serves two
neighbours is the same with and without the other tokens.  So the first merge
that crossed an edge would also cross it in the pair alone, which stability
excludes.  Both sides of a join are encodings, hence stable inside; only the
pairs at the window's edges are left to test.

Null texts are encoded as the empty text (no ids).  Rows are never dropped or
grouped, so repeated rows and repeated ids come out as often as they came in.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import add_columns, is_plain

LEAF = 6
DECODED_LEAF = 64
SCANNED = 32
KEPT = 100_000
# Plain texts split alike in ``re`` with plain classes and, much slower, by Unicode property.
_CLASSES = {r"\p{L}": "A-Za-zÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9"}


def _plain(pattern: str) -> str:
    """The pattern with Unicode properties written out for plain texts, inside brackets and alone."""
    def put(found: re.Match) -> str:
        out = found[0]
        for unicode_class, plain in _CLASSES.items():
            out = out.replace(unicode_class, plain)
        return out if found[1] else f"[{out}]"

    return re.sub(r"(\[[^\]]*\])|\\p\{[LN]\}", put, pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file (base64 token, space, rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class TreeBPE:
    """Encoder and decoder for one set of ranks; results of pieces are kept up to a fixed number."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.split_plain = re.compile(_plain(pattern)).findall
        self.none = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * self.none
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.stable = lru_cache(50_000)(self._stable)
        self.small = lru_cache(50_000)(self._small)
        self.kept: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[bytes]:
        """Merge adjacent parts, lowest rank first and leftmost on ties, until none has a rank."""
        n = len(piece)
        if n <= SCANNED:
            return self._scan(piece)
        get, end, before = self.ranks.get, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or get(piece[i:end[j]]) != rank:
                continue  # one of its parts has changed since
            end[i], alive[j] = end[j], False
            k = end[i]
            if k < n:
                before[k] = i
                if (r := get(piece[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i))
            p = before[i]
            if p >= 0 and (r := get(piece[p:end[i]])) is not None:
                heapq.heappush(heap, (r, p))
        out, i = [], 0
        while i < n:
            out.append(piece[i:end[i]])
            i = end[i]
        return out

    def _scan(self, piece: bytes) -> list[bytes]:
        """The same for a few bytes: look through all pairs for the lowest rank."""
        get, none = self.ranks.get, self.none
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def _stable(self, a: bytes, b: bytes) -> bool:
        return self.merge(a + b) == [a, b]

    def _small(self, piece: bytes) -> tuple[bytes, ...]:
        return tuple(self._scan(piece))

    def join(self, left: tuple[bytes, ...], right: tuple[bytes, ...]) -> tuple[bytes, ...]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        k = m = 1
        while True:
            k, m = min(k, len(left)), min(m, len(right))
            middle = b"".join(left[-k:] + right[:m])
            window = self.small(middle) if len(middle) <= SCANNED else tuple(self.merge(middle))
            left_ok = k == len(left) or self.stable(left[-k - 1], window[0])
            right_ok = m == len(right) or self.stable(window[-1], right[m])
            if left_ok and right_ok:
                return left[:-k] + window + right[m:]
            k, m = k * (1 if left_ok else 2), m * (1 if right_ok else 2)

    def parts(self, piece: bytes) -> tuple[bytes, ...]:
        if len(piece) <= LEAF:
            return self.small(piece)
        half = len(piece) // 2
        return self.join(self.parts(piece[:half]), self.parts(piece[half:]))

    def match_ids(self, match: str) -> tuple[int, ...]:
        """Ids of one match, which are not among the newest results: an older one, or by the tree.

        A match that is itself a token is that token.
        """
        out = self.older.get(match)
        if out is None:
            piece = match.encode("utf-8")
            whole = self.ranks.get(piece)
            out = (whole,) if whole is not None else tuple([self.ranks[t] for t in self.parts(piece)])
        if len(match) <= 48:
            if len(self.kept) >= KEPT:
                self.kept, self.older = {}, self.kept
            self.kept[match] = out
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for match in (self.split_plain if is_plain(text) else self.split)(text):
            ids = self.kept.get(match)
            out += self.match_ids(match) if ids is None else ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The ids' bytes, concatenated up the tree: leaves of some ids, then neighbours pair by pair."""
        tokens = self.tokens
        level = [b"".join([tokens[i] for i in ids[k:k + DECODED_LEAF]]) for k in range(0, len(ids), DECODED_LEAF)]
        while len(level) > 1:
            odd = level[-1:] if len(level) % 2 else []
            level = [a + b for a, b in zip(level[::2], level[1::2])] + odd
        return level[0] if level else b""


_codecs: dict[str, TreeBPE] = {}


def _codec(shared, key: str) -> TreeBPE:
    """One codec for each vocabulary in a worker process."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = TreeBPE(*shared.value)
    return _codecs[key]


def _share(df: DataFrame, ranks: dict[bytes, int], pattern: str):
    """Broadcast the vocabulary (its size is fixed by its file) under a key of its content."""
    size = sum(map(len, ranks)) + 8 * len(ranks)
    if size > 256 << 20:
        raise ValueError(f"a vocabulary of {size} bytes is too large to broadcast")
    digest = hashlib.sha256(pattern.encode("utf-8"))
    for token, rank in ranks.items():
        digest.update(token + b"=%d;" % rank)
    return df.sparkSession.sparkContext.broadcast((ranks, pattern)), digest.hexdigest()


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text in ``ids`` (array<int>; a null or empty text has none)."""
    shared, key = _share(df, ranks, pattern)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        codec = _codec(shared, key)
        return [pa.array([codec.encode(t.as_py() or "") for t in columns[0]], pa.list_(pa.int32()))]

    return add_columns(df, [text], {ids: T.ArrayType(T.IntegerType())}, run)


def decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids",
           decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids`` stand for in ``decoded`` (binary; null or no ids: empty)."""
    shared, key = _share(df, ranks, pattern)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        codec = _codec(shared, key)
        rows = columns[0].fill_null([]) if columns[0].null_count else columns[0]
        ends = rows.offsets.to_pylist()
        numbers = rows.values.to_numpy(zero_copy_only=False)
        return [pa.array([codec.decode(numbers[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.binary())]

    return add_columns(df, [ids], {decoded: T.BinaryType()}, run)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass: a task needs one worker, and one vocabulary, instead of two."""
    shared, key = _share(df, ranks, pattern)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        codec = _codec(shared, key)
        rows = [codec.encode(t.as_py() or "") for t in columns[0]]
        return [pa.array(rows, pa.list_(pa.int32())), pa.array([codec.decode(x) for x in rows], pa.binary())]

    return add_columns(df, [text], {ids: T.ArrayType(T.IntegerType()), decoded: T.BinaryType()}, run)


def digest(df: DataFrame, ids: str = "ids", decoded: str = "decoded", keep_ids: bool = False) -> DataFrame:
    """doc_id, number of ids, SHA-256 of the comma-joined decimal ids and of the decoded bytes; the ids on demand."""
    return df.select(
        "doc_id",
        *([ids] if keep_ids else []),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
