"""Spelling variants: words one edit apart, grouped under their most frequent form.

The corpus' words are counted over whole texts.  Two words are near if one
inserted, deleted or replaced letter turns one into the other.  A word's form
is its near word of the largest count, if that is ``ratio`` times its own; the
root follows forms to the last one.

A word's frequency vector counts its letters by groups (``GROUPS``).  A near
word's vector has at most one letter more in one group (a surplus) and one
less in one group (a deficit).  Words are arranged in a trie by the counts of
the first group, the second and so on.  A depth-first search takes a set of
words down the trie and spends each one's budget of one surplus and one
deficit; the words of the leaves that it reaches are verified.

Scale.  The upper part of the trie is split until a node holds few words, in
one aggregation a level; it has at most some thousand nodes whatever the number
of words (the words a node may hold grow instead), so the driver can hold it.
Its leaves are cells.  A word belongs to one cell, and a copy goes to those
cells of higher number that the budget reaches, so two words meet in one place.
A cell whose words agree in all groups, which no level can split, is dealt out
in blocks, and words visit all of them.  A cell returns at most one row for
each word that it saw (the number of its near words and the best of them), no
pairs.  Roots come from pointer doubling: counts grow by ``ratio`` along
forms, so a chain is no longer than the logarithm of the largest count.

Null and empty texts have no words.  A null doc_id counts as the empty text in
the hash.  Repeated rows count as often as they come.  Ties between forms go
to the smaller word in code-point order.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import narrow_batches, stage, unstage

NOT_RUN = re.compile("[^A-Za-zÀ-ÿ]")
#: Letter groups in the order of the trie's levels; all others (rare letters) by their code, see ``group_table``.
GROUPS = ("e", "a", "n", "i", "r", "t", "o", "s", "dl", "ch", "um", "gbp", "fvw", "kyzxjq")
LEVELS = len(GROUPS) + 2
#: The upper trie takes counts beyond this as equal, so a node has few children.
MOST_COUNT = 7


@dataclass(frozen=True)
class Params:
    least_length: int = 5
    least_count: int = 3
    ratio: int = 2
    #: one in so many distinct words of a document loses a letter; 0: none
    misspell: int = 97
    #: words a cell of the trie may hold before it is split; grows so that there are at most ``cells``
    cell_words: int = 4_000
    cells: int = 2_048


# --- words and their counts --------------------------------------------------------------------

def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def runs_of(text: str, least: int = 1, piece: int = 1 << 20) -> Iterator[list[str]]:
    """The maximal runs of at least so many letters, in lists of one piece of the text each; cuts are between runs."""
    at, run = 0, re.compile(f"[A-Za-zÀ-ÿ]{{{max(1, least)},}}")
    while at < len(text):
        cut = NOT_RUN.search(text, min(len(text), at + piece))
        end = cut.start() if cut else len(text)
        yield run.findall(text, at, end)
        at = max(end, at + 1)


def words_of(doc_id: object, text: str | None, misspell: int, least: int = 1) -> Counter:
    """How often each word occurs in a text; runs of fewer than ``least`` letters are left out.  A run whose hash with the doc_id is divisible by ``misspell`` loses
    the letter at the hash modulo its length."""
    runs: Counter = Counter()
    for found in runs_of(ascii_lower(text or ""), least):
        runs.update(found)
    if not misspell:
        return runs
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % misspell == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def count_words(docs: DataFrame, p: Params = Params(), text: str = "text", most_held: int = 200_000) -> DataFrame:
    """(word, n) of all words that are long and frequent enough.  Tasks add up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(held: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        held: Counter = Counter()
        size = 0
        for batch in batches:
            for doc_id, t in zip(batch.column(0), batch.column(1)):
                for word, n in words_of(doc_id.as_py(), t.as_py(), p.misspell, p.least_length).items():
                    if len(word) >= p.least_length:
                        if word not in held:
                            size += len(word)
                        held[word] += n
                if len(held) > most_held or size > 20 * most_held:
                    yield batch_of(held)
                    held, size = Counter(), 0
        yield batch_of(held)

    narrow_batches(docs.sparkSession)
    counted = docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least_count)


# --- frequency vectors and the trie ------------------------------------------------------------

def group_table() -> np.ndarray:
    """The level of each code point below 256: listed groups, then the other letters by their code's parity."""
    table = np.array([len(GROUPS) + c % 2 for c in range(256)], np.int64)
    for k, letters in enumerate(GROUPS):
        table[[ord(c) for c in letters]] = k
    return table


_TABLE = group_table()


def vectors(words: list[bytes]) -> np.ndarray:
    """The frequency vector of each word (Latin-1: one byte a letter)."""
    lengths = np.array([len(w) for w in words], np.int64)
    which = np.repeat(np.arange(len(words)), lengths) * LEVELS
    flat = np.bincount(which + _TABLE[np.frombuffer(b"".join(words), np.uint8)], minlength=len(words) * LEVELS)
    return flat.reshape(len(words), LEVELS).astype(np.int32)


def spend(diff: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> np.ndarray:
    """Which members can still go on, having ``diff`` more letters of a group than the node."""
    return (diff == 0) | ((diff == 1) & surplus) | ((diff == -1) & deficit)


def ends(words: list[bytes]) -> np.ndarray:
    """The first two and the last two letters of each word, as numbers; 0 for words of less than four letters.

    One edit of words of four letters or more leaves the first two or the last two as they are.
    """
    long = b"".join(w[:2] + w[-2:] if len(w) > 3 else bytes(4) for w in words)
    return np.frombuffer(long, np.uint16).reshape(len(words), 2)


def search(base: np.ndarray, queries: np.ndarray, leaf: int = 6) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth-first search of all ``queries`` in the trie of ``base``, whose rows are sorted by level: the numbers of
    queries and base words that meet in a leaf, with vectors that the budget allows."""
    everyone = np.arange(len(queries))
    todo = [(0, len(base), 0, everyone, np.ones(len(queries), bool), np.ones(len(queries), bool))]
    while todo:
        lo, hi, level, who, surplus, deficit = todo.pop()
        if level == LEVELS or hi - lo <= leaf:
            a, b = np.repeat(who, hi - lo), np.tile(np.arange(lo, hi), len(who))
            diff = queries[a] - base[b]
            fits = (np.maximum(diff, 0).sum(axis=1) <= 1) & (np.maximum(-diff, 0).sum(axis=1) <= 1)
            yield a[fits], b[fits]
            continue
        counts = base[lo:hi, level]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(counts)) + 1, [hi - lo]])
        own = queries[who, level]
        for k in range(len(starts) - 1):
            diff = own - counts[starts[k]]
            on = spend(diff, surplus, deficit)
            if on.any():
                d = diff[on]
                todo.append((lo + starts[k], lo + starts[k + 1], level + 1, who[on], surplus[on] & (d != 1), deficit[on] & (d != -1)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    lo, hi = 0, len(a)  # the longest common beginning, by halves
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


@dataclass(frozen=True)
class Top:
    """The upper part of the trie: per node its level and children by count, or its cell."""

    level: tuple[int, ...]
    children: tuple[dict[int, int], ...]
    blocks: tuple[int, ...]

    def cells(self, vecs: np.ndarray, budget: bool) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, numbers of the words that reach it), depth first; without a budget, each word's own cell."""
        everyone = np.arange(len(vecs))
        capped = np.minimum(vecs, MOST_COUNT)
        todo = [(0, everyone, np.full(len(vecs), budget), np.full(len(vecs), budget))]
        while todo:
            node, who, surplus, deficit = todo.pop()
            if not self.children[node]:
                yield node, who
                continue
            own = capped[who, self.level[node]]
            for count, child in self.children[node].items():
                diff = own - count
                on = spend(diff, surplus, deficit)
                if on.any():
                    d = diff[on]
                    todo.append((child, who[on], surplus[on] & (d != 1), deficit[on] & (d != -1)))


def upper_trie(words: DataFrame, n: int, p: Params) -> Top:
    """Split nodes of more words than a cell may hold by the next level's counts, one aggregation a level."""
    most = max(p.cell_words, math.ceil(n / p.cells))
    levels, children, sizes = [0], [{}], [n]
    paths: dict[tuple[int, ...], int] = {(): 0}
    for level in range(LEVELS):
        large = {path: node for path, node in paths.items() if sizes[node] > most}
        if not large:
            break

        def run(batches: Iterator[pa.RecordBatch], large=frozenset(large), level=level) -> Iterator[pa.RecordBatch]:
            found: Counter = Counter()
            for batch in batches:
                vecs = np.minimum(vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()]), MOST_COUNT)
                found.update(t for t in map(tuple, vecs[:, :level + 1].tolist()) if t[:level] in large)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.list_(pa.int32())), pa.array(list(found.values()), pa.int64())], names=["path", "n"])

        rows = words.select("word").mapInArrow(run, "path array<int>, n long").groupBy("path").agg(F.sum("n").alias("n"))
        paths = {}
        for r in sorted((tuple(r["path"]), r["n"]) for r in rows.collect()):  # at most 8 children of each large node
            path, size = r
            node = len(levels)
            parent = large[path[:-1]]
            levels[parent] = level
            children[parent][path[-1]] = node
            levels.append(level + 1)
            children.append({})
            sizes.append(size)
            paths[path] = node
    blocks = tuple(1 if c else math.ceil(s / (4 * most)) for c, s in zip(children, sizes))
    return Top(tuple(levels), tuple(children), blocks)


# --- the search over cells ---------------------------------------------------------------------

OWN, BASE = 1, 2  # a word of this cell that visits another of its blocks; a word of this very block


def deal(words: DataFrame, top: Top) -> DataFrame:
    """(cell, block, kind, word, n): each word in its block, and as a visitor where the budget reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = batch.column(0).to_pylist(), batch.column(1)
            vecs = vectors([w.encode("latin-1") for w in texts])
            home = np.zeros(len(texts), np.int64)
            for cell, who in top.cells(vecs, False):
                home[who] = cell
            block = np.array([zlib.crc32(w.encode()) % top.blocks[c] for w, c in zip(texts, home)], np.int64)
            for cell, who in top.cells(vecs, True):
                who = who[home[who] <= cell]
                for b in range(top.blocks[cell]):
                    kind = np.where(home[who] < cell, 0, np.where(block[who] == b, BASE, OWN))
                    if len(who):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(who), cell), pa.int32()), pa.array(np.full(len(who), b), pa.int32()),
                             pa.array(kind, pa.int32()), batch.column(0).take(pa.array(who)), n.take(pa.array(who))],
                            names=["cell", "block", "kind", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell int, block int, kind int, word string, n long")


def meet(table: pa.Table) -> pa.Table:
    """One block of a cell: search the trie of its words for all words dealt to it, and verify.  Per word that has
    near words here: their number, and the best one with its count."""
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    n, kind = table.column("n").to_numpy(), table.column("kind").to_numpy()
    vecs = vectors(words)
    base = np.flatnonzero(kind == BASE)
    base = base[np.lexsort(vecs[base].T[::-1])]
    tips = ends(words)
    near: dict[int, int] = {}
    best: dict[int, tuple[int, bytes]] = {}

    def take(i: int, j: int) -> None:
        near[i] = near.get(i, 0) + 1
        found = (-int(n[j]), words[j])
        if i not in best or found < best[i]:
            best[i] = found

    for a, b in search(vecs[base], vecs):
        b = base[b]
        alike = (tips[a] == tips[b]).any(axis=1) | (tips[a] == 0).any(axis=1) | (tips[b] == 0).any(axis=1)
        for i, j in zip(a[alike].tolist(), b[alike].tolist()):
            x, y = words[i], words[j]
            # words of one cell meet from both sides
            if (not kind[i] or x < y) and one_edit(x, y):
                take(i, j)
                take(j, i)
    who = list(near)
    return pa.table({"word": pa.array([words[i].decode("latin-1") for i in who], pa.string()),
                     "near": pa.array([near[i] for i in who], pa.int64()),
                     "form_n": pa.array([-best[i][0] for i in who], pa.int64()),
                     "form": pa.array([best[i][1].decode("latin-1") for i in who], pa.string())})


def near_words(words: DataFrame, n: int, p: Params = Params()) -> DataFrame:
    """(word, n_near, best: struct of the negative count and the word) of all words of ``words`` that have near words."""
    narrow_batches(words.sparkSession, 20_000)
    dealt = deal(words, upper_trie(words, n, p))
    found = dealt.groupBy("cell", "block").applyInArrow(meet, "word string, near long, form_n long, form string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct(
        (-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of ``links`` (word, form), whose chains end: pointer doubling."""
    cur = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = cur.select(F.col("word").alias("at"), F.col("root").alias("further"))
        nxt = stage(cur.join(up.hint("merge"), cur["root"] == up["at"], "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        unstage(cur)
        cur = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return cur


def variants(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if p.ratio < 2:
        raise ValueError("ratio has to be 2 or more: counts must grow along the forms, or chains would not end")
    words = stage(count_words(docs, p, text), "spelling-words")
    found = stage(near_words(words, words.count(), p), "spelling-near")
    joined = words.join(found.hint("merge"), "word", "left").withColumn("top", -F.col("best.less"))
    has_form = F.coalesce(F.col("top") >= p.ratio * F.col("n"), F.lit(False))
    joined = stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, F.col("top")).alias("form_n")), "spelling-forms")
    last = roots(joined.where("form is not null"))
    return joined.join(last.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
