"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases a text, maps look-alike letters of other scripts and
digits or signs that stand for letters to plain letters, drops invisible
characters, and turns everything else that is no letter into single spaces.
Lexicon entries are whole words (" word ") or word beginnings (" beg").  One
pass of an Aho-Corasick automaton finds all entries and all exception phrases;
entries inside an exception phrase do not count.  A document's features are
the summed weight of its hits and that sum by length; a logistic curve turns
them into a score from 0 to 1.

The lexicon is learned: among the words and word beginnings of labelled
documents, those that toxic ones have far more often than others, weighted by
their smoothed log odds, plus a short base list.  Learning reads a bounded,
repeatable sample of labelled documents (``max_train``, by hash of doc_id)
outside the held-out fold; matching covers every whole text.

Null and empty texts have no hits.  Null labels are left out, a document with
conflicting labels counts for both.  Without labels of both classes the base
list and a fixed curve are used.  Repeated rows are scored alike.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import add_columns, held_out, narrow_batches, stage

# Words that are insults in most contexts, and phrases in which such words are not.
BASE = ("idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "worthless")
EXCEPTIONS = ("clown fish", "clown car", "trash can", "trash bag", "trash bin", "idiot proof", "sore loser rule")
BASE_WEIGHT = 3.0

# Letters that look like a Latin letter, and digits or signs written for one.
_ALIKE = {
    "a": "аαａ4@", "b": "ｂ8", "c": "сϲｃ", "d": "ԁｄ", "e": "еεｅ3€", "f": "ｆ", "g": "ɡｇ9", "h": "һｈ", "i": "іιｉ1", "j": "јｊ",
    "k": "κкｋ", "l": "ӏⅼｌ", "m": "мｍ", "n": "ոｎ", "o": "оοｏ0", "p": "рρｐ", "q": "ԛｑ", "r": "гｒ", "s": "ѕｓ5$", "t": "тτｔ7",
    "u": "υսｕ", "v": "νѵｖ", "w": "ԝｗ", "x": "хχｘ", "y": "уγｙ", "z": "ｚ2",
}


class _Folding(dict):
    """Translation table that decides on a character when it first meets it."""

    def __missing__(self, code: int) -> str:
        char = chr(code).lower()
        out = "".join(self[ord(c)] for c in char) if len(char) > 1 else char
        if len(char) == 1:
            kind = unicodedata.category(char)
            out = char if kind[0] == "L" else "" if kind in ("Cf", "Mn") else " "
            out = self.get(ord(char), out) if ord(char) != code else out
        self[code] = out
        return out


FOLDING = _Folding({ord(c): letter for letter, alike in _ALIKE.items() for c in alike})
FOLDING.update({ord(c.upper()): letter for letter, alike in _ALIKE.items() for c in alike if len(c.upper()) == 1
                and c.upper() != c and not c.isascii()})


def fold(text: str | None) -> str:
    """The folded words of a text, each with a space before and after."""
    return f" {' '.join((text or '').translate(FOLDING).split())} "


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]                 # " word " or " beginning" -> weight
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 0.5)   # intercept, by log weight, by log weight per 1000 words
    _built: list = field(default_factory=list, compare=False, repr=False)

    def automaton(self) -> ahocorasick.Automaton:
        if not self._built:
            machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                machine.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                entry = fold(phrase)
                machine.add_word(entry, (len(entry), 0.0))
            machine.make_automaton()
            self._built.append(machine)
        return self._built[0]

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_built": []}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def features(self, text: str | None) -> tuple[float, float]:
        """log of 1 + the weight of all hits, and of 1 + that weight by 1000 words.

        Only the heaviest entry counts where several start at the same word.
        """
        folded = fold(text)
        if not self.weights:
            return 0.0, 0.0
        best: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton().iter(folded):
            start = end - size + 1
            if weight:
                best[start] = max(best.get(start, 0.0), weight)
            else:
                excepted.append((start, end))
        if excepted:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in excepted)}
        total = sum(best.values())
        return math.log1p(total), math.log1p(1000.0 * total / max(1, folded.count(" ") - 1))

    def score(self, text: str | None) -> float:
        a, b = self.features(text)
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def base_lexicon() -> Lexicon:
    return Lexicon({f" {w} ": BASE_WEIGHT for w in BASE})


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.05,
              c: np.ndarray | None = None) -> tuple[float, float, float]:
    """Ridge-penalised logistic regression by Newton steps; ``c``: how many rows each one stands for."""
    c = np.ones(len(x)) if c is None else c
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -500, 500)))
        hess = (x * (c * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (c * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", max_train: int = 20_000, beginnings: tuple[int, ...] =
          (4, 5, 6, 7, 8), least_toxic: int = 5, most_chance: float = 1e-4,
          least_weight: float = 4.0) -> Lexicon:
    """A lexicon and curve from about ``max_train`` labelled documents outside the held-out fold.

    ``max_train`` bounds the sample, a parameter of the fit only; with it the
    number of entries is bounded, of which none that is significant is left out.  An entry must occur in ``least_toxic`` distinct
    toxic texts, copies of a text counting once, and have the log odds
    ``least_weight`` or occur in no other text, where the smoothing alone bounds
    them.  Its distinct texts must be so much more often toxic that chance would
    have it with a probability below ``most_chance`` (by Chernoff's bound).
    How many toxic texts are without it does not matter.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).select(
        "doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    n = known.count()
    share = min(1.0, max_train / max(1, n))
    if share < 1.0:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < int(share * 1_000_000))
    # one row for each text and label, with the number of its rows
    sample = stage(docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(known), "doc_id").groupBy(
        "text", "y").agg(F.count("*").alias("c")), "toxic-sample")

    def words(columns: list[pa.Array]) -> list[pa.Array]:
        out = []
        for t in columns[0]:
            found = set()
            for w in set(fold(t.as_py()).split()):
                found.add(f" {w} ")
                found.update(f" {w[:k]}" for k in beginnings if len(w) >= k)
            out.append(sorted(found))
        return [pa.array(out, pa.list_(pa.string()))]

    classes = {r["y"]: (float(r["n"]), float(r["texts"])) for r in sample.groupBy("y").agg(
        F.sum("c").alias("n"), F.count("*").alias("texts")).collect()}  # two rows
    if len(classes) < 2:
        return base_lexicon()
    (clean, clean_texts), (toxic, toxic_texts) = classes[0], classes[1]
    entries = add_columns(sample, ["text"], {"entries": T.ArrayType(T.StringType())}, words).select(
        "y", "c", F.explode("entries").alias("entry"))
    a, b, both = F.col("toxic_texts"), F.col("clean_texts"), clean_texts + toxic_texts
    counts = entries.groupBy("entry").agg(
        F.sum(F.col("y") * F.col("c")).alias("t"), F.sum((1 - F.col("y")) * F.col("c")).alias("f"),
        F.sum("y").alias("toxic_texts"), F.sum(1 - F.col("y")).alias("clean_texts")).where(a >= least_toxic)
    surprise = a * F.log(a * both / ((a + b) * toxic_texts)) + F.when(
        b > 0, b * F.log(b * both / ((a + b) * clean_texts))).otherwise(0.0)
    telling = (surprise >= -math.log(most_chance)) & (a * clean_texts > b * toxic_texts)
    weight = (F.log((F.col("t") + 0.5) / (F.lit(toxic) - F.col("t") + 0.5))
              - F.log((F.col("f") + 0.5) / (F.lit(clean) - F.col("f") + 0.5)))
    # a text becomes thousands of entries: few texts at a time
    narrow_batches(sample.sparkSession, 100)
    found = counts.withColumn("w", weight).where(
        telling & (F.col("w") > 0) & ((F.col("w") >= least_weight) | (F.col("f") == 0))).collect()  # bounded by the sample
    chosen: dict[str, float] = {}
    most: dict[str, int] = {}   # beginning of chosen entries -> the most toxic rows that one of them has
    for r in sorted(found, key=lambda r: (-r["w"], len(r["entry"]), r["entry"])):
        entry, stem = r["entry"], r["entry"].strip()
        # a beginning at least as telling covers it, or it is telling only for the sake of a longer one
        covered = any(f" {stem[:k]}" in chosen for k in range(1, len(stem) + 1))
        borrowed = most.get(f" {stem}", -1) >= 0.8 * r["t"]
        if not covered and not borrowed:
            chosen[entry] = r["w"]
            for k in range(1, len(entry) + 1):
                most[entry[:k]] = max(most.get(entry[:k], 0), r["t"])
    for w in BASE:
        chosen.setdefault(f" {w} ", BASE_WEIGHT)
    raw = Lexicon(chosen)
    shared = sample.sparkSession.sparkContext.broadcast(raw)

    def measure(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([shared.value.features(t.as_py()) for t in columns[0]], pa.list_(pa.float64()))]

    # in one order, so that the sums of the fit are the same each time
    rows = sorted(add_columns(sample, ["text"], {"x": T.ArrayType(T.DoubleType())}, measure).groupBy("x", "y").agg(F.sum("c").alias("c")).collect())
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], dtype=float)
    return Lexicon(chosen, curve=fit_curve(x, y, c=np.array([r["c"] for r in rows], dtype=float)))


def score_texts(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the toxicity of each whole text, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([shared.value.score(t.as_py()) for t in columns[0]], pa.float64())]

    return add_columns(docs, [text], {out: T.DoubleType()}, run)
