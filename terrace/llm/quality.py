"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a fixed vector of transformed statistics (``FEATURES``).
Per class, Spark adds up counts, sums and products of the labelled rows, so
the fit covers all labels and nothing larger than (features squared) reaches
the driver.  Class covariances are shrunk towards the pooled covariance and a
multiple of the identity.  The score is the class-1 probability from the
difference of the log densities; Mahalanobis distances are solved with the
Cholesky factors, which are computed once per fit.

Null and empty texts have the statistics of no words.  Rows whose held-out
remainder is 0 are never learned from.  Repeated rows count as often as they
come; a document with conflicting labels counts for both classes; null labels
are left out.  Where the labelled texts of a class, or of both, are all alike,
the covariance is the ridge alone, with an absolute floor.  Without labelled rows of a class, scores are the prior of the
other: 1.0 if class 0 is missing, 0.0 if class 1 is, 0.5 if both are.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import add_columns, held_out, stage

FEATURES = ("log_words", "word_length", "upper", "marks", "stops", "digits", "repeats", "top_word", "distinct",
            "short_long", "line_words", "same_lines", "blank")
_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = b"0123456789"
_STOP = b".,;:?'\"-"
_MARK = bytes(b for b in range(0x21, 0x7F) if chr(b) in "!#$%&()*+/<=>@[\\]^_`{|}~")
_SPACE = b" \t\n\r\x0b\x0c"


def _share(part: float, whole: float, scale: float) -> float:
    """A share on a scale that spreads small values: 0 -> 0, 1 -> 1."""
    return math.log1p(scale * part / whole) / math.log1p(scale) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    counts = Counter(words)
    inked = size - (size - len(data.translate(None, _SPACE)))
    lines = [x for x in data.split(b"\n") if x.strip()]
    top = max(counts.values(), default=0)
    same = len(lines) - len(set(lines))
    letters = max(1, inked)
    return [
        math.log1p(n),
        math.log1p(inked / n) if n else 0.0,
        _share(size - len(data.translate(None, _UPPER)), letters, 10.0),
        _share(size - len(data.translate(None, _MARK)), letters, 100.0),
        _share(size - len(data.translate(None, _STOP)), letters, 100.0),
        _share(size - len(data.translate(None, _DIGIT)), letters, 100.0),
        _share(sum(map(eq, words, words[1:])), n + 20, 20.0),
        # the most frequent word beyond what chance gives a short text
        _share(max(0, top - 1), n + 20, 20.0),
        len(counts) / n ** 0.9 if n else 0.0,
        _share(sum(c for w, c in counts.items() if len(w) > 24), n, 100.0),
        math.log1p(n / len(lines)) if lines else 0.0,
        _share(same, len(lines), 10.0),
        _share(size - inked, max(1, size), 1.0),
    ]


def with_statistics(docs: DataFrame, text: str = "text", out: str = "__llm_stats") -> DataFrame:
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        return [pa.array([statistics(t.as_py()) for t in columns[0]], pa.list_(pa.float64()))]

    return add_columns(docs, [text], {out: T.ArrayType(T.DoubleType())}, run)


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors of the shrunk covariances, and log priors of classes 0 and 1."""

    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    log_priors: tuple[float, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.means) < 2:
            return np.full(len(x), math.exp(self.log_priors[1]) if self.log_priors else 0.5)
        log = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_priors):
            z = np.linalg.solve(factor, (x - mean).T)
            log.append(prior - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(stats: DataFrame, label: str, vector: str = "__llm_stats", shrink: float = 0.3,
        ridge: float = 1e-2) -> Discriminant:
    """Fit on rows (vector, label 0/1) by one aggregation of their sums and products."""
    d = len(FEATURES)
    x = [F.element_at(vector, i + 1) for i in range(d)]
    sums = [F.sum(c) for c in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i + 1)]
    rows = stats.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("y")).agg(
        F.count("*").alias("n"), F.array(*sums).alias("s")).collect()  # two rows
    per = {int(r["y"]): (r["n"], np.array(r["s"])) for r in rows}
    if len(per) < 2:
        one = 1.0 if per and 1 in per else 0.0 if per else 0.5
        return Discriminant((), (), (math.log1p(-one) if one < 1 else -math.inf, math.log(one) if one else -math.inf))
    total = sum(n for n, _ in per.values())
    means, covs = [], []
    for y in (0, 1):
        n, s = per[y]
        mean, second = s[:d] / n, np.zeros((d, d))
        second[np.tril_indices(d)] = s[d:] / n
        second = second + np.tril(second, -1).T
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
    pooled = sum(per[y][0] / total * covs[y] for y in (0, 1))
    # the floor keeps the factors regular where all texts of both classes agree
    scale = max(np.trace(pooled) / d, 1e-4)
    factors = [np.linalg.cholesky((1 - shrink) * c + shrink * (0.5 * pooled + 0.5 * np.diag(np.diag(pooled)))
                                  + ridge * scale * np.eye(d)) for c in covs]
    return Discriminant(tuple(means), tuple(factors), tuple(math.log(per[y][0] / total) for y in (0, 1)))


def training_rows(docs_with_id: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Rows of documents outside the held-out fold with their label; a label repeated for a document counts once."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("__llm_label")).distinct()
    # both sides grow with the corpus: merged, not broadcast
    return docs_with_id.where(~held_out()).join(known.hint("merge"), "doc_id")


def score(rows: DataFrame, model: Discriminant, vector: str = "__llm_stats", out: str = "score") -> DataFrame:
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        x = columns[0].flatten().to_numpy(zero_copy_only=False).reshape(len(columns[0]), -1)
        return [pa.array(model.scores(x) if len(x) else [], pa.float64())]

    return add_columns(rows, [vector], {out: T.DoubleType()}, run)


def train(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[Discriminant, DataFrame]:
    """The model, and the statistics (doc_id, vector) of every row that it was fitted from."""
    stats = stage(with_statistics(docs.select("doc_id", F.col(text).alias("text"))).drop("text"), "quality-stats")
    return fit(training_rows(stats, labels, "quality"), "__llm_label"), stats


def score_texts(docs: DataFrame, model: Discriminant, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, in one pass."""
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        x = np.array([statistics(t.as_py()) for t in columns[0]]).reshape(len(columns[0]), len(FEATURES))
        return [pa.array(model.scores(x), pa.float64())]

    return add_columns(docs, [text], {out: T.DoubleType()}, run)
