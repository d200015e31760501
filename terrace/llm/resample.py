"""Importance resampling: draw the documents whose hashed n-grams look most like a target's.

Every run of 1 to ``longest`` consecutive words is a feature, and its bucket
is its CRC-32 modulo ``buckets``.  Counts of the buckets over all documents
and over the whole target give each bucket a gain, 1000 times the smoothed log
ratio of its shares.  A document's weight is the floored mean of its features'
gains.  Gumbel noise from the hash of (seed, doc_id) is added, and the highest
``percent`` of the documents with at least ``least_words`` words are drawn,
which samples without replacement in proportion to exp(weight / 1000).

A batch's texts are joined with a sentinel that no word holds; one regex pass
finds all words of the batch, ``searchsorted`` in the documents' offsets gives
each word its document and masks the n-grams that reach over a sentinel, and
``bincount`` adds up buckets or documents.  Batches are cut by bytes, and a
text beyond that size is read in pieces cut between words, so memory does not
grow with a text; whole texts are counted.

What reaches the driver is bounded by parameters: one number a bucket.  Ranks
need no global sort: scores are whole numbers in a range that the formula
bounds, so places come from a histogram of the scores, and only rows of one
score are sorted together, equal rows as one.

Null and empty texts have no features: n_features 0, weight 0.  A null doc_id
is the empty text in the hash and comes last among ties.  Repeated rows count
as often as they come and take one rank each.  An empty target or table is
fine: counts are smoothed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import add_columns, narrow_batches, stage

#: Words in UTF-8: every byte of a character beyond ASCII is a word byte.  A-Z are lower-cased before.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SENTINEL = b"\x00"


@dataclass(frozen=True)
class Params:
    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: str = "2024"
    #: bytes of text that are scanned at once; no effect on the result
    batch_bytes: int = 1 << 20


def joined(texts: list[bytes], most: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Batches of whole texts, lower-cased and joined: the first text's number, the bytes, the texts' starts."""
    first, held, size = 0, [], 0
    for k, t in enumerate(texts):
        if held and size + len(t) > most:
            yield first, SENTINEL.join(held).lower(), np.cumsum([0, *(len(x) + 1 for x in held[:-1])])
            first, held, size = k, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, SENTINEL.join(held).lower(), np.cumsum([0, *(len(x) + 1 for x in held[:-1])])


def hashes(data: bytes, at: int, end: int, longest: int, before: list[int]) -> np.ndarray:
    """(start, CRC of the words that end here, 1 to ``longest`` of them) per word of ``data[at:end]``, in one pass.

    ``before`` holds the CRCs of the runs that end at the word before, and is left for the next piece.
    """
    crc, kind = zlib.crc32, np.dtype([("at", np.int64), *((f"h{n}", np.uint32) for n in range(1, longest + 1))])
    if longest == 1:
        return np.fromiter(((m.start(), crc(m.group())) for m in WORD.finditer(data, at, end)), kind)

    def rows():
        for m in WORD.finditer(data, at, end):
            word = m.group()
            runs = [crc(word), *(crc(word, crc(b" ", h)) for h in before[:longest - 1])]
            before[:] = runs
            yield (m.start(), *runs, *[0] * (longest - len(runs)))
    return np.fromiter(rows(), kind)


def pieces(data: bytes, most: int) -> Iterator[tuple[int, int]]:
    """Cuts of ``data`` between words, of about ``most`` bytes each."""
    at = 0
    while at < len(data):
        cut = NOT_WORD.search(data, min(len(data), at + most))
        end = cut.start() if cut else len(data)
        yield at, end
        at = max(end, at + 1)


def features(texts: list[bytes], p: Params) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document numbers of all features, their buckets, document numbers of the words), piece by piece."""
    for first, data, starts in joined(texts, p.batch_bytes):
        before: list[int] = []
        tail = np.zeros(0, np.int64)  # documents of the last words of the piece before
        for at, end in pieces(data, p.batch_bytes * 2):
            found = hashes(data, at, end, p.longest, before)
            doc = np.searchsorted(starts, found["at"], side="right") - 1
            docs, buckets = [doc], [found["h1"] % p.buckets]
            past = np.concatenate([tail, doc])
            for n in range(2, p.longest + 1):
                # the run's first word, n - 1 words earlier, has to be of the same document
                begin = np.arange(len(doc)) + len(tail) - (n - 1)
                same = (begin >= 0) & (past[np.maximum(begin, 0)] == doc) if len(past) else np.zeros(0, bool)
                docs.append(doc[same])
                buckets.append(found[f"h{n}"][same] % p.buckets)
            tail = past[len(past) - (p.longest - 1):] if p.longest > 1 else tail
            yield first + np.concatenate(docs), np.concatenate(buckets), first + doc


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in column]


def bucket_counts(docs: DataFrame, p: Params, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket: each task adds up, then one row a bucket and task is summed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets, np.int64)
        for batch in batches:
            for _, buckets, _ in features(_bytes(batch.column(0)), p):
                total += np.bincount(buckets, minlength=p.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["b", "n"])

    narrow_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "b int, n long").groupBy("b").agg(F.sum("n").alias("n"))
    out = np.zeros(p.buckets, np.int64)
    for r in rows.collect():  # at most ``buckets`` rows
        out[r["b"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of each bucket."""
    all_s, all_t, m = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + m) / ((s + 1) * (all_t + m))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def with_weights(docs: DataFrame, gain: np.ndarray, p: Params, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_features and weight of each whole text."""
    def run(columns: list[pa.Array]) -> list[pa.Array]:
        size = len(columns[0])
        words, n, total = (np.zeros(size, np.int64) for _ in range(3))
        for doc, buckets, of_word in features(_bytes(columns[0]), p):
            words += np.bincount(of_word, minlength=size)
            n += np.bincount(doc, minlength=size)
            np.add.at(total, doc, gain[buckets])
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        return [pa.array(x, pa.int64()) for x in (words, n, weight)]

    kinds = {c: T.LongType() for c in ("n_words", "n_features", "weight")}
    return add_columns(docs, [text], kinds, run)


def noise(seed: str, doc_id: str = "doc_id") -> Column:
    """floor(1000 times a standard Gumbel value) from the first 32 bits of sha256(``seed:doc_id``)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, target: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, n_features, weight and score instead of the text."""
    gain = gains(bucket_counts(docs, p, text), bucket_counts(target, p))
    rows = with_weights(docs, gain, p, text).drop(text)
    return rows.withColumn("score", (F.col("weight") + noise(p.seed)).cast("long"))


def rank_drawn(rows: DataFrame, p: Params = Params()) -> DataFrame:
    """``rows`` (doc_id, n_words, n_features, weight, score) with ``rank`` from 1 for those drawn, else null.

    A histogram of the scores, in coarse steps and single scores, says how many
    documents come before each score.  The formula bounds the number of
    different scores (the noise spans 26,000, the gains some ten thousand), so
    the window over the steps is short whatever the table's size.
    """
    eligible = rows.where(F.col("n_words") >= p.least_words)
    hist = stage(eligible.groupBy("score").agg(F.count("*").alias("n")).withColumn(
        "step", F.floor(F.col("score") / 100)), "resample-scores")
    n = hist.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = n * p.percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not most:
        return rows.select("*", none)

    def earlier(window):
        return F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    steps = hist.groupBy("step").agg(F.sum("n").alias("n")).select("step", earlier(
        Window.orderBy(F.col("step").desc())).alias("over"))
    places = hist.select("step", "score", earlier(Window.partitionBy("step").orderBy(F.col("score").desc())).alias("in_step"))
    places = places.join(steps, "step").select(F.col("score").alias("at"), (F.col("over") + F.col("in_step")).alias("before"))
    places = stage(places.where(F.col("before") < most), "resample-places")
    last = places.agg(F.min("at")).first()[0]
    drawn = F.coalesce((F.col("n_words") >= p.least_words) & (F.col("score") >= last), F.lit(False))
    # rows that are equal in all columns take neighbouring ranks: they are sorted as one
    groups = rows.where(drawn).groupBy(*rows.columns).agg(F.count("*").alias("__llm_n"))
    order = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    first = groups.join(places, groups["score"] == places["at"]).withColumn(
        "__llm_first", F.col("before") + F.sum("__llm_n").over(order) - F.col("__llm_n"))
    single = first.withColumn("rank", F.explode(F.sequence(F.col("__llm_first") + 1, F.col("__llm_first") + F.col("__llm_n"))))
    ranked = single.select(*rows.columns, F.when(F.col("rank") <= most, F.col("rank")).alias("rank"))
    return ranked.union(rows.where(~drawn).select("*", none))


def resample(docs: DataFrame, target: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank."""
    rows = stage(weigh(docs.select("doc_id", F.col(text).alias("text")), target, p), "resample-scores")
    return rank_drawn(rows, p).select("doc_id", "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """The drawn documents themselves, with all columns of ``docs``; a doc_id of which one row is drawn comes with all its rows."""
    keys = resample(docs, target, p, text).where("rank is not null").select(
        F.col("doc_id").alias("__llm_id")).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["__llm_id"]), "left_semi")
