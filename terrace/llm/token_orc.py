"""Token ids as ORC files: range-sorted, with row indexes and Bloom filters on doc_id.

``write_tokens`` deals whole texts to range partitions of doc_id, encodes them
where they land and writes one file per partition, in ascending doc_id order
(null ids first; rows with the same id in the order of their text's hash).
ORC stores the ids with integer run-length encoding in stripes; tasks read the
stripes of a file in parallel.  A reader that asks for some doc_ids skips
files and stripes by their statistics and Bloom filters (``read_tokens``).

Each row holds ``doc_id``, ``ids``, their number ``n`` and ``offset``, the number of ids before it
among the rows of its task; ``task_starts`` adds up the tasks' files, so a document's first position
in the whole stream needs no global sort of rows.

Null and empty texts are written with the end id alone.  Repeated rows are
written as often as they come.  An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import is_plain, narrow_batches

KEPT = 250_000
SCHEMA = "doc_id long, ids array<int>, offset long, n int"
# In plain texts lower-casing goes letter by letter and composes nothing, and the tokenizer's split
# is this one; the strings of its special tokens start with the mark below.
_SPECIAL = "<|"
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


class TextEncoder:
    """Ids of whole texts by the library, which drops white space and never lets a token span it.

    Texts of plain letters are split here and each part is merged by the
    library's model once while it is among the newest results; other words go
    through the whole library one by one.  ``check`` holds the two ways
    against each other when the encoder is made.
    """

    def __init__(self, json: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(json)
        self.model = self.tokenizer.model
        self.numbers = list(range(self.tokenizer.get_vocab_size()))
        self.kept: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x100)
                      if is_plain(chr(c))}
        self.plain = self.check()

    def check(self) -> bool:
        sample = "".join(chr(c) + " " * (c % 3 == 0) for c in self.table) + "It's we'll ÀÉß1234 ,.!? don't"
        return self._split(sample) == self.library(sample)

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _keep(self, part: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(part) <= 48:
            if len(self.kept) >= KEPT:
                self.kept, self.older = {}, self.kept
            self.kept[part] = ids
        return ids

    def _part(self, part: str) -> tuple[int, ...]:
        out = self.older.get(part)
        if out is None:
            numbers = self.numbers
            out = tuple([numbers[t.id] for t in self.model.tokenize(
                part if part.isascii() else part.translate(self.table))])
        return self._keep(part, out)

    def _split(self, text: str) -> list[int]:
        out: list[int] = []
        for part in _SPLIT.findall(text.lower()):
            ids = self.kept.get(part)
            out += self._part(part) if ids is None else ids
        return out

    def encode(self, text: str) -> list[int]:
        if not self.plain:
            return self.library(text)
        if is_plain(text) and _SPECIAL not in text:
            return self._split(text)
        out: list[int] = []
        for word in text.split(" "):
            out += self._split(word) if is_plain(word) and _SPECIAL not in word else self.library(word)
        return out


_encoders: dict[int, TextEncoder] = {}


def _encoder(shared) -> TextEncoder:
    key = hash(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(shared.value)
    return _encoders[key]


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, text: str = "text",
                 stripe_mb: int = 64, stride: int = 1000) -> None:
    """Encode ``docs`` (doc_id and text) with the tokenizer in the file ``tokenizer_json`` and write it to ``path``."""
    with open(tokenizer_json, encoding="utf-8") as f:
        json = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = _encoder(shared), 0
        for batch in batches:
            ids, offsets, sizes = [], [], []
            for t in batch.column(1):
                row = encoder.encode(t.as_py() or "")
                row.append(end_id)
                ids.append(row)
                offsets.append(before)
                sizes.append(len(row))
                before += len(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.int64()),
                 pa.array(sizes, pa.int32())], names=["doc_id", "ids", "offset", "n"])

    narrow_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, SCHEMA)
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(stride))
     .option("orc.stripe.size", str(stripe_mb << 20)).option("compression", "snappy").orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of ``path`` with the file they are in and the task that wrote it; ``doc_ids`` prunes by statistics
    and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path).withColumn("file", F.col("_metadata.file_name"))
    # the number in a file's name says which range it holds; as text, part-100000 would come before part-99999
    rows = rows.withColumn("task", F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long"))
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))


def task_starts(tokens: DataFrame) -> DataFrame:
    """(task, first): ids in the files of all tasks before it; one row a task, so the running sum is over metadata.

    A row's ``offset`` counts all of its task's rows, however many files the task was split into.
    """
    totals = tokens.groupBy("task").agg(F.sum(F.col("n").cast("long")).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            n = [int(b - a) for a, b in zip(ends[:-1], ends[1:])]
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "offset", "task", "n_tokens", "ids_crc32"])

    tokens = read_tokens(spark, path)
    starts = task_starts(tokens)
    rows = tokens.select("doc_id", "ids", "offset", "task").mapInArrow(run, "doc_id long, offset long, task long, n_tokens long, ids_crc32 long")
    # one short row a task: bounded by the number of range partitions
    return rows.join(F.broadcast(starts), "task").select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
