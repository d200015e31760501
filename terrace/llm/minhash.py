"""Near-duplicate documents by similarity sketches, banding and exact verification.

A document is the set of its distinct word shingles.  Its sketch has one
coordinate per bin.  Each round hashes every element once more, to a bin and a
value; a bin keeps the smallest (round, value).  After as many rounds as bins,
the remaining rounds take one bin each and place all elements in it, so every
coordinate fills, and the number of equal coordinates of two sets concentrates
around their similarity (Dahlgaard, Knudsen, Thorup, "Fast Similarity
Sketching").  Most documents need two or three rounds.

Coordinates are cut into bands; sets that agree in a band share a bucket.  The
sets that buckets connect make up a family, and links are confirmed inside
families on the full sets: every pair of a family whose sets are not already
connected by links is compared.  With the default 42 bands of 6, a pair at
similarity 0.8 shares no bucket with probability 3e-6, and a pair that shares
none is still compared when its family has both.

Copies and scale.  Equal sets are one node from the start (a 64-bit hash of
the set), whatever their number.  Families are dealt to tasks by the number of
their shingles: small ones many to a task, a large one in chunks, each of which
also holds the family's first sets as hubs.  After that pass nearly all sets of
a large family hang together through the hubs; those outside its main component
are compared with all chunks in a second pass.  No pairs are emitted: a task
returns at most one link for each set and component that it met.

Null, empty and blank texts have no shingles: n_shingles 0, linked with
nothing, each its own component.  Texts with fewer words than a shingle are one
shingle.  Repeated rows, and rows with one doc_id and different texts, are rows
of their own; a component's id is its smallest doc_id (null if it has none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import components, narrow_batches, stage

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_EMPTY = np.uint64(2**64 - 1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2, _S33, _S32 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33), np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)
_hash = xxhash.xxh3_64_intdigest


@dataclass(frozen=True)
class Params:
    words: int = 5            # words in a shingle
    percent: int = 80         # least similarity of a link, in hundredths
    bands: int = 42
    rows: int = 6             # coordinates in a band
    chunk: int = 100_000      # shingles that a task compares at a time; no effect on the result
    hubs: int = 16            # sets of a large family that every chunk holds; no effect on the result


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    x = (x ^ (x >> _S33)) * _MIX1
    x = (x ^ (x >> _S33)) * _MIX2
    return x ^ (x >> _S33)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter; empty without words."""
    # bytes.split() parts at the six ASCII white-space characters, \x20 and \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = mix(out * _GOLD + h[i:i + n])
    return np.unique(out)


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """The t coordinates of a non-empty set."""
    seeds = mix(np.arange(1, 2 * t + 1, dtype=np.uint64) * _GOLD)
    out = np.full(t, _EMPTY)
    done, n = 0, len(elements)
    while done < t:  # small sets take several rounds at a time
        upto = min(t, done + max(1, 2 * t // n))
        h = mix(elements[None, :] ^ seeds[done:upto, None])
        bins = ((h >> _S32) * np.uint64(t)) >> _S32
        values = (h & _LOW32) | (np.arange(done, upto, dtype=np.uint64) << _S32)[:, None]
        np.minimum.at(out, bins.ravel().astype(np.intp), values.ravel())
        done = upto
        if not (out == _EMPTY).any():
            return out
    for b in np.nonzero(out == _EMPTY)[0]:
        out[b] = (mix(elements ^ seeds[t + b]) & _LOW32).min() | np.uint64((t + int(b)) << 32)
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = coordinates.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _GOLD
    for c in range(rows):
        key = mix(key * _MIX1 + parts[:, c])
    return key


def set_id(elements: np.ndarray) -> int:
    """64-bit identity of a set, as a signed number."""
    x = _hash(elements.tobytes())
    return x - (1 << 64) if x >> 63 else x


def sketches(docs: DataFrame, p: Params, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, bands) for every row; node and bands are null without shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), p.words)
                sizes.append(len(s))
                nodes.append(set_id(s) if len(s) else None)
                bands.append(band_keys(sketch(s, p.bands * p.rows), p.bands, p.rows).view(np.int64)
                             if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "node", "bands"])

    narrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, node long, bands array<long>")


class Postings:
    """Sets of a task, by element: for a set, how many elements it shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.values, first = np.unique(flat[order], return_index=True)
        self.ends = np.append(first, len(flat))

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of the sets with 100 * intersection >= percent * union."""
        at = np.minimum(np.searchsorted(self.values, s), len(self.values) - 1)
        at = at[self.values[at] == s]
        first, n = self.ends[at], self.ends[at + 1] - self.ends[at]
        total = int(n.sum())
        if not total:
            return np.empty(0, np.intp)
        skip = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        shared = np.bincount(self.owner[np.arange(total) + skip], minlength=len(self.sizes))
        return np.nonzero(100 * shared >= percent * (self.sizes + len(s) - shared))[0]


def link_within(sets: list[np.ndarray], percent: int, starts: int = 8) -> list[int]:
    """For each set the smallest index it is connected with, over all links among the sets.

    The first sets are compared with all.  From then on a set that hangs
    together with the largest component so far is skipped: a link between two
    skipped sets joins what is joined already, and any other link has an end
    that was compared with all sets.
    """
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if len(sets) == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [0, 0] if 100 * shared >= percent * (len(sets[0]) + len(sets[1]) - shared) else [0, 1]
    postings = Postings(sets)
    left, anchor = len(sets), None
    for i, s in enumerate(sets):
        if left == 1:
            break
        if i == starts:
            roots = [find(j) for j in range(len(sets))]
            anchor = max(set(roots), key=roots.count)
        if anchor is not None and find(i) == find(anchor):
            continue
        for j in postings.linked(s, percent):
            a, b = find(i), find(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                left -= 1
    return [find(i) for i in range(len(sets))]


def _sets(pdf: pd.DataFrame, k: int) -> dict[int, np.ndarray]:
    """Sets by node; a text that is not the node's (another row with its doc_id) is left out."""
    out: dict[int, np.ndarray] = {}
    for node, text in zip(pdf["node"], pdf["text"]):
        if node not in out:
            s = shingle_set(text, k)
            if len(s) and set_id(s) == node:
                out[node] = s
    return out


def _links_within(p: Params):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a: list[int] = []
        b: list[int] = []
        for _, family in pdf.groupby("family", sort=False):
            sets = _sets(family, p.words)
            nodes = list(sets)
            if len(nodes) > 1:
                for node, root in zip(nodes, link_within([sets[n] for n in nodes], p.percent)):
                    if nodes[root] != node:
                        a.append(node)
                        b.append(nodes[root])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def _links_across(p: Params):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a: list[int] = []
        b: list[int] = []
        part = dict(zip(pdf["node"], pdf["part"]))
        outer, home = _sets(pdf[pdf["outer"]], p.words), _sets(pdf[~pdf["outer"]], p.words)
        if outer and home:
            nodes = list(home)
            postings = Postings([home[n] for n in nodes])
            for node, s in outer.items():
                met = {part[node]}
                for j in postings.linked(s, p.percent):
                    if part[nodes[j]] not in met:
                        met.add(part[nodes[j]])
                        a.append(node)
                        b.append(nodes[j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def _links(docs: DataFrame, nodes: DataFrame, p: Params, text: str) -> DataFrame:
    """Confirmed links (a, b) that connect exactly the nodes that links connect."""
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    near = buckets.join(shared, "bucket").where("node <> hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b"))
    families = components(near, "minhash-families").withColumnRenamed("root", "family")
    members = stage(families.join(nodes.select("node", "rep", "n_shingles"), "node"), "minhash-members")

    sizes = members.groupBy("family").agg(F.sum("n_shingles").alias("total"))
    sizes = stage(sizes.withColumn("chunks", F.ceil(F.col("total") / p.chunk)), "minhash-sizes")
    small = sizes.where("chunks = 1").agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    bins = int(small // p.chunk) + 1
    texts = docs.select(F.col("doc_id").alias("rep"), F.col(text).alias("text"))
    in_family = members.join(sizes, "family")
    chunk = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("chunks")))
    group = F.when(F.col("chunks") == 1, F.lit(0)).otherwise(F.col("family"))
    dealt = in_family.select("node", "rep", "family", "chunks", group.alias("grp"), F.array(chunk).alias("chunk_ids"))
    large = stage(in_family.where("chunks > 1"), "minhash-large")
    if large.isEmpty():
        hubs = None
    else:
        # the first sets of each large family, a fixed number, by partial top lists
        first = large.groupBy("family", F.pmod(F.xxhash64("node", F.lit(7)), F.lit(64)).alias("s")).agg(
            F.min("node").alias("node")).groupBy("family").agg(
            F.slice(F.sort_array(F.collect_list("node")), 1, p.hubs).alias("nodes"))
        hubs = first.select("family", F.explode("nodes").alias("node")).join(large, ["family", "node"]).select(
            "node", "rep", "family", "chunks", F.col("family").alias("grp"),
            F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1).alias("chunk_ids"))
    rows = dealt if hubs is None else dealt.union(hubs)
    with_text = rows.join(texts, rows["rep"].eqNullSafe(texts["rep"])).select(
        "node", "family", "grp", F.explode("chunk_ids").alias("chunk"), "text")
    links = stage(with_text.groupBy("grp", "chunk").applyInPandas(_links_within(p), "a long, b long"), "minhash-links")
    if hubs is None:
        return links

    # sets of large families that the hubs did not reach, against all of their family
    parts = large.select("node", "rep", "family", "chunks", "n_shingles").join(
        components(links.join(large.select(F.col("node").alias("a")), "a", "left_semi"), "minhash-parts")
        .withColumnRenamed("root", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    parts = stage(parts, "minhash-parts")
    counts = parts.groupBy("family", "part").agg(F.count("*").alias("n"))
    main = counts.groupBy("family").agg(F.max(F.struct("n", "part"))["part"].alias("main"))
    parts = parts.join(main, "family")
    outside = parts.where("part <> main")
    loose = outside.groupBy("family").agg(F.ceil(F.sum("n_shingles") / p.chunk).alias("blocks"))
    home = parts.join(loose, "family").select(
        "node", "rep", "family", "part", F.pmod(F.xxhash64("node"), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("outer"))
    outer = outside.join(loose, "family").select(
        "node", "rep", "family", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).alias("block"), F.lit(True).alias("outer"))
    rows = home.union(outer)
    across = rows.join(texts, rows["rep"].eqNullSafe(texts["rep"])).select(
        "node", "family", "part", "chunk", "block", "outer", "text")
    more = across.groupBy("family", "chunk", "block").applyInPandas(_links_across(p), "a long, b long")
    return stage(links.union(more), "minhash-all-links")


def duplicates(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """For every row of ``docs``: doc_id, n_shingles, node, component_id, kept, and the
    component's first node (``first``: a row of that node and id represents it)."""
    rows = stage(sketches(docs, p, text), "minhash-sketches")
    nodes = stage(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")),
        "minhash-nodes")
    links = _links(docs, nodes, p, text)
    # a node without links is its own root: no null keys that would meet in one task
    joined = nodes.select("node", "rep").join(components(links, "minhash-components"), "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("least"))
    found = stage(joined.join(least, "root").select(
        "node", F.col("least.rep").alias("component"), F.col("least.node").alias("first")), "minhash-found")
    return rows.select("doc_id", "n_shingles", "node").join(found, "node", "left").select(
        "doc_id", "n_shingles", "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True)).otherwise(
            F.col("doc_id").eqNullSafe(F.col("component"))).alias("kept"), "first")


def deduplicate(docs: DataFrame, p: Params = Params(), text: str = "text") -> DataFrame:
    """One row of each component of ``docs``, with all its columns: the smallest doc_id's, one of its
    repeats.  Rows without shingles all stay."""
    names = ["__llm_node", "__llm_blank"]
    keep = duplicates(docs, p, text).where("node = first").groupBy("node").agg(F.first("component_id").alias("__llm_id"))
    keep = keep.select(F.col("node").alias(names[0]), F.lit(False).alias(names[1]), "__llm_id",
                       F.lit(True).alias("__llm_hit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [set_id(s) if len(s) else None
                     for s in (shingle_set(t.as_py(), p.words) for t in batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())],
                                             names=[*batch.schema.names, names[0]])

    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType())])
    narrow_batches(docs.sparkSession)
    marked = docs.mapInArrow(run, schema).withColumn(names[1], F.col(names[0]).isNull()).withColumn(
        names[0], F.coalesce(F.col(names[0]), F.monotonically_increasing_id()))
    joined = marked.join(keep, names, "left").where(
        F.col(names[1]) | (F.col("__llm_hit") & F.col("doc_id").eqNullSafe(F.col("__llm_id"))))
    return joined.dropDuplicates(names).select(*[F.col(f"`{c}`") for c in docs.columns])
