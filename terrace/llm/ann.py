"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table projects unit vectors on Gaussian directions (2-stable), shifts and
cuts every projection into cells of one width; the cells of all projections
name a bucket.  A query visits, in every table, its own bucket and those a step
away in some projections, in the order of estimated success: the smaller the
sum of squared distances to the boundaries crossed, the likelier a neighbour
is there.  Candidates of all visited buckets are ranked by the exact cosine of
the original vectors, in double precision, and merged over tables.

Buckets are joined with their visitors in tasks of bounded blocks on either
side, which return the best few per query: no candidate pairs are emitted.  Of
equal vectors only the smallest ``k + 1`` ids can be in a result, so the rest
never leave their task.  A query that met fewer than ``k`` others is searched
again among all rows, in blocks, so small tables give all candidates.

Vectors that are null, empty or zero, or hold null or non-finite components
take no part, as queries or candidates; neither do rows with a null id.
Vectors of another length than the query's are no candidates.  Repeated rows
count once.  Ties go to the smaller id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import narrow_batches, parts_for, stage
from terrace.llm.embed_dedup import unit_rows

BLOCK = 4000   # base rows of a task
VISITORS = 4000  # queries of a task
FOUND = "query long, vec_id long, score double"


def _valid(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec): distinct rows that take part; the vector as little-endian doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if u is None else (v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0).tobytes()
                   for u, v in zip(unit_rows(batch.column(1)), batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    narrow_batches(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where("vec_id is not null")
    return rows.mapInArrow(run, "vec_id long, vec binary").where("vec is not null").distinct()


def _units(vecs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tables:
    """Projections, shifts and the order of perturbations; the same for every run with one seed."""

    def __init__(self, dim: int, tables: int, projections: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.width, self.probes, self.tables = width, probes, tables
        self.lines = rng.standard_normal((tables, projections, dim))
        self.shifts = rng.uniform(0.0, width, (tables, projections))
        self.steps = np.array(list(itertools.product((-1, 0, 1), repeat=projections)), dtype=np.int64)
        self.odd = rng.integers(1, 2**62, projections, dtype=np.int64) * 2 + 1

    def name(self, cells: np.ndarray) -> np.ndarray:
        """One number per bucket; two buckets that shared one would only add candidates."""
        with np.errstate(over="ignore"):
            return (cells * self.odd).sum(axis=-1)

    def buckets(self, units: np.ndarray, t: int) -> np.ndarray:
        return self.name(np.floor((units @ self.lines[t].T + self.shifts[t]) / self.width).astype(np.int64))

    def visits(self, units: np.ndarray, t: int) -> np.ndarray:
        """Buckets to visit, a row for each query, likeliest first."""
        at = (units @ self.lines[t].T + self.shifts[t]) / self.width
        cell = np.floor(at)
        down = at - cell  # distance to the lower boundary, in widths
        cost = ((self.steps < 0)[None] * (down ** 2)[:, None] + (self.steps > 0)[None] * ((1 - down) ** 2)[:, None]).sum(-1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
        return self.name(cell.astype(np.int64)[:, None, :] + self.steps[order])


def _hashed(rows: DataFrame, make: dict, visit: bool) -> DataFrame:
    """(vec_id, vec, dim, t, bucket): base rows once a table, queries once a visit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Tables] = {}
        for batch in batches:
            vecs = batch.column(1).to_pylist()
            for dim in sorted({len(v) // 8 for v in vecs}):
                tables = known.setdefault(dim, Tables(dim, **make))
                at = [i for i, v in enumerate(vecs) if len(v) == 8 * dim]
                units, own = _units([vecs[i] for i in at]), batch.take(pa.array(at, pa.int64()))
                for t in range(tables.tables):
                    found = tables.visits(units, t) if visit else tables.buckets(units, t)[:, None]
                    rows = own.take(pa.array(np.repeat(np.arange(len(at)), found.shape[1])))
                    n = rows.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.array(np.full(n, dim), pa.int32()),
                         pa.array(np.full(n, t), pa.int32()), pa.array(found.ravel(), pa.int64())],
                        names=["vec_id", "vec", "dim", "t", "bucket"])

    return rows.mapInArrow(run, "vec_id long, vec binary, dim int, t int, bucket long")


def _best(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k best base rows of the task for each of its queries."""
        base, asked = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].drop_duplicates(["vec_id", "vec"])
        if not len(base) or not len(asked):
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype(
                {"query": "int64", "vec_id": "int64", "score": "float64"})
        base = base.sort_values("vec_id", kind="stable")
        ids, queries = base["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        bvec, qvec = base["vec"].tolist(), asked["vec"].tolist()
        b, q = np.frombuffer(b"".join(bvec), "<f8").reshape(len(bvec), -1), np.frombuffer(
            b"".join(qvec), "<f8").reshape(len(qvec), -1)
        ub, uq = _units(bvec), _units(qvec)
        # a few more than k by the fast product, then exactly
        some = min(len(ids), 2 * k + 4)
        out_q, out_b = [], []
        for a in range(0, len(q), 256):
            near = uq[a:a + 256] @ ub.T
            near[queries[a:a + 256, None] == ids[None, :]] = -np.inf
            if some < len(ids):
                # rows that tie with the last of them within rounding stay in, so that ids break ties
                last = -np.partition(-near, some - 1, axis=1)[:, some - 1]
                rows, cols = np.nonzero((near >= last[:, None] - 1e-12) & np.isfinite(near))
            else:
                rows, cols = np.nonzero(np.isfinite(near))
            out_q.append(rows + a)
            out_b.append(cols)
        rows, cols = np.concatenate(out_q), np.concatenate(out_b)
        # by a power of two, which rounds nothing, so that squares of extreme values stay finite
        q, b = (x / np.ldexp(1.0, np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (q, b))
        nq, nb = np.sqrt((q * q).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        score = np.concatenate([(q[rows[a:a + 4096]] * b[cols[a:a + 4096]]).sum(axis=1)
                                / (nq[rows[a:a + 4096]] * nb[cols[a:a + 4096]])
                                for a in range(0, len(rows), 4096)]) if len(rows) else np.empty(0)
        order = np.lexsort((ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, rows, side="left")
        top = np.arange(len(rows)) - first < k
        return pd.DataFrame({"query": queries[rows[top]], "vec_id": ids[cols[top]], "score": score[top]})
    return run


def _meet(base: DataFrame, asked: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Join base rows and queries on ``keys`` in blocks; the best k of each block and query."""
    zero = F.lit(0).cast("long")
    sizes = base.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    visits = asked.groupBy(*keys).agg(F.ceil(F.count("*") / VISITORS).alias("turns"))
    sizes = stage(sizes.join(visits, keys), "ann-sizes")
    left = base.join(sizes, keys).select(
        *keys, "vec_id", "vec", F.lit(0).alias("side"), F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(zero, F.col("turns") - 1)).alias("turn"))
    right = asked.join(sizes, keys).select(
        *keys, "vec_id", "vec", F.lit(1).alias("side"), F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.col("turns")).alias("turn"))
    return left.unionByName(right).groupBy(*keys, "block", "turn").applyInPandas(_best(k), FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """Rank each query's distinct candidates; at most k a task and query reach the sort."""
    once = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", tables: int = 5,
           projections: int = 5, width: float = 2.0, probes: int = 32, seed: int = 7) -> DataFrame:
    """For each row that ``is_query`` (a condition on vec_id) its k nearest found: query_id, rank, vec_id, score."""
    make = {"tables": tables, "projections": projections, "width": width, "probes": probes, "seed": seed}
    valid = stage(_valid(df, vec_id, vector), "ann-vectors")
    same = Window.partitionBy("vec").orderBy("vec_id")
    base = valid.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    base = stage(base, "ann-base")
    asked = valid.where(is_query)
    found = _meet(_hashed(base, make, False), _hashed(asked, make, True), ["dim", "t", "bucket"], k)
    best = stage(_top(found, k), "ann-found")

    met = best.groupBy("query").agg(F.count("*").alias("met"))
    short = asked.join(met.where(F.col("met") >= k), F.col("vec_id") == F.col("query"), "left_anti")
    short = stage(short, "ann-short")
    if not short.isEmpty():
        dim = (F.octet_length("vec") / 8).cast("int").alias("dim")
        slices = parts_for(base.count(), BLOCK)
        every = base.select("vec_id", "vec", dim, F.pmod(F.xxhash64("vec_id"), F.lit(slices)).alias("slice"))
        again = short.select("vec_id", "vec", dim, F.explode(F.sequence(
            F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
        best = stage(_top(best.select("query", "vec_id", "score").union(
            _meet(every, again, ["dim", "slice"], k)), k), "ann-all")
    return best.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
