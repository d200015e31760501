"""Near-duplicate vectors by an exact metric range join.

Vectors are compared within their group (equal, non-null labels and equal
length) by cosine in double precision.  On unit vectors a least cosine is a
largest chord length r, and the chord is a metric.  A bounded sample of the
vectors gives the pivots; every vector belongs to the cell of its nearest
pivot.  A vector x is also sent to the cell of pivot p if the triangle
inequality leaves room for a partner there: its chord to p is at most the
cell's covering radius plus r, and x lies within r of the plane between p and
its own pivot.  Each cell then joins its own vectors with all it was sent,
independently of other cells, and no pair is missed.  Cells above a number of
rows are dealt to tasks in blocks, which meet pairwise.

Equal vectors are one node from the start, weighted by their number.  A task
returns counts per vector and, for the components, at most one connection per
vector: no pairs are emitted.

Vectors that are null, empty or zero, or hold null or non-finite components,
and vectors with a null label link with nothing: n_links 0, each its own
component.  Repeated rows (same id and vector) count as vectors of their own.
A component's id is its smallest vec_id (null if it has none).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import components, narrow_batches, stage

PIVOTS = 4096         # bound of the pivot sample over all groups
CELL_ROWS = 2000      # vectors a pivot is taken for
BLOCK = 3000          # rows of a task's side
SLACK = 1e-9


def unit_rows(vectors: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision at length 1; None where it takes no part."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            top = np.abs(x).max()
            if not np.isfinite(x).all() or top == 0.0:
                x = None
            else:  # scaled first, so that squares neither overflow nor vanish
                x = x / top
                x = x / math.sqrt(float(x @ x))
        out.append(x)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def unit_table(df: DataFrame, vec_id: str, vector: str, group: str | None) -> DataFrame:
    """(id, grp, node, unit): the group as text with the length, a hash of group and vector, the unit vector
    (little-endian doubles); the last three null where the row takes no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grps, nodes, units = [], [], []
            for x, g in zip(unit_rows(batch.column(1)), batch.column(2)):
                if x is None or not g.is_valid:
                    grps.append(None), nodes.append(None), units.append(None)
                    continue
                data, name = (x + 0.0).astype("<f8").tobytes(), f"{len(x)}:{g.as_py()}"
                grps.append(name), units.append(data)
                nodes.append(_signed(xxhash.xxh3_64_intdigest(name.encode() + b"\0" + data)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grps, pa.string()), pa.array(nodes, pa.int64()), pa.array(units, pa.binary())],
                names=["id", "grp", "node", "unit"])

    narrow_batches(df.sparkSession)
    label = F.lit("") if group is None else F.col(group).cast("string")
    return df.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"), label.alias("g")).mapInArrow(
        run, "id long, grp string, node long, unit binary")


def matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1)


def _assign(nodes: DataFrame, cells, radius: float, covering: dict | None) -> DataFrame:
    """(node, weight, unit, cell, home, chord): each vector in its own cell; with ``covering``, in those of partners too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = cells.value
        for batch in batches:
            take, cell, home, chord = [], [], [], []
            grps = np.array(batch.column(3).to_pylist(), dtype=object)
            units = batch.column(2)
            for g in dict.fromkeys(grps):
                at = np.nonzero(grps == g)[0]
                if g not in pivots:
                    take += at.tolist()
                    cell += [f"{g}|0"] * len(at)
                    home += [True] * len(at)
                    chord += [0.0] * len(at)
                    continue
                x, p = matrix([units[int(i)].as_py() for i in at]), matrix(pivots[g])
                dots = x @ p.T
                own = dots.argmax(axis=1)
                length = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
                sent = np.zeros_like(dots, dtype=bool)
                if covering is not None:
                    reach = np.array([covering.get(f"{g}|{j}", -10.0) for j in range(len(p))])
                    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (p @ p.T)))[own]
                    lead = dots[np.arange(len(at)), own][:, None] - dots
                    sent = (length <= reach + radius + SLACK) & (lead <= radius * apart + SLACK)
                sent[np.arange(len(at)), own] = True
                for r, j in zip(*np.nonzero(sent)):
                    take.append(int(at[r]))
                    cell.append(f"{g}|{j}")
                    home.append(bool(own[r] == j))
                    chord.append(float(length[r, j]))
            rows = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), rows.column(2), pa.array(cell, pa.string()), pa.array(home, pa.bool_()),
                 pa.array(chord, pa.float64())], names=["node", "weight", "unit", "cell", "home", "chord"])

    return nodes.select("node", "weight", "unit", "grp").mapInArrow(
        run, "node long, weight long, unit binary, cell string, home boolean, chord double")


def _join_block(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Own rows against all rows of the task: weighted links of each own row, and connections."""
        own = pdf[pdf["side"] == 0]
        rest = pdf[pdf["side"] == 1].drop_duplicates("node")
        if not len(own) or not len(rest):
            return pd.DataFrame({"node": [], "links": [], "other": []}).astype("int64")
        x, y = matrix(own["unit"].tolist()), matrix(rest["unit"].tolist())
        ids, others = own["node"].to_numpy(), rest["node"].to_numpy()
        weights = rest["weight"].to_numpy()
        near = np.empty((len(x), len(y)), dtype=bool)
        for a in range(0, len(x), 512):
            near[a:a + 512] = x[a:a + 512] @ y.T >= least
        near[ids[:, None] == others[None, :]] = False
        links = near.sum(axis=1) if weights.max() == 1 else near.astype(np.float64) @ weights
        rows, cols = near.any(axis=1), near.any(axis=0)
        # smallest node that each row is connected with inside the task
        sub, left, right = near[np.ix_(rows, cols)], ids[rows].copy(), others[cols].copy()
        big = np.iinfo(np.int64).max
        while len(left) and len(right):
            l2 = np.minimum(left, np.where(sub, right[None, :], big).min(axis=1))
            r2 = np.minimum(right, np.where(sub, l2[:, None], big).min(axis=0))
            if (l2 == left).all() and (r2 == right).all():
                break
            left, right = l2, r2
        out = pd.DataFrame({"node": ids, "links": np.rint(links).astype(np.int64), "other": ids})
        out.loc[rows, "other"] = left
        met = pd.DataFrame({"node": others[cols], "links": 0, "other": right})
        return pd.concat([out[out["links"] > 0], met[met["node"] != met["other"]]]).astype("int64")
    return run


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", group: str | None = "label",
                 least: float = 0.93) -> DataFrame:
    """For every row of ``df``: vec_id, n_links, component_id, kept."""
    spark = df.sparkSession
    rows = stage(unit_table(df, vec_id, vector, group), "vectors")
    nodes = stage(rows.where("node is not null").groupBy("node").agg(
        F.count("*").alias("weight"), F.first("unit").alias("unit"), F.first("grp").alias("grp")), "vector-nodes")
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * least))

    n = nodes.count()
    share = min(1.0 / CELL_ROWS, PIVOTS / max(1, n))
    large = nodes.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > CELL_ROWS).select("grp")
    sample = nodes.join(large, "grp", "left_semi").where(
        F.pmod(F.xxhash64("node", F.lit(4)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    pivots: dict[str, list[bytes]] = {}
    for r in sample.select("grp", "node", "unit").orderBy("grp", "node").collect():  # about PIVOTS rows at most
        pivots.setdefault(r["grp"], []).append(bytes(r["unit"]))
    cells = spark.sparkContext.broadcast(pivots)
    covering = {}
    if pivots:
        in_pivots = F.col("cell").isin([f"{g}|{j}" for g, p in pivots.items() for j in range(len(p))])
        covering = {r["cell"]: r["m"] for r in _assign(nodes, cells, radius, None).where(in_pivots)
                    .groupBy("cell").agg(F.max("chord").alias("m")).collect()}  # one row a pivot

    placed = stage(_assign(nodes, cells, radius, covering), "vector-cells")
    sizes = placed.groupBy("cell").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("n"))
    sizes = stage(sizes.select("cell", F.ceil(F.col("homes") / BLOCK).alias("own_blocks"),
                               F.ceil(F.col("n") / BLOCK).alias("blocks")).where("own_blocks > 0"), "vector-cell-sizes")
    placed = placed.join(sizes, "cell")
    part = F.pmod(F.xxhash64("node"), F.col("own_blocks"))
    other = F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks"))
    zero = F.lit(0).cast("long")
    own = placed.where("home").select("cell", "node", "weight", "unit", F.lit(0).alias("side"), part.alias("a"),
                                      F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("b"))
    rest = placed.select("cell", "node", "weight", "unit", F.lit(1).alias("side"),
                         F.explode(F.sequence(zero, F.col("own_blocks") - 1)).alias("a"), other.alias("b"))
    found = stage(own.union(rest).groupBy("cell", "a", "b").applyInPandas(
        _join_block(least), "node long, links long, other long"), "vector-links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), "vector-components")
    ids = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("least_id"))
    of_node = nodes.select("node", "weight").join(ids, "node").join(counts, "node", "left").join(roots, "node", "left")
    # a node without links is its own root: no null keys that would meet in one task
    of_node = of_node.withColumn("root", F.coalesce("root", "node"))
    of_root = of_node.groupBy("root").agg(F.min("least_id").alias("root_id"))
    final = stage(of_node.join(of_root, "root").select(
        "node", (F.coalesce("links", zero) + F.col("weight") - 1).alias("n_links"),
        F.col("root_id").alias("component")), "vector-found")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.select("id", "node").join(final, "node", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", zero).alias("n_links"), component.alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True)).otherwise(F.col("id").eqNullSafe(component)).alias("kept"))
