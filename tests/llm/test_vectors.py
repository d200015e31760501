"""Vector operators against all-pairs cosine."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import ann, embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 8, 1), (9004, [float("nan")] + [1.0] * 7, 1),
       (9005, [float("inf")] + [1.0] * 7, 1), (9006, [None] + [1.0] * 7, 1), (9007, [1.0] * 8, None), (9008, [1.0, 2.0], 1)]


def rows(seed, n=260, dim=8, labels=3):
    rng, out = np.random.default_rng(seed), []
    centres = rng.standard_normal((9, dim))
    for i in range(n):
        v = centres[i % 9] + rng.standard_normal(dim) * rng.choice([0.0, 0.2, 0.4, 3.0])
        out.append((i * 2 + 1, [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    return out


def takes_part(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
    return float((a * b).sum() / math.sqrt((a * a).sum()) / math.sqrt((b * b).sum()))


def brute_links(data, least):
    n, parent, links = len(data), list(range(len(data))), [0] * len(data)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(n):
        for b in range(a):
            (_, u, p), (_, v, q) = data[a], data[b]
            if p is not None and p == q and takes_part(u) and takes_part(v) and len(u) == len(v) and cosine(u, v) >= least:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    low = {}
    for a, (i, _, _) in enumerate(data):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    return sorted(((i, links[a], low.get(find(a)), i == low.get(find(a))) for a, (i, _, _) in enumerate(data)), key=str)


@pytest.mark.parametrize("cell_rows,block", [(2000, 3000), (20, 3000), (20, 12), (7, 40)])
def test_near_vectors_match_all_pairs(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    data = rows(cell_rows + block) + ODD + [(7, rows(1)[3][1], 1)] + [(6000 + i, [3.0] + [1.0] * 7, 2) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("n_links", F.lit("x")).withColumn("cell", F.lit(0))
    got = embed_dedup.near_vectors(df)
    got = sorted(((r.vec_id, r.n_links, r.component_id, bool(r.kept)) for r in got.collect()), key=str)
    assert got == brute_links(data, 0.93)


def test_near_vectors_boundary_replication_is_exact(spark, monkeypatch):
    """Points spread along arcs between pivots, so that links cross cells."""
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 12)
    rng = random.Random(3)
    data = []
    for i in range(240):
        t = i / 240 * 2 * math.pi
        data.append((i, [math.cos(t), math.sin(t), 0.3 * rng.random()], 1))
    got = embed_dedup.near_vectors(spark.createDataFrame(data, SCHEMA), least=0.99)
    got = sorted(((r.vec_id, r.n_links, r.component_id, bool(r.kept)) for r in got.collect()), key=str)
    data = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in data]
    assert got == brute_links(data, 0.99)


def test_near_vectors_empty_and_ungrouped(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert embed_dedup.near_vectors(df).count() == 0
    df = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [1.0, 0.01], 4)], SCHEMA)
    assert sorted(r.n_links for r in embed_dedup.near_vectors(df, group=None).collect()) == [1, 1]


def brute_nearest(data, is_query, k):
    seen = sorted({(i, tuple(v)) for i, v, _ in data if i is not None and takes_part(v)})
    out = {}
    for i, v in seen:
        if is_query(i):
            found = sorted(((-cosine(v, w), j) for j, w in seen if j != i and len(w) == len(v)))
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def test_search_small_tables_give_all_candidates(spark):
    data = rows(5, n=4) + ODD + [(50, [1.0] * 8, 0)]
    got = {}
    df = spark.createDataFrame(data, SCHEMA).withColumn("rank", F.lit(0)).withColumn("bucket", F.lit("x"))
    for r in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute_nearest(data, lambda i: i % 50 == 0, 5)
    assert {q: [got[q][r + 1][0] for r in range(len(got[q]))] for q in got} == {q: [j for j, _ in w] for q, w in want.items()}
    assert ann.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_search_scores_ties_and_repeats(spark):
    same = [(i, [0.5, 0.5, 0.1], 0) for i in range(0, 120, 2)]
    data = same + same[:3] + [(1001, [0.5, 0.5, 0.11], 0), (1003, [-1.0, 0.0, 0.0], 0)]
    got = ann.search(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    for q in (0, 50, 100):
        mine = [r for r in got if r.query_id == q]
        assert [r.vec_id for r in mine] == [i for i in (0, 2, 4, 6, 8, 10) if i != q][:5]
        assert all(r.score == pytest.approx(1.0, abs=1e-12) for r in mine) and [r.rank for r in mine] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("block", [4000, 60])
def test_search_recall_and_exact_scores(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "VISITORS", 3 if block == 60 else 4000)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r.vec_id, list(r.embedding), r.label) for r in df.collect()]
    want = brute_nearest(data, lambda i: i % 50 == 0, 5)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    vectors = {i: v for i, v, _ in data}
    hits = 0
    for q, found in got.items():
        assert len(found) == 5 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(cosine(vectors[q], vectors[j]), abs=1e-12) for j, s in found)
        hits += len({j for j, _ in found} & {j for j, _ in want[q]})
    assert set(got) == set(want) and hits >= 0.9 * 5 * len(want)


def test_visits_go_in_order_of_estimated_success():
    tables = ann.Tables(8, tables=2, projections=4, width=2.0, probes=81, seed=1)
    units = np.random.default_rng(0).standard_normal((5, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    visits, own = tables.visits(units, 0), tables.buckets(units, 0)
    assert (visits[:, 0] == own).all()
    assert all(len(set(v)) == 81 for v in visits.tolist())
