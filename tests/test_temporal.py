"""Range matching in dyadic ranges, daily snapshots and version history against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from terrace.operators.history import OPEN_END, record_snapshot
from terrace.operators.sinks import table_schema
from terrace.operators.temporal import daily_snapshot, dyadic_nodes, newest_versions, point_in_time_join, versions_at
from terrace.sources.files import read_table

D = dt.date
DIM = "k string, valid_from date, valid_to date, p int"


def day(n):
    return D(2020, 1, 1) + dt.timedelta(days=n)


def random_versions(rnd, n, keys="ab", span=60):
    out = []
    for i in range(n):
        a = rnd.randint(0, span)
        out.append((rnd.choice(keys), day(a), rnd.choice([day(a + rnd.randint(-2, 20)), day(a), D(9999, 12, 31), None]), i))
    return out + [("a", None, day(3), 900), (None, day(0), day(50), 901)]


def valid(versions, k, d):
    return [v for v in versions if v[0] is not None and v[0] == k and d and v[1] and v[2] and v[1] <= d <= v[2]]


def test_dyadic_nodes_cover_each_day_once(spark):
    rnd = random.Random(3)
    rows = [(day(a), day(a + rnd.randint(0, 200))) for a in (rnd.randint(-400, 400) for _ in range(60))]
    rows += [(D(1, 1, 1), D(9999, 12, 31)), (D(1900, 1, 1), D(9999, 12, 31)), (day(1), day(0))]
    df = spark.createDataFrame(rows, "a date, b date").select("a", "b", dyadic_nodes(F.col("a"), F.col("b")).alias("n"),
                                                              (F.unix_date("a") + 719528).alias("x"))
    for r in df.collect():
        size = (r.b - r.a).days + 1
        spans = sorted((n.node << n.level, (n.node + 1) << n.level) for n in r.n)
        assert len(spans) <= 44 and sum(e - s for s, e in spans) == max(0, size)
        if spans:
            assert spans[0][0] == r.x and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("method", ["range", "points", "snapshot"])
@pytest.mark.parametrize("overlap", ["fanout", "latest"])
def test_methods_agree_with_brute_force(spark, method, overlap):
    rnd = random.Random(5)
    versions = random_versions(rnd, 40)
    facts = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([day(rnd.randint(-5, 90)), None])) for i in range(120)]
    fact = spark.createDataFrame(facts, "id int, k string, d date")
    dim = spark.createDataFrame(versions, DIM)
    got = point_in_time_join(fact, dim, ["k"], "d", columns={"p": "p"}, on_overlap=overlap, method=method)
    assert got.columns == ["id", "k", "d", "p"]
    want = []
    for i, k, d in facts:
        found = valid(versions, k, d)
        if overlap == "latest":
            found = [max(found, key=lambda v: (v[1], v[2], v[3]))] if found else []
        want += [(i, k, d, v[3]) for v in found] or [(i, k, d, None)]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    with pytest.raises(ValueError):
        point_in_time_join(fact, dim, ["k"], "d", method="other")


def _most_rows(plan):
    """The largest number of rows that any operator put out."""
    out, todo = 0, [plan]
    while todo:
        node = todo.pop()
        node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
        node = node.plan() if "QueryStage" in node.nodeName() else node
        found = node.metrics().get("numOutputRows")
        if found.isDefined():
            out = max(out, found.get().value())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


def test_a_key_with_20000_versions_is_linear(spark):
    """Each version lasts 30 days and begins a day after the one before, on one key."""
    n = 20_000
    dim = spark.range(n).select(F.lit("hot").alias("k"), F.date_add(F.lit(D(1950, 1, 1)), F.col("id").cast("int")).alias("valid_from"),
                                F.date_add(F.lit(D(1950, 1, 1)), (F.col("id") + 29).cast("int")).alias("valid_to"),
                                F.col("id").cast("int").alias("p"))
    flat = newest_versions(dim, ["k"])
    rows = flat.collect()
    # every day belongs to the version that began on it, the last one to its end
    assert len(rows) == n + 29 and sum((r.valid_to - r.valid_from).days + 1 for r in rows) == n + 29
    assert all(r.p == min((r.valid_from - D(1950, 1, 1)).days, n - 1) for r in rows)
    assert _most_rows(flat._jdf.queryExecution().executedPlan()) <= 25 * (n + 30)


def test_snapshot_is_bounded_by_the_facts(spark):
    dim = spark.createDataFrame([("a", D(1900, 1, 1), D(9999, 12, 31), 1), ("b", D(1900, 1, 1), D(9999, 12, 31), 2)], DIM)
    fact = spark.createDataFrame([("a", day(3)), ("a", day(5)), ("c", day(1)), ("b", None)], "k string, d date")
    got = sorted((r.k, r.day, r.p) for r in daily_snapshot(dim, fact, ["k"], "d").collect())
    assert got == [("a", day(i), 1) for i in (3, 4, 5)]
    points = fact.where("d is not null").distinct()
    assert sorted((r.k, r.d, r.p) for r in versions_at(points, dim, ["k"], "d").collect()) == [("a", day(3), 1), ("a", day(5), 1)]


# --- version history --------------------------------------------------------------------------

def brute_history(snapshots):
    """snapshots: day -> {key: attributes}.  Runs of equal attributes over consecutive snapshots."""
    days = sorted(snapshots)
    out = []
    for k in sorted({k for s in snapshots.values() for k in s}, key=str):
        run = None
        for i, d in enumerate(days):
            end = days[i + 1] - dt.timedelta(days=1) if i + 1 < len(days) else OPEN_END
            here = snapshots[d].get(k)
            if run and here is not None and run[1] == here:
                run = (run[0], here, end)
                continue
            if run:
                out.append((k, *run[1], run[0], run[2], run[2] == OPEN_END))
            run = (d, here, end) if here is not None else None
        if run:
            out.append((k, *run[1], run[0], run[2], run[2] == OPEN_END))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_history_does_not_depend_on_the_order_of_snapshots(spark, tmp_table, seed):
    rnd = random.Random(seed)
    days = [day(10 * i) for i in range(4)]
    snapshots = {d: {k: (rnd.choice([1.0, 2.0, None]), rnd.choice(["x", None])) for k in [*"abcdef", None] if rnd.random() < 0.8}
                 for d in days}
    arrival = rnd.sample(days, 4)
    for d in [*arrival, arrival[1]]:           # one of them twice: nothing changes
        rows = [(k, *v) for k, v in snapshots[d].items()]
        n = record_snapshot(spark, spark.createDataFrame(rows, "k string, price double, note string"), tmp_table, ["k"],
                            ["price", "note"], d, buckets=3)
    assert n == 0
    table = read_table(spark, tmp_table, schema=table_schema(spark, tmp_table))
    got = [tuple(r) for r in table.select("k", "price", "note", "valid_from", "valid_to", "is_current").collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(brute_history(snapshots), key=key)


def test_snapshot_with_a_key_twice_raises(spark, tmp_table):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, price double")
    with pytest.raises(Exception, match="twice"):
        record_snapshot(spark, rows, tmp_table, ["k"], ["price"], day(0))


def test_sparse_points_get_no_row_a_level(spark):
    """A key's few days in a long span: neither the days between nor the levels of a tree of dates become rows."""
    n = 300
    fact = spark.range(n).select((F.col("id") % 3).alias("k"), F.date_add(F.lit(D(1990, 1, 1)), (F.col("id") * 30).cast("int")).alias("d"))
    dim = spark.range(3).selectExpr("id AS k", "DATE'1900-01-01' AS valid_from", "DATE'9999-12-31' AS valid_to", "id AS p")
    for method in ("points", "snapshot"):
        for overlap in ("fanout", "latest"):
            out = point_in_time_join(fact, dim, ["k"], "d", columns={"p": "p"}, on_overlap=overlap, method=method)
            assert all(r.p == r.k for r in out.collect())
            assert _most_rows(out._jdf.queryExecution().executedPlan()) <= 2 * n
