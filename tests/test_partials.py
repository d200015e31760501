"""Stored partial aggregates: exactness, order, merging, refresh of single days."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrace.operators.metrics import Measure
from terrace.operators.partials import finish_metrics, merge_partials, partial_metrics, refresh_partials
from terrace.sources.files import read_table

SCHEMA = "t string, d int, q double, p double, r int"
MEASURES = (Measure("units", "sum", ("q",)), Measure("revenue", "sum_product", ("q", "p")),
            Measure("routes", "count_distinct", ("r",)), Measure("pairs", "count_distinct", ("r", "t")),
            Measure("n", "count"), Measure("n_q", "count", ("q",)))


def close(got, want):
    return abs(got - want) <= 2 * math.ulp(want) or abs(got - want) <= 1e-15


def test_sums_are_exact_and_free_of_order(spark):
    deal = random.Random(3)
    values = [deal.uniform(-1, 1) * 10 ** deal.randint(-5, 15) for _ in range(3000)]
    values += [-v for v in values[:2000]] + [0.1] * 500 + [-0.1, 1e12, 2.0 ** 60, 2.0 ** 99, -(2.0 ** 99), -(2.0 ** 60)]
    rows = [("a" if k % 3 else "b", k % 7, v, 0.5, k % 11) for k, v in enumerate(values)]
    seen = set()
    for parts in (1, 5, 9):
        deal.shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = finish_metrics(merge_partials(partial_metrics(df, ["t", "d"], MEASURES), ["t"], MEASURES), MEASURES).collect()
        seen.add(tuple(sorted((r.t, r.units, r.revenue, r.n) for r in got)))
        for r in got:
            mine = [x for x in rows if x[0] == r.t]
            assert close(r.units, math.fsum(x[2] for x in mine)) and close(r.revenue, math.fsum(x[2] * x[3] for x in mine))
            assert (r.routes, r.pairs, r.n, r.n_q) == (11, 11, len(mine), len(mine))
    assert len(seen) == 1


@pytest.mark.parametrize("values, want", [
    ([-0.1], -0.1), ([1e-6, -1e-6], 0.0), ([2.0 ** 20, -0.1], 2.0 ** 20 - 0.1), ([-(2.0 ** 60), 0.25], -(2.0 ** 60)), ([None, None], None),
    ([1e12] * 3 + [0.01], 3e12 + 0.01), ([1e40, 1.0], 1e40), ([float("inf"), 1.0], math.inf), ([float("nan"), 1.0], math.nan), ([None, 2.5], 2.5)])
def test_single_sums(spark, values, want):
    df = spark.createDataFrame([("a", 1, v, 1.0, None) for v in values], SCHEMA)
    got = finish_metrics(partial_metrics(df, ["t"], MEASURES), MEASURES).first()
    for x in (got.units, got.revenue):
        assert x is None if want is None else math.isnan(x) if want != want else x == want or close(x, want)
    assert (got.routes, got.pairs, got.n) == (0, 0, len(values))


def test_sketches_merge_within_their_error(spark):
    df = spark.range(200_000).select(F.lit("a").alias("t"), (F.col("id") % 40).cast("int").alias("d"), F.lit(1.0).alias("q"),
                                     F.lit(1.0).alias("p"), (F.col("id") % 60_000).cast("int").alias("r"))
    days = partial_metrics(df, ["t", "d"], MEASURES)
    got = finish_metrics(merge_partials(days, ["t"], MEASURES), MEASURES).first()
    assert abs(got.routes / 60_000 - 1) < 5 * 1.04 / 64 and got.n == 200_000
    assert finish_metrics(merge_partials(days, [], MEASURES), MEASURES).first().n == 200_000


def test_a_new_day_replaces_its_own_partials_alone(spark, tmp_table):
    base = [("a", 101, 1.0, 2.0, 1), ("a", 102, 3.0, 1.0, 2), ("a", 201, 5.0, 1.0, 3), ("b", 101, 7.0, 1.0, 4), (None, 101, 9.0, 1.0, 5)]
    month = F.expr("d div 100").cast("int")

    def refresh(rows, processed=None):
        df = spark.createDataFrame(rows, SCHEMA).withColumn("m", month)
        if processed:
            processed = spark.createDataFrame(processed, "t string, d int").withColumn("m", month)
        refresh_partials(spark, df, tmp_table, ["t", "m"], ["t", "d"], ["t", "d"], MEASURES, processed=processed)

    def state():
        return {(r.t, r.d): r.units for r in finish_metrics(read_table(spark, tmp_table), MEASURES).collect()}

    refresh(base)
    want = {(t, d): q for t, d, q, *_ in base}
    assert state() == want
    for _ in range(2):      # a rerun changes nothing more
        refresh([("a", 102, 30.0, 1.0, 2), ("a", 103, 1.5, 1.0, 1), (None, 101, 0.5, 1.0, 1)])
        want.update({("a", 102): 30.0, ("a", 103): 1.5, (None, 101): 0.5})
        assert state() == want
    refresh([], [("a", 101), ("b", 101)])       # days without rows are emptied where they are listed
    del want["a", 101], want["b", 101]
    assert state() == want
    refresh([])
    assert state() == want


def test_facts_of_the_queries_are_evaluated_once(spark):
    """All that is made of the good rows reads their stage; the tables behind them are not scanned again."""
    from terrace.plans import registry as reg

    _, facts = reg._refreshed_partials(spark, "/root/testdata/sf0.001", "once")
    files = facts.inputFiles()
    assert files and not any("lineitem" in f for f in files)
