"""Copies and doubled keys found by hash, and the steps that no longer sort or shuffle whole rows."""

import pytest
from pyspark.sql import functions as F

from terrace.config import DEFAULT_RULES
from terrace.functions.columns import int_date_key, parse_date_key
from terrace.operators import repeats
from terrace.operators.metrics import DAILY_MEASURES, daily_metrics, dedup
from terrace.operators.quality import evaluate_rules, rule_summary
from terrace.operators.sinks import duplicate_keys, materialize
from terrace.session import session_conf

KEYS = ["t", "k"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark):
    data = [("a", 1, 1.0), ("a", 1, 1.0), ("a", 2, 1.0),          # a copy
            ("b", 1, 1.0), ("b", 1, 2.0), ("b", 3, 0.0), ("b", None, 5.0), ("b", None, 5.0),   # a doubled key, copies without a key
            ("c", 1, 1.0), ("c", 2, 1.0),
            (None, 7, 1.0), (None, 7, 1.0), (None, 8, None)]
    return materialize(spark, spark.createDataFrame(data, "t string, k int, v double"), "repeats-test")[0]


@pytest.mark.parametrize("bound", [1_000_000, 1, 0])
def test_repeats_dedup_and_candidates(spark, monkeypatch, bound):
    monkeypatch.setattr(repeats, "MOST_BROADCAST_HASHES", bound)
    df = _rows(spark)
    found = repeats.Repeats(spark, df, KEYS, "t")
    assert {*found.few, *found.many} == {"a", "b", None}
    assert len(found.few) == {1_000_000: 3, 1: 1, 0: 0}[bound]
    once = found.dedup(df)
    key = str
    assert sorted(map(tuple, once.collect()), key=key) == sorted(map(tuple, dedup(df).collect()), key=key)
    assert [tuple(r) for r in duplicate_keys(found.candidates(once), KEYS).collect()] == [("b", 1, 2)]


def test_rows_without_repeats_are_not_shuffled(spark):
    df = _rows(spark).filter("t = 'c'")
    found = repeats.Repeats(spark, df, KEYS, "t")
    assert found.candidates(df) is None
    plan = _plan(found.dedup(df))
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_summary_sorts_no_rows(spark):
    data = [("A", 1.0, "b1"), ("a", -1.0, "b2"), ("a", None, None), ("x", 2.0, None)]
    df, _ = evaluate_rules(spark.createDataFrame(data, "_tenant_id string, precio double, _batch_id string"),
                           [r for r in DEFAULT_RULES if r.name == "precio_valido"])
    out = rule_summary(df, [r for r in DEFAULT_RULES if r.name == "precio_valido"])
    assert "SortAggregate" not in _plan(out.select("tenant", "records_checked"))
    got = {r["tenant"]: r for r in out.collect()}
    assert (got["a"]["records_checked"], got["a"]["_batch_id"], got["a"]["__f0"], got["a"]["good"]) == (3, "b2", 2, 1)
    assert (got["x"]["records_checked"], got["x"]["_batch_id"]) == (1, None)


def test_integer_dates_equal_parsed_ones(spark):
    keys = [y * 10000 + m * 100 + d for y in (0, 1, 999, 1000, 1582, 1900, 2023, 2024, 9999, 10000)
            for m in (0, 1, 2, 4, 12, 13) for d in (0, 1, 15, 28, 29, 30, 31, 32, 99)]
    df = spark.createDataFrame([(k,) for k in [*keys, *(-k for k in keys), None, 0, 7, 2147483647, -2147483648]], "k int")
    wrong = df.withColumns({"fast": int_date_key("k"), "slow": parse_date_key("k")}).filter(~F.col("fast").eqNullSafe(F.col("slow")))
    assert wrong.count() == 0
    with session_conf(spark, {"spark.sql.ansi.enabled": "false"}):
        assert df.withColumns({"fast": int_date_key("k"), "slow": parse_date_key("k")}).filter(
            ~F.col("fast").eqNullSafe(F.col("slow"))).count() == 0


def test_metrics_of_a_table_equal_those_of_one_aggregation(spark):
    data = [(t, d, c, float(q) if q else None, p, r, o)
            for t in ("a", None) for d in (1, 2) for c in ("x", None)
            for q, p, r, o in ((1, 2.5, 1, 1), (2, 0.1, 1, 2), (0, 1e300, None, 2), (3, float("nan"), 2, None))]
    data += [("b", 1, "x", None, None, None, None)]
    df = spark.createDataFrame(data, "_tenant_id string, fecha_proceso int, tipo_entrega string, "
                                     "cantidad_normalizada_st double, precio double, ruta long, transporte long")
    one, apart = daily_metrics(df), daily_metrics(df, table=df)
    assert one.schema.simpleString() == apart.schema.simpleString() and "Expand" not in _plan(apart)
    assert sorted(map(str, one.collect())) == sorted(map(str, apart.collect()))
    assert [m.name for m in DAILY_MEASURES] == apart.columns[3:]
