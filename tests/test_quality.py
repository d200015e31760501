"""Quality rules, log, split, routing, reasons, breaker, tenant overrides."""

import pytest
from pyspark.sql import functions as F

from terrace.config import DEFAULT_RULES, Rule
from terrace.operators.quality import (
    CriticalQualityError,
    enforce_critical,
    evaluate_rules,
    outcome_counts,
    quality_log,
    quarantine_frame,
    route_bad,
    rules_for_tenants,
    split_by_quality,
)


def test_rules_are_three_valued_sql(spark):
    values = [3, 7, None]
    df = spark.createDataFrame([(x, y) for x in values for y in values], "x int, y int")
    out, cond = evaluate_rules(df, {"small": "x < 5", "ordered": {"expr": "y >= x", "severity": "warning"}})
    for r in out.withColumn("all_hold", cond).collect():
        small = None if r["x"] is None else r["x"] < 5
        ordered = None if None in (r["x"], r["y"]) else r["y"] >= r["x"]
        both = False if False in (small, ordered) else None if None in (small, ordered) else True
        assert (r["_rule_small"], r["_rule_ordered"], r["all_hold"]) == (small, ordered, both)


def test_tenant_severity_and_new_rules_stay_with_their_tenant(spark):
    rules = rules_for_tenants({"x_small": {"expr": "x < 5", "severity": "critical"}},
                              {"A": {"x_small": {"severity": "info"}, "x_odd": {"expr": "x % 2 = 1", "severity": "critical"}},
                               "b": {"x_small": "x < 9"}})
    df = spark.createDataFrame([("a", 6), ("a", 8), ("b", 8), ("c", 8)], "_tenant_id string, x int")
    out, _ = evaluate_rules(df, rules)
    log = {(r["tenant_id"], r["check_name"]): (r["check_severity"], r["records_failed"]) for r in quality_log(out, rules).collect()}
    assert log == {("a", "x_small"): ("info", 2), ("a", "x_odd"): ("critical", 2), ("b", "x_small"): ("critical", 0),
                   ("c", "x_small"): ("critical", 1)}
    reasons = {(r["_tenant_id"], r["x"]): r["_quarantine_reason"] for r in quarantine_frame(out, rules, (), timestamp=False).collect()}
    assert reasons[("a", 8)] == "x_odd" and reasons[("c", 8)] == "x_small"
    from terrace.operators.quality import rule_summary
    critical = {r["tenant"]: r["critical_failed"] for r in rule_summary(out, rules, discard_rules=()).collect()}
    assert critical == {"a": 2, "b": 0, "c": 1}


def _frame(spark):
    # tenant, cantidad, precio, date ok, tipo, price found
    data = [
        ("a", 1.0, 1.0, True, "ZPRE", 1.0),     # good
        ("a", -1.0, 1.0, True, "ZPRE", 1.0),    # bad: cantidad -> quarantine
        ("a", 1.0, 1.0, True, "Z99", 1.0),      # bad: tipo -> discard
        ("a", 1.0, 1.0, True, None, 1.0),       # NULL conjunction -> lost (parity)
        ("b", -1.0, 1.0, True, None, 1.0),      # bad, NULL discard rule -> lost (parity)
        ("b", 1.0, -1.0, False, "Z04", None),   # bad: precio, fecha, material -> quarantine
    ]
    df = spark.createDataFrame(
        data, "_tenant_id string, cantidad double, precio double, ok boolean, tipo_entrega string, "
              "precio_catalogo_unitario double")
    df = df.withColumn("fecha_proceso_dt", F.when(F.col("ok"), F.current_date())).drop("ok")
    return evaluate_rules(df, DEFAULT_RULES)


def test_split_and_route_parity_loses_null_rows(spark):
    df, cond = _frame(spark)
    good, bad = split_by_quality(df, cond)
    assert good.count() == 1 and bad.count() == 4
    quarantine, discard = route_bad(bad, DEFAULT_RULES)
    assert quarantine.count() == 2 and discard.count() == 1
    counts = {r["tenant"]: r.asDict() for r in outcome_counts(df, DEFAULT_RULES).collect()}
    assert counts["a"]["lost"] == 1 and counts["b"]["lost"] == 1


def test_null_safe_mode_conserves_rows(spark):
    df, cond = _frame(spark)
    good, bad = split_by_quality(df, cond, unknown="quarantine")
    quarantine, discard = route_bad(bad, DEFAULT_RULES, unknown="quarantine")
    assert good.count() + quarantine.count() + discard.count() == df.count()
    reasons = {r["_quarantine_reason"] for r in
               quarantine_frame(quarantine, DEFAULT_RULES, unknown="quarantine", timestamp=False).collect()}
    assert "tipo_entrega_valido" in reasons                 # NULL type alone
    assert "cantidad_valida, tipo_entrega_valido" in reasons
    for r in outcome_counts(df, DEFAULT_RULES, unknown="quarantine").collect():
        assert r["lost"] == 0


def test_reasons_in_rule_order_and_unknown(spark):
    df, cond = _frame(spark)
    q, _ = route_bad(split_by_quality(df, cond)[1], DEFAULT_RULES)
    out = quarantine_frame(q, DEFAULT_RULES, timestamp=False)
    assert not [c for c in out.columns if c.startswith("_rule_")] and "fecha_proceso_dt" not in out.columns
    reasons = sorted(r[0] for r in out.select("_quarantine_reason").collect())
    assert reasons == ["cantidad_valida", "precio_valido, fecha_valida, material_existe"]
    info_only = [Rule("x", "cantidad > 0", "info")]
    d2, _ = evaluate_rules(df.drop(*[c for c in df.columns if c.startswith("_rule_")]), info_only)
    assert {r[0] for r in quarantine_frame(d2, info_only, discard_rules=(), timestamp=False)
            .select("_quarantine_reason").collect()} == {"unknown"}


def test_quality_log_counts_false_only(spark):
    df, _ = _frame(spark)
    log = {(r["tenant_id"], r["check_name"]): r for r in quality_log(df, DEFAULT_RULES, "run-1").collect()}
    a_tipo = log[("a", "tipo_entrega_valido")]
    assert a_tipo["records_checked"] == 4 and a_tipo["records_failed"] == 1
    assert a_tipo["records_unknown"] == 1 and a_tipo["check_passed"] is False
    assert a_tipo["check_severity"] == "info" and a_tipo["_run_id"] == "run-1"
    assert log[("a", "precio_valido")]["check_passed"] is True
    assert log[("b", "precio_valido")]["records_failed"] == 1


def test_breaker(spark):
    df, _ = _frame(spark)
    with pytest.raises(CriticalQualityError) as err:
        enforce_critical(quality_log(df, DEFAULT_RULES))
    assert err.value.tenants == ["b"]
    enforce_critical(quality_log(df.filter("_tenant_id = 'a'"), DEFAULT_RULES))


def test_tenant_overrides_single_job(spark):
    rules = rules_for_tenants(DEFAULT_RULES, {"b": {"precio_valido": "TRUE"}, "a": {"extra": "cantidad < 0"}})
    assert [r.name for r in rules][-1] == "extra"
    df, _ = _frame(spark)
    base = df.drop(*[c for c in df.columns if c.startswith("_rule_")])
    out, _ = evaluate_rules(base, rules)
    rows = out.select("_tenant_id", "_rule_precio_valido", "_rule_extra").collect()
    assert all(r["_rule_precio_valido"] for r in rows if r["_tenant_id"] == "b")
    assert all(r["_rule_extra"] for r in rows if r["_tenant_id"] == "b")
    assert sum(1 for r in rows if r["_tenant_id"] == "a" and r["_rule_extra"]) == 1


def test_tenant_override_quotes_tenant_names(spark):
    df = spark.createDataFrame([("o'hara", -1.0), ("x", -1.0)], "_tenant_id string, cantidad double")
    rules = rules_for_tenants([Rule("c", "cantidad > 0")], {"O'Hara": {"c": "TRUE"}})
    out, _ = evaluate_rules(df, rules)
    assert {r["_tenant_id"]: r["_rule_c"] for r in out.collect()} == {"o'hara": True, "x": False}
