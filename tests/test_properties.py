"""Property tests with random inputs (hypothesis): routing conserves rows, upsert equals a model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrace.config import Rule
from terrace.operators.quality import evaluate_rules, outcome_counts, route_bad, split_by_quality
from terrace.operators.sinks import upsert
from terrace.session import scratch_path
from terrace.sources.files import read_table

RULES = [Rule("a", "a", "warning"), Rule("b", "b", "critical"), Rule("t", "t", "info")]
tri = st.sampled_from([True, False, None])
rows_st = st.lists(st.tuples(st.sampled_from(["x", "y"]), tri, tri, tri), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_routing_accounts_for_every_row(spark, rows):
    df = spark.createDataFrame(rows, "_tenant_id string, a boolean, b boolean, t boolean")
    ev, cond = evaluate_rules(df, RULES)
    for unknown in ("drop", "quarantine"):
        good, bad = split_by_quality(ev, cond, unknown)
        quar, disc = route_bad(bad, RULES, ("t",), unknown)
        g, q, d = good.count(), quar.count(), disc.count()
        counts = {r["tenant"]: r for r in outcome_counts(ev, RULES, ("t",), unknown).collect()}
        assert sum(r["good"] for r in counts.values()) == g
        assert sum(r["quarantined"] for r in counts.values()) == q
        assert sum(r["discarded"] for r in counts.values()) == d
        lost = sum(r["lost"] for r in counts.values())
        assert g + q + d + lost == len(rows)
        if unknown == "quarantine":
            assert lost == 0
        else:
            # parity: a row is lost exactly when its conjunction is NULL, or it is bad with a NULL type rule
            def conj(r):
                vals = r[1:]
                return False if False in vals else (None if None in vals else True)
            expect = sum(1 for r in rows if conj(r) is None or (conj(r) is False and r[3] is None))
            assert lost == expect


keys_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5), st.integers(0, 99)), max_size=25,
                   unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=keys_st, source=keys_st)
def test_upsert_equals_dict_merge(spark, target, source):
    path = scratch_path(spark, "prop-upsert")
    schema = "p int, k int, v int"
    upsert(spark, spark.createDataFrame(target, schema), path, ["p", "k"], ["p"])
    upsert(spark, spark.createDataFrame(source, schema), path, ["p", "k"], ["p"])
    model = {(p, k): v for p, k, v in target}
    model.update({(p, k): v for p, k, v in source})
    if not model:
        return
    got = sorted(tuple(r) for r in read_table(spark, path).select("p", "k", "v").collect())
    assert got == sorted((p, k, v) for (p, k), v in model.items())
