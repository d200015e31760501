"""Declarative quality rules: evaluation, log, good/bad split, quarantine routing.

NULL handling.  A rule is TRUE (pass), FALSE (fail) or NULL (unknown).  In
``unknown='drop'`` mode (parity with the original pipeline) a row whose rule
conjunction is NULL is neither good nor bad, and a bad row whose discard rule
is NULL is neither quarantined nor discarded: such rows are counted as
``lost``.  ``unknown='quarantine'`` treats anything not TRUE as bad, discards
only rows whose discard rule is FALSE, and quarantines the rest, so
good + quarantined + discarded = input.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.config import (
    DEFAULT_SEVERITY,
    DISCARD_RULES,
    LOG_LAYER,
    LOG_TABLE,
    NO_REASON,
    REASON_SEPARATOR,
    Rule,
)
from terrace.functions.columns import all_true, is_false


class CriticalQualityError(ValueError):
    """Critical rules failed and the circuit breaker is on."""

    def __init__(self, tenants: list[str]):
        super().__init__(f"critical quality failures for tenants {tenants}")
        self.tenants = tenants


def as_rules(rules: Iterable[Rule] | Mapping[str, Mapping | str]) -> list[Rule]:
    """Accept Rule objects or a ``{name: {"expr": ..., "severity": ...}}`` mapping."""
    if isinstance(rules, Mapping):
        out = []
        for name, cfg in rules.items():
            if isinstance(cfg, str):
                out.append(Rule(name, cfg, DEFAULT_SEVERITY))
            else:
                out.append(Rule(name, cfg["expr"], cfg.get("severity", DEFAULT_SEVERITY)))
        return out
    return list(rules)


def rule_condition(rules: Iterable[Rule]) -> Column:
    """Row-level conjunction of the rule columns (three-valued)."""
    return all_true(F.col(r.column) for r in rules)


def evaluate_rules(df: DataFrame, rules) -> tuple[DataFrame, Column]:
    """Add one ``_rule_<name>`` boolean column per rule in a single projection.

    Returns the frame and the conjunction of all rules.  Rule expressions run
    under the session's ANSI setting: authors should use ``try_*`` functions
    where a value can raise (division by zero, casts).
    """
    rules = as_rules(rules)
    df = df.withColumns({r.column: F.expr(r.expr).cast("boolean") for r in rules})
    return df, rule_condition(rules)


def _sql_string(text: str) -> str:
    """Escape a value for a single-quoted Spark SQL string literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def rules_for_tenants(base, overrides: Mapping[str, Mapping[str, str | Mapping[str, str]]],
                      tenant_column: str = "_tenant_id") -> list[Rule]:
    """Per-tenant rule overrides as one ``CASE`` per rule, so all tenants stay in one job.

    ``overrides = {tenant: {rule_name: expr}}`` or, to set a severity as well,
    ``{tenant: {rule_name: {"expr": ..., "severity": ...}}}`` (either may be
    left out for a rule of ``base``).  A rule name not in ``base`` becomes a
    new rule of the tenants that name it: TRUE for the others, and in no log
    of theirs.  Its severity is the tenant's, ``info`` if none is given.
    """
    def parts(value) -> dict[str, str]:
        return {"expr": value} if isinstance(value, str) else dict(value)

    by_tenant = {t.lower(): {n: parts(v) for n, v in o.items()} for t, o in overrides.items()}
    base = as_rules(base)
    names = [r.name for r in base]
    extra = dict.fromkeys(n for o in by_tenant.values() for n in o if n not in names)
    out = []
    for r in [*base, *(Rule(n, "TRUE", DEFAULT_SEVERITY) for n in extra)]:
        mine = {t: o[r.name] for t, o in by_tenant.items() if r.name in o}
        if not mine:
            out.append(r)
            continue
        cases = " ".join(f"WHEN `{tenant_column}` = '{_sql_string(t)}' THEN ({o['expr']})"
                         for t, o in mine.items() if "expr" in o)
        out.append(Rule(r.name, f"CASE {cases} ELSE ({r.expr}) END" if cases else r.expr, r.severity,
                        tuple((t, o["severity"]) for t, o in mine.items() if "severity" in o),
                        tuple(sorted(mine)) if r.name in extra else ()))
    return out


def severity_of(rule: Rule, tenant: Column) -> Column:
    """A rule's severity for the tenant of a row, in lower case."""
    out = F.lit((rule.severity or DEFAULT_SEVERITY).lower())
    for t, severity in rule.tenant_severity:
        out = F.when(F.lower(tenant) == t.lower(), F.lit((severity or DEFAULT_SEVERITY).lower())).otherwise(out)
    return out


def rule_summary(df: DataFrame, rules, tenant_column: str = "_tenant_id",
                 batch_column: str = "_batch_id", discard_rules: Iterable[str] = DISCARD_RULES,
                 unknown: str = "drop") -> DataFrame:
    """Every per-tenant counter of a quality run in ONE aggregation (one row per tenant).

    Columns: ``tenant``, ``records_checked``, ``_batch_id``, per rule ``__f<i>``
    (FALSE) and ``__u<i>`` (NULL), the outcome counts ``good``, ``bad``,
    ``quarantined``, ``discarded`` and ``critical_failed`` (rows failing a
    critical rule).  The quality log and the outcome counts are projections of
    it, so the evaluated rows are scanned once.  Partial aggregation keeps the
    shuffle at one row per tenant, batch and task, whatever the tenant skew.  The batch
    is grouped by: the largest string as an aggregate would have all rows sorted.
    """
    rules = as_rules(rules)
    cond = rule_condition(rules)
    keep = _discard_condition(rules, discard_rules)
    if unknown == "drop":
        good, bad = cond, ~cond
        quar = bad & (keep if keep is not None else F.lit(True))
        disc = bad & (~keep if keep is not None else F.lit(False))
    elif unknown == "quarantine":
        good = F.coalesce(cond, F.lit(False))
        bad = ~good
        quar = bad & (~is_false(keep) if keep is not None else F.lit(True))
        disc = bad & (is_false(keep) if keep is not None else F.lit(False))
    else:
        raise ValueError("unknown must be 'drop' or 'quarantine'")
    crit = F.lit(False)
    for r in rules:
        if "critical" in r.severities():
            crit = crit | ((severity_of(r, F.col(tenant_column)) == "critical") & is_false(F.col(r.column)))
    aggs = [F.count(F.lit(1)).alias("records_checked")]
    for i, r in enumerate(rules):
        c = F.col(r.column)
        aggs += [F.count_if(~c).alias(f"__f{i}"), F.count_if(c.isNull()).alias(f"__u{i}")]
    aggs += [F.count_if(good).alias("good"), F.count_if(bad).alias("bad"),
             F.count_if(quar).alias("quarantined"), F.count_if(disc).alias("discarded"),
             F.count_if(crit).alias("critical_failed")]
    batch = F.col(batch_column) if batch_column in df.columns else F.lit(None)
    by_batch = df.groupBy(F.lower(F.col(tenant_column)).alias("tenant"), batch.cast("string").alias("_batch_id")).agg(*aggs)
    counters = [c for c in by_batch.columns if c not in ("tenant", "_batch_id")]
    at = 1 + 2 * len(rules)
    return by_batch.groupBy("tenant").agg(*[F.sum(c).alias(c) for c in counters[:at]], F.max("_batch_id").alias("_batch_id"),
                                          *[F.sum(c).alias(c) for c in counters[at:]])


def log_from_summary(summary: DataFrame, rules, run_id: str | None = None,
                     layer: str = LOG_LAYER, table_name: str = LOG_TABLE) -> DataFrame:
    """Quality log rows (tenant x rule) from a :func:`rule_summary`."""
    rules = as_rules(rules)
    entries = F.array(*[
        F.struct(F.lit(r.name).alias("check_name"),
                 severity_of(r, F.col("tenant")).alias("check_severity"),
                 (F.col("tenant").isin(list(r.only)) if r.only else F.lit(True)).alias("applies"),
                 F.col(f"__f{i}").alias("records_failed"),
                 F.col(f"__u{i}").alias("records_unknown"))
        for i, r in enumerate(rules)])
    long = summary.select(F.col("tenant").alias("tenant_id"), "records_checked", "_batch_id",
                          F.inline(entries)).filter("applies")
    return long.select(
        F.lit(run_id).cast("string").alias("_run_id"), "_batch_id", "tenant_id",
        F.lit(layer).alias("layer"), F.lit(table_name).alias("table_name"),
        "check_name", "check_severity", "records_checked", "records_failed",
        (F.col("records_failed") == 0).alias("check_passed"), "records_unknown",
        F.current_timestamp().alias("executed_at"))


def counts_from_summary(summary: DataFrame) -> DataFrame:
    """Per-tenant outcome counts (with ``lost``) from a :func:`rule_summary`."""
    return summary.select(
        "tenant", F.col("records_checked").alias("rows_in"), "good", "bad", "quarantined", "discarded",
        (F.col("records_checked") - F.col("good") - F.col("quarantined") - F.col("discarded")).alias("lost"))


def quality_log(df: DataFrame, rules, run_id: str | None = None,
                tenant_column: str = "_tenant_id", batch_column: str = "_batch_id",
                layer: str = LOG_LAYER, table_name: str = LOG_TABLE) -> DataFrame:
    """One log row per tenant and rule, from one grouped aggregation.

    ``records_failed`` counts FALSE only; NULL goes to ``records_unknown``.
    ``check_passed`` is ``records_failed = 0``.  Tenants without rows produce
    no log rows.  ``_batch_id`` is the largest batch id of the tenant's rows
    (deterministic).
    """
    return log_from_summary(rule_summary(df, rules, tenant_column, batch_column), rules, run_id,
                            layer, table_name)


def critical_tenants(log: DataFrame) -> list[str]:
    """Tenants with a failing critical check (one row per tenant at most)."""
    rows = (log.filter((F.lower("check_severity") == "critical") & (F.col("records_failed") > 0))
            .select("tenant_id").distinct().collect())
    return sorted(r.tenant_id for r in rows)


def enforce_critical(log: DataFrame) -> None:
    """Circuit breaker: raise when any critical check failed."""
    tenants = critical_tenants(log)
    if tenants:
        raise CriticalQualityError(tenants)


def split_by_quality(df: DataFrame, cond: Column, unknown: str = "drop") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``.  ``drop``: good = cond TRUE, bad = cond FALSE (NULL in neither).
    ``quarantine``: good = cond TRUE, bad = cond FALSE or NULL."""
    if unknown == "drop":
        return df.filter(cond), df.filter(~cond)
    if unknown == "quarantine":
        safe = F.coalesce(cond, F.lit(False))
        return df.filter(safe), df.filter(~safe)
    raise ValueError("unknown must be 'drop' or 'quarantine'")


def _discard_condition(rules: Sequence[Rule], discard_rules: Iterable[str]) -> Column | None:
    names = set(discard_rules)
    present = [r for r in rules if r.name in names]
    return rule_condition(present) if present else None


def route_bad(bad: DataFrame, rules, discard_rules: Iterable[str] = DISCARD_RULES,
              unknown: str = "drop") -> tuple[DataFrame, DataFrame]:
    """``(quarantine, discard)`` of the bad rows.

    A bad row whose discard rules all hold goes to quarantine; one whose
    discard rule is FALSE is discarded (counted, not stored).  Without discard
    rules everything bad is quarantined.
    """
    rules = as_rules(rules)
    keep = _discard_condition(rules, discard_rules)
    if keep is None:
        return bad, bad.filter(F.lit(False))
    if unknown == "drop":
        return bad.filter(keep), bad.filter(~keep)
    if unknown == "quarantine":
        return bad.filter(~is_false(keep)), bad.filter(is_false(keep))
    raise ValueError("unknown must be 'drop' or 'quarantine'")


def failure_reasons(rules, discard_rules: Iterable[str] = (), name_null_discards: bool = False,
                    tenant_column: str = "_tenant_id") -> Column:
    """Comma-separated names, in rule order, of the non-``info`` rules that are FALSE or NULL.

    ``'unknown'`` when every rule is ``info``.  ``name_null_discards`` also
    names discard rules that are NULL (the ``unknown='quarantine'`` mode).
    """
    rules = as_rules(rules)
    discard = set(discard_rules)
    parts = []
    for r in rules:
        c = F.col(r.column)
        if r.severities() != {"info"}:
            named = ~c | c.isNull()
            if "info" in r.severities():
                named = named & (severity_of(r, F.col(tenant_column)) != "info")
            parts.append(F.when(named, F.lit(r.name)))
        elif name_null_discards and r.name in discard:
            parts.append(F.when(c.isNull(), F.lit(r.name)))
    if not parts:
        return F.lit(NO_REASON)
    return F.concat_ws(REASON_SEPARATOR, *parts)


def quarantine_frame(df: DataFrame, rules, discard_rules: Iterable[str] = DISCARD_RULES,
                     unknown: str = "drop", parsed_date: str = "fecha_proceso_dt",
                     timestamp: bool = True) -> DataFrame:
    """Quarantine projection: reason added, rule columns and the parsed date dropped."""
    rules = as_rules(rules)
    out = df.withColumn("_quarantine_reason",
                        failure_reasons(rules, discard_rules, name_null_discards=(unknown == "quarantine")))
    out = out.drop(*[c for c in out.columns if c.startswith("_rule_")], parsed_date)
    if timestamp:
        out = out.withColumn("_quarantine_timestamp", F.current_timestamp())
    return out


def action_frame(df: DataFrame, cond: Column, rules, discard_rules: Iterable[str] = DISCARD_RULES,
                 timestamp: bool = True) -> DataFrame:
    """Every row that is not good (NULL included) with its reason and ``_action``: ``discard`` if a
    discard rule is FALSE, else ``quarantine``.  Nothing is lost or only counted."""
    rules = as_rules(rules)
    _, bad = split_by_quality(df, cond, "quarantine")
    keep = _discard_condition(rules, discard_rules)
    action = F.lit("quarantine") if keep is None else F.when(is_false(keep), F.lit("discard")).otherwise("quarantine")
    return quarantine_frame(bad.withColumn("_action", action), rules, discard_rules, "quarantine", timestamp=timestamp)


def outcome_counts(df: DataFrame, rules, discard_rules: Iterable[str] = DISCARD_RULES,
                   unknown: str = "drop", tenant_column: str = "_tenant_id") -> DataFrame:
    """Per tenant: rows in, good, bad, quarantined, discarded and lost — one aggregation."""
    return counts_from_summary(rule_summary(df, rules, tenant_column, discard_rules=discard_rules,
                                            unknown=unknown))
