"""Registered queries: one per operator or job, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the fixture views
(``terrace.sources.fixtures``) over whole tables.  Sink queries write to a
fresh folder under the shared checkpoint directory and return the table as
read back; they partition by month (``mes = fecha_proceso div 100``) rather
than by day to keep the number of directories small at test scale.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import DEFAULT_RULES, DIMENSION_KEYS, FACT_KEYS, MONTH_KEY
from terrace.operators.contract import isolate_tenants, stamp_global
from terrace.operators.history import record_snapshot
from terrace.operators.metrics import DAILY_KEYS, DAILY_MEASURES, Measure, daily_metrics, dedup
from terrace.operators.normalize import (
    DELIVERY_FLAGS,
    class_flags,
    date_range,
    normalize_deliveries,
    normalize_units,
    parse_process_date,
)
from terrace.operators.partials import finish_metrics, merge_partials, refresh_partials
from terrace.operators.quality import (
    action_frame,
    outcome_counts,
    quality_log,
    quarantine_frame,
    route_bad,
    rules_for_tenants,
    split_by_quality,
)
from terrace.operators.sinks import (
    append, materialize, overwrite, recover, replace_partitions, replace_prefix, stage_commit, table_schema, upsert)
from terrace.operators.temporal import point_in_time_join
from terrace.plans.medallion import (
    LOG_DATE,
    Layout,
    RunConfig,
    bronze_frame,
    conform_dimension,
    gold_frame,
    ingest,
    routine_extract,
    run,
    silver_evaluate,
    silver_rows,
)
from terrace.session import CLEAN_CONF, remove_path, scratch_path, session_conf
from terrace.sources import fixtures
from terrace.sources.files import file_bytes, read_table
from terrace.sources.fixtures import FIXTURE_DELIVERIES, FIXTURE_MATERIALS
from terrace.streaming.ingest import stream_ingest
from terrace.streaming.silver import stream_quality_log, stream_silver

# Fixed values of the query scenarios.
FIXTURE_TENANTS = ("africa", "america", "asia", "europe", "middle east")
ISOLATED_TENANTS = ("America", "EUROPE", "middle east")
RANGE = ("1996-01-01", "1997-12-31")
ROUTINE_COUNTRIES = ("EUROPE", "ASIA", "america")
OVERRIDES = {
    "europe": {"precio_valido": "precio > 1000 AND precio IS NOT NULL"},
    "asia": {"cantidad_valida": "cantidad >= 10 AND cantidad IS NOT NULL"},
}
MONTH = MONTH_KEY
MONTH_LAYOUT = ("_tenant_id", "mes")

QueryFn = Callable[[SparkSession, str], DataFrame]


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH[0], F.expr(MONTH[1]))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.deliveries(spark, sf)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Fixture deliveries with the tenant stamped (no clock or file columns)."""
    return isolate_tenants(fixtures.deliveries(spark, sf), "pais")


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    return conform_dimension(fixtures.materials_raw(spark, sf))


def evaluated(spark: SparkSession, sf: str, rules=DEFAULT_RULES):
    return silver_evaluate(bronze(spark, sf), dimension(spark, sf), rules)


# ---------------------------------------------------------------- contract / tenants
def tenant_isolation(spark, sf):
    return isolate_tenants(deliveries(spark, sf), "pais", ISOLATED_TENANTS)


def global_catalog_stamp(spark, sf):
    return stamp_global(dimension(spark, sf))


# ---------------------------------------------------------------- filters / projections
def date_range_filter(spark, sf):
    return date_range(bronze(spark, sf), "fecha_proceso", *RANGE)


def unit_normalization(spark, sf):
    return normalize_units(bronze(spark, sf))


def process_date_parse(spark, sf):
    return parse_process_date(bronze(spark, sf))


def delivery_class_flags(spark, sf):
    return class_flags(bronze(spark, sf), "tipo_entrega", DELIVERY_FLAGS)


def dimension_conform(spark, sf):
    return dimension(spark, sf)


def silver_column_order(spark, sf):
    df, cond = evaluated(spark, sf)
    return silver_rows(df.filter(cond), FACT_KEYS, timestamp=False)


# ---------------------------------------------------------------- join
def point_in_time_join_q(spark, sf):
    fact = normalize_deliveries(bronze(spark, sf))
    return point_in_time_join(fact, dimension(spark, sf).select("material", "valid_from", "valid_to", "precio_base"),
                              ["material"], at="fecha_proceso_dt",
                              columns={"precio_base": "precio_catalogo_unitario"})


def point_in_time_join_salted(spark, sf):
    """The same join with every material explicitly split over 8 salt buckets."""
    fact = normalize_deliveries(bronze(spark, sf))
    return point_in_time_join(fact, dimension(spark, sf).select("material", "valid_from", "valid_to", "precio_base"),
                              ["material"], at="fecha_proceso_dt",
                              columns={"precio_base": "precio_catalogo_unitario"}, salt=8)


def _overlapping_versions(spark, sf) -> DataFrame:
    """Besides the two versions of the catalog a one-month promotion inside an open version, a second
    version with an equal start that ends earlier, and versions with a NULL end."""
    dim = dimension(spark, sf).select("material", "valid_from", "valid_to", "precio_base")
    newer = dim.filter(F.col("valid_from") == F.lit("1998-07-01").cast("date"))

    def version(start, end, factor, every):
        return newer.filter(F.col("material") % every == 0).select(
            "material", F.lit(start).cast("date").alias("valid_from"), F.lit(end).cast("date").alias("valid_to"),
            (F.col("precio_base") * F.lit(factor)).alias("precio_base"))

    return (dim.unionByName(version("1996-03-01", "1996-03-31", 0.5, 1))
            .unionByName(version("1998-07-01", "1998-08-15", 0.75, 3))
            .unionByName(version("1997-01-01", None, 0.25, 2)))


def _join_latest(spark, sf, method: str) -> DataFrame:
    fact = normalize_deliveries(bronze(spark, sf))
    return point_in_time_join(fact, _overlapping_versions(spark, sf), ["material"], at="fecha_proceso_dt",
                              columns={"precio_base": "precio_catalogo_unitario"}, on_overlap="latest", method=method)


def point_in_time_join_latest(spark, sf):
    """``on_overlap='latest'`` keeps one row per fact: the newest version valid on its day."""
    return _join_latest(spark, sf, "range")


def point_in_time_join_points(spark, sf):
    """The newest version of each distinct (material, day), found in dyadic ranges, joined by equality."""
    return _join_latest(spark, sf, "points")


def point_in_time_join_fanout_points(spark, sf):
    """All valid versions of overlapping ones, one row each, found in dyadic ranges."""
    fact = normalize_deliveries(bronze(spark, sf))
    return point_in_time_join(fact, _overlapping_versions(spark, sf), ["material"], at="fecha_proceso_dt",
                              columns={"precio_base": "precio_catalogo_unitario"}, method="points")


def point_in_time_join_snapshot(spark, sf):
    """The pre-expanded daily dimension, cut to the facts' days of each material, joined by equality."""
    fact = normalize_deliveries(bronze(spark, sf))
    return point_in_time_join(fact, dimension(spark, sf).select("material", "valid_from", "valid_to", "precio_base"),
                              ["material"], at="fecha_proceso_dt",
                              columns={"precio_base": "precio_catalogo_unitario"}, method="snapshot")


# ---------------------------------------------------------------- version history
def scd2_history_state(spark, sf):
    """Versions built from three plain catalog snapshots, the one of 1996 arriving last: prices change and change
    back, parts appear and disappear."""
    part = fixtures.table(spark, sf, "part")
    path = scratch_path(spark, "history")
    for day, there, factor in ((dt.date(1995, 1, 1), "p_partkey % 13 <> 0", "1"),
                               (dt.date(1997, 1, 1), "p_partkey % 11 <> 0", "IF(p_partkey % 3 = 0, 1.1D, 1)"),
                               (dt.date(1996, 1, 1), "TRUE", "IF(p_partkey % 5 = 0, 0.9D, 1)")):
        snapshot = part.filter(there).select(F.col("p_partkey").alias("material"), F.expr(
            f"CAST(p_retailprice * {factor} AS DOUBLE)").alias("precio_base"), F.col("p_brand").alias("marca"))
        record_snapshot(spark, snapshot, path, ["material"], ["precio_base", "marca"], day)
    return read_table(spark, path, schema=table_schema(spark, path)).drop("_bucket")


# ---------------------------------------------------------------- quality
def rule_flags(spark, sf):
    return evaluated(spark, sf)[0]


def quality_log_q(spark, sf):
    df, _ = evaluated(spark, sf)
    return quality_log(df, DEFAULT_RULES).drop("_run_id", "_batch_id", "executed_at")


def good_rows(spark, sf):
    df, cond = evaluated(spark, sf)
    return split_by_quality(df, cond)[0]


def bad_rows(spark, sf):
    df, cond = evaluated(spark, sf)
    return split_by_quality(df, cond)[1]


def bad_rows_null_safe(spark, sf):
    df, cond = evaluated(spark, sf)
    return split_by_quality(df, cond, unknown="quarantine")[1]


def quarantine_reasons(spark, sf):
    df, cond = evaluated(spark, sf)
    quarantine, _ = route_bad(split_by_quality(df, cond)[1], DEFAULT_RULES)
    return quarantine_frame(quarantine, DEFAULT_RULES, timestamp=False)


def quarantine_null_safe(spark, sf):
    df, cond = evaluated(spark, sf)
    quarantine, _ = route_bad(split_by_quality(df, cond, "quarantine")[1], DEFAULT_RULES, unknown="quarantine")
    return quarantine_frame(quarantine, DEFAULT_RULES, unknown="quarantine", timestamp=False)


def discard_counts(spark, sf):
    df, _ = evaluated(spark, sf)
    return outcome_counts(df, DEFAULT_RULES)


def discard_counts_null_safe(spark, sf):
    df, _ = evaluated(spark, sf)
    return outcome_counts(df, DEFAULT_RULES, unknown="quarantine")


def tenant_rule_override(spark, sf):
    rules = rules_for_tenants(DEFAULT_RULES, OVERRIDES)
    df, cond = evaluated(spark, sf, rules)
    return df.select(*FACT_KEYS, "cantidad", "precio", *[r.column for r in rules],
                     cond.alias("passed"))


SEVERITIES = {
    "europe": {"precio_valido": {"severity": "warning"},
               "ruta_conocida": {"expr": "ruta IS NOT NULL AND ruta % 7 <> 0", "severity": "critical"}},
    "asia": {"cantidad_valida": {"expr": "cantidad >= 10 AND cantidad IS NOT NULL", "severity": "info"}},
}


def tenant_rule_severity(spark, sf):
    """The log under per-tenant severities; a new rule is logged for its tenant only."""
    rules = rules_for_tenants(DEFAULT_RULES, SEVERITIES)
    df, _ = evaluated(spark, sf, rules)
    return quality_log(df, rules).drop("_run_id", "_batch_id", "executed_at")


def tenant_severity_reasons(spark, sf):
    rules = rules_for_tenants(DEFAULT_RULES, SEVERITIES)
    df, cond = evaluated(spark, sf, rules)
    quarantine, _ = route_bad(split_by_quality(df, cond)[1], rules)
    return quarantine_frame(quarantine, rules, timestamp=False).select(*FACT_KEYS, "_quarantine_reason")


def quarantine_actions(spark, sf):
    df, cond = evaluated(spark, sf)
    return action_frame(df, cond, DEFAULT_RULES, timestamp=False)


# ---------------------------------------------------------------- aggregation
def full_row_dedup(spark, sf):
    b = bronze(spark, sf)
    return dedup(b.unionByName(b))


def gold_daily_metrics(spark, sf):
    df, cond = evaluated(spark, sf)
    return gold_frame(df.filter(cond))


def gold_fractional_metrics(spark, sf):
    """Operands with three and five decimals: nothing is rounded to cents."""
    df, cond = evaluated(spark, sf)
    fine = df.filter(cond).withColumns({
        "cantidad_normalizada_st": F.col("cantidad_normalizada_st") * F.lit(0.125),
        "precio": F.col("precio") / F.lit(1000)})
    return gold_frame(fine)


def gold_extreme_metrics(spark, sf):
    """Quantities beyond the decimal operands (days ending in 3) and NaN (in 4): those groups get double sums."""
    last = F.col("fecha_proceso") % 10
    extreme = bronze(spark, sf).withColumn("cantidad", F.when(last == 3, F.lit(1e12)).when(
        (last == 4) & (F.col("material") % 2 == 0), F.lit(float("nan"))).otherwise(F.col("cantidad"))).withColumn(
        "precio", F.when(last == 3, F.floor("precio").cast("double")).otherwise(F.col("precio")))
    df, cond = silver_evaluate(extreme, dimension(spark, sf))
    good, _ = split_by_quality(df, cond)
    return gold_frame(silver_rows(good, timestamp=False), ())


def gold_approx_distinct_error(spark, sf):
    """HyperLogLog distinct counts of whole tenants: are they within 15 % of the exact ones?"""
    df, cond = evaluated(spark, sf)
    good = df.filter(cond)
    exact = daily_metrics(good, ["_tenant_id"])
    near = daily_metrics(good, ["_tenant_id"], approx=True).select(
        "_tenant_id", F.col("active_routes").alias("r"), F.col("active_transports").alias("t"))
    return exact.join(near, "_tenant_id").select(
        "_tenant_id", "active_routes", "active_transports",
        (F.abs(F.col("r") / F.col("active_routes") - 1) <= 0.15).alias("routes_within"),
        (F.abs(F.col("t") / F.col("active_transports") - 1) <= 0.15).alias("transports_within"))


PARTIAL_MEASURES = (*DAILY_MEASURES, Measure("deliveries", "count"))
MENDED_DAYS, EMPTIED_DAYS = (19930615, 19980302), (19950310, 19970704)


def _refreshed_partials(spark, sf, name):
    """Partials of all days, then of two mended days five years apart and two emptied ones; and the facts they stand for."""
    path, good = scratch_path(spark, name), _staged_good(spark, sf)[0]
    refresh_partials(spark, good, path, MONTH_LAYOUT, measures=PARTIAL_MEASURES)
    mended = good.filter(F.col("fecha_proceso").isin(*MENDED_DAYS)).withColumn(
        "cantidad_normalizada_st", F.col("cantidad_normalizada_st") + 0.25)
    emptied = good.filter(F.col("fecha_proceso").isin(*EMPTIED_DAYS)).select("_tenant_id", "fecha_proceso", "mes").distinct()
    refresh_partials(spark, mended, path, MONTH_LAYOUT, measures=PARTIAL_MEASURES, processed=emptied)
    facts = good.filter(~F.col("fecha_proceso").isin(*MENDED_DAYS, *EMPTIED_DAYS)).unionByName(mended)
    return read_table(spark, path, schema=table_schema(spark, path)), facts


def gold_incremental_state(spark, sf):
    """Gold from stored partials after single days were refreshed; sums to cents, without the estimates."""
    partials, _ = _refreshed_partials(spark, sf, "gold-partials")
    return finish_metrics(partials, PARTIAL_MEASURES).select(
        *DAILY_KEYS, "mes", F.round("total_units", 2).alias("total_units"), F.round("total_revenue", 2).alias("total_revenue"),
        "deliveries")


def gold_rollup_partials(spark, sf):
    """Monthly metrics merged from daily partials: exact sums, and distinct counts within 10 % of the exact ones."""
    partials, facts = _refreshed_partials(spark, sf, "rollup-partials")
    keys = ["_tenant_id", "mes"]
    near = finish_metrics(merge_partials(partials, keys, PARTIAL_MEASURES), PARTIAL_MEASURES).withColumnsRenamed(
        {"active_routes": "r", "active_transports": "t"})
    exact = daily_metrics(facts, keys).select(*keys, "active_routes", "active_transports")
    return near.join(exact, keys).select(
        *keys, F.round("total_units", 2).alias("total_units"), F.round("total_revenue", 2).alias("total_revenue"), "deliveries",
        "active_routes", "active_transports",
        (F.abs(F.col("r") / F.col("active_routes") - 1) <= 0.1).alias("routes_within"),
        (F.abs(F.col("t") / F.col("active_transports") - 1) <= 0.1).alias("transports_within"))


# ---------------------------------------------------------------- sinks
def replace_partitions_state(spark, sf):
    path = scratch_path(spark, "replace-partitions")
    b = _with_month(bronze(spark, sf))
    replace_partitions(b, path, MONTH_LAYOUT)
    batch = (b.filter(F.col("fecha_proceso").between(19970601, 19980630))
             .withColumn("precio", F.col("precio") + 1))
    replace_partitions(batch, path, MONTH_LAYOUT)
    return read_table(spark, path, schema=b.schema)


def replace_prefix_state(spark, sf):
    path = scratch_path(spark, "replace-prefix")
    layout = ("pais", "mes")
    ext = routine_extract(deliveries(spark, sf), fixtures_countries()).withColumn(
        "mes", F.expr("CAST(fecha DIV 100 AS INT)"))
    overwrite(ext, path, layout)
    batch = (routine_extract(deliveries(spark, sf).filter(F.col("fecha_proceso") >= 19980101), ["EUROPE"])
             .withColumn("total", F.col("total") * 2)
             .withColumn("mes", F.expr("CAST(fecha DIV 100 AS INT)")))
    replace_prefix(batch, path, {"pais": "EUROPE"}, layout)
    return read_table(spark, path, schema=ext.schema)


def fixtures_countries():
    return [t.upper() for t in FIXTURE_TENANTS]


def _good_monthly(spark, sf):
    df, cond = evaluated(spark, sf)
    return _with_month(silver_rows(df.filter(cond), FACT_KEYS, timestamp=False))


def _staged_good(spark, sf) -> tuple[DataFrame, str]:
    """The good rows, evaluated once for all that is made of them, and the folder they lie in."""
    with session_conf(spark, CLEAN_CONF):
        return materialize(spark, _good_monthly(spark, sf), "good")


def upsert_fact_state(spark, sf):
    path = scratch_path(spark, "upsert-fact")
    good = _good_monthly(spark, sf)
    keys = list(FACT_KEYS) + ["mes"]
    upsert(spark, good, path, keys, MONTH_LAYOUT)
    source = good.filter(F.col("mes").isin(199806, 199807))
    updates = source.withColumn("precio", F.col("precio") + 1)
    inserts = source.withColumn("transporte", -F.col("transporte") - 1)
    upsert(spark, updates.unionByName(inserts), path, keys, MONTH_LAYOUT)
    return read_table(spark, path, schema=good.schema)


def upsert_evolved_state(spark, sf):
    """Tables whose later files have a column that the first file lacks, then an upsert whose source
    lacks it too: matched rows keep its values.  Once partitioned, once not."""
    good, stage = _staged_good(spark, sf)
    keys = list(FACT_KEYS) + ["mes"]
    old = good.filter(F.col("mes") < 199706)
    new = good.filter(F.col("mes") >= 199706).withColumn("nota", F.concat(F.lit("n"), F.col("ruta").cast("string")))
    source = good.filter(F.col("mes").isin(199701, 199806) & (F.col("ruta") % 2 == 0)).select(
        *keys, "cantidad", (F.col("precio") + 1).alias("precio"))
    out = None
    for name, layout in (("month", MONTH_LAYOUT), ("none", ())):
        path = scratch_path(spark, f"upsert-evolved-{name}")
        for batch in (old, new, source):
            upsert(spark, batch, path, keys, layout)
        table = read_table(spark, path, schema=table_schema(spark, path)).select(
            *keys, "cantidad", "precio", "unidad", "nota", F.lit(name).alias("layout"))
        out = table if out is None else out.unionByName(table)
    remove_path(spark, stage)
    return out


def upsert_dim_state(spark, sf):
    path = scratch_path(spark, "upsert-dim")
    dim = dimension(spark, sf)
    upsert(spark, dim, path, DIMENSION_KEYS)
    newer = dim.filter(F.col("valid_from") == F.lit("1998-07-01").cast("date"))
    updates = newer.withColumn("precio_base", F.col("precio_base") * F.lit(1.2))
    inserts = newer.select(
        "material", (F.col("precio_base") * F.lit(1.3)).alias("precio_base"),
        F.lit("2001-01-01").cast("date").alias("valid_from"),
        F.lit("9999-12-31").cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    upsert(spark, updates.unionByName(inserts), path, DIMENSION_KEYS)
    return read_table(spark, path, schema=dim.schema)


def append_evolved_state(spark, sf):
    path = scratch_path(spark, "append")
    b = bronze(spark, sf)
    append(b.filter(F.col("fecha_proceso") < 19970101), path)
    append(normalize_units(b.filter(F.col("fecha_proceso") >= 19970101)), path)
    return read_table(spark, path, merge_schema=True)


def full_overwrite_state(spark, sf):
    path = scratch_path(spark, "overwrite")
    b = bronze(spark, sf)
    overwrite(b, path)
    overwrite(b.drop("unidad"), path, keep_old_columns=True)
    return read_table(spark, path, schema=b.schema)


def quarantine_state(spark, sf):
    path = scratch_path(spark, "quarantine")
    q = _with_month(quarantine_reasons(spark, sf))
    replace_partitions(q, path, MONTH_LAYOUT)
    replace_partitions(q, path, MONTH_LAYOUT)   # rerun: same state
    return read_table(spark, path, schema=q.schema)


# ---------------------------------------------------------------- ingest / jobs
def routine_extract_q(spark, sf):
    return routine_extract(deliveries(spark, sf), ROUTINE_COUNTRIES)


RAW_FILES, RAW_BYTES = 6, 4 << 20     # least number of raw files; bytes of the driver's tables that go into one


def _raw_files_of(df: DataFrame, least: int = RAW_FILES) -> int:
    """How many raw files rows are dealt to: a multiple of ``least`` that grows with the files they come from."""
    return least * max(1, -(-(file_bytes(df) or 0) // (RAW_BYTES * RAW_FILES)))


def _write_raw(df: DataFrame, fmt: str) -> str:
    """Rows as several raw files in the shared folder."""
    path = scratch_path(df.sparkSession, f"raw-{fmt}")
    with session_conf(df.sparkSession, CLEAN_CONF):
        df.repartition(_raw_files_of(df)).write.option("header", "true").format(fmt).save(path)
    return path


def _raw_files(spark, sf, fmt: str) -> str:
    return _write_raw(deliveries(spark, sf), fmt)


BRONZE_CSV_TENANTS = ("Asia", "EUROPE")
BRONZE_CSV_RANGE = ("1995-06-01", "1998-12-31")


MONTHLY = dataclasses.replace(FIXTURE_DELIVERIES, partition_by=MONTH_LAYOUT, derived=(MONTH,))
BRONZE_SCHEMA = T.StructType(list(FIXTURE_DELIVERIES.schema.fields) + [
    T.StructField("_tenant_id", T.StringType()), T.StructField("mes", T.IntegerType())])


def bronze_csv_ingest(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    raw = _raw_files(spark, sf, "csv")
    ingest(spark, raw, MONTHLY, layout, BRONZE_CSV_TENANTS, *BRONZE_CSV_RANGE)
    ingest(spark, raw, MONTHLY, layout, BRONZE_CSV_TENANTS, *BRONZE_CSV_RANGE)   # rerun: same state
    return read_table(spark, layout.bronze("deliveries"), schema=BRONZE_SCHEMA)


def _ragged_files(spark, sf) -> str:
    """CSV files with lines that lack their last value (transporte % 97 = 0) or have one too many (% 89 = 0)."""
    raw = deliveries(spark, sf)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
    line = (F.when(F.col("transporte") % 97 == 0, F.concat_ws(",", *values[:-1]))
            .when(F.col("transporte") % 89 == 0, F.concat_ws(",", *values, F.lit("surplus")))
            .otherwise(F.concat_ws(",", *values)))
    path = scratch_path(spark, "ragged")
    # one column that holds the whole line, header included, with a separator that no value has
    raw.select(line.alias(",".join(raw.columns))).repartition(6).write.option("header", "true").option("sep", "\x01").csv(path)
    return path


def malformed_lines_status(spark, sf):
    """Lines with the wrong number of values are counted, kept or left out."""
    raw, out = _ragged_files(spark, sf), None
    for mode in ("keep", "quarantine"):
        layout = Layout(scratch_path(spark, "lake"))
        res = ingest(spark, raw, MONTHLY, layout, malformed=mode)
        table = read_table(spark, layout.bronze("deliveries"), schema=BRONZE_SCHEMA).groupBy("_tenant_id").agg(
            F.count(F.lit(1)).alias("rows"), F.count("unidad").alias("with_unit"))
        table = table.select("*", F.lit(mode).alias("mode"), F.lit(res.reason).alias("reason"))
        out = table if out is None else out.unionByName(table)
    return out


def malformed_lines_state(spark, sf):
    """The quarantined raw lines; loading the same files again replaces them."""
    raw, layout = _ragged_files(spark, sf), Layout(scratch_path(spark, "lake"))
    for _ in range(2):
        ingest(spark, raw, MONTHLY, layout, malformed="quarantine")
    path = layout.malformed("deliveries")
    values = F.split("line", ",", -1)
    return read_table(spark, path, schema=table_schema(spark, path)).select(
        F.size(values).alias("n_values"), values[0].alias("pais"), values[1].cast("int").alias("fecha_proceso"),
        values[2].cast("long").alias("transporte"), values[3].cast("long").alias("ruta"))


def csv_reordered_columns(spark, sf):
    """Columns are taken by their names in the header, whatever their order and case."""
    layout = Layout(scratch_path(spark, "lake"))
    raw = deliveries(spark, sf)
    turned = raw.select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)])
    ingest(spark, _write_raw(turned, "csv"), MONTHLY, layout)
    return read_table(spark, layout.bronze("deliveries"), schema=BRONZE_SCHEMA)


def csv_extra_column_to_silver(spark, sf):
    """A column that the spec does not declare reaches silver; identifiers are text by default."""
    layout = Layout(scratch_path(spark, "lake"))
    raw = deliveries(spark, sf).withColumns({
        "canal": F.concat(F.lit("c"), F.col("unidad")), "material": F.concat(F.lit("SKU"), F.col("material"))})
    catalog = fixtures.materials_raw(spark, sf).withColumn("material", F.concat(F.lit("SKU"), F.col("material")))
    cfg = RunConfig(tenants=RUN_TENANTS, partition_by=MONTH_LAYOUT, derived=(MONTH,))
    run(spark, _write_raw(raw, "csv"), _write_raw(catalog, "csv"), layout, cfg)
    return read_table(spark, layout.fact, schema=table_schema(spark, layout.fact)).select(
        *FACT_KEYS, "cantidad_normalizada_st", "precio", "precio_catalogo_unitario", "canal")


def contract_violation_status(spark, sf):
    """Files without a required column: the run fails (raise) or skips (skip) the entity."""
    raw = _write_raw(deliveries(spark, sf).drop("pais"), "csv")
    out = None
    for mode in ("raise", "skip"):
        layout = Layout(scratch_path(spark, "lake"))
        status = run(spark, raw, fixtures.materials_raw(spark, sf), layout, _run_config(on_violation=mode))
        status = status.withColumn("mode", F.lit(mode))
        out = status if out is None else out.unionByName(status)
    return out


def unparsable_values_status(spark, sf):
    """Values that do not convert to the declared type are NULL and counted in the status."""
    raw = deliveries(spark, sf).withColumns({
        "precio": F.when(F.col("transporte") % 7 == 0, "n/a").otherwise(F.col("precio").cast("string")),
        "cantidad": F.when(F.col("transporte") % 5 == 0, "12 pieces").otherwise(F.col("cantidad").cast("string"))})
    layout = Layout(scratch_path(spark, "lake"))
    res = ingest(spark, _write_raw(raw, "csv"), MONTHLY, layout)
    table = read_table(spark, layout.bronze("deliveries"), schema=BRONZE_SCHEMA)
    return table.groupBy("_tenant_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count("precio").alias("with_price"),
        F.count("cantidad").alias("with_quantity")).withColumn("reason", F.lit(res.reason))


def lineage_stamps(spark, sf):
    raw = _raw_files(spark, sf, "parquet")
    spec = dataclasses.replace(FIXTURE_DELIVERIES, fmt="parquet")
    b = bronze_frame(spark, raw, spec, batch_id="batch-1")
    return b.groupBy("_tenant_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_batch_id").alias("batches"),
        F.count_if(F.col("_source_file").endswith(".parquet")).alias("rows_with_file"),
        F.count_if(F.col("_ingestion_timestamp").isNotNull()).alias("rows_with_time"))


def stream_ingest_state(spark, sf):
    """Stream the files, restart, deliver half of the rows again in other files, then load a
    changed month in batch: one plain table that holds every row once."""
    raw = deliveries(spark, sf)
    landing = _write_raw(raw, "parquet")
    layout = Layout(scratch_path(spark, "lake"))
    sink, ckpt = layout.bronze("deliveries"), scratch_path(spark, "stream-ckpt")
    spec = dataclasses.replace(MONTHLY, fmt="parquet")
    stream_ingest(spark, landing, spec, sink, ckpt, max_files_per_trigger=_raw_files_of(raw) // 2)
    stream_ingest(spark, landing, spec, sink, ckpt)   # restart: nothing new
    raw.filter(F.col("ruta") % 2 == 0).repartition(_raw_files_of(raw, 2)).write.mode("append").parquet(landing)
    stream_ingest(spark, landing, spec, sink, ckpt)   # delivered again: nothing twice
    month = raw.filter(F.col("fecha_proceso").between(19970301, 19970331))
    ingest(spark, month.withColumn("precio", F.col("precio") + 1), MONTHLY, layout)
    return read_table(spark, sink, schema=BRONZE_SCHEMA)


def forget_last_commit(spark, checkpoint: str) -> None:
    """Remove a stream's last commit mark, as if it had failed right before: the next start replays that micro-batch."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = [f.getPath() for f in fs.listStatus(fs_path) if f.getPath().getName().isdigit()]
    fs.delete(max(marks, key=lambda p: int(p.getName())), False)


def _streamed(spark, sf) -> Layout:
    """Stream the files to silver in two micro-batches, deliver half of the rows again in other files, replay that batch."""
    raw, layout = deliveries(spark, sf), Layout(scratch_path(spark, "lake"))
    overwrite(dimension(spark, sf), layout.dimension)
    landing, ckpt = _write_raw(raw, "parquet"), scratch_path(spark, "stream-ckpt")
    cfg = dataclasses.replace(_run_config(), tenants=FIXTURE_TENANTS, partition_by=MONTH_LAYOUT[:1], deliveries=dataclasses.replace(FIXTURE_DELIVERIES, fmt="parquet"))
    stream_silver(spark, landing, layout, ckpt, cfg, max_files_per_trigger=_raw_files_of(raw) // 2)
    raw.filter(F.col("ruta") % 2 == 0).repartition(_raw_files_of(raw, 2)).write.mode("append").parquet(landing)
    stream_silver(spark, landing, layout, ckpt, cfg)
    forget_last_commit(spark, ckpt)
    stream_silver(spark, landing, layout, ckpt, cfg)
    return layout


def stream_silver_state(spark, sf):
    """Silver after the stream: the state that the batch path reaches."""
    path = _streamed(spark, sf).fact
    return read_table(spark, path, schema=table_schema(spark, path)).drop("_silver_timestamp")


def stream_quarantine_state(spark, sf):
    path = _streamed(spark, sf).quarantine
    return read_table(spark, path, schema=table_schema(spark, path)).drop("_quarantine_timestamp")


def stream_quality_log_totals(spark, sf):
    """The stream's log over all micro-batches: no row is counted twice, neither as a copy nor by the replay."""
    path = stream_quality_log(_streamed(spark, sf))
    log = read_table(spark, path, schema=table_schema(spark, path))
    return log.groupBy("tenant_id", "layer", "table_name", "check_name", "check_severity").agg(
        F.sum("records_checked").alias("records_checked"), F.sum("records_failed").alias("records_failed"),
        F.sum("records_unknown").alias("records_unknown")).withColumn("check_passed", F.col("records_failed") == 0)


RUN_TENANTS = FIXTURE_TENANTS + ("ec",)


def _run_config(**kw) -> RunConfig:
    return RunConfig(tenants=RUN_TENANTS, partition_by=MONTH_LAYOUT, derived=(MONTH,),
                     deliveries=FIXTURE_DELIVERIES, materials=FIXTURE_MATERIALS, **kw)


def rerun_idempotence(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    cfg = _run_config()
    for _ in range(2):
        run(spark, deliveries(spark, sf), fixtures.materials_raw(spark, sf), layout, cfg)
    gold_schema = T.StructType([
        T.StructField("_tenant_id", T.StringType()), T.StructField("fecha_proceso", T.IntegerType()),
        T.StructField("tipo_entrega", T.StringType()), T.StructField("mes", T.IntegerType()),
        T.StructField("total_units", T.DoubleType()), T.StructField("total_revenue", T.DoubleType()),
        T.StructField("active_routes", T.LongType()), T.StructField("active_transports", T.LongType())])
    return read_table(spark, layout.gold, schema=gold_schema)


def run_status(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    return run(spark, deliveries(spark, sf), fixtures.materials_raw(spark, sf), layout, _run_config())


def run_status_breaker(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    return run(spark, deliveries(spark, sf), fixtures.materials_raw(spark, sf), layout,
               _run_config(fail_on_critical=True, overrides={"africa": {"precio_valido": "TRUE"},
                                                            "america": {"precio_valido": "TRUE",
                                                                        "fecha_valida": "TRUE"}}))


RERUN_RANGE = ("1996-01-10", "1996-03-20")


def _range_rerun(spark, sf) -> Layout:
    """A full run by months, then a rerun of a range inside them with changed prices."""
    layout = Layout(scratch_path(spark, "lake"))
    raw, catalog = deliveries(spark, sf), fixtures.materials_raw(spark, sf)
    run(spark, raw, catalog, layout, _run_config())
    run(spark, raw.withColumn("precio", F.col("precio") + 1), catalog, layout,
        _run_config(start=RERUN_RANGE[0], end=RERUN_RANGE[1]))
    return layout


def range_rerun_bronze_state(spark, sf):
    layout = _range_rerun(spark, sf)
    return read_table(spark, layout.bronze("deliveries"), schema=BRONZE_SCHEMA)


def range_rerun_quarantine_state(spark, sf):
    layout = _range_rerun(spark, sf)
    return read_table(spark, layout.quarantine, schema=table_schema(spark, layout.quarantine)).select(
        *FACT_KEYS, "precio", "cantidad", "mes", "_quarantine_reason")


def range_rerun_gold_state(spark, sf):
    layout = _range_rerun(spark, sf)
    return read_table(spark, layout.gold, schema=table_schema(spark, layout.gold))


def _retracting_rerun(spark, sf) -> Layout:
    """A full run, then a rerun of a range in which rows turn bad, others good, and a tenant's month is left without
    a good row; with ``retract`` every layer follows."""
    layout = Layout(scratch_path(spark, "lake"))
    raw, catalog = deliveries(spark, sf), fixtures.materials_raw(spark, sf)
    run(spark, raw, catalog, layout, _run_config(retract=True))
    emptied = (F.col("pais") == "ASIA") & (F.expr(MONTH[1]) == 199602)
    changed = raw.withColumn("cantidad", F.when(emptied, F.lit(-1.0)).when(F.col("pais") == "AFRICA", F.lit(5.0))
                             .when(F.col("material") % 7 == 0, F.lit(None).cast("double"))
                             .otherwise(F.coalesce("cantidad", F.lit(5.0))))
    run(spark, changed, catalog, layout, _run_config(retract=True, start=RERUN_RANGE[0], end=RERUN_RANGE[1]))
    return layout


def retracted_silver_state(spark, sf):
    layout = _retracting_rerun(spark, sf)
    return read_table(spark, layout.fact, schema=table_schema(spark, layout.fact)).select(
        *FACT_KEYS, "precio", "cantidad", "mes")


def retracted_quarantine_state(spark, sf):
    layout = _retracting_rerun(spark, sf)
    return read_table(spark, layout.quarantine, schema=table_schema(spark, layout.quarantine)).select(
        *FACT_KEYS, "precio", "cantidad", "mes", "_quarantine_reason")


def retracted_gold_state(spark, sf):
    layout = _retracting_rerun(spark, sf)
    return read_table(spark, layout.gold, schema=table_schema(spark, layout.gold))


def recovered_upsert_state(spark, sf):
    """An upsert of two months whose commit did not happen, replayed without a word about the table's layout."""
    path = scratch_path(spark, "recover")
    good = _good_monthly(spark, sf).select(*FACT_KEYS, "mes", "precio", "cantidad")
    upsert(spark, good, path, [*FACT_KEYS, "mes"], MONTH_LAYOUT)
    batch = good.filter(F.col("mes").isin(199701, 199806)).withColumn("precio", F.col("precio") + 1)
    merged = read_table(spark, path, schema=table_schema(spark, path)).filter(
        F.col("mes").isin(199701, 199806)).join(batch, [*FACT_KEYS, "mes"], "left_anti").unionByName(batch)
    stage_commit(merged, path, MONTH_LAYOUT)
    recover(spark, path)
    return read_table(spark, path, schema=table_schema(spark, path))


def sparse_upsert_state(spark, sf):
    """A batch of two months six years apart; the table's scan is pruned to them dynamically."""
    path = scratch_path(spark, "sparse")
    good = _good_monthly(spark, sf).select(*FACT_KEYS, "mes", "precio", "cantidad")
    upsert(spark, good, path, [*FACT_KEYS, "mes"], MONTH_LAYOUT)
    batch = good.filter(F.col("mes").isin(199202, 199809)).withColumn("cantidad", F.col("cantidad") * 2)
    upsert(spark, batch, path, [*FACT_KEYS, "mes"], MONTH_LAYOUT)
    return read_table(spark, path, schema=table_schema(spark, path))


def _plain_reason(status: DataFrame) -> DataFrame:
    """Without the parts of a reason that name a path or an example."""
    return status.withColumn("reason", F.regexp_replace("reason", "(, e\\.g\\. .*| at \\S+)$", ""))


def run_status_bad_tenant(spark, sf):
    """Asia has every row twice, with two prices: it fails alone."""
    raw = deliveries(spark, sf)
    twice = raw.unionByName(raw.filter("pais = 'ASIA'").withColumn("precio", F.col("precio") + 1))
    layout = Layout(scratch_path(spark, "lake"))
    return _plain_reason(run(spark, twice, fixtures.materials_raw(spark, sf), layout, _run_config()))


def missing_inputs_status(spark, sf):
    """No catalog at all: the dimension is skipped, facts fail on the missing dependency, gold is skipped."""
    layout = Layout(scratch_path(spark, "lake"))
    catalog = fixtures.materials_raw(spark, sf).drop("precio_base")
    return _plain_reason(run(spark, deliveries(spark, sf), catalog, layout, _run_config()))


def layer_stamps(spark, sf):
    """Per tenant, rows of each layer with their own timestamp."""
    layout = Layout(scratch_path(spark, "lake"))
    run(spark, deliveries(spark, sf), fixtures.materials_raw(spark, sf), layout, _run_config())
    out = None
    for layer, path, stamp in (("bronze", layout.bronze("deliveries"), "_ingestion_timestamp"),
                               ("silver", layout.fact, "_silver_timestamp"),
                               ("quarantine", layout.quarantine, "_quarantine_timestamp")):
        table = read_table(spark, path, schema=table_schema(spark, path))
        rows = table.groupBy("_tenant_id").agg(F.count(F.lit(1)).alias("rows"), F.count(stamp).alias("stamped"),
                                               F.count("_batch_id").alias("with_batch"))
        rows = rows.withColumn("layer", F.lit(layer))
        out = rows if out is None else out.unionByName(rows)
    return out


def quality_log_runs(spark, sf):
    """The shared log, laid out per tenant and day, after two runs with a batch id each."""
    layout = Layout(scratch_path(spark, "lake"))
    for batch in ("batch-1", "batch-2"):
        run(spark, deliveries(spark, sf), fixtures.materials_raw(spark, sf), layout,
            _run_config(log_partition_by=("tenant_id", LOG_DATE)), batch_id=batch)
    log = read_table(spark, layout.quality_log, schema=table_schema(spark, layout.quality_log))
    return log.groupBy("tenant_id", "_batch_id", "check_name").agg(
        F.count_distinct("_run_id").alias("runs"), F.count("executed_at").alias("with_time"),
        F.sum("records_checked").alias("records_checked"), F.sum("records_failed").alias("records_failed"))


QUERIES: dict[str, QueryFn] = {
    "tenant_isolation": tenant_isolation,
    "global_catalog_stamp": global_catalog_stamp,
    "date_range_filter": date_range_filter,
    "unit_normalization": unit_normalization,
    "process_date_parse": process_date_parse,
    "delivery_class_flags": delivery_class_flags,
    "dimension_conform": dimension_conform,
    "silver_column_order": silver_column_order,
    "point_in_time_join": point_in_time_join_q,
    "point_in_time_join_salted": point_in_time_join_salted,
    "point_in_time_join_latest": point_in_time_join_latest,
    "point_in_time_join_points": point_in_time_join_points,
    "point_in_time_join_fanout_points": point_in_time_join_fanout_points,
    "point_in_time_join_snapshot": point_in_time_join_snapshot,
    "rule_flags": rule_flags,
    "quality_log": quality_log_q,
    "good_rows": good_rows,
    "bad_rows": bad_rows,
    "bad_rows_null_safe": bad_rows_null_safe,
    "quarantine_reasons": quarantine_reasons,
    "quarantine_null_safe": quarantine_null_safe,
    "discard_counts": discard_counts,
    "discard_counts_null_safe": discard_counts_null_safe,
    "tenant_rule_override": tenant_rule_override,
    "full_row_dedup": full_row_dedup,
    "gold_daily_metrics": gold_daily_metrics,
    "replace_partitions_state": replace_partitions_state,
    "replace_prefix_state": replace_prefix_state,
    "upsert_fact_state": upsert_fact_state,
    "upsert_dim_state": upsert_dim_state,
    "append_evolved_state": append_evolved_state,
    "full_overwrite_state": full_overwrite_state,
    "quarantine_state": quarantine_state,
    "routine_extract": routine_extract_q,
    "bronze_csv_ingest": bronze_csv_ingest,
    "lineage_stamps": lineage_stamps,
    "stream_ingest_state": stream_ingest_state,
    "rerun_idempotence": rerun_idempotence,
    "run_status": run_status,
    "run_status_breaker": run_status_breaker,
    "run_status_bad_tenant": run_status_bad_tenant,
    "range_rerun_bronze_state": range_rerun_bronze_state,
    "range_rerun_quarantine_state": range_rerun_quarantine_state,
    "range_rerun_gold_state": range_rerun_gold_state,
    "csv_reordered_columns": csv_reordered_columns,
    "csv_extra_column_to_silver": csv_extra_column_to_silver,
    "contract_violation_status": contract_violation_status,
    "unparsable_values_status": unparsable_values_status,
    "missing_inputs_status": missing_inputs_status,
    "upsert_evolved_state": upsert_evolved_state,
    "gold_fractional_metrics": gold_fractional_metrics,
    "gold_approx_distinct_error": gold_approx_distinct_error,
    "tenant_rule_severity": tenant_rule_severity,
    "tenant_severity_reasons": tenant_severity_reasons,
    "quarantine_actions": quarantine_actions,
    "layer_stamps": layer_stamps,
    "quality_log_runs": quality_log_runs,
    "malformed_lines_status": malformed_lines_status,
    "malformed_lines_state": malformed_lines_state,
    "gold_extreme_metrics": gold_extreme_metrics,
    "scd2_history_state": scd2_history_state,
    "retracted_silver_state": retracted_silver_state,
    "retracted_quarantine_state": retracted_quarantine_state,
    "retracted_gold_state": retracted_gold_state,
    "recovered_upsert_state": recovered_upsert_state,
    "sparse_upsert_state": sparse_upsert_state,
    "gold_incremental_state": gold_incremental_state,
    "gold_rollup_partials": gold_rollup_partials,
    "stream_silver_state": stream_silver_state,
    "stream_quarantine_state": stream_quarantine_state,
    "stream_quality_log_totals": stream_quality_log_totals,
}
