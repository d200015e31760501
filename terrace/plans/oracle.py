"""Independent DuckDB SQL for each registered query (the correctness oracle).

The fixture views are repeated as CTEs over the driver's tables; every query
is plain SQL written from the operator's contract, not generated from the
Spark code.  Column names and types match the Spark results.
"""

from __future__ import annotations

DELIVERIES_V = """
deliveries_v AS (
  SELECT r.r_name AS pais,
         CAST(CASE WHEN l.l_orderkey % 211 = 0 THEN 20250230
                   ELSE year(l.l_shipdate) * 10000 + month(l.l_shipdate) * 100 + day(l.l_shipdate)
              END AS INTEGER) AS fecha_proceso,
         l.l_orderkey AS transporte,
         l.l_suppkey AS ruta,
         CASE WHEN l.l_orderkey % 101 = 0 THEN NULL
              WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'Z99'
              WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Z05'
              WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'ZPRE'
              WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'ZVE1'
              WHEN l.l_returnflag = 'A' THEN 'Z04'
         END AS tipo_entrega,
         l.l_partkey AS material,
         CASE WHEN l.l_partkey % 83 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS precio,
         CASE WHEN l.l_quantity = 2 THEN NULL
              WHEN l.l_quantity = 1 THEN -l.l_quantity
              ELSE l.l_quantity END AS cantidad,
         CASE WHEN l.l_linenumber % 2 = 0 THEN 'CS' ELSE 'ST' END AS unidad
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

BRONZE_V = """
bronze_v AS (SELECT *, lower(pais) AS _tenant_id FROM deliveries_v)"""

MATERIALS_V = """
materials_v AS (
  SELECT p_partkey AS material, p_retailprice AS precio_base,
         DATE '1900-01-01' AS valid_from, DATE '1998-06-30' AS valid_to, false AS is_current
  FROM part WHERE p_partkey % 50 <> 0
  UNION ALL
  SELECT p_partkey, p_retailprice * CAST(1.1 AS DOUBLE),
         DATE '1998-07-01', CASE WHEN p_partkey % 75 = 1 THEN NULL ELSE DATE '9999-12-31' END, true
  FROM part WHERE p_partkey % 50 <> 0
)"""

NORMALIZED_V = """
normalized_v AS (
  SELECT *,
         CASE WHEN unidad = 'CS' THEN cantidad * 20 ELSE cantidad END AS cantidad_normalizada_st,
         'ST' AS unidad_estandar,
         CAST(try_strptime(CAST(fecha_proceso AS VARCHAR), '%Y%m%d') AS DATE) AS fecha_proceso_dt,
         tipo_entrega IN ('ZPRE', 'ZVE1') AS is_routine_delivery,
         tipo_entrega IN ('Z04', 'Z05') AS is_bonus_delivery
  FROM (SELECT DISTINCT * FROM bronze_v)
)"""

JOINED_V = """
joined_v AS (
  SELECT n.*, m.precio_base AS precio_catalogo_unitario
  FROM normalized_v n
  LEFT JOIN materials_v m
    ON n.material = m.material AND n.fecha_proceso_dt BETWEEN m.valid_from AND m.valid_to
)"""

RULES_SQL = """
         (cantidad > 0 AND cantidad IS NOT NULL) AS _rule_cantidad_valida,
         (precio >= 0 AND precio IS NOT NULL) AS _rule_precio_valido,
         (fecha_proceso_dt IS NOT NULL) AS _rule_fecha_valida,
         (tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05')) AS _rule_tipo_entrega_valido,
         (precio_catalogo_unitario IS NOT NULL) AS _rule_material_existe"""

EVALUATED_V = f"""
evaluated_v AS (
  SELECT *,{RULES_SQL}
  FROM joined_v
)"""

COND = ("(_rule_cantidad_valida AND _rule_precio_valido AND _rule_fecha_valida "
        "AND _rule_tipo_entrega_valido AND _rule_material_existe)")

REASON = """concat_ws(', ',
    CASE WHEN NOT _rule_cantidad_valida OR _rule_cantidad_valida IS NULL THEN 'cantidad_valida' END,
    CASE WHEN NOT _rule_precio_valido OR _rule_precio_valido IS NULL THEN 'precio_valido' END,
    CASE WHEN NOT _rule_fecha_valida OR _rule_fecha_valida IS NULL THEN 'fecha_valida' END,
    CASE WHEN NOT _rule_material_existe OR _rule_material_existe IS NULL THEN 'material_existe' END)"""

REASON_NULL_SAFE = """concat_ws(', ',
    CASE WHEN NOT _rule_cantidad_valida OR _rule_cantidad_valida IS NULL THEN 'cantidad_valida' END,
    CASE WHEN NOT _rule_precio_valido OR _rule_precio_valido IS NULL THEN 'precio_valido' END,
    CASE WHEN NOT _rule_fecha_valida OR _rule_fecha_valida IS NULL THEN 'fecha_valida' END,
    CASE WHEN _rule_tipo_entrega_valido IS NULL THEN 'tipo_entrega_valido' END,
    CASE WHEN NOT _rule_material_existe OR _rule_material_existe IS NULL THEN 'material_existe' END)"""

SILVER_COLS = ("_tenant_id, fecha_proceso, transporte, ruta, material, tipo_entrega, pais, precio, cantidad, "
               "unidad, cantidad_normalizada_st, unidad_estandar, is_routine_delivery, is_bonus_delivery, "
               "precio_catalogo_unitario")

RULE_COLS = ("_rule_cantidad_valida, _rule_precio_valido, _rule_fecha_valida, "
             "_rule_tipo_entrega_valido, _rule_material_existe")

GOLD_AGGS = """
       CAST(SUM(CAST(cantidad_normalizada_st AS DECIMAL(18,6))) AS DOUBLE) AS total_units,
       CAST(SUM(CAST(cantidad_normalizada_st AS DECIMAL(36,6)) * CAST(precio AS DECIMAL(18,6))) AS DOUBLE)
         AS total_revenue,
       COUNT(DISTINCT ruta) AS active_routes,
       COUNT(DISTINCT transporte) AS active_transports"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SILVER = with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V, EVALUATED_V)
MONTH = "CAST(fecha_proceso // 100 AS INTEGER)"


def _quality_log() -> str:
    rules = [("cantidad_valida", "warning"), ("precio_valido", "critical"), ("fecha_valida", "critical"),
             ("tipo_entrega_valido", "info"), ("material_existe", "warning")]
    parts = []
    for name, sev in rules:
        parts.append(f"""
SELECT lower(_tenant_id) AS tenant_id, 'silver' AS layer, 'fact_deliveries' AS table_name,
       '{name}' AS check_name, '{sev}' AS check_severity,
       COUNT(*) AS records_checked,
       COUNT(*) FILTER (WHERE NOT _rule_{name}) AS records_failed,
       COUNT(*) FILTER (WHERE NOT _rule_{name}) = 0 AS check_passed,
       COUNT(*) FILTER (WHERE _rule_{name} IS NULL) AS records_unknown
FROM evaluated_v GROUP BY 1""")
    return SILVER + "\nUNION ALL\n".join(parts)


def _counts(null_safe: bool) -> str:
    if null_safe:
        good = f"COALESCE({COND}, false)"
        bad = f"NOT COALESCE({COND}, false)"
        quar = f"{bad} AND NOT COALESCE(NOT _rule_tipo_entrega_valido, false)"
        disc = f"{bad} AND COALESCE(NOT _rule_tipo_entrega_valido, false)"
    else:
        good, bad = COND, f"NOT {COND}"
        quar = f"NOT {COND} AND _rule_tipo_entrega_valido"
        disc = f"NOT {COND} AND NOT _rule_tipo_entrega_valido"
    return SILVER + f"""
SELECT tenant, rows_in, good, bad, quarantined, discarded,
       rows_in - good - quarantined - discarded AS lost
FROM (SELECT _tenant_id AS tenant, COUNT(*) AS rows_in,
             COUNT(*) FILTER (WHERE {good}) AS good,
             COUNT(*) FILTER (WHERE {bad}) AS bad,
             COUNT(*) FILTER (WHERE {quar}) AS quarantined,
             COUNT(*) FILTER (WHERE {disc}) AS discarded
      FROM evaluated_v GROUP BY 1)"""


QUARANTINE = SILVER + f"""
SELECT * EXCLUDE ({RULE_COLS}, fecha_proceso_dt), {REASON} AS _quarantine_reason
FROM evaluated_v WHERE NOT {COND} AND _rule_tipo_entrega_valido"""

OVERRIDE_EVALUATED = with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V) + """
SELECT _tenant_id, fecha_proceso, transporte, ruta, material, tipo_entrega, cantidad, precio,
       CASE WHEN _tenant_id = 'asia' THEN (cantidad >= 10 AND cantidad IS NOT NULL)
            ELSE (cantidad > 0 AND cantidad IS NOT NULL) END AS _rule_cantidad_valida,
       CASE WHEN _tenant_id = 'europe' THEN (precio > 1000 AND precio IS NOT NULL)
            ELSE (precio >= 0 AND precio IS NOT NULL) END AS _rule_precio_valido,
       (fecha_proceso_dt IS NOT NULL) AS _rule_fecha_valida,
       (tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05')) AS _rule_tipo_entrega_valido,
       (precio_catalogo_unitario IS NOT NULL) AS _rule_material_existe,
       (CASE WHEN _tenant_id = 'asia' THEN (cantidad >= 10 AND cantidad IS NOT NULL)
             ELSE (cantidad > 0 AND cantidad IS NOT NULL) END)
       AND (CASE WHEN _tenant_id = 'europe' THEN (precio > 1000 AND precio IS NOT NULL)
                 ELSE (precio >= 0 AND precio IS NOT NULL) END)
       AND (fecha_proceso_dt IS NOT NULL)
       AND (tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05'))
       AND (precio_catalogo_unitario IS NOT NULL) AS passed
FROM joined_v"""

ROUTINE = """SELECT pais, fecha_proceso AS fecha, material,
       CASE WHEN unidad = 'CS' THEN cantidad * 20 ELSE cantidad END AS cantidad_st,
       (CASE WHEN unidad = 'CS' THEN cantidad * 20 ELSE cantidad END) * precio AS total
FROM deliveries_v WHERE tipo_entrega IN ('ZPRE', 'ZVE1')"""

GOOD_MONTHLY = SILVER.rstrip("\n") + f""",
good_m AS (SELECT {SILVER_COLS}, {MONTH} AS mes FROM evaluated_v WHERE {COND})
"""

REFRESHED = GOOD_MONTHLY + """,
facts AS (
  SELECT * REPLACE (CASE WHEN fecha_proceso IN (19930615, 19980302) THEN cantidad_normalizada_st + 0.25
                         ELSE cantidad_normalizada_st END AS cantidad_normalizada_st)
  FROM good_m WHERE fecha_proceso NOT IN (19950310, 19970704))
"""

REFRESHED_AGGS = """
       CAST(ROUND(SUM(CAST(cantidad_normalizada_st AS DECIMAL(18,6))), 2) AS DOUBLE) AS total_units,
       CAST(ROUND(SUM(CAST(cantidad_normalizada_st AS DECIMAL(36,6)) * CAST(precio AS DECIMAL(18,6))), 2) AS DOUBLE) AS total_revenue,
       COUNT(*) AS deliveries"""

RUN_TENANTS = ("africa", "america", "asia", "europe", "middle east", "ec")


def _status_sql(blocked_expr: str | None = None, overrides: dict | None = None) -> str:
    """Status table of one run: per tenant and stage, rows and ok/skipped."""
    tenants = ", ".join(f"('{t}')" for t in RUN_TENANTS)
    ov = overrides or {}

    def rule(name: str, default: str) -> str:
        branches = [f"WHEN _tenant_id = '{t}' THEN ({e[name]})" for t, e in ov.items() if name in e]
        return f"(CASE {' '.join(branches)} ELSE ({default}) END)" if branches else f"({default})"

    r_c = rule("cantidad_valida", "cantidad > 0 AND cantidad IS NOT NULL")
    r_p = rule("precio_valido", "precio >= 0 AND precio IS NOT NULL")
    r_f = rule("fecha_valida", "fecha_proceso_dt IS NOT NULL")
    r_t = "(tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05'))"
    r_m = "(precio_catalogo_unitario IS NOT NULL)"
    cond = f"({r_c} AND {r_p} AND {r_f} AND {r_t} AND {r_m})"
    crit = f"(COALESCE(NOT {r_p}, false) OR COALESCE(NOT {r_f}, false))"
    blocked = f"(SELECT _tenant_id FROM joined_v GROUP BY 1 HAVING COUNT(*) FILTER (WHERE {crit}) > 0)" \
        if blocked_expr else "(SELECT NULL::VARCHAR WHERE false)"
    return with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V) + f""",
t(tenant) AS (VALUES {tenants}),
per_tenant AS (
  SELECT _tenant_id AS tenant, COUNT(*) AS bronze,
         COUNT(*) FILTER (WHERE {cond}) AS good,
         COUNT(*) FILTER (WHERE NOT {cond} AND {r_t}) AS quarantined,
         COUNT(*) FILTER (WHERE NOT {cond} AND NOT {r_t}) AS discarded
  FROM joined_v GROUP BY 1),
gold AS (
  SELECT _tenant_id AS tenant, COUNT(*) AS groups FROM (
    SELECT DISTINCT _tenant_id, fecha_proceso, tipo_entrega FROM joined_v WHERE {cond}
      AND _tenant_id NOT IN {blocked}) GROUP BY 1),
stages AS (
  SELECT t.tenant, s.stage, s.n FROM t
  LEFT JOIN per_tenant p ON p.tenant = t.tenant
  LEFT JOIN gold g ON g.tenant = t.tenant,
  LATERAL (VALUES ('bronze_deliveries', p.bronze), ('silver_fact_deliveries', p.good),
                  ('silver_quarantine', p.quarantined), ('silver_discarded', p.discarded),
                  ('silver_lost', p.bronze - p.good - p.quarantined - p.discarded),
                  ('gold_daily_metrics', g.groups)) s(stage, n)
  WHERE t.tenant NOT IN {blocked} OR s.stage <> 'gold_daily_metrics'
),
catalog AS (SELECT COUNT(*) AS n FROM materials_v)
SELECT tenant, stage,
       CASE WHEN COALESCE(n, 0) > 0 THEN 'ok' ELSE 'skipped' END AS status,
       CAST(COALESCE(n, 0) AS BIGINT) AS rows,
       CASE WHEN COALESCE(n, 0) > 0 THEN NULL ELSE 'no rows for tenant' END AS reason
FROM stages
UNION ALL
SELECT tenant, 'gold_daily_metrics', 'blocked', CAST(0 AS BIGINT), 'critical quality failures'
FROM t WHERE tenant IN {blocked}
UNION ALL SELECT 'global', 'bronze_materials', 'ok', n, NULL FROM catalog
UNION ALL SELECT 'global', 'silver_dim_materials', 'ok', n, NULL FROM catalog"""


IN_RERUN = "fecha_proceso BETWEEN 19960110 AND 19960320"
RERUN_PRICE = f"CASE WHEN {IN_RERUN} THEN precio + 1 ELSE precio END"
KEYS = "_tenant_id, fecha_proceso, transporte, ruta, material, tipo_entrega"
LATER = ("silver_fact_deliveries", "silver_quarantine", "silver_discarded", "silver_lost", "gold_daily_metrics")


def _values(*rows: str) -> str:
    return ", ".join(f"('{r}')" for r in rows)


def _status_bad_tenant() -> str:
    """The status of a run in which Asia's rows come twice: its bronze doubles, it fails in silver."""
    return f"""
WITH plain AS ({_status_sql()}),
good AS ({SILVER} SELECT COUNT(*) AS n FROM evaluated_v WHERE {COND} AND _tenant_id = 'asia')
SELECT tenant, stage,
       CASE WHEN tenant <> 'asia' OR stage = 'bronze_deliveries' THEN status
            WHEN stage = 'silver_fact_deliveries' THEN 'failed' ELSE 'skipped' END AS status,
       CASE WHEN tenant <> 'asia' THEN rows WHEN stage = 'bronze_deliveries' THEN 2 * rows ELSE 0 END AS rows,
       CASE WHEN tenant <> 'asia' OR stage = 'bronze_deliveries' THEN reason
            WHEN stage = 'silver_fact_deliveries'
            THEN 'DuplicateKeyError: ' || (SELECT n FROM good) || ' upsert keys occur more than once'
            ELSE 'silver_fact_deliveries failed' END AS reason
FROM plain"""


def _status_missing_catalog() -> str:
    return with_(DELIVERIES_V, BRONZE_V) + f""",
t(tenant) AS (VALUES {_values(*RUN_TENANTS)}),
n AS (SELECT _tenant_id AS tenant, COUNT(*) AS n FROM bronze_v GROUP BY 1)
SELECT t.tenant, 'bronze_deliveries' AS stage, CASE WHEN n.n > 0 THEN 'ok' ELSE 'skipped' END AS status,
       CAST(COALESCE(n.n, 0) AS BIGINT) AS rows,
       CASE WHEN n.n > 0 THEN NULL ELSE 'no rows for tenant' END AS reason
FROM t LEFT JOIN n USING (tenant)
UNION ALL
SELECT tenant, stage, CASE WHEN stage = 'silver_fact_deliveries' THEN 'failed' ELSE 'skipped' END, 0,
       CASE WHEN stage = 'silver_fact_deliveries'
            THEN 'MissingTableError: dependency not met: dim_materials does not exist'
            ELSE 'silver_fact_deliveries failed' END
FROM t, (VALUES {_values(*LATER)}) s(stage)
UNION ALL SELECT 'global', 'bronze_materials', 'skipped', 0, 'missing required columns [''precio_base'']'
UNION ALL SELECT 'global', 'silver_dim_materials', 'skipped', 0, 'no bronze catalog'"""


def _status_contract() -> str:
    return with_(MATERIALS_V) + f""",
t(tenant) AS (VALUES {_values(*RUN_TENANTS)}),
m("mode") AS (VALUES ('raise'), ('skip')),
n AS (SELECT COUNT(*) AS n FROM materials_v)
SELECT tenant, 'bronze_deliveries' AS stage, CASE WHEN "mode" = 'raise' THEN 'failed' ELSE 'skipped' END AS status,
       CAST(0 AS BIGINT) AS rows,
       CASE WHEN "mode" = 'raise' THEN 'ContractViolation: deliveries: ' ELSE '' END
         || 'missing required columns [''pais'']' AS reason, "mode"
FROM t, m
UNION ALL
SELECT tenant, stage, 'skipped', 0,
       CASE WHEN "mode" = 'raise' THEN 'bronze_deliveries failed' ELSE 'bronze_deliveries skipped' END, "mode"
FROM t, m, (VALUES {_values(*LATER)}) s(stage)
UNION ALL
SELECT 'global', stage, 'ok', n, NULL, "mode" FROM m, n, (VALUES ('bronze_materials'), ('silver_dim_materials')) s(stage)"""


SEVERITY_EVALUATED = with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V) + """,
evaluated_v AS (
  SELECT *,
         CASE WHEN _tenant_id = 'asia' THEN (cantidad >= 10 AND cantidad IS NOT NULL)
              ELSE (cantidad > 0 AND cantidad IS NOT NULL) END AS r_cantidad_valida,
         (precio >= 0 AND precio IS NOT NULL) AS r_precio_valido,
         (fecha_proceso_dt IS NOT NULL) AS r_fecha_valida,
         (tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05')) AS r_tipo_entrega_valido,
         (precio_catalogo_unitario IS NOT NULL) AS r_material_existe,
         CASE WHEN _tenant_id = 'europe' THEN (ruta IS NOT NULL AND ruta % 7 <> 0) ELSE TRUE END AS r_ruta_conocida
  FROM joined_v
)"""


def _severity_log() -> str:
    rules = [("cantidad_valida", "CASE WHEN _tenant_id = 'asia' THEN 'info' ELSE 'warning' END", ""),
             ("precio_valido", "CASE WHEN _tenant_id = 'europe' THEN 'warning' ELSE 'critical' END", ""),
             ("fecha_valida", "'critical'", ""), ("tipo_entrega_valido", "'info'", ""),
             ("material_existe", "'warning'", ""),
             ("ruta_conocida", "'critical'", "WHERE _tenant_id = 'europe'")]
    return SEVERITY_EVALUATED + "\nUNION ALL\n".join(f"""
SELECT _tenant_id AS tenant_id, 'silver' AS layer, 'fact_deliveries' AS table_name,
       '{name}' AS check_name, {sev} AS check_severity, COUNT(*) AS records_checked,
       COUNT(*) FILTER (WHERE NOT r_{name}) AS records_failed,
       COUNT(*) FILTER (WHERE NOT r_{name}) = 0 AS check_passed,
       COUNT(*) FILTER (WHERE r_{name} IS NULL) AS records_unknown
FROM evaluated_v {where} GROUP BY 1""" for name, sev, where in rules)


SEVERITY_REASONS = SEVERITY_EVALUATED + f"""
SELECT {KEYS}, concat_ws(', ',
    CASE WHEN r_cantidad_valida IS NOT TRUE AND _tenant_id <> 'asia' THEN 'cantidad_valida' END,
    CASE WHEN r_precio_valido IS NOT TRUE THEN 'precio_valido' END,
    CASE WHEN r_fecha_valida IS NOT TRUE THEN 'fecha_valida' END,
    CASE WHEN r_material_existe IS NOT TRUE THEN 'material_existe' END,
    CASE WHEN r_ruta_conocida IS NOT TRUE THEN 'ruta_conocida' END) AS _quarantine_reason
FROM evaluated_v
WHERE NOT (r_cantidad_valida AND r_precio_valido AND r_fecha_valida AND r_tipo_entrega_valido
           AND r_material_existe AND r_ruta_conocida) AND r_tipo_entrega_valido"""


#: Deliveries as a rerun of a range leaves them: rows turn bad, others good, a tenant's month has no good row.
RETRACTED_V = f"""
bronze_v AS (
  SELECT * REPLACE (CASE WHEN fecha_proceso NOT BETWEEN 19960110 AND 19960320 THEN cantidad
                         WHEN pais = 'ASIA' AND {MONTH} = 199602 THEN -1
                         WHEN pais = 'AFRICA' THEN 5
                         WHEN material % 7 = 0 THEN NULL
                         ELSE coalesce(cantidad, 5) END AS cantidad), lower(pais) AS _tenant_id
  FROM deliveries_v)"""
RETRACTED = with_(DELIVERIES_V, RETRACTED_V, MATERIALS_V, NORMALIZED_V, JOINED_V, EVALUATED_V)

ORACLE: dict[str, str] = {
    "tenant_isolation": with_(DELIVERIES_V) + """
SELECT *, lower(pais) AS _tenant_id FROM deliveries_v
WHERE lower(pais) IN ('america', 'europe', 'middle east')""",

    "global_catalog_stamp": with_(MATERIALS_V) + "SELECT *, 'global' AS _tenant_id FROM materials_v",

    "date_range_filter": with_(DELIVERIES_V, BRONZE_V) + """
SELECT * FROM bronze_v WHERE fecha_proceso BETWEEN 19960101 AND 19971231""",

    "unit_normalization": with_(DELIVERIES_V, BRONZE_V) + """
SELECT *, CASE WHEN unidad = 'CS' THEN cantidad * 20 ELSE cantidad END AS cantidad_normalizada_st,
       'ST' AS unidad_estandar
FROM bronze_v""",

    "process_date_parse": with_(DELIVERIES_V, BRONZE_V) + """
SELECT *, CAST(try_strptime(CAST(fecha_proceso AS VARCHAR), '%Y%m%d') AS DATE) AS fecha_proceso_dt
FROM bronze_v""",

    "delivery_class_flags": with_(DELIVERIES_V, BRONZE_V) + """
SELECT *, tipo_entrega IN ('ZPRE', 'ZVE1') AS is_routine_delivery,
       tipo_entrega IN ('Z04', 'Z05') AS is_bonus_delivery
FROM bronze_v""",

    "dimension_conform": with_(MATERIALS_V) + "SELECT * FROM materials_v",

    "silver_column_order": SILVER + f"SELECT {SILVER_COLS} FROM evaluated_v WHERE {COND}",

    "point_in_time_join": with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V)
    + "SELECT * FROM joined_v",

    "point_in_time_join_salted": with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V)
    + "SELECT * FROM joined_v",

    "point_in_time_join_latest": with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V) + """,
newer AS (SELECT * FROM materials_v WHERE valid_from = DATE '1998-07-01'),
dim AS (
  SELECT material, valid_from, valid_to, precio_base FROM materials_v
  UNION ALL
  SELECT material, DATE '1996-03-01', DATE '1996-03-31', precio_base * CAST(0.5 AS DOUBLE) FROM newer
  UNION ALL
  SELECT material, DATE '1998-07-01', DATE '1998-08-15', precio_base * CAST(0.75 AS DOUBLE) FROM newer
  WHERE material % 3 = 0
  UNION ALL
  SELECT material, DATE '1997-01-01', NULL, precio_base * CAST(0.25 AS DOUBLE) FROM newer WHERE material % 2 = 0),
facts AS (SELECT *, row_number() OVER () AS rid FROM normalized_v),
ranked AS (
  SELECT f.rid, d.precio_base,
         row_number() OVER (PARTITION BY f.rid ORDER BY d.valid_from DESC, d.valid_to DESC, d.precio_base DESC) AS k
  FROM facts f JOIN dim d ON f.material = d.material AND f.fecha_proceso_dt BETWEEN d.valid_from AND d.valid_to)
SELECT f.* EXCLUDE (rid), r.precio_base AS precio_catalogo_unitario
FROM facts f LEFT JOIN ranked r ON r.rid = f.rid AND r.k = 1""",

    "point_in_time_join_snapshot": with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V, JOINED_V)
    + "SELECT * FROM joined_v",

    "point_in_time_join_fanout_points": with_(DELIVERIES_V, BRONZE_V, MATERIALS_V, NORMALIZED_V) + """,
newer AS (SELECT * FROM materials_v WHERE valid_from = DATE '1998-07-01'),
dim AS (
  SELECT material, valid_from, valid_to, precio_base FROM materials_v
  UNION ALL
  SELECT material, DATE '1996-03-01', DATE '1996-03-31', precio_base * CAST(0.5 AS DOUBLE) FROM newer
  UNION ALL
  SELECT material, DATE '1998-07-01', DATE '1998-08-15', precio_base * CAST(0.75 AS DOUBLE) FROM newer
  WHERE material % 3 = 0
  UNION ALL
  SELECT material, DATE '1997-01-01', NULL, precio_base * CAST(0.25 AS DOUBLE) FROM newer WHERE material % 2 = 0)
SELECT f.*, d.precio_base AS precio_catalogo_unitario
FROM normalized_v f LEFT JOIN dim d ON f.material = d.material AND f.fecha_proceso_dt BETWEEN d.valid_from AND d.valid_to""",

    "rule_flags": SILVER + "SELECT * FROM evaluated_v",

    "quality_log": _quality_log(),

    "good_rows": SILVER + f"SELECT * FROM evaluated_v WHERE {COND}",

    "bad_rows": SILVER + f"SELECT * FROM evaluated_v WHERE NOT {COND}",

    "bad_rows_null_safe": SILVER + f"SELECT * FROM evaluated_v WHERE {COND} IS NOT TRUE",

    "quarantine_reasons": QUARANTINE,

    "quarantine_null_safe": SILVER + f"""
SELECT * EXCLUDE ({RULE_COLS}, fecha_proceso_dt), {REASON_NULL_SAFE} AS _quarantine_reason
FROM evaluated_v WHERE {COND} IS NOT TRUE AND _rule_tipo_entrega_valido IS NOT FALSE""",

    "discard_counts": _counts(False),

    "discard_counts_null_safe": _counts(True),

    "tenant_rule_override": OVERRIDE_EVALUATED,

    "full_row_dedup": with_(DELIVERIES_V, BRONZE_V) + "SELECT DISTINCT * FROM bronze_v",

    "gold_daily_metrics": SILVER + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega,{GOLD_AGGS}
FROM evaluated_v WHERE {COND} GROUP BY 1, 2, 3""",

    "replace_partitions_state": with_(DELIVERIES_V, BRONZE_V) + f""",
b AS (SELECT *, {MONTH} AS mes FROM bronze_v),
base AS (SELECT * FROM b),
batch AS (SELECT * REPLACE (precio + 1 AS precio) FROM b WHERE fecha_proceso BETWEEN 19970601 AND 19980630)
SELECT * FROM base
WHERE NOT EXISTS (SELECT 1 FROM batch WHERE batch._tenant_id = base._tenant_id AND batch.mes = base.mes)
UNION ALL SELECT * FROM batch""",

    "replace_prefix_state": with_(DELIVERIES_V) + f""",
ext AS (SELECT *, CAST(fecha // 100 AS INTEGER) AS mes FROM ({ROUTINE})),
batch AS (SELECT * REPLACE (total * 2 AS total) FROM ext WHERE pais = 'EUROPE' AND fecha >= 19980101)
SELECT * FROM ext WHERE pais <> 'EUROPE'
UNION ALL SELECT * FROM batch""",

    "upsert_fact_state": GOOD_MONTHLY + """,
target AS (SELECT * FROM good_m),
source AS (
  SELECT * REPLACE (precio + 1 AS precio) FROM good_m WHERE mes IN (199806, 199807)
  UNION ALL SELECT * REPLACE (-transporte - 1 AS transporte) FROM good_m WHERE mes IN (199806, 199807))
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s._tenant_id = t._tenant_id AND s.fecha_proceso = t.fecha_proceso
    AND s.transporte = t.transporte AND s.ruta = t.ruta AND s.material = t.material
    AND s.tipo_entrega = t.tipo_entrega AND s.mes = t.mes)
UNION ALL SELECT * FROM source""",

    "upsert_dim_state": with_(MATERIALS_V) + """,
newer AS (SELECT * FROM materials_v WHERE valid_from = DATE '1998-07-01'),
source AS (
  SELECT * REPLACE (precio_base * CAST(1.2 AS DOUBLE) AS precio_base) FROM newer
  UNION ALL
  SELECT material, precio_base * CAST(1.3 AS DOUBLE), DATE '2001-01-01', DATE '9999-12-31', true FROM newer)
SELECT * FROM materials_v m WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.material = m.material AND s.valid_from = m.valid_from)
UNION ALL SELECT * FROM source""",

    "append_evolved_state": with_(DELIVERIES_V, BRONZE_V) + """
SELECT * FROM bronze_v WHERE fecha_proceso < 19970101
UNION ALL BY NAME
SELECT *, CASE WHEN unidad = 'CS' THEN cantidad * 20 ELSE cantidad END AS cantidad_normalizada_st,
       'ST' AS unidad_estandar
FROM bronze_v WHERE fecha_proceso >= 19970101""",

    "full_overwrite_state": with_(DELIVERIES_V, BRONZE_V) + """
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS unidad) FROM bronze_v""",

    "quarantine_state": QUARANTINE.replace(
        "AS _quarantine_reason\n", f"AS _quarantine_reason, {MONTH} AS mes\n"),

    "routine_extract": with_(DELIVERIES_V) + f"""
SELECT * FROM ({ROUTINE}) WHERE pais IN ('EUROPE', 'ASIA', 'america')""",

    "bronze_csv_ingest": with_(DELIVERIES_V, BRONZE_V) + f"""
SELECT *, {MONTH} AS mes FROM bronze_v
WHERE _tenant_id IN ('asia', 'europe') AND fecha_proceso BETWEEN 19950601 AND 19981231""",

    "lineage_stamps": with_(DELIVERIES_V, BRONZE_V) + """
SELECT _tenant_id, COUNT(*) AS rows, CAST(1 AS BIGINT) AS batches,
       COUNT(*) AS rows_with_file, COUNT(*) AS rows_with_time
FROM bronze_v GROUP BY 1""",

    "stream_ingest_state": with_(DELIVERIES_V, BRONZE_V) + f"""
SELECT * REPLACE (CASE WHEN fecha_proceso BETWEEN 19970301 AND 19970331 THEN precio + 1 ELSE precio END AS precio),
       {MONTH} AS mes FROM bronze_v""",

    "rerun_idempotence": SILVER + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega, {MONTH} AS mes,{GOLD_AGGS}
FROM evaluated_v WHERE {COND} GROUP BY 1, 2, 3, 4""",

    "run_status": _status_sql(),

    "run_status_breaker": _status_sql(
        blocked_expr="critical",
        overrides={"africa": {"precio_valido": "TRUE"},
                   "america": {"precio_valido": "TRUE", "fecha_valida": "TRUE"}}),

    "run_status_bad_tenant": _status_bad_tenant(),

    "missing_inputs_status": _status_missing_catalog(),

    "contract_violation_status": _status_contract(),

    "range_rerun_bronze_state": with_(DELIVERIES_V, BRONZE_V) + f"""
SELECT * REPLACE ({RERUN_PRICE} AS precio), {MONTH} AS mes FROM bronze_v""",

    "range_rerun_quarantine_state": SILVER + f"""
SELECT {KEYS}, {RERUN_PRICE} AS precio, cantidad, {MONTH} AS mes, {REASON} AS _quarantine_reason
FROM evaluated_v WHERE NOT {COND} AND _rule_tipo_entrega_valido""",

    "range_rerun_gold_state": SILVER + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega, {MONTH} AS mes,{GOLD_AGGS}
FROM (SELECT * REPLACE ({RERUN_PRICE} AS precio) FROM evaluated_v WHERE {COND}) GROUP BY 1, 2, 3, 4""",

    "csv_reordered_columns": with_(DELIVERIES_V, BRONZE_V) + f"SELECT *, {MONTH} AS mes FROM bronze_v",

    "csv_extra_column_to_silver": SILVER + f"""
SELECT _tenant_id, fecha_proceso, CAST(transporte AS VARCHAR) AS transporte, CAST(ruta AS VARCHAR) AS ruta,
       'SKU' || material AS material, tipo_entrega, cantidad_normalizada_st, precio, precio_catalogo_unitario,
       'c' || unidad AS canal
FROM evaluated_v WHERE {COND}""",

    "unparsable_values_status": with_(DELIVERIES_V, BRONZE_V) + """,
bad AS (SELECT COUNT(*) FILTER (WHERE transporte % 5 = 0) AS c, COUNT(*) FILTER (WHERE transporte % 7 = 0) AS p
        FROM bronze_v)
SELECT _tenant_id, COUNT(*) AS rows, COUNT(*) FILTER (WHERE transporte % 7 <> 0) AS with_price,
       COUNT(cantidad) FILTER (WHERE transporte % 5 <> 0) AS with_quantity,
       (SELECT 'unparsable values: cantidad ' || c || ', precio ' || p FROM bad) AS reason
FROM bronze_v GROUP BY 1""",

    "upsert_evolved_state": GOOD_MONTHLY + f""",
merged AS (
  SELECT {KEYS}, mes, cantidad,
         CASE WHEN mes IN (199701, 199806) AND ruta % 2 = 0 THEN precio + 1 ELSE precio END AS precio, unidad,
         CASE WHEN mes >= 199706 THEN 'n' || ruta END AS nota
  FROM good_m)
SELECT *, 'month' AS layout FROM merged UNION ALL SELECT *, 'none' FROM merged""",

    "gold_fractional_metrics": SILVER + """
SELECT _tenant_id, fecha_proceso, tipo_entrega,
       CAST(SUM(CAST(cantidad_normalizada_st * CAST(0.125 AS DOUBLE) AS DECIMAL(18,6))) AS DOUBLE) AS total_units,
       CAST(SUM(CAST(cantidad_normalizada_st * CAST(0.125 AS DOUBLE) AS DECIMAL(36,6))
                * CAST(precio / CAST(1000 AS DOUBLE) AS DECIMAL(18,6))) AS DOUBLE) AS total_revenue,
       COUNT(DISTINCT ruta) AS active_routes, COUNT(DISTINCT transporte) AS active_transports
FROM evaluated_v WHERE """ + COND + " GROUP BY 1, 2, 3",

    "gold_approx_distinct_error": SILVER + f"""
SELECT _tenant_id, COUNT(DISTINCT ruta) AS active_routes, COUNT(DISTINCT transporte) AS active_transports,
       true AS routes_within, true AS transports_within
FROM evaluated_v WHERE {COND} GROUP BY 1""",

    "tenant_rule_severity": _severity_log(),

    "tenant_severity_reasons": SEVERITY_REASONS,

    "quarantine_actions": SILVER + f"""
SELECT * EXCLUDE ({RULE_COLS}, fecha_proceso_dt),
       CASE WHEN NOT _rule_tipo_entrega_valido THEN 'discard' ELSE 'quarantine' END AS _action,
       {REASON_NULL_SAFE} AS _quarantine_reason
FROM evaluated_v WHERE {COND} IS NOT TRUE""",

    "layer_stamps": SILVER + f"""
SELECT _tenant_id, COUNT(*) AS rows, COUNT(*) AS stamped, COUNT(*) AS with_batch, 'bronze' AS layer
FROM bronze_v GROUP BY 1
UNION ALL SELECT _tenant_id, COUNT(*), COUNT(*), COUNT(*), 'silver' FROM evaluated_v WHERE {COND} GROUP BY 1
UNION ALL SELECT _tenant_id, COUNT(*), COUNT(*), COUNT(*), 'quarantine' FROM evaluated_v
WHERE NOT {COND} AND _rule_tipo_entrega_valido GROUP BY 1""",

    "quality_log_runs": f"""
WITH log AS ({_quality_log()})
SELECT tenant_id, b._batch_id, check_name, CAST(1 AS BIGINT) AS runs, CAST(1 AS BIGINT) AS with_time,
       records_checked, records_failed
FROM log, (VALUES ('batch-1'), ('batch-2')) b(_batch_id)""",

    "malformed_lines_status": with_(DELIVERIES_V, BRONZE_V) + """,
bad AS (SELECT COUNT(*) AS n FROM bronze_v WHERE transporte % 97 = 0 OR transporte % 89 = 0),
why AS (SELECT 'malformed lines: ' || n || ' in 6 files' AS reason FROM bad)
SELECT _tenant_id, COUNT(*) AS rows, COUNT(unidad) FILTER (WHERE transporte % 97 <> 0) AS with_unit, 'keep' AS mode,
       (SELECT reason FROM why) AS reason
FROM bronze_v GROUP BY 1
UNION ALL
SELECT _tenant_id, COUNT(*), COUNT(unidad), 'quarantine', (SELECT reason FROM why)
FROM bronze_v WHERE transporte % 97 <> 0 AND transporte % 89 <> 0 GROUP BY 1""",

    "malformed_lines_state": with_(DELIVERIES_V) + """
SELECT CAST(CASE WHEN transporte % 97 = 0 THEN 8 ELSE 10 END AS INTEGER) AS n_values, pais, fecha_proceso, transporte, ruta
FROM deliveries_v WHERE transporte % 97 = 0 OR transporte % 89 = 0""",

    "gold_extreme_metrics": with_(DELIVERIES_V, """
bronze_v AS (
  SELECT * REPLACE (CASE WHEN fecha_proceso % 10 = 3 THEN CAST(1e12 AS DOUBLE)
                         WHEN fecha_proceso % 10 = 4 AND material % 2 = 0 THEN CAST('NaN' AS DOUBLE)
                         ELSE cantidad END AS cantidad,
                    CASE WHEN fecha_proceso % 10 = 3 THEN floor(precio) ELSE precio END AS precio),
         lower(pais) AS _tenant_id FROM deliveries_v)""", MATERIALS_V, NORMALIZED_V, JOINED_V, EVALUATED_V) + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega,
       CASE WHEN bool_or(abs(cantidad_normalizada_st) >= 1e12 OR isnan(cantidad_normalizada_st)) THEN SUM(cantidad_normalizada_st)
            ELSE CAST(SUM(TRY_CAST(cantidad_normalizada_st AS DECIMAL(18,6))) AS DOUBLE) END AS total_units,
       CASE WHEN bool_or(abs(cantidad_normalizada_st) >= 1e12 OR isnan(cantidad_normalizada_st))
            THEN SUM(cantidad_normalizada_st * precio)
            ELSE CAST(SUM(CAST(TRY_CAST(cantidad_normalizada_st AS DECIMAL(18,6)) AS DECIMAL(36,6))
                          * CAST(precio AS DECIMAL(18,6))) AS DOUBLE) END AS total_revenue,
       COUNT(DISTINCT ruta) AS active_routes, COUNT(DISTINCT transporte) AS active_transports
FROM evaluated_v WHERE {COND} GROUP BY 1, 2, 3""",

    "scd2_history_state": """
WITH days AS (SELECT * FROM (VALUES (1, DATE '1995-01-01', DATE '1995-12-31'), (2, DATE '1996-01-01', DATE '1996-12-31'),
                                    (3, DATE '1997-01-01', DATE '9999-12-31')) t(i, d, until)),
seen AS (SELECT p_partkey AS material, i, d, until, p_brand AS marca,
                CASE WHEN i = 3 AND p_partkey % 3 = 0 THEN p_retailprice * CAST(1.1 AS DOUBLE)
                     WHEN i = 2 AND p_partkey % 5 = 0 THEN p_retailprice * CAST(0.9 AS DOUBLE)
                     ELSE p_retailprice END AS precio_base
         FROM part, days
         WHERE CASE i WHEN 1 THEN p_partkey % 13 <> 0 WHEN 3 THEN p_partkey % 11 <> 0 ELSE TRUE END),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY material, precio_base, marca ORDER BY i) AS run FROM seen)
SELECT material, precio_base, marca, min(d) AS valid_from, max(until) AS valid_to, max(until) = DATE '9999-12-31' AS is_current
FROM runs GROUP BY material, precio_base, marca, run""",

    "retracted_silver_state": RETRACTED + f"""
SELECT {KEYS}, precio, cantidad, {MONTH} AS mes FROM evaluated_v WHERE {COND}""",

    "retracted_quarantine_state": RETRACTED + f"""
SELECT {KEYS}, precio, cantidad, {MONTH} AS mes, {REASON} AS _quarantine_reason
FROM evaluated_v WHERE NOT {COND} AND _rule_tipo_entrega_valido""",

    "retracted_gold_state": RETRACTED + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega, {MONTH} AS mes,{GOLD_AGGS}
FROM evaluated_v WHERE {COND} GROUP BY 1, 2, 3, 4""",

    "recovered_upsert_state": GOOD_MONTHLY + f"""
SELECT {KEYS}, mes, CASE WHEN mes IN (199701, 199806) THEN precio + 1 ELSE precio END AS precio, cantidad FROM good_m""",

    "sparse_upsert_state": GOOD_MONTHLY + f"""
SELECT {KEYS}, mes, precio, CASE WHEN mes IN (199202, 199809) THEN cantidad * 2 ELSE cantidad END AS cantidad FROM good_m""",

    "gold_incremental_state": REFRESHED + f"""
SELECT _tenant_id, fecha_proceso, tipo_entrega, mes,{REFRESHED_AGGS}
FROM facts GROUP BY 1, 2, 3, 4""",

    "gold_rollup_partials": REFRESHED + f"""
SELECT _tenant_id, mes,{REFRESHED_AGGS},
       COUNT(DISTINCT ruta) AS active_routes, COUNT(DISTINCT transporte) AS active_transports,
       true AS routes_within, true AS transports_within
FROM facts GROUP BY 1, 2""",
}
ORACLE["stream_silver_state"] = GOOD_MONTHLY + "SELECT * FROM good_m"
ORACLE["stream_quarantine_state"] = ORACLE["quarantine_state"]
ORACLE["stream_quality_log_totals"] = ORACLE["quality_log"]
ORACLE["point_in_time_join_points"] = ORACLE["point_in_time_join_latest"]
