"""Declarative specs and the fixed values of the deliveries pipeline.

Everything a pipeline run needs is a parameter; the deliveries pipeline is one
configuration of the generic operators.  The block marked *fixed values* holds
the constants whose values must stay as they are for the results to match the
original pipeline's configuration.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """A declarative quality rule: a SQL boolean expression with a severity.

    ``expr`` is evaluated with ``F.expr`` against the row.  TRUE passes, FALSE
    fails, NULL is *unknown* (neither a failure in the log nor a pass).
    """

    name: str
    expr: str
    severity: str = "info"
    tenant_severity: tuple[tuple[str, str], ...] = ()   # (tenant, severity) where it differs
    only: tuple[str, ...] = ()                          # tenants that have the rule; empty: all

    def severities(self) -> set[str]:
        return {(s or DEFAULT_SEVERITY).lower() for s in (self.severity, *(s for _, s in self.tenant_severity))}

    @property
    def column(self) -> str:
        return f"_rule_{self.name}"


# --------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's configuration)
# --------------------------------------------------------------------------
ACTIVE_TENANTS = ("ec", "hn", "jm", "sv", "pe", "gt")
GLOBAL_TENANT = "global"
ROUTINE_TYPES = ("ZPRE", "ZVE1")
BONUS_TYPES = ("Z04", "Z05")
UNIT_FACTORS = {"CS": 20}
STANDARD_UNIT = "ST"
PROCESS_DATE_FORMAT = "yyyyMMdd"
DIMENSION_DATE_FORMAT = "yyyy-MM-dd"
DEFAULT_SEVERITY = "info"
REASON_SEPARATOR = ", "
NO_REASON = "unknown"
FACT_KEYS = ("_tenant_id", "fecha_proceso", "transporte", "ruta", "material", "tipo_entrega")
DIMENSION_KEYS = ("material", "valid_from")
DELIVERIES_REQUIRED = ("pais", "fecha_proceso")
MATERIALS_REQUIRED = ("material", "precio_base")
MONTH_KEY = ("mes", "CAST(fecha_proceso DIV 100 AS INT)")   # optional coarser partition key
DEFAULT_RULES = (
    Rule("cantidad_valida", "cantidad > 0 AND cantidad IS NOT NULL", "warning"),
    Rule("precio_valido", "precio >= 0 AND precio IS NOT NULL", "critical"),
    Rule("fecha_valida", "fecha_proceso_dt IS NOT NULL", "critical"),
    Rule("tipo_entrega_valido", "tipo_entrega IN ('ZPRE', 'ZVE1', 'Z04', 'Z05')", "info"),
    Rule("material_existe", "precio_catalogo_unitario IS NOT NULL", "warning"),
)
DISCARD_RULES = ("tipo_entrega_valido",)
LOG_LAYER = "silver"
LOG_TABLE = "fact_deliveries"
# --------------------------------------------------------------------------


# Identifiers are text: "SKU1", "007" and "R-12" are all valid.
DELIVERIES_SCHEMA = T.StructType([
    T.StructField("pais", T.StringType()),
    T.StructField("fecha_proceso", T.IntegerType()),
    T.StructField("transporte", T.StringType()),
    T.StructField("ruta", T.StringType()),
    T.StructField("tipo_entrega", T.StringType()),
    T.StructField("material", T.StringType()),
    T.StructField("precio", T.DoubleType()),
    T.StructField("cantidad", T.DoubleType()),
    T.StructField("unidad", T.StringType()),
])

# The catalog arrives untyped; the dimension build conforms it.
MATERIALS_RAW_SCHEMA = T.StructType([
    T.StructField("material", T.StringType()),
    T.StructField("precio_base", T.StringType()),
    T.StructField("valid_from", T.StringType()),
    T.StructField("valid_to", T.StringType()),
    T.StructField("is_current", T.StringType()),
])

# Target types of the dimension conform step: column -> (type, date format or None).
MATERIALS_CONFORM = {
    "precio_base": ("double", None),
    "valid_from": ("date", DIMENSION_DATE_FORMAT),
    "valid_to": ("date", DIMENSION_DATE_FORMAT),
    "is_current": ("boolean", None),
}


@dataclass(frozen=True)
class EntitySpec:
    """How one raw entity is landed in bronze.

    ``tenant_column`` set: a transactional entity, isolated per tenant.
    ``tenant_column`` None: a catalog shared by all tenants (``_tenant_id='global'``).
    ``date_column`` is the ``yyyyMMdd`` process-date column used for range filters.
    ``partition_by`` is the physical layout of the bronze table; ``derived`` adds
    columns (name, SQL expression) before the write, e.g. a month key.  A batch
    replaces the (tenant, date) slices it holds, however coarse the layout.
    """

    name: str
    required_columns: tuple[str, ...]
    schema: T.StructType | None = None
    fmt: str = "csv"
    tenant_column: str | None = None
    date_column: str | None = None
    partition_by: tuple[str, ...] = ()
    derived: tuple[tuple[str, str], ...] = ()
    options: dict = field(default_factory=dict)

    @property
    def slices(self) -> tuple[str, ...]:
        """The columns whose values a batch replaces: layout, tenant and date."""
        more = [c for c in ("_tenant_id", self.date_column) if c and c not in self.partition_by]
        return (*self.partition_by, *more)


DELIVERIES = EntitySpec(
    name="deliveries",
    required_columns=DELIVERIES_REQUIRED,
    schema=DELIVERIES_SCHEMA,
    tenant_column="pais",
    date_column="fecha_proceso",
    partition_by=("_tenant_id", "fecha_proceso"),
)

MATERIALS = EntitySpec(
    name="materials",
    required_columns=MATERIALS_REQUIRED,
    schema=MATERIALS_RAW_SCHEMA,
)

ENTITIES = {"deliveries": DELIVERIES, "materials": MATERIALS}
