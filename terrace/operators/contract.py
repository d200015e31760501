"""Column contract, tenant isolation and lineage stamps."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.config import ENTITIES, GLOBAL_TENANT, EntitySpec
from terrace.functions.columns import lower_in


class ContractViolation(ValueError):
    """Required columns are missing from a source."""

    def __init__(self, entity: str, missing: list[str]):
        super().__init__(f"{entity}: missing required columns {missing}")
        self.entity = entity
        self.missing = missing


def entity_spec(entity: str | EntitySpec) -> EntitySpec:
    """Resolve an entity name; unknown names are a ``ValueError``."""
    if isinstance(entity, EntitySpec):
        return entity
    if entity not in ENTITIES:
        raise ValueError(f"entity {entity!r} is not defined; known: {sorted(ENTITIES)}")
    return ENTITIES[entity]


def check_contract(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns absent from ``df``, compared case-insensitively.

    Reads the schema only; no Spark job runs.
    """
    present = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in present]


def enforce_contract(df: DataFrame, required: Iterable[str], entity: str = "source",
                     on_violation: str = "raise") -> DataFrame | None:
    """``on_violation='raise'`` raises :class:`ContractViolation`; ``'skip'`` returns None."""
    missing = check_contract(df, required)
    if not missing:
        return df
    if on_violation == "raise":
        raise ContractViolation(entity, missing)
    if on_violation == "skip":
        return None
    raise ValueError(f"on_violation must be 'raise' or 'skip', got {on_violation!r}")


def isolate_tenants(df: DataFrame, tenant_column: str, tenants: Iterable[str] | None = None,
                    out: str = "_tenant_id") -> DataFrame:
    """Keep the rows of a *set* of tenants and stamp ``_tenant_id = lower(column)``.

    Matching is case-insensitive.  ``tenants=None`` keeps every tenant, so all
    tenants land in one job instead of one scan of the raw data per tenant.
    """
    if tenants is not None:
        df = df.filter(lower_in(tenant_column, tenants))
    return df.withColumn(out, F.lower(F.col(tenant_column)))


def stamp_global(df: DataFrame, tenant: str = GLOBAL_TENANT, out: str = "_tenant_id") -> DataFrame:
    """Catalog entities have no tenant column; they belong to every tenant."""
    return df.withColumn(out, F.lit(tenant))


def stamp_lineage(df: DataFrame, batch_id: str | None = None, from_files: bool = True) -> DataFrame:
    """Add ``_ingestion_timestamp``, ``_source_file`` and ``_batch_id``.

    ``from_files``: ``df`` is a direct file scan (parquet, CSV, JSON, also a
    file stream); the source file comes from its hidden ``_metadata.file_path``
    column.  For any other frame (e.g. a join) there is no single source file
    and ``_source_file`` is NULL.
    """
    batch_id = batch_id or str(uuid.uuid4())
    source = F.col("_metadata.file_path") if from_files else F.lit(None).cast("string")
    return df.withColumns({
        "_ingestion_timestamp": F.current_timestamp(),
        "_source_file": source,
        "_batch_id": F.lit(batch_id),
    })
