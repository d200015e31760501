"""Filters and projections of the silver layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import (
    BONUS_TYPES,
    PROCESS_DATE_FORMAT,
    ROUTINE_TYPES,
    STANDARD_UNIT,
    UNIT_FACTORS,
)
from terrace.functions.columns import bound_key, factor_case, int_date_key, parse_date_key


def date_range(df: DataFrame, column: str, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """Inclusive ``yyyyMMdd`` range; either bound optional; NULL dates drop out.

    Bounds may be given with dashes.  A numeric column is compared as a number
    so the predicate stays a plain comparison on the column (parquet pushdown,
    partition pruning); for 8-digit keys this equals comparing the strings.
    """
    lo, hi = bound_key(start), bound_key(end)
    if lo is None and hi is None:
        return df
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    c = F.col(column) if numeric else F.col(column).cast("string")
    cast = (lambda v: v) if numeric else str
    if lo is not None:
        df = df.filter(c >= cast(lo))
    if hi is not None:
        df = df.filter(c <= cast(hi))
    return df


def normalize_units(df: DataFrame, unit: str = "unidad", qty: str = "cantidad",
                    factors: Mapping[str, float | int] = UNIT_FACTORS,
                    out: str = "cantidad_normalizada_st", standard_out: str = "unidad_estandar",
                    standard_unit: str = STANDARD_UNIT) -> DataFrame:
    """Quantity in the standard unit: ``qty * factor[unit]``; other or NULL units keep ``qty``."""
    return df.withColumns({
        out: factor_case(unit, qty, factors),
        standard_out: F.lit(standard_unit),
    })


def parse_process_date(df: DataFrame, column: str = "fecha_proceso",
                       out: str = "fecha_proceso_dt", fmt: str = PROCESS_DATE_FORMAT) -> DataFrame:
    return df.withColumn(out, parse_date_key(column, fmt))


def class_flags(df: DataFrame, type_column: str,
                flags: Mapping[str, Iterable[str]]) -> DataFrame:
    """One boolean column per class: ``type IN (values)``.  A NULL type gives NULL flags."""
    return df.withColumns({name: F.col(type_column).isin(list(values))
                           for name, values in flags.items()})


DELIVERY_FLAGS = {"is_routine_delivery": ROUTINE_TYPES, "is_bonus_delivery": BONUS_TYPES}


#: The columns of :func:`normalize_deliveries`: each depends on nothing but other columns of its row.
NORMALIZED = ("cantidad_normalizada_st", "unidad_estandar", "fecha_proceso_dt", *DELIVERY_FLAGS)


def normalize_deliveries(df: DataFrame) -> DataFrame:
    """Units to ``ST``, parsed process date, routine/bonus flags — one projection."""
    parse = int_date_key if isinstance(df.schema["fecha_proceso"].dataType, T.IntegerType) else parse_date_key
    return df.withColumns({
        "cantidad_normalizada_st": factor_case("unidad", "cantidad", UNIT_FACTORS),
        "unidad_estandar": F.lit(STANDARD_UNIT),
        "fecha_proceso_dt": parse("fecha_proceso", PROCESS_DATE_FORMAT),
        **{name: F.col("tipo_entrega").isin(list(values)) for name, values in DELIVERY_FLAGS.items()},
    })


def conform_types(df: DataFrame, spec: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Cast columns to target types without failing the job on dirty values.

    ``spec`` maps column -> (type, date format).  Dates use ``try_to_date``;
    other types ``try_cast``; a value that does not convert becomes NULL.
    """
    out = {}
    for name, (dtype, fmt) in spec.items():
        c = F.col(name)
        if dtype == "date":
            out[name] = F.try_to_date(c.cast("string"), fmt) if fmt else c.try_cast("date")
        else:
            out[name] = c.try_cast(dtype)
    return df.withColumns(out)


def order_columns(df: DataFrame, keys: Iterable[str], audit_prefix: str = "_",
                  drop_prefixes: Iterable[str] = ("_rule_",),
                  drop: Iterable[str] = ("fecha_proceso_dt",)) -> DataFrame:
    """Standard column order: keys, then metrics, then audit columns.

    Audit = names starting with ``audit_prefix`` that are not keys.  Columns
    with a ``drop_prefixes`` prefix and the ``drop`` names are removed.
    """
    keys = list(keys)
    drop_prefixes, drop = tuple(drop_prefixes), set(drop)
    kept = [c for c in df.columns if not c.startswith(drop_prefixes) and c not in drop]
    audit = [c for c in kept if c.startswith(audit_prefix) and c not in keys]
    metrics = [c for c in kept if c not in keys and c not in audit]
    return df.select(*keys, *metrics, *audit)
