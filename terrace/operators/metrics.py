"""Aggregations: declarative daily metrics and deduplication."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import MONEY, money, rounded


@dataclass(frozen=True)
class Measure:
    """One output metric.

    kind: ``sum`` (one column), ``sum_product`` (product of columns),
    ``count_distinct``, ``approx_count_distinct``, ``count``.
    """

    name: str
    kind: str
    columns: tuple[str, ...] = ()


DAILY_KEYS = ("_tenant_id", "fecha_proceso", "tipo_entrega")
DAILY_MEASURES = (
    Measure("total_units", "sum", ("cantidad_normalizada_st",)),
    Measure("total_revenue", "sum_product", ("cantidad_normalizada_st", "precio")),
    Measure("active_routes", "count_distinct", ("ruta",)),
    Measure("active_transports", "count_distinct", ("transporte",)),
)


def measure_column(m: Measure, exact: bool = True, money_type: str = MONEY,
                   rsd: float = 0.05) -> Column:
    """Aggregate expression of one measure.

    ``exact`` sums fixed-point decimal operands and returns a double: a double
    sum's last digits depend on the order in which tasks combine partial sums,
    so reruns and the oracle would disagree; the decimal sum does not.  A group
    with an operand that the decimal type cannot hold (too large, infinite or
    NaN), or whose sum it cannot, gets the plain double sum instead, as it would without ``exact``.
    """
    cols = [F.col(c) for c in m.columns]
    if m.kind in ("sum", "sum_product"):
        plain = cols[0]
        for c in cols[1:]:
            plain = plain * c
        if not exact:
            return F.sum(plain).alias(m.name)
        fixed = money(cols[0], money_type)
        for c in cols[1:]:
            fixed = fixed * money(c, money_type)
        too_large = F.lit(False)
        for c in cols:
            too_large = too_large | (c.isNotNull() & money(c, money_type).isNull())
        return F.coalesce(F.when(~F.max(too_large), F.try_sum(fixed).cast("double")),
                          F.sum(plain.cast("double"))).alias(m.name)
    if m.kind == "count_distinct":
        return F.count_distinct(*cols).alias(m.name)
    if m.kind == "approx_count_distinct":
        return F.approx_count_distinct(cols[0], rsd).alias(m.name)
    if m.kind == "count":
        return (F.count(cols[0]) if cols else F.count(F.lit(1))).alias(m.name)
    raise ValueError(f"unknown measure kind {m.kind!r}")


def rounded_operands(measures: Iterable[Measure] = DAILY_MEASURES, money_type: str = MONEY) -> Column:
    """TRUE for rows with an operand of a sum that ``money_type`` cannot hold without rounding."""
    out = F.lit(False)
    for m in measures:
        if m.kind in ("sum", "sum_product"):
            for c in m.columns:
                out = out | rounded(c, money_type)
    return out


def daily_metrics(df: DataFrame, keys: Iterable[str] = DAILY_KEYS,
                  measures: Iterable[Measure] = DAILY_MEASURES, exact: bool = True,
                  approx: bool = False, money_type: str = MONEY, table: DataFrame | None = None) -> DataFrame:
    """Group by ``keys`` and compute the measures in one aggregation.

    Exact distinct counts are planned by Spark as an ``Expand`` + two-level
    aggregation: the first level is keyed by (group, distinct value), so even
    a group holding a third of all rows spreads its distinct values over all
    tasks.  ``approx=True`` turns distinct counts into HyperLogLog sketches
    (one partial sketch per task and group).

    ``table`` holds the rows of ``df`` in a form that is cheap to read several
    times: each exact distinct count is then an aggregation of its own over two
    or three columns of it, and no row is copied per count with the buffers of the sums.
    """
    ms = [Measure(m.name, "approx_count_distinct", m.columns)
          if approx and m.kind == "count_distinct" else m for m in measures]
    keys = list(keys)
    apart = [m for m in ms if m.kind == "count_distinct"] if table is not None else []
    rest = [measure_column(m, exact, money_type) for m in ms if m not in apart] or [F.lit(0).alias("__none")]
    if not apart:
        return df.groupBy(*keys).agg(*rest)
    out = df.groupBy(*keys).agg(*rest)
    for m in apart:
        found = table.select(*keys, *[F.col(c).alias(f"__v_{i}") for i, c in enumerate(m.columns)])
        found = found.dropna(subset=[f"__v_{i}" for i in range(len(m.columns))]).dropDuplicates()
        out = out.unionByName(found.groupBy(*keys).agg(F.count(F.lit(1)).alias(m.name)), allowMissingColumns=True)
    # a group has one row with each measure, and is counted where it has no value
    return out.groupBy(*keys).agg(*[
        (F.coalesce(F.max(m.name), F.lit(0).cast("long")) if m in apart else F.max(m.name)).alias(m.name) for m in ms])


def dedup(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop duplicate rows (full row by default).  Copies collapse in the map-side
    partial aggregation, so a hot group of copies never reaches one reducer whole;
    what is left is distributed by all its columns
    (``spark.sql.requireAllClusterKeysForDistribution``), not by those of an
    earlier join, so a hot join key does not stay in one task."""
    subset = list(subset) if subset else None
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()
