"""Stored partial aggregates: metrics of new days, and roll-ups, without a second read of the facts.

A table of partials has one row per group of the finest keys (tenant, day,
class).  Each measure is kept in a form that merges: sums as integer limbs of
an accumulator that is wider than a double, distinct counts as HyperLogLog
sketches, counts as they are.  A day's rows replace that day's partials and
nothing else; any coarser metric is a merge of partials.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.metrics import DAILY_KEYS, DAILY_MEASURES, Measure
from terrace.operators.sinks import replace_slices

LIMB_BITS = 40
LIMB_UNITS = (-60, -20, 20, 60)     # limb k counts units of 2 ** LIMB_UNITS[k], lowest first
LARGEST = 2.0 ** (LIMB_UNITS[-1] + LIMB_BITS)
WIDE = "decimal(38,0)"


def _sum_columns(m: Measure) -> list[str]:
    return [*(f"{m.name}__limb{k}" for k in range(len(LIMB_UNITS))), f"{m.name}__beyond", f"{m.name}__rows"]


def partial_columns(m: Measure) -> list[str]:
    """Names of the columns that hold a measure's partial form."""
    if m.kind in ("sum", "sum_product"):
        return _sum_columns(m)
    if m.kind in ("count_distinct", "approx_count_distinct"):
        return [f"{m.name}__sketch"]
    if m.kind == "count":
        return [f"{m.name}__rows"]
    raise ValueError(f"unknown measure kind {m.kind!r}")


def _limbs(x: Column) -> list[Column]:
    """``x`` cut into integer limbs, lowest first.  Each remainder is exact; what is below half a unit of
    the lowest limb is rounded away.  NULL where ``x`` does not fit."""
    rest, out = F.when(F.abs(x) < LARGEST, x), []
    for unit in LIMB_UNITS[:0:-1]:
        limb = (rest / F.lit(2.0 ** unit)).cast("bigint")      # towards zero, so the rest keeps its bits
        out.append(limb)
        rest = rest - limb.cast("double") * F.lit(2.0 ** unit)
    out.append(F.rint(rest / F.lit(2.0 ** LIMB_UNITS[0])).cast("bigint"))
    return out[::-1]


def _distinct_value(columns: Iterable[str]) -> Column:
    cols = [F.col(c) for c in columns]
    if len(cols) == 1:
        return cols[0].cast("string")
    present = F.lit(True)
    for c in cols:
        present = present & c.isNotNull()
    return F.when(present, F.to_json(F.struct(*cols)))


def partial_metrics(df: DataFrame, keys: Iterable[str] = DAILY_KEYS, measures: Iterable[Measure] = DAILY_MEASURES,
                    lg_k: int = 12) -> DataFrame:
    """One row of partials per group of ``keys``.

    A sum's limbs are sums of integers, so they do not depend on the order in which tasks combine
    them; each row adds an error of at most 2**-61.  Values of 2**100 and more, infinite ones and NaN are
    summed as doubles beside the limbs.  NULL operands add nothing.  ``lg_k`` is the sketches' size:
    their standard error is 1.04 / sqrt(2 ** lg_k).
    """
    aggs = []
    for m in measures:
        names = partial_columns(m)
        if m.kind in ("sum", "sum_product"):
            x = F.col(m.columns[0]).cast("double")
            for c in m.columns[1:]:
                x = x * F.col(c).cast("double")
            aggs += [F.coalesce(F.sum(limb.cast("decimal(18,0)")).cast(WIDE), F.lit(0).cast(WIDE)).alias(n)
                     for n, limb in zip(names, _limbs(x))]
            aggs += [F.sum(F.when(~(F.abs(x) < LARGEST), x)).alias(names[-2]), F.count(x).alias(names[-1])]
        elif m.kind == "count":
            aggs.append((F.count(F.col(m.columns[0])) if m.columns else F.count(F.lit(1))).alias(names[0]))
        else:
            aggs.append(F.hll_sketch_agg(_distinct_value(m.columns), lg_k).alias(names[0]))
    return df.groupBy(*keys).agg(*aggs)


def merge_partials(partials: DataFrame, keys: Iterable[str], measures: Iterable[Measure] = DAILY_MEASURES) -> DataFrame:
    """Partials of coarser ``keys`` (none: of everything)."""
    aggs = []
    for m in measures:
        for n in partial_columns(m):
            if n.endswith("__sketch"):
                aggs.append(F.hll_union_agg(n).alias(n))
            else:
                total = F.sum(n)
                aggs.append((total.cast(WIDE) if "__limb" in n else total).alias(n))
    return partials.groupBy(*keys).agg(*aggs)


def _total(m: Measure) -> Column:
    """The double nearest to the limbs' sum, within two units in the last place."""
    *limbs, beyond, rows = [F.col(n) for n in _sum_columns(m)]

    def wide(v: int) -> Column:
        return F.lit(str(v)).cast(WIDE)

    low = limbs[1] * wide(2 ** LIMB_BITS) + limbs[0]
    high = limbs[3] * wide(2 ** LIMB_BITS) + limbs[2]
    whole, half = wide(2 ** (2 * LIMB_BITS)), wide(2 ** (2 * LIMB_BITS - 1))
    near = (F.pmod(low + half, whole) - half).cast(WIDE)   # around zero, so the two parts never cancel
    carry = ((low - near) / whole).cast(WIDE)
    exact = ((high + carry).cast("double") * F.lit(2.0 ** LIMB_UNITS[2]) + near.cast("double") * F.lit(2.0 ** LIMB_UNITS[0]))
    return F.when(rows > 0, F.when(beyond.isNull(), exact).otherwise(exact + beyond)).alias(m.name)


def finish_metrics(partials: DataFrame, measures: Iterable[Measure] = DAILY_MEASURES) -> DataFrame:
    """Metrics from partials, one row per row: NULL for a sum without operands, 0 for a distinct count without values."""
    measures = list(measures)
    parts = {n for m in measures for n in partial_columns(m)}
    out = []
    for m in measures:
        if m.kind in ("sum", "sum_product"):
            out.append(_total(m))
        elif m.kind == "count":
            out.append(F.col(partial_columns(m)[0]).alias(m.name))
        else:
            out.append(F.hll_sketch_estimate(partial_columns(m)[0]).alias(m.name))
    return partials.select(*[F.col(f"`{c}`") for c in partials.columns if c not in parts], *out)


def refresh_partials(spark: SparkSession, rows: DataFrame, path: str, partition_by: Iterable[str],
                     slices: Iterable[str] = ("_tenant_id", "fecha_proceso"), keys: Iterable[str] = DAILY_KEYS,
                     measures: Iterable[Measure] = DAILY_MEASURES, lg_k: int = 12, processed: DataFrame | None = None) -> None:
    """Replace the partials of the slices that ``rows`` holds, in the table at ``path``.

    ``rows`` are all facts of those slices; facts of other days are not read, whatever the layout.
    Within the partitions touched only partials are read and rewritten.  Slices listed in
    ``processed`` without rows are emptied.
    """
    pb = list(partition_by)
    cut = list(dict.fromkeys([*slices, *pb]))
    group = list(dict.fromkeys([*keys, *cut]))
    replace_slices(spark, partial_metrics(rows, group, measures, lg_k), path, cut, pb, processed=processed)
