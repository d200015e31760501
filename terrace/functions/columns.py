"""Column-expression builders.  All of them stay JVM-side (codegen friendly)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """Integer ``yyyyMMdd`` key of a date or timestamp (arithmetic, no string formatting)."""
    c = col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def parse_date_key(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Parse a ``yyyyMMdd`` value (int or string) into a date; NULL when not a valid date.

    ``try_to_date`` keeps an ANSI session alive on ``20250230`` or ``abc``,
    where ``to_date`` raises.
    """
    return F.try_to_date(col(c).cast("string"), fmt)


def int_date_key(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """:func:`parse_date_key` of an integer column.  Days that every month has are put together from the
    digits, which costs a fraction of parsing; all other values are parsed."""
    key = col(c)
    year, month, day = (key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100
    plain = key.between(10000101, 99991231) & month.between(1, 12) & day.between(1, 28)
    return F.when(plain, F.make_date(year, month, day)).otherwise(parse_date_key(key, fmt))


def bound_key(value: str | int | None) -> int | None:
    """``'2025-01-15'`` / ``'20250115'`` / ``20250115`` -> ``20250115``."""
    if value is None:
        return None
    text = str(value).replace("-", "").strip()
    if len(text) != 8 or not text.isdigit():
        raise ValueError(f"date bound must be yyyy-MM-dd or yyyyMMdd, got {value!r}")
    return int(text)


def factor_case(unit: str | Column, qty: str | Column, factors: Mapping[str, float | int]) -> Column:
    """``CASE unit WHEN u THEN qty * f ... ELSE qty END``; unknown or NULL unit keeps qty."""
    unit, qty = col(unit), col(qty)
    expr = None
    for u, f in factors.items():
        branch = qty * F.lit(f)
        expr = F.when(unit == u, branch) if expr is None else expr.when(unit == u, branch)
    return qty if expr is None else expr.otherwise(qty)


def lower_in(c: str | Column, values: Iterable[str]) -> Column:
    return F.lower(col(c)).isin(sorted({v.lower() for v in values}))


def all_true(cols: Iterable[Column]) -> Column:
    """Conjunction under three-valued logic, starting from TRUE."""
    out = F.lit(True)
    for c in cols:
        out = out & c
    return out


def is_false(c: Column) -> Column:
    """TRUE only when ``c`` is FALSE (NULL -> FALSE)."""
    return F.coalesce(~c, F.lit(False))


MONEY = "decimal(18,6)"


def money(c: str | Column, dtype: str = MONEY) -> Column:
    """Cast an operand to a fixed decimal so that sums do not depend on task order.

    A value beyond the type's range is NULL, so the caller can tell it; one with
    more decimals is rounded, see :func:`rounded`.
    """
    return col(c).try_cast(dtype)


def rounded(c: str | Column, dtype: str = MONEY) -> Column:
    """TRUE where :func:`money` changes a value by more than the noise of a double."""
    value = col(c).cast("double")
    return F.coalesce(F.abs(value - col(c).try_cast(dtype).cast("double"))
                      > F.lit(1e-12) * F.greatest(F.abs(value), F.lit(1.0)), value.isNotNull())
