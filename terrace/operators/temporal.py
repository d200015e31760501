"""Point-in-time (SCD2) join of facts against a versioned dimension."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.sources.files import file_bytes


BROADCAST_FILE_BYTES = 8 << 20   # parquet file bytes of a dimension that may be sent to every executor


#: Days are counted from year 0, so that every date has a number of 0 or more and below 2 ** LEVELS.
LEVELS = 22
_DAY_ZERO = 719_528


def _day(date: Column) -> Column:
    return F.unix_date(date) + _DAY_ZERO


def _nodes(first: Column, after: Column, top: Column) -> Column:
    """The dyadic ranges, up to level ``top``, that make up the numbers from ``first`` to before ``after``."""
    def at(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), k)
        lo = F.call_function("shiftright", first + size - 1, k)     # whole nodes of this level inside the range
        hi = F.call_function("shiftright", after, k)
        left = F.when((lo < hi) & (lo % 2 == 1), F.struct(k.alias("level"), lo.alias("node")))
        right = F.when((lo < hi) & (hi % 2 == 1), F.struct(k.alias("level"), (hi - 1).alias("node")))
        return F.array_compact(F.array(left, right))

    return F.flatten(F.transform(F.sequence(F.lit(0), top), at))


def dyadic_nodes(first: Column, last: Column) -> Column:
    """The dyadic ranges that make up the days from ``first`` to ``last``: an array of (level, node), a node of
    level ``k`` being the days ``node * 2**k`` to ``(node + 1) * 2**k - 1``.

    A range has at most two nodes a level, so O(log days) in all, and every
    day of it lies in exactly one of them.
    """
    return _nodes(_day(first), _day(last) + 1, F.lit(LEVELS))


def _top(days: Column) -> Column:
    """The level of the smallest dyadic range that may hold all of ``days``."""
    return F.length(F.bin(F.size(days)))


def _days_before(days: Column, at: str | None, date: Column) -> Column:
    """How many of the ordered ``days`` (dates, or structs with the date in ``at``) lie before ``date``, by bisection."""
    def step(n: Column, k: Column) -> Column:
        ahead = n + F.call_function("shiftleft", F.lit(1), k)
        here = F.get(days, ahead - 1)                               # NULL beyond the end
        return F.when((here if at is None else here[at]) < date, ahead).otherwise(n)

    return F.aggregate(F.sequence(_top(days), F.lit(0), F.lit(-1)), F.lit(0), step)


def days_by_key(points: DataFrame, keys: Iterable[str], at: str) -> DataFrame:
    """One row a key (columns ``__p_0``, ...): its distinct days ``at`` in order, as the array ``__days``.

    Columns of ``points`` beyond keys and day ride along in structs.  A key's array is as long as the
    calendar days it has points on, however many facts it has: copies collapse before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in points.columns if c not in (*keys, at)]
    entry = F.struct(at, *rest) if rest else F.col(at)
    return points.filter(F.col(at).isNotNull()).groupBy(*[F.col(k).alias(f"__p_{i}") for i, k in enumerate(keys)]).agg(
        F.sort_array(F.collect_set(entry)).alias("__days"))


def _same_key(left: DataFrame, names: Iterable[str], days: DataFrame) -> Column:
    cond = F.lit(True)
    for i, n in enumerate(names):
        cond = cond & (left[n] == days[f"__p_{i}"])
    return cond


def versions_at(points: DataFrame, dim: DataFrame, keys: Iterable[str], at: str, valid_from: str = "valid_from",
                valid_to: str = "valid_to", newest: bool = False) -> DataFrame:
    """The versions of ``dim`` that are valid at each of the distinct ``points`` (keys and day ``at``): the points'
    columns, the range and the other columns of each version; ``newest``: only the newest one.

    A key's points are numbered in the order of their days, and a version finds
    the first and last number within its range by bisection.  The numbers are
    cut into dyadic ranges, and each of these hands the version to its points.
    A version has O(log P) ranges for the P days of its key, and a point gets
    no row for a level that holds no version, so work is
    O(V log P + matches) rows.  With ``newest`` each dyadic range keeps its newest version
    before it is expanded: a point then has log P rows at most, however many
    versions cover it.  A key's days travel with each of its versions inside
    a task, but are shuffled once a key.
    """
    keys = list(keys)
    dim = dim.filter(F.col(valid_from).isNotNull() & F.col(valid_to).isNotNull() & (F.col(valid_from) <= F.col(valid_to)))
    others = [c for c in dim.columns if c not in (*keys, valid_from, valid_to)]
    rest = [c for c in points.columns if c not in (*keys, at)]
    version = F.struct(F.col(valid_from).alias("__f"), F.col(valid_to).alias("__t"), *[F.col(c) for c in others])
    named = [f"__n_{i}" for i in range(len(keys))]
    days, inner = days_by_key(points, keys, at), at if rest else None
    versions = dim.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], version.alias("__v"))
    ranged = versions.join(days, _same_key(versions, named, days))
    ends = F.struct(_days_before(F.col("__days"), inner, F.col("__v.__f")).alias("a"),
                    _days_before(F.col("__days"), inner, F.date_add("__v.__t", 1)).alias("b"))
    # The ends are bound once; and the optimizer copies what is exploded into a filter, unless it is an outer explode.
    nodes = F.flatten(F.transform(F.array(ends), lambda e: _nodes(e["a"], e["b"], _top(F.col("__days")))))

    def within(node: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), node["level"])
        return F.slice("__days", node["node"] * size + 1, size)

    if newest:
        best = ranged.select(*named, "__v", F.explode_outer(nodes).alias("__node")).filter("__node IS NOT NULL").groupBy(
            *named, F.col("__node.level").alias("level"), F.col("__node.node").alias("node")).agg(F.max("__v").alias("__v"))
        met = best.join(days, _same_key(best, named, days)).select(
            *named, "__v", F.explode_outer(within(F.struct("level", "node"))).alias("__point"))
        met = met.groupBy(*named, "__point").agg(F.max("__v").alias("__v"))
    else:
        met = ranged.select(*named, "__v", F.explode_outer(F.flatten(F.transform(nodes, within))).alias("__point")).filter(
            "__point IS NOT NULL")
    point = {c: F.col(f"__point.{c}") for c in (at, *rest)} if rest else {at: F.col("__point")}
    point.update({k: F.col(n) for k, n in zip(keys, named)})
    return met.select(*[point[c].alias(c) for c in points.columns], F.col("__v.__f").alias(valid_from),
                      F.col("__v.__t").alias(valid_to), *[F.col(f"__v.{c}").alias(c) for c in others])


def newest_versions(dim: DataFrame, keys: Iterable[str], valid_from: str = "valid_from",
                    valid_to: str = "valid_to") -> DataFrame:
    """Make the versions of one key non-overlapping: on every day the newest valid version wins.

    Versions with a NULL start or end never match and are dropped.  The starts
    and ends of a key cut time into elementary intervals; each keeps the
    version that covers it with the latest ``valid_from`` (on ties the latest
    ``valid_to``, then the largest values of the other columns).  A version
    that a shorter, newer one interrupts therefore continues after it.  The
    version of an interval is that of its first day (:func:`versions_at`), so
    a key's versions are not compared with each other: work is O(V log days).
    """
    keys = list(keys)
    dim = dim.filter(F.col(valid_from).isNotNull() & F.col(valid_to).isNotNull() & (F.col(valid_from) <= F.col(valid_to)))
    # the day after the last date there is (9999-12-31) has no number in a dyadic tree of dates, and needs none
    cuts = dim.select(*keys, F.explode(F.array(F.col(valid_from), F.date_add(valid_to, 1))).alias("__start")).distinct()
    following = F.lead("__start").over(Window.partitionBy(*keys).orderBy("__start"))
    spans = cuts.select(*keys, "__start", F.date_sub(following, 1).alias("__end")).filter(F.col("__end").isNotNull())
    others = [c for c in dim.columns if c not in (*keys, valid_from, valid_to)]
    found = versions_at(spans, dim, keys, "__start", valid_from, valid_to, newest=True)
    return found.select(*keys, F.col("__start").alias(valid_from), F.col("__end").alias(valid_to), *others).select(
        *dim.columns)


def daily_snapshot(dim: DataFrame, fact: DataFrame, keys: Iterable[str], at: str, valid_from: str = "valid_from",
                   valid_to: str = "valid_to", on_overlap: str = "fanout", day: str = "day",
                   only_fact_days: bool = False) -> DataFrame:
    """The dimension as one row per key, day and valid version, for the keys and days that facts need.

    Versions are cut to each key's first and last fact day before they are
    expanded, so an open end costs no more than the facts' own span.  The rows
    are the sum of these clipped spans.  ``only_fact_days`` leaves out the days on
    which a key has no fact, so that the rows are at most one a fact and version valid on its day;
    a join of these facts meets no other day.
    """
    keys = list(keys)
    if only_fact_days:
        found = days_by_key(fact.select(*keys, at), keys, at)
        ends = F.struct(_days_before(F.col("__days"), None, F.col(valid_from)).alias("a"),
                        _days_before(F.col("__days"), None, F.date_add(valid_to, 1)).alias("b"))
        inside = F.flatten(F.transform(F.array(ends), lambda e: F.slice("__days", e["a"] + 1, e["b"] - e["a"])))
        days = dim.filter(F.col(valid_from) <= F.col(valid_to)).join(found, _same_key(dim, keys, found)).select(
            *dim.columns, F.explode_outer(inside).alias(day)).filter(F.col(day).isNotNull())
        return _one_a_day(days, dim, keys, day, valid_from, valid_to) if on_overlap != "fanout" else days
    bounds = fact.filter(F.col(at).isNotNull()).groupBy(*keys).agg(F.min(at).alias("__lo"), F.max(at).alias("__hi"))
    clipped = dim.join(bounds, keys).filter(
        (F.col(valid_from) <= F.col("__hi")) & (F.col(valid_to) >= F.col("__lo")) & (F.col(valid_from) <= F.col(valid_to)))
    days = clipped.withColumn(day, F.explode(F.sequence(
        F.greatest(valid_from, "__lo"), F.least(valid_to, "__hi")))).drop("__lo", "__hi")
    return _one_a_day(days, dim, keys, day, valid_from, valid_to) if on_overlap != "fanout" else days


def _one_a_day(days: DataFrame, dim: DataFrame, keys: list[str], day: str, valid_from: str, valid_to: str) -> DataFrame:
    """Of the versions of a key and day the newest one."""
    others = [c for c in dim.columns if c not in keys]
    ordered = [valid_from, valid_to, *[c for c in others if c not in (valid_from, valid_to)]]
    newest = days.groupBy(*keys, day).agg(F.max(F.struct(*ordered)).alias("__v"))
    return newest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in others], day)


def point_in_time_join(fact: DataFrame, dim: DataFrame, keys: Iterable[str] | Mapping[str, str],
                       at: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                       columns: Mapping[str, str] | None = None, how: str = "left",
                       on_overlap: str = "fanout", broadcast_bytes: int = BROADCAST_FILE_BYTES,
                       salt: int = 0, method: str = "range") -> DataFrame:
    """Attach the dimension version valid at ``fact[at]``: equal keys and
    ``valid_from <= at <= valid_to`` (both ends inclusive).

    * no matching version -> NULL dimension columns (``how='left'``);
    * ``valid_to`` NULL never matches (use an open-end date such as 9999-12-31);
    * overlapping versions: ``on_overlap='fanout'`` returns one row per match,
      ``'latest'`` keeps the newest version that is valid on the day
      (:func:`newest_versions`).

    Plan: an equi-join on the business key with the range as a residual
    condition.  A dimension whose files hold at most ``broadcast_bytes`` (8 MB
    by default, which leaves room for decompression and for ``salt``; 0: never)
    is broadcast, so the facts are not shuffled.  Otherwise both sides are
    shuffled on the key, and hot keys on the fact side are split by AQE's
    skew-join handling.

    ``salt > 1`` splits every key over ``salt`` join partitions explicitly:
    each fact row gets a deterministic salt (a hash of the whole row, so a
    recomputed task gives the same value), each dimension version is
    replicated once per salt value, and the salt joins the equi keys.  A key
    holding a third of all facts then spreads over ``salt`` tasks even where
    AQE cannot split it (AQE off, or the hot side on the build side).  Costs:
    the dimension side grows ``salt`` times.

    ``method`` says how days meet ranges: ``"range"`` as above; ``"points"``
    finds the versions of the facts' distinct (key, day) in dyadic ranges
    (:func:`versions_at`); ``"snapshot"`` expands the versions to the facts'
    days of each key (:func:`daily_snapshot`).  The latter two then join facts on (key,
    day) by equality alone, which keeps a key with thousands of versions linear:
    a range condition compares each of its facts with all of them.

    ``keys`` is a list of shared names or a mapping fact column -> dim column.
    ``columns`` maps dimension columns to output names (default: all non-key,
    non-range columns with their own names).
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    if columns is None:
        skip = set(pairs.values()) | {valid_from, valid_to}
        columns = {c: c for c in dim.columns if c not in skip}
    if on_overlap not in ("fanout", "latest"):
        raise ValueError("on_overlap must be 'fanout' or 'latest'")
    if method not in ("range", "points", "snapshot"):
        raise ValueError("method must be 'range', 'points' or 'snapshot'")
    if method != "range":
        return _join_on_days(fact, dim, pairs, at, valid_from, valid_to, columns, how, on_overlap, method)
    if on_overlap == "latest":
        dim = newest_versions(dim, list(pairs.values()), valid_from, valid_to)

    # Prefix the dimension's columns so no name is ambiguous after the join.
    d = dim.select(
        *[F.col(dc).alias(f"__dk_{i}") for i, dc in enumerate(pairs.values())],
        F.col(valid_from).alias("__d_from"), F.col(valid_to).alias("__d_to"),
        *[F.col(src).alias(f"__dv_{i}") for i, src in enumerate(columns)])
    out_cols = list(fact.columns)
    if salt > 1:
        fact = fact.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in out_cols]), F.lit(salt)))
        d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    size = file_bytes(dim) if broadcast_bytes else None
    if size is not None and size * max(1, salt) <= broadcast_bytes:
        d = F.broadcast(d)
    cond = None
    for i, fc in enumerate(pairs):
        c = fact[fc] == d[f"__dk_{i}"]
        cond = c if cond is None else cond & c
    if salt > 1:
        cond = cond & (fact["__salt"] == d["__salt"])
    cond = cond & fact[at].between(d["__d_from"], d["__d_to"])
    joined = fact.join(d, cond, how)
    return joined.select(
        *[fact[c] for c in out_cols],
        *[d[f"__dv_{i}"].alias(out) for i, out in enumerate(columns.values())])


def _join_on_days(fact: DataFrame, dim: DataFrame, pairs: Mapping[str, str], at: str, valid_from: str, valid_to: str,
                  columns: Mapping[str, str], how: str, on_overlap: str, method: str) -> DataFrame:
    """The point-in-time join as an equi-join of facts on (keys, day)."""
    d = dim.select(*[F.col(dc).alias(f"__dk_{i}") for i, dc in enumerate(pairs.values())],
                   F.col(valid_from).alias("__d_from"), F.col(valid_to).alias("__d_to"),
                   *[F.col(src).alias(f"__dv_{i}") for i, src in enumerate(columns)])
    keys = [f"__dk_{i}" for i in range(len(pairs))]
    seen = fact.select(*[F.col(fc).alias(k) for fc, k in zip(pairs, keys)], F.col(at).alias("__day"))
    if method == "points":
        days = versions_at(seen, d, keys, "__day", "__d_from", "__d_to",
                           on_overlap == "latest")
    else:
        days = daily_snapshot(d, seen, keys, "__day", "__d_from", "__d_to", on_overlap, day="__on", only_fact_days=True)
        days = days.withColumnRenamed("__on", "__day")
    cond = fact[at] == days["__day"]
    for fc, k in zip(pairs, keys):
        cond = cond & (fact[fc] == days[k])
    joined = fact.join(days, cond, how)
    return joined.select(*[fact[c] for c in fact.columns],
                         *[days[f"__dv_{i}"].alias(out) for i, out in enumerate(columns.values())])
