"""Version history (SCD2) from plain snapshots: change detection, closing of versions, late snapshots.

A snapshot lists all keys with their attributes as of a day.  It holds until
the next snapshot's day, so recording one replaces what the history says about
``[day, next day)``: versions are cut at both ends, a key that the snapshot
lacks has no version there, and neighbouring versions of equal attributes grow
together again.  A late snapshot, between two known ones, thus splits the
version that covered it, and the order in which snapshots arrive does not matter.

Only keys whose versions change are rewritten: a key whose covering version
has the same attribute hash is left alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.operators.sinks import materialize, overwrite, replace_slices, table_schema
from terrace.session import remove_path
from terrace.sources.files import read_table, table_exists

#: The last day of a version that is still open.
OPEN_END = dt.date(9999, 12, 31)
BUCKET = "_bucket"


def attribute_hash(attributes: Iterable[str]) -> Column:
    """Two versions are equal if all attributes are, NULLs included."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in attributes]), {"ignoreNullFields": "false"}), 256)


def _same_key(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return cond


def changed_keys(history: DataFrame, snapshot: DataFrame, keys: Iterable[str], attributes: Iterable[str],
                 day: dt.date, until: dt.date) -> DataFrame:
    """Keys whose versions within ``day`` to ``until`` are not just the snapshot's attributes all the time.

    One aggregation over both sides: a key is unchanged if one version covers
    the whole time with the snapshot's hash, or if neither side has it.
    """
    keys = list(keys)
    inside = history.filter((F.col("valid_from") <= F.lit(until)) & (F.col("valid_to") >= F.lit(day)))
    covers = (F.col("valid_from") <= F.lit(day)) & (F.col("valid_to") >= F.lit(until))
    old = inside.select(*keys, attribute_hash(attributes).alias("__h"), covers.alias("__covers"), F.lit(1).alias("__old"))
    new = snapshot.select(*keys, attribute_hash(attributes).alias("__h"), F.lit(True).alias("__covers"), F.lit(0).alias("__old"))
    both = old.unionByName(new).groupBy(*keys).agg(
        F.sum("__old").alias("__o"), F.count(F.lit(1)).alias("__n"), F.min("__h").alias("__lo"), F.max("__h").alias("__hi"),
        F.every("__covers").alias("__covers"))
    same = (F.col("__o") == 1) & (F.col("__n") == 2) & (F.col("__lo") == F.col("__hi")) & F.col("__covers")
    return both.filter(~same).select(*keys)


def splice_snapshot(history: DataFrame, snapshot: DataFrame, keys: Iterable[str], attributes: Iterable[str],
                    day: dt.date, until: dt.date) -> DataFrame:
    """The history after ``snapshot`` is recorded as valid from ``day`` to ``until`` (both inclusive).

    Columns: keys, attributes, valid_from, valid_to, is_current.  A key that
    occurs twice in the snapshot raises.
    """
    keys, attributes = list(keys), list(attributes)
    columns = [*keys, *attributes, "valid_from", "valid_to"]
    before = history.filter(F.col("valid_from") < F.lit(day)).withColumn(
        "valid_to", F.least("valid_to", F.date_sub(F.lit(day), 1)))
    after = history.filter(F.col("valid_to") > F.lit(until)).withColumn(
        "valid_from", F.greatest("valid_from", F.date_add(F.lit(until), 1)))
    twice = F.raise_error(F.concat(F.lit("a key occurs twice in the snapshot: "), F.to_json(F.struct(*keys))))
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    new = snapshot.select(*keys, *attributes, F.lit(day).alias("valid_from"), F.lit(until).alias("valid_to"),
                          rows.alias("__rows")).filter(F.when(F.col("__rows") > 1, twice.cast("boolean")).otherwise(True))
    pieces = before.select(*columns).unionByName(after.select(*columns)).unionByName(new.select(*columns))
    # neighbours of equal attributes are one version: a version starts where the hash or the days do not go on
    pieces = pieces.withColumn("__h", attribute_hash(attributes))
    order = Window.partitionBy(*keys).orderBy("valid_from")
    goes_on = (F.lag("__h").over(order) == F.col("__h")) & (
        F.date_add(F.lag("valid_to").over(order), 1) == F.col("valid_from"))
    pieces = pieces.withColumn("__starts", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    pieces = pieces.withColumn("__run", F.sum("__starts").over(order))
    # attributes of one run are equal, so any will do; "first" keeps types that have no order
    whole = pieces.groupBy(*keys, "__run").agg(*[F.first(c).alias(c) for c in attributes],
                                               F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
    return whole.select(*columns, (F.col("valid_to") == F.lit(OPEN_END)).alias("is_current"))


def record_snapshot(spark: SparkSession, snapshot: DataFrame, path: str, keys: Iterable[str], attributes: Iterable[str],
                    day: dt.date, buckets: int = 16) -> int:
    """Record a snapshot in the history table at ``path``; how many keys changed.

    The days of all recorded snapshots are kept beside the table, one row a
    day.  The table is bucketed by a hash of the key; buckets that hold no
    changed key are neither read for the merge nor rewritten.
    """
    keys, attributes = list(keys), list(attributes)
    days_path = f"{path.rstrip('/')}-days"
    known = sorted({r[0] for r in read_table(spark, days_path).select("day").distinct().collect()}) if table_exists(
        spark, days_path) else []
    later = [d for d in known if d > day]
    until = later[0] - dt.timedelta(days=1) if later else OPEN_END
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    snapshot, stage = materialize(spark, snapshot.select(*keys, *attributes), "snapshot")
    stages = [stage]
    try:
        if table_exists(spark, path):
            history = read_table(spark, path, schema=table_schema(spark, path))
            changed, stage = materialize(spark, changed_keys(history, snapshot, keys, attributes, day, until).withColumn(
                BUCKET, bucket), "changed-keys")
            stages.append(stage)
            named = changed.select(*[F.col(c).alias(f"__c_{c}") for c in [*keys, BUCKET]])
            mine = history.join(named, _same_key(history, named, [*keys, BUCKET], "__c_"), "left_semi")
            wanted = snapshot.join(named, _same_key(snapshot, named, keys, "__c_"), "left_semi")
            spliced, stage = materialize(spark, splice_snapshot(mine, wanted, keys, attributes, day, until).withColumn(
                BUCKET, bucket), "spliced")
            stages.append(stage)
            replace_slices(spark, spliced, path, [BUCKET, *keys], [BUCKET], stage_source=False, processed=changed)
            n = changed.count()
        else:
            empty = snapshot.limit(0).select("*", F.lit(day).alias("valid_from"), F.lit(until).alias("valid_to"))
            first = splice_snapshot(empty, snapshot, keys, attributes, day, until).withColumn(BUCKET, bucket)
            overwrite(first, path, [BUCKET])
            n = snapshot.count()
    finally:
        for s in stages:
            remove_path(spark, s)
    overwrite(spark.createDataFrame([(d,) for d in sorted({*known, day})], "day date").coalesce(1), days_path)
    return n
