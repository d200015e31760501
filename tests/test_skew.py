"""Hot keys: a partition value or join key holding most rows is split over several tasks."""

import contextlib
import io
import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from terrace.operators.sinks import replace_partitions
from terrace.operators.temporal import point_in_time_join


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_table):
    rows = spark.range(0, 200000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 10).cast("string")))
        .alias("p"), F.col("id"), (F.col("id") * 7 % 1000).alias("v")).repartition(8)
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}):
        replace_partitions(rows, tmp_table, ["p"])
    hot = [f for f in os.listdir(os.path.join(urlparse(tmp_table).path, "p=hot")) if f.endswith(".parquet")]
    assert len(hot) > 1                     # the 80 % value was split, not written by one task
    assert spark.read.parquet(tmp_table).count() == 200000


def test_point_in_time_join_hot_key_becomes_a_skew_join(spark):
    fact = spark.range(0, 200000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 500).alias("material"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d"),
        F.col("id"))
    dim = spark.range(0, 500).select(F.col("id").alias("material"), F.lit("2024-01-01").cast("date").alias("valid_from"),
                                     F.lit("9999-12-31").cast("date").alias("valid_to"),
                                     (F.col("id") * 1.5).alias("precio_base"))
    with conf(spark, **{"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB"}):
        joined = point_in_time_join(fact, dim, ["material"], "d", columns={"precio_base": "p"})
        assert joined.count() == 200000
        joined.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
    plan = buf.getvalue()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan or "skew=true" in plan
