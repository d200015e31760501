"""Raw files to silver in one stream: de-duplication, price lookup, rules, quarantine and log.

Rows that arrive again within ``forget_after`` are dropped by Spark's
keyed state; later copies pass, and change nothing, as every write is
idempotent.  Each micro-batch then takes the batch path's steps: it is
normalized, joined with the dimension's versions as they are now, judged by
the rules and written by upserts.  The log of micro-batch N is the
partition N of a log table, so a batch that is replayed after a failure
replaces its log instead of adding another.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.normalize import NORMALIZED, normalize_deliveries
from terrace.operators.quality import log_from_summary, quarantine_frame, route_bad, rule_summary, split_by_quality
from terrace.operators.sinks import materialize, replace_partitions, table_schema, upsert
from terrace.plans.medallion import LOOKUP_CONF, Layout, RunConfig, bronze_rows, silver_evaluate, silver_rows
from terrace.session import remove_path, session_conf
from terrace.sources.files import read_table, require_table
from terrace.streaming.ingest import file_stream, start_stream

LOG_PARTITION = ("_stream", "_micro_batch")


#: The state that drops copies lies on the executors' disks, in RocksDB: what it holds in memory is bounded (MB per
#: executor) however many rows it remembers.  A checkpoint that began with another store keeps that one.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",   # a lookup for each row put
}


IDENTITY = ("_identity_a", "_identity_b")


def row_identity(columns: Iterable[str]) -> dict[str, Column]:
    """128 bits that stand for the values of ``columns``, NULLs being values: two 64-bit hashes, which meet the
    columns in opposite orders.  Rows that differ in one column never share the first; of n different rows some
    two share both with a chance of about n ** 2 / 2 ** 129."""
    parts = [(F.col(c).isNull(), F.col(c)) for c in columns]    # a hash passes NULLs over, so each has its mark
    return {name: F.xxhash64(F.lit(seed), *[x for pair in order for x in pair])
            for seed, (name, order) in enumerate(zip(IDENTITY, (parts, parts[::-1])))}


def stream_quality_log(layout: Layout) -> str:
    return f"{layout.root}/shared/stream_quality_logs"


def stream_silver(spark: SparkSession, landing: str, layout: Layout, checkpoint: str, cfg: RunConfig = RunConfig(),
                  name: str = "silver", forget_after: str = "1 day", max_files_per_trigger: int | None = None,
                  available_now: bool = True, processing_time: str | None = None):
    """Stream ``cfg.deliveries`` from ``landing`` into silver, quarantine and the stream's quality log.

    Rows that agree in all data columns (NULL equals NULL) are one row.  The state that
    drops copies is keyed by them and bounded by the rows that arrive within ``forget_after``; arrival is the
    micro-batch's own time, which a replay repeats, so no row is ever late, whatever its date.  A key that
    comes with other values replaces its row in silver (NULL keys equal none); a quarantined row is kept once.
    Two different good rows with one key in one micro-batch raise.  As in the batch path without ``retract``,
    a row that turns bad stays in silver.  ``name`` tells the streams of one log table apart.

    Returns the ``StreamingQuery`` (already stopped in ``available_now`` mode).
    """
    spec = dataclasses.replace(cfg.deliveries, partition_by=cfg.partition_by, derived=cfg.derived)
    rules, tenants = cfg.effective_rules(), cfg.tenant_list()
    require_table(spark, layout.dimension, "dim_materials")
    rows = bronze_rows(file_stream(spark, landing, spec, max_files_per_trigger), spec, tenants, cfg.start, cfg.end)
    data = [c for c in rows.columns if c != "_source_file"]
    once = rows.withColumns({"_arrived": F.current_timestamp(), **row_identity(data)}).withWatermark("_arrived", forget_after)
    once = once.dropDuplicatesWithinWatermark(list(IDENTITY)).drop("_arrived", *IDENTITY)

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        dim = read_table(session, layout.dimension, schema=table_schema(session, layout.dimension))
        evaluated, cond = silver_evaluate(batch.drop("_source_file"), dim, rules, deduplicate=False)
        with session_conf(session, LOOKUP_CONF):
            staged, folder = materialize(session, evaluated.drop(*NORMALIZED), "stream-silver")
        staged = normalize_deliveries(staged).select(*evaluated.columns)     # cheaper than to shuffle and write them
        try:
            good, bad = split_by_quality(staged, cond, cfg.unknown)
            held, _ = route_bad(bad, rules, cfg.discard_rules, cfg.unknown)
            held = quarantine_frame(held, rules, cfg.discard_rules, cfg.unknown)
            log = log_from_summary(rule_summary(staged, rules, discard_rules=cfg.discard_rules, unknown=cfg.unknown), rules,
                                   f"{name}#{number}").withColumns({"_stream": F.lit(name), "_micro_batch": F.lit(number).cast("long")})
            with ThreadPoolExecutor(2) as pool:     # independent tables
                writes = [pool.submit(upsert, session, silver_rows(good), layout.fact, cfg.fact_keys(), cfg.partition_by,
                                      stage_source=False),
                          pool.submit(upsert, session, held, layout.quarantine, data, cfg.partition_by, null_safe=True,
                                      stage_source=False, check_duplicates=False)]
                for w in writes:
                    w.result()
            replace_partitions(log, stream_quality_log(layout), LOG_PARTITION)
        finally:
            remove_path(session, folder)

    # a scheduled stream has few and large micro-batches: a task closes its part of the state when it is done
    state = {**STATE_CONF, "spark.sql.streaming.stateStore.unloadOnCommit": str(available_now).lower()}
    return start_stream(once, write, checkpoint, available_now, processing_time, state)
