"""Incremental bronze ingest with Structured Streaming.

New raw files in a landing folder are picked up by a file-source stream; each
micro-batch goes through the same steps and the same sink as the batch path
(contract, date range, tenants, lineage, upsert), in ``foreachBatch``.  The
bronze table stays a plain table: streams and batch loads can take turns on
it, and a file that is delivered again, under whatever name, updates its rows
instead of doubling them.  The checkpoint skips files that were processed; a
batch that is replayed after a failure gives the same table, as the upsert is
idempotent.  ``trigger(availableNow=True)`` processes everything present and
stops, so the same code serves scheduled and continuous runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.config import FACT_KEYS, EntitySpec
from terrace.operators.contract import ContractViolation, check_contract, entity_spec
from terrace.operators.repeats import Repeats
from terrace.operators.sinks import upsert
from terrace.plans.medallion import bronze_rows
from terrace.session import CLEAN_CONF, remove_path, session_conf


def file_stream(spark: SparkSession, landing: str, spec: EntitySpec, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of raw rows with their ``_source_file``; the declared schema must hold the contract."""
    missing = check_contract(spark.createDataFrame([], spec.schema), spec.required_columns)
    if missing:
        raise ContractViolation(spec.name, missing)
    reader = spark.readStream.format(spec.fmt).schema(spec.schema).options(**spec.options)
    if spec.fmt == "csv":
        reader = reader.option("header", "true").option("enforceSchema", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).withColumn("_source_file", F.col("_metadata.file_path"))


def start_stream(source: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None, conf: dict | None = None):
    """Start ``write`` on every micro-batch; with ``available_now`` block until the backlog is done.

    The stream takes a copy of the session's settings when it starts, with those in ``conf``.
    """
    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with session_conf(source.sparkSession, {**CLEAN_CONF, **(conf or {})}):
        query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stream_ingest(spark: SparkSession, landing: str, spec: EntitySpec | str, sink: str,
                  checkpoint: str, tenants: Iterable[str] | None = None, start: str | None = None,
                  end: str | None = None, max_files_per_trigger: int | None = None,
                  batch_id: str | None = None, available_now: bool = True,
                  processing_time: str | None = None, keys: Iterable[str] = FACT_KEYS):
    """Start the stream; with ``available_now`` block until the backlog is ingested.

    ``keys`` identify a row (NULL equals NULL); a later delivery of a key
    replaces the earlier one.  Rows of one micro-batch that agree in all data
    columns are one row, two different ones with one key raise.  A stream
    needs a declared schema: files that lack a required column, or whose CSV
    header differs from it, raise.

    Returns the ``StreamingQuery`` (already stopped in ``available_now`` mode).
    """
    spec = entity_spec(spec)
    source = file_stream(spark, landing, spec, max_files_per_trigger)
    keys = [*keys, *(c for c in spec.partition_by if c not in keys)]
    tenants = None if tenants is None else list(tenants)

    def land(batch: DataFrame, number: int) -> None:
        rows = bronze_rows(batch, spec, tenants, start, end)
        data = [c for c in rows.columns if c != "_source_file"]
        # the smallest string of a group has all rows sorted, so only rows that may have copies are grouped
        repeats = Repeats(batch.sparkSession, rows, data, "_tenant_id")
        try:
            once = repeats.dedup(rows, lambda some: some.groupBy(*data).agg(F.min("_source_file").alias("_source_file")))
            once = once.withColumns({"_ingestion_timestamp": F.current_timestamp(),
                                     "_batch_id": F.lit(batch_id or f"{checkpoint}#{number}")})
            upsert(batch.sparkSession, once.select(*data, "_source_file", "_ingestion_timestamp", "_batch_id"), sink, keys,
                   spec.partition_by, null_safe=True, stage_source=False)     # its rows are read once
        finally:
            remove_path(batch.sparkSession, repeats.path)

    return start_stream(source, land, checkpoint, available_now, processing_time)
