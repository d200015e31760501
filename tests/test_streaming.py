"""The stream to silver on a small table: copies, changed rows, bad rows, replay."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from terrace.operators.sinks import overwrite
from terrace.plans import registry as reg
from terrace.plans.medallion import Layout, conform_dimension
from terrace.session import scratch_path
from terrace.sources import fixtures
from terrace.sources.files import MissingTableError, read_table
from terrace.streaming.silver import stream_quality_log, stream_silver

SF = "/root/testdata/sf0.001"


def test_copies_changes_bad_rows_and_replay(spark):
    layout = Layout(scratch_path(spark, "lake"))
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    cfg = dataclasses.replace(reg._run_config(), tenants=("asia",), partition_by=("_tenant_id",),
                              deliveries=dataclasses.replace(reg.FIXTURE_DELIVERIES, fmt="parquet"))
    schema = cfg.deliveries.schema
    like = dict(pais="ASIA", fecha_proceso=19970105, transporte=1, ruta=2, tipo_entrega="ZPRE", material=3, precio=5.0,
                cantidad=4.0, unidad="ST")

    def deliver(*rows):
        rows = [tuple({**like, **r}[f.name] for f in schema.fields) for r in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def state():
        fact = read_table(spark, layout.fact).select("transporte", "precio").collect()
        held = read_table(spark, layout.quarantine).select("transporte", "cantidad").collect()
        log = read_table(spark, stream_quality_log(layout)).where("check_name = 'cantidad_valida'")
        return sorted(map(tuple, fact)), sorted(map(tuple, held)), sum(r.records_checked for r in log.collect())

    deliver({}, {}, {"transporte": 2}, {"transporte": 3, "cantidad": -1.0}, {"pais": "EUROPE"})
    with pytest.raises(MissingTableError):
        stream_silver(spark, landing, layout, ckpt, cfg)
    overwrite(conform_dimension(fixtures.materials_raw(spark, SF)), layout.dimension)
    stream_silver(spark, landing, layout, ckpt, cfg)
    assert state() == ([(1, 5.0), (2, 5.0)], [(3, -1.0)], 3)     # copies are one, other tenants none
    # copies in a later file, a changed row, and a second bad row of one key
    deliver({}, {"transporte": 2, "precio": 7.0}, {"transporte": 3, "cantidad": -1.0}, {"transporte": 3, "cantidad": -2.0})
    stream_silver(spark, landing, layout, ckpt, cfg)
    want = ([(1, 5.0), (2, 7.0)], [(3, -2.0), (3, -1.0)], 5)
    assert state() == want
    reg.forget_last_commit(spark, ckpt)
    stream_silver(spark, landing, layout, ckpt, cfg)
    assert state() == want


def test_raw_files_grow_with_the_input(spark, monkeypatch):
    raw = reg.deliveries(spark, SF)
    assert reg._raw_files_of(raw) == 6 and reg._raw_files_of(raw, 2) == 2
    monkeypatch.setattr(reg, "RAW_BYTES", 2000)
    n = reg._raw_files_of(raw)
    assert n > 12 and n % 6 == 0
    landing = reg._write_raw(raw, "parquet")
    assert len(spark.read.parquet(landing).inputFiles()) == n


def test_the_identity_of_a_row_tells_nulls_and_swapped_values_apart(spark):
    from terrace.streaming.silver import IDENTITY, row_identity

    rows = [(None, "x", 1.0), ("x", None, 1.0), ("x", "x", None), (None, None, None), ("x", "y", 0.0), ("y", "x", 0.0), ("", None, 1.0)]
    df = spark.createDataFrame(rows * 2, "a string, b string, c double").withColumns(row_identity(["a", "b", "c"]))
    assert df.select(*IDENTITY).distinct().count() == df.select("a", *IDENTITY).distinct().count() == len(rows)


def test_the_state_lies_on_disk_and_ingest_writes_its_source_once(spark, monkeypatch):
    """The stream's state is not held in the executors' heap; a checked upsert keeps no copy of its source."""
    from terrace.operators import sinks
    from terrace.sources.files import path_exists
    from terrace.streaming.ingest import stream_ingest

    spec = dataclasses.replace(reg.FIXTURE_DELIVERIES, fmt="parquet", partition_by=("_tenant_id",))
    layout, landing = Layout(scratch_path(spark, "lake")), scratch_path(spark, "landing")
    raw = reg.deliveries(spark, SF)
    raw.coalesce(2).write.parquet(landing)
    overwrite(conform_dimension(fixtures.materials_raw(spark, SF)), layout.dimension)
    ckpt = scratch_path(spark, "ckpt")
    stream_silver(spark, landing, layout, ckpt, dataclasses.replace(
        reg._run_config(), tenants=reg.FIXTURE_TENANTS, partition_by=("_tenant_id",), deliveries=spec))
    offsets = spark.read.text(f"{ckpt}/offsets/0").collect()
    assert any("RocksDBStateStoreProvider" in r.value for r in offsets)

    written, plain = [], sinks.materialize
    monkeypatch.setattr(sinks, "materialize", lambda s, df, name="stage": written.append(name) or plain(s, df, name))
    sink, ckpt = layout.bronze("deliveries"), scratch_path(spark, "ckpt")
    stream_ingest(spark, landing, spec, sink, ckpt)
    raw.filter("ruta % 2 = 0").withColumn("precio", F.col("precio") + 1).coalesce(1).write.mode("append").parquet(landing)
    stream_ingest(spark, landing, spec, sink, ckpt)
    assert "merge-source" not in written and not path_exists(spark, sinks._pending(sink))
    table = read_table(spark, sink)
    once = raw.distinct()
    assert table.count() == once.count()
    want = once.agg(F.sum(F.col("precio").cast("decimal(20,2)") + (F.col("ruta") % 2 == 0).cast("int"))).first()[0]
    assert table.agg(F.sum(F.col("precio").cast("decimal(20,2)"))).first()[0] == want
