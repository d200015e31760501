"""Jobs: ingest contract, multi-tenant run, idempotence, breaker, streaming restart."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from terrace.config import DELIVERIES
from terrace.operators.contract import ContractViolation, check_contract, entity_spec
from terrace.operators.quality import CriticalQualityError
from terrace.operators.sinks import DuplicateKeyError
from terrace.plans import medallion as m
from terrace.plans import registry as reg
from terrace.session import scratch_path
from terrace.sources import fixtures
from terrace.sources.fixtures import FIXTURE_DELIVERIES, FIXTURE_MATERIALS
from terrace.sources.files import MissingTableError, read_table, table_exists, try_read_table

from conftest import SF_SMALL


def test_contract_case_insensitive_and_unknown_entity(spark):
    df = spark.createDataFrame([("x", 1)], ["PAIS", "Fecha_Proceso"])
    assert check_contract(df, ["pais", "fecha_proceso", "material"]) == ["material"]
    with pytest.raises(ValueError):
        entity_spec("clientes")


def test_ingest_contract_violation(spark):
    layout = m.Layout(scratch_path(spark, "lake"))
    bad = fixtures.deliveries(spark, SF_SMALL).drop("fecha_proceso")
    res = m.ingest(spark, bad, FIXTURE_DELIVERIES, layout, on_violation="skip")
    assert res.status == "skipped" and "fecha_proceso" in res.reason
    with pytest.raises(ContractViolation):
        m.ingest(spark, bad, FIXTURE_DELIVERIES, layout, on_violation="raise")


def test_table_exists_lists_only_the_root(spark):
    base = scratch_path(spark, "exists")
    assert not table_exists(spark, base)
    df = spark.createDataFrame([("a", 1, 1.0)], "_tenant_id string, mes int, x double")
    df.write.partitionBy("_tenant_id", "mes").parquet(base + "/parted")   # root holds `_tenant_id=a`
    assert table_exists(spark, base + "/parted")
    df.limit(0).write.partitionBy("_tenant_id").parquet(base + "/empty")  # root holds only _SUCCESS
    assert not table_exists(spark, base + "/empty")
    df.write.parquet(base + "/flat")
    assert table_exists(spark, base + "/flat")


def test_missing_dimension_and_missing_source(spark):
    layout = m.Layout(scratch_path(spark, "lake"))
    with pytest.raises(MissingTableError):
        m.build_fact(spark, layout, m.RunConfig(tenants=("asia",)))
    df, why = try_read_table(spark, layout.fact)
    assert df is None and "PATH_NOT_FOUND" in why
    status = {(r.tenant, r.stage): r for r in
              m.run(spark, fixtures.deliveries(spark, SF_SMALL).drop("pais"),
                    fixtures.materials_raw(spark, SF_SMALL), layout, m.RunConfig(tenants=("asia",), deliveries=FIXTURE_DELIVERIES, materials=FIXTURE_MATERIALS)).collect()}
    assert status[("asia", "bronze_deliveries")].status == "skipped"
    assert status[("asia", "gold_daily_metrics")].reason == "bronze_deliveries skipped"


def _gold(spark, layout):
    return sorted(tuple(r) for r in read_table(spark, layout.gold).select(
        "_tenant_id", "fecha_proceso", "tipo_entrega", "total_units", "total_revenue",
        "active_routes", "active_transports").collect())


def test_single_job_equals_union_of_per_tenant_jobs(spark):
    cfg = reg._run_config()
    d, mat = fixtures.deliveries(spark, SF_SMALL), fixtures.materials_raw(spark, SF_SMALL)
    together = m.Layout(scratch_path(spark, "lake"))
    m.run(spark, d, mat, together, cfg)
    apart = m.Layout(scratch_path(spark, "lake"))
    for t in ("asia", "europe"):
        m.run(spark, d, mat, apart, dataclasses.replace(cfg, tenants=(t,)))
    g = [r for r in _gold(spark, together) if r[0] in ("asia", "europe")]
    assert g == _gold(spark, apart)


def test_rerun_is_idempotent_for_every_layer(spark):
    cfg = reg._run_config()
    d, mat = fixtures.deliveries(spark, SF_SMALL), fixtures.materials_raw(spark, SF_SMALL)
    layout = m.Layout(scratch_path(spark, "lake"))
    m.run(spark, d, mat, layout, cfg)
    snap = {p: read_table(spark, p).drop(*[c for c in read_table(spark, p).columns
                                            if c in ("_silver_timestamp", "_quarantine_timestamp",
                                                     "_ingestion_timestamp", "_batch_id")]).count()
            for p in (layout.bronze("deliveries"), layout.fact, layout.quarantine, layout.gold, layout.dimension)}
    m.run(spark, d, mat, layout, cfg)
    for p, n in snap.items():
        assert read_table(spark, p).count() == n, p
    assert read_table(spark, layout.fact).count() == 4456
    assert read_table(spark, layout.quarantine).count() == 440
    log = read_table(spark, layout.quality_log)
    assert log.select("_run_id").distinct().count() == 2 and log.count() == 2 * 5 * 5


def test_breaker_blocks_gold_per_tenant(spark):
    status = {(r.tenant, r.stage): r for r in reg.run_status_breaker(spark, SF_SMALL).collect()}
    assert status[("america", "gold_daily_metrics")].status == "ok"
    assert status[("europe", "gold_daily_metrics")].status == "blocked"
    assert status[("ec", "bronze_deliveries")].status == "skipped"


def test_stream_and_batch_take_turns_on_one_table(spark):
    df = reg.stream_ingest_state(spark, SF_SMALL)
    assert df.count() == 6000
    assert df.groupBy("_tenant_id").count().count() == 5


def test_stream_checks_the_contract_and_the_header(spark):
    from terrace.streaming.ingest import stream_ingest
    lake, ckpt = scratch_path(spark, "lake"), scratch_path(spark, "ckpt")
    spec = dataclasses.replace(DELIVERIES, required_columns=("pais", "planta"))
    with pytest.raises(ContractViolation):
        stream_ingest(spark, lake, spec, lake + "/t", ckpt)
    landing = scratch_path(spark, "landing")
    spark.createDataFrame([("EC", "20250101")], "pais string, planta string").write.option("header", "true").csv(landing)
    with pytest.raises(Exception, match="(?i)header"):
        stream_ingest(spark, landing, DELIVERIES, lake + "/t", ckpt)
    assert not table_exists(spark, lake + "/t")


def _csv(spark, text, folder=None):
    folder = folder or scratch_path(spark, "csv")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").option("lineSep", "\n").text(folder)
    return folder


HEADER = "pais,fecha_proceso,transporte,ruta,tipo_entrega,material,precio,cantidad,unidad"


def test_csv_by_header_extra_columns_and_text_ids(spark):
    raw = _csv(spark, "canal,cantidad,PRECIO,material,ruta,transporte,fecha_proceso,pais,tipo_entrega\n"
                      "web,2,1.5,SKU1,R02,T01,20250110,EC,ZPRE\nshop,x,oops,MAT7,007,T02,20250111,EC,Z04")
    layout = m.Layout(scratch_path(spark, "lake"))
    res = m.ingest(spark, raw, DELIVERIES, layout, ["ec"])
    assert res.status == "ok" and res.rows == {"ec": 2} and res.reason == "unparsable values: cantidad 1, precio 1"
    rows = {r["material"]: r for r in read_table(spark, layout.bronze("deliveries")).collect()}
    assert set(rows) == {"SKU1", "MAT7"}
    r = rows["SKU1"]
    assert (r["canal"], r["cantidad"], r["precio"], r["ruta"], r["transporte"], r["_tenant_id"], r["unidad"]) == (
        "web", 2.0, 1.5, "R02", "T01", "ec", None)
    assert rows["MAT7"]["ruta"] == "007" and rows["MAT7"]["precio"] is None


def test_csv_without_a_required_column_and_mixed_headers(spark):
    layout = m.Layout(scratch_path(spark, "lake"))
    bad = _csv(spark, "fecha_proceso,material\n20250101,a")
    with pytest.raises(ContractViolation, match="pais"):
        m.ingest(spark, bad, DELIVERIES, layout, on_violation="raise")
    assert m.ingest(spark, bad, DELIVERIES, layout, on_violation="skip").status == "skipped"
    assert not table_exists(spark, layout.bronze("deliveries"))
    mixed = _csv(spark, HEADER + "\nEC,20250101,1,1,ZPRE,a,1,1,ST")
    _csv(spark, "fecha_proceso,pais,transporte,ruta,tipo_entrega,material,precio,cantidad,unidad\n20250101,EC,1,1,ZPRE,a,1,1,ST", mixed)
    with pytest.raises(Exception, match="(?i)header"):
        m.ingest(spark, mixed, DELIVERIES, layout)


CATALOG = "material,precio_base,valid_from,valid_to,is_current\nSKU1,10,2024-01-01,9999-12-31,true\n"


def _day_rows(days, price=5, tenant="EC", transport="t"):
    return HEADER + "\n" + "\n".join(
        f"{tenant},{d},{transport}{i},r,{k},SKU1,{price},{q},ST" for i, d in enumerate(days)
        for k, q in (("ZPRE", 3), ("Z04", -1)))


@pytest.mark.parametrize("layout_by", [("_tenant_id", "fecha_proceso"), ("_tenant_id", "mes")])
def test_range_rerun_replaces_only_its_days(spark, layout_by):
    days = [20250101, 20250115, 20250120, 20250131, 20250203]
    cfg = m.RunConfig(tenants=("ec",), partition_by=layout_by, derived=(reg.MONTH,) if "mes" in layout_by else ())
    layout = m.Layout(scratch_path(spark, "lake"))
    catalog = _csv(spark, CATALOG)
    m.run(spark, _csv(spark, _day_rows(days)), catalog, layout, cfg)
    status = m.run(spark, _csv(spark, _day_rows(days, price=7)), catalog, layout,
                   dataclasses.replace(cfg, start="2025-01-15", end="2025-01-20"))
    assert {r["status"] for r in status.collect() if r["stage"] in ("bronze_deliveries", "gold_daily_metrics")} == {"ok"}
    again = (20250115, 20250120)
    for path, price, n in ((layout.bronze("deliveries"), "precio", 2), (layout.fact, "precio", 1), (layout.quarantine, "precio", 1)):
        got = sorted((r["fecha_proceso"], r[price]) for r in read_table(spark, path).collect())
        assert got == sorted((d, 7.0 if d in again else 5.0) for d in days for _ in range(n)), path
    gold = {r["fecha_proceso"]: r["total_revenue"] for r in read_table(spark, layout.gold).collect()}
    assert gold == {d: 21.0 if d in again else 15.0 for d in days}


def _by(status):
    return {(r["tenant"], r["stage"]): r for r in status.collect()}


def test_a_tenant_with_duplicate_keys_fails_alone(spark):
    rows = _day_rows([20250101], tenant="EC") + "\n" + _day_rows([20250101], tenant="HN").split("\n", 1)[1]
    rows += "\nEC,20250101,t0,r,ZPRE,SKU1,9,3,ST"
    cfg = m.RunConfig(tenants=("ec", "hn"))
    layout = m.Layout(scratch_path(spark, "lake"))
    got = _by(m.run(spark, _csv(spark, rows), _csv(spark, CATALOG), layout, cfg))
    assert got[("ec", "silver_fact_deliveries")].status == "failed" and "t0" in got[("ec", "silver_fact_deliveries")].reason
    assert got[("ec", "gold_daily_metrics")].status == "skipped"
    assert got[("hn", "silver_fact_deliveries")].status == got[("hn", "gold_daily_metrics")].status == "ok"
    assert [r["_tenant_id"] for r in read_table(spark, layout.gold).collect()] == ["hn"]
    with pytest.raises(DuplicateKeyError):
        m.run(spark, _csv(spark, rows), _csv(spark, CATALOG), m.Layout(scratch_path(spark, "lake")),
              dataclasses.replace(cfg, fail_fast=True))


def test_a_stage_that_breaks_is_run_tenant_by_tenant(spark, monkeypatch):
    rows = _day_rows([20250101], tenant="EC") + "\n" + _day_rows([20250101], tenant="HN").split("\n", 1)[1]
    build = m.build_metrics

    def breaks(spark_, layout, cfg, blocked=()):
        if "hn" in cfg.tenant_list():
            raise OSError("x" * 700)
        return build(spark_, layout, cfg, blocked)
    monkeypatch.setattr(m, "build_metrics", breaks)
    got = _by(m.run(spark, _csv(spark, rows), _csv(spark, CATALOG), m.Layout(scratch_path(spark, "lake")),
                    m.RunConfig(tenants=("ec", "hn"))))
    assert got[("ec", "gold_daily_metrics")].status == "ok"
    assert got[("hn", "gold_daily_metrics")].status == "failed" and "x" * 700 in got[("hn", "gold_daily_metrics")].reason


def test_breaker_raises_with_fail_fast_and_can_be_per_tenant(spark):
    rows = _day_rows([20250101], tenant="EC", price=-1) + "\n" + _day_rows([20250101], tenant="HN", price=-1).split("\n", 1)[1]
    rows += "\n" + "\n".join(x.replace(",t", ",u") for t in ("EC", "HN") for x in _day_rows([20250101], tenant=t).split("\n")[1:])
    raw, catalog = _csv(spark, rows), _csv(spark, CATALOG)
    cfg = m.RunConfig(tenants=("ec", "hn"), fail_on_critical=("HN",))
    got = _by(m.run(spark, raw, catalog, m.Layout(scratch_path(spark, "lake")), cfg))
    assert got[("hn", "gold_daily_metrics")].status == "blocked" and got[("ec", "gold_daily_metrics")].status == "ok"
    with pytest.raises(CriticalQualityError, match="hn"):
        m.run(spark, raw, catalog, m.Layout(scratch_path(spark, "lake")), dataclasses.replace(cfg, fail_fast=True))
    from terrace.__main__ import main
    from terrace.session import apply_conf
    code = main(["--deliveries", raw, "--materials", catalog, "--root", scratch_path(spark, "lake"), "--tenants", "ec,hn",
                 "--fail-on-critical"])
    apply_conf(spark)
    assert code == 1


def test_gold_reports_operands_that_it_rounds(spark):
    raw = _csv(spark, HEADER + "\nEC,20250101,t,r,ZPRE,SKU1,1.999,0.125,ST\nEC,20250101,u,r,ZPRE,SKU1,1000,0.004,ST")
    layout = m.Layout(scratch_path(spark, "lake"))
    cfg = m.RunConfig(tenants=("ec",))
    got = _by(m.run(spark, raw, _csv(spark, CATALOG), layout, cfg))
    gold = read_table(spark, layout.gold).first()
    assert (gold["total_units"], gold["total_revenue"]) == (0.129, 4.249875)
    assert got[("ec", "gold_daily_metrics")].reason is None
    res = m.build_metrics(spark, layout, dataclasses.replace(cfg, money_type="decimal(18,2)"))
    assert res.reason == "2 rows with operands that decimal(18,2) rounds"


def test_approximate_distinct_counts_are_close(spark):
    from terrace.operators.metrics import daily_metrics
    df = spark.range(0, 60000).select(F.lit("a").alias("_tenant_id"), (F.col("id") % 20000).alias("ruta"),
                                      F.col("id").alias("transporte"), F.lit(1.0).alias("cantidad_normalizada_st"),
                                      F.lit(1.0).alias("precio"))
    r = daily_metrics(df, ["_tenant_id"], approx=True).first()
    assert abs(r["active_routes"] / 20000 - 1) < 0.15 and abs(r["active_transports"] / 60000 - 1) < 0.15


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from terrace.session import shared_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="yarn", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_lineage_columns(spark):
    raw = reg._raw_files(spark, SF_SMALL, "parquet")
    spec = dataclasses.replace(FIXTURE_DELIVERIES, fmt="parquet")
    b = m.bronze_frame(spark, raw, spec, tenants=["ASIA"])
    row = b.select("_source_file", "_batch_id", "_ingestion_timestamp", "_tenant_id").first()
    assert row["_source_file"].endswith(".parquet") and row["_tenant_id"] == "asia"
    assert b.select(F.count_distinct("_batch_id")).first()[0] == 1


def test_date_range_run_prunes_months_and_keeps_others(spark, capsys):
    cfg = dataclasses.replace(reg._run_config(), tenants=("asia",), start="1996-01-15", end="1996-03-31")
    layout = m.Layout(scratch_path(spark, "lake"))
    m.run(spark, fixtures.deliveries(spark, SF_SMALL), fixtures.materials_raw(spark, SF_SMALL), layout, cfg)
    silver = read_table(spark, layout.fact)
    got = silver.agg(F.min("fecha_proceso"), F.max("fecha_proceso"), F.count(F.lit(1))).first()
    ev, cond = reg.evaluated(spark, SF_SMALL)
    want = ev.filter(cond & (F.col("_tenant_id") == "asia")
                     & F.col("fecha_proceso").between(19960115, 19960331)).count()
    assert got[0] >= 19960115 and got[1] <= 19960331 and got[2] == want
    bronze = read_table(spark, layout.bronze("deliveries"))
    cfg.select_dates(bronze).explain()
    scan = [line for line in capsys.readouterr().out.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(mes" in scan and "(mes#" in scan and ">= 199601" in scan


def test_read_source_with_inference(spark):
    path = reg._raw_files(spark, SF_SMALL, "csv")
    from terrace.sources.files import read_source
    inferred = read_source(spark, path, "csv", infer=True)
    assert dict(inferred.dtypes)["fecha_proceso"] == "int"
    declared = read_source(spark, path, "csv", schema=DELIVERIES.schema)
    assert declared.count() == 6000


def test_command_line_run_over_raw_csv(spark):
    import subprocess
    import sys as _sys
    deliveries_csv = reg._raw_files(spark, SF_SMALL, "csv")
    materials_csv = scratch_path(spark, "raw-materials")
    fixtures.materials_raw(spark, SF_SMALL).write.option("header", "true").csv(materials_csv)
    root = scratch_path(spark, "lake")
    out = subprocess.run(
        [_sys.executable, "-m", "terrace", "--deliveries", deliveries_csv, "--materials", materials_csv,
         "--root", root, "--tenants", "Asia,europe", "--month-partitions", "--start", "1996-01-01"],
        cwd=reg.__file__.rsplit("/terrace/", 1)[0], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line.split() for line in out.stdout.splitlines()]
    gold = {line[0]: line for line in lines if len(line) > 2 and line[1] == "gold_daily_metrics"}
    assert set(gold) == {"asia", "europe"} and all(v[2] == "ok" for v in gold.values())
    silver = read_table(spark, m.Layout(root).fact)
    assert silver.filter(F.col("fecha_proceso") < 19960101).count() == 0
    assert sorted(r[0] for r in silver.select("_tenant_id").distinct().collect()) == ["asia", "europe"]


def test_a_stage_that_breaks_once_logs_once(spark, monkeypatch):
    """The silver upsert breaks at its first try and the retry runs tenant by tenant: one log of each tenant."""
    layout = m.Layout(scratch_path(spark, "lake"))
    cfg = reg._run_config(log_partition_by=("tenant_id", m.LOG_DATE))
    cfg = dataclasses.replace(cfg, tenants=("asia", "europe"))
    upsert, calls = m.upsert, []

    def flaky(spark, df, path, *args, **kw):
        if path == layout.fact:
            calls.append(path)
            if len(calls) == 1:
                raise OSError("lost once")
        return upsert(spark, df, path, *args, **kw)

    monkeypatch.setattr(m, "upsert", flaky)
    status = m.run(spark, fixtures.deliveries(spark, SF_SMALL), fixtures.materials_raw(spark, SF_SMALL), layout, cfg).collect()
    assert {r["status"] for r in status if r["stage"] == "silver_fact_deliveries"} == {"ok"} and len(calls) == 3
    log = read_table(spark, layout.quality_log).groupBy("tenant_id").agg(
        F.count_distinct("_run_id").alias("runs"), F.count("*").alias("n"), F.count_distinct("executed_date").alias("days"))
    assert {(r["tenant_id"], r["runs"], r["n"], r["days"]) for r in log.collect()} == {("asia", 1, 5, 1), ("europe", 1, 5, 1)}


def test_malformed_lines_are_counted_kept_or_left_out(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n,,\n")
    (tmp_path / "b.csv").write_text("a,b,c\n7,8,9\n")
    spec = dataclasses.replace(DELIVERIES, name="lines", required_columns=("a",), tenant_column=None, date_column=None, partition_by=(),
                               schema=m.T.StructType([m.T.StructField(c, m.T.LongType()) for c in "abc"]))
    for mode, rows in (("keep", {(1, 2, 3), (4, 5, None), (6, 7, 8), (None, None, None), (7, 8, 9)}),
                       ("quarantine", {(1, 2, 3), (None, None, None), (7, 8, 9)})):
        layout = m.Layout(scratch_path(spark, "lake"))
        res = m.ingest(spark, str(tmp_path), spec, layout, malformed=mode)
        assert res.reason == "malformed lines: 2 in 1 files"
        assert {(r.a, r.b, r.c) for r in read_table(spark, layout.bronze("lines")).collect()} == rows
        assert table_exists(spark, layout.malformed("lines")) == (mode == "quarantine")
    assert {r.line for r in read_table(spark, layout.malformed("lines")).collect()} == {"4,5", "6,7,8,9"}
    with pytest.raises(ValueError):
        m.ingest(spark, str(tmp_path), spec, layout, malformed="other")


def test_gold_of_extreme_operands(spark):
    """An operand beyond the decimals, an infinite one and NaN give double sums for their groups only."""
    rows = [("x", 1, "A", 1e12, 2.0, 1, 1), ("x", 1, "A", 1.0, 2.0, 2, 2), ("x", 2, "A", float("nan"), 1.0, 1, 1),
            ("x", 2, "A", 1.0, 1.0, 1, 1), ("x", 3, "A", float("inf"), 1.0, 1, 1), ("x", 4, "A", 0.1, 0.2, 1, 1),
            ("x", 4, "A", 0.2, None, 1, 1), ("x", 5, "A", None, None, 1, 1)]
    df = spark.createDataFrame(rows, "_tenant_id string, fecha_proceso int, tipo_entrega string, cantidad_normalizada_st double, "
                                     "precio double, ruta int, transporte int")
    got = {r["fecha_proceso"]: (r["total_units"], r["total_revenue"]) for r in m.gold_frame(df, ()).collect()}
    assert got[1] == (1e12 + 1, 2e12 + 2) and got[3] == (float("inf"), float("inf"))
    assert all(x != x for x in got[2]) and got[4] == (0.3, 0.02) and got[5] == (None, None)


def test_retraction_reaches_every_layer(spark):
    """A month whose rows all turn bad leaves silver and gold; when they are mended, quarantine is cleared."""
    layout = m.Layout(scratch_path(spark, "lake"))
    raw, catalog = fixtures.deliveries(spark, SF_SMALL).filter("pais = 'ASIA'"), fixtures.materials_raw(spark, SF_SMALL)
    cfg = dataclasses.replace(reg._run_config(retract=True), tenants=("asia",))
    month = F.expr(reg.MONTH[1]) == 199602

    def rows(path):
        return read_table(spark, path).filter("mes = 199602").count()
    bad = raw.withColumn("cantidad", F.when(month, F.lit(-1.0)).otherwise(F.col("cantidad")))
    good = raw.withColumn("cantidad", F.when(month, F.lit(5.0)).otherwise(F.col("cantidad"))).withColumn(
        "precio", F.abs("precio")).filter("material % 50 <> 0")
    seen = []
    for df in (good, bad, good):
        m.run(spark, df, catalog, layout, cfg)
        seen.append([rows(layout.fact), rows(layout.quarantine), rows(layout.gold)])
    assert seen[0] == seen[2] and seen[0][0] and not seen[0][1] and seen[0][2]
    assert seen[1][0] == 0 and seen[1][1] and seen[1][2] == 0
