"""

Prints one JSON object.  ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1),
``$BENCH_CPUS`` (default 8).  Every timing fully evaluates its result (noop
sink or a table write).
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from terrace.operators.sinks import replace_partitions, upsert  # noqa: E402
from terrace.operators.temporal import point_in_time_join  # noqa: E402
from terrace.operators.normalize import normalize_deliveries  # noqa: E402
from terrace.plans import medallion as m  # noqa: E402
from terrace.plans import registry as reg  # noqa: E402
from terrace.session import build_session, scratch_path  # noqa: E402
from terrace.sources import fixtures  # noqa: E402


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", 2 * cpus, app_name="terrace-measure")
    out: dict = {"sf_dir": sf, "master": f"local[{cpus}]", "spark": spark.version,
                 "shuffle_partitions": 2 * cpus}

    # gold_daily_metrics: median of 5 after one warm-up.
    noop(reg.gold_daily_metrics(spark, sf))
    out["gold_daily_metrics_median5"] = statistics.median(
        timed(lambda: noop(reg.gold_daily_metrics(spark, sf))) for _ in range(5))

    # point-in-time join strategies.
    fact = normalize_deliveries(reg.bronze(spark, sf))
    dim = reg.dimension(spark, sf).select("material", "valid_from", "valid_to", "precio_base")
    cols = {"precio_base": "precio_catalogo_unitario"}
    pit = {}
    variants = {
        "broadcast_by_file_size": ({}, {}),
        "adaptive": ({"broadcast_bytes": 0}, {}),
        "sort_merge": ({"broadcast_bytes": 0}, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}),
        "salted_8_sort_merge": ({"salt": 8, "broadcast_bytes": 0}, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}),
    }
    for name, (kw, conf) in variants.items():
        old = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        q = point_in_time_join(fact, dim, ["material"], "fecha_proceso_dt", columns=cols, **kw)
        noop(q)
        pit[name] = statistics.median(timed(lambda: noop(q)) for _ in range(3))
        for k, v in old.items():
            spark.conf.set(k, v)
    out["point_in_time_join"] = pit

    # build_fact: staged intermediate vs recomputed per consumer.
    cfg = reg._run_config()
    d, mat = fixtures.deliveries(spark, sf), fixtures.materials_raw(spark, sf)
    facts = {}
    for stage in (True, False):
        layout = m.Layout(scratch_path(spark, "measure-lake"))
        m.ingest(spark, mat, cfg.materials, layout)
        m.build_dimension(spark, layout, cfg.materials)
        spec = dataclasses.replace(cfg.deliveries, partition_by=cfg.partition_by, derived=cfg.derived)
        m.ingest(spark, d, spec, layout, cfg.tenants)
        facts["staged" if stage else "recomputed"] = timed(lambda: m.build_fact(spark, layout, cfg, stage=stage))
    out["build_fact"] = facts

    # replace_partitions and upsert with 1 %, 10 %, 100 % of the (tenant, month) partitions touched.
    good = reg._good_monthly(spark, sf)
    base_path = scratch_path(spark, "measure-base")
    replace_partitions(good, base_path, reg.MONTH_LAYOUT)
    base = spark.read.parquet(base_path)
    months = sorted(r[0] for r in base.select("mes").distinct().collect())
    sinks = {}
    for pct in (1, 10, 100):
        chosen = months[: max(1, round(len(months) * pct / 100))]
        batch = good.filter(F.col("mes").isin(chosen)).withColumn("precio", F.col("precio") + 1)
        rp = scratch_path(spark, "measure-rp")
        replace_partitions(good, rp, reg.MONTH_LAYOUT)
        sinks[f"replace_partitions_{pct}pct"] = timed(lambda: replace_partitions(batch, rp, reg.MONTH_LAYOUT))
        up = scratch_path(spark, "measure-up")
        upsert(spark, good, up, list(m.FACT_KEYS) + ["mes"], reg.MONTH_LAYOUT)
        sinks[f"upsert_{pct}pct"] = timed(
            lambda: upsert(spark, batch, up, list(m.FACT_KEYS) + ["mes"], reg.MONTH_LAYOUT))
    out["sinks"] = sinks

    # whole run: all tenants in one job vs one job per tenant.
    one = m.Layout(scratch_path(spark, "measure-run"))
    runs = {"one_job_all_tenants": timed(lambda: m.run(spark, d, mat, one, cfg).collect())}
    each = m.Layout(scratch_path(spark, "measure-run"))
    runs["one_job_per_tenant"] = timed(lambda: [
        m.run(spark, d, mat, each, dataclasses.replace(cfg, tenants=(t,))).collect()
        for t in reg.FIXTURE_TENANTS])
    out["run"] = runs
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
