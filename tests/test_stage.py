"""What the silver stage holds, and how aggregates with hardly repeating keys are run."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrace.operators import repeats, sinks
from terrace.operators.normalize import NORMALIZED, normalize_deliveries
from terrace.plans import medallion as m
from terrace.plans import registry as reg
from terrace.session import UNIQUE_KEYS_CONF, scratch_path
from terrace.sources import fixtures
from terrace.sources.files import read_table

CONF, OFF = next(iter(UNIQUE_KEYS_CONF.items()))


@pytest.fixture
def landed(spark):
    """Bronze, with an undeclared column and one that has the name of a normalized one, and the dimension."""
    layout, cfg = m.Layout(scratch_path(spark, "lake")), reg._run_config()
    raw = fixtures.deliveries(spark, SF_SMALL).withColumns({
        "canal": F.concat(F.lit("c"), F.col("unidad")), "unidad_estandar": F.lit("from the source")})
    m.ingest(spark, fixtures.materials_raw(spark, SF_SMALL), cfg.materials, layout)
    m.build_dimension(spark, layout, cfg.materials)
    spec = dataclasses.replace(cfg.deliveries, partition_by=cfg.partition_by, derived=cfg.derived)
    m.ingest(spark, raw, spec, layout, cfg.tenants)
    return layout, cfg


def _silver(spark, layout):
    out = []
    for path in (layout.fact, layout.quarantine):
        df = read_table(spark, path, schema=sinks.table_schema(spark, path)).drop("_silver_timestamp", "_quarantine_timestamp")
        out.append((df.columns, sorted(map(str, df.collect()))))
    return out


def test_normalized_columns_are_not_staged_and_silver_is_the_same(spark, landed, monkeypatch):
    layout, cfg = landed
    staged = {}

    def spy(spark, df, name="stage"):
        staged[name] = df.columns
        return sinks.materialize(spark, df, name)

    monkeypatch.setattr(m, "materialize", spy)
    got = {}
    for stage in (True, False):
        here = dataclasses.replace(layout)
        monkeypatch.setattr(m.Layout, "fact", property(lambda self, s=stage: f"{self.root}/silver-{s}/fact"))
        monkeypatch.setattr(m.Layout, "quarantine", property(lambda self, s=stage: f"{self.root}/quarantine-{s}/fact"))
        res = m.build_fact(spark, here, cfg, stage=stage)
        got[stage] = (res.extra["counts"], _silver(spark, here))
    assert got[True] == got[False] and got[True][1][0][1] and got[True][1][1][1]
    assert {"unidad_estandar", "canal", "cantidad_normalizada_st"} <= set(got[True][1][0][0])
    assert not set(NORMALIZED) & set(staged["silver-evaluated"]) and "canal" in staged["silver-evaluated"]


def test_normalized_names_every_column_that_normalizing_makes(spark):
    df = fixtures.deliveries(spark, SF_SMALL)
    once = normalize_deliveries(df)
    assert set(once.columns) - set(df.columns) == set(NORMALIZED)
    again = normalize_deliveries(once.drop(*NORMALIZED))
    assert again.exceptAll(once).count() == 0 and once.exceptAll(again).count() == 0


def test_one_map_for_keys_that_hardly_repeat(spark, landed, monkeypatch):
    layout, cfg = landed
    seen = {}

    def spy(spark, df, name="stage"):
        seen[name] = spark.conf.get(CONF, None)
        return sinks.materialize(spark, df, name)

    def replaced(df, path, pb):
        seen["gold"] = df.sparkSession.conf.get(CONF, None)
        return sinks.replace_partitions(df, path, pb)

    monkeypatch.setattr(repeats, "materialize", spy)
    monkeypatch.setattr(m, "materialize", spy)
    monkeypatch.setattr(m, "replace_partitions", replaced)
    m.build_fact(spark, layout, cfg)
    m.build_metrics(spark, layout, cfg)
    assert (seen["repeats"], seen["silver-evaluated"], seen["gold"]) == (OFF, OFF, OFF)
    assert seen["silver-summary"] != OFF and spark.conf.get(CONF, None) != OFF
