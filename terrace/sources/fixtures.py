"""Deterministic deliveries and materials views over the driver's TPC-H-like tables.

The driver's tables carry no deliveries, so two views map them onto the
pipeline's input schemas; every case the pipeline must handle (bad dates,
NULL types, negative quantities and prices, missing materials, open-ended
versions) occurs in them.  The same expressions appear as CTEs in the oracle
SQL (``terrace.plans.oracle``).

Scale notes: ``lineitem`` is the only large input.  ``nation`` (25 rows) and
``region`` (5 rows) have a size fixed by the TPC-H definition, so broadcasting
them is bounded; ``supplier`` grows with the scale factor: it is broadcast only
while its files are small, otherwise the join shuffles.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.config import DELIVERIES, MATERIALS, EntitySpec
from terrace.functions.columns import date_key
from terrace.sources.files import file_bytes

# Fixed values of the fixture mapping.
BAD_DATE_KEY = 20250230
BAD_DATE_EVERY = 211       # l_orderkey % 211 = 0 -> unparsable process date
NULL_TYPE_EVERY = 101      # l_orderkey % 101 = 0 -> NULL delivery type
NEGATIVE_PRICE_EVERY = 83  # l_partkey % 83 = 0 -> negated price
MISSING_PART_EVERY = 50    # p_partkey % 50 = 0 -> no catalog version
OPEN_END_EVERY = 75        # p_partkey % 75 = 1 -> valid_to NULL
TYPE_BY_FLAGS = (          # (l_returnflag, l_linestatus or None for any) -> tipo_entrega
    ("N", "F", "Z99"),
    ("N", "O", "Z05"),
    ("R", "O", "ZPRE"),
    ("R", "F", "ZVE1"),
    ("A", None, "Z04"),
)
OLD_VERSION = ("1900-01-01", "1998-06-30", "false")
NEW_VERSION = ("1998-07-01", "9999-12-31", "true")
NEW_PRICE_FACTOR = 1.1

SUPPLIER_FILE_BYTES = 8 << 20   # supplier files that may be sent to every executor


def _numeric_ids(spec: EntitySpec) -> EntitySpec:
    """The spec with the identifiers as the numbers that the driver's tables hold."""
    fields = [T.StructField(f.name, T.LongType() if f.name in ("transporte", "ruta", "material") else f.dataType)
              for f in spec.schema.fields]
    return dataclasses.replace(spec, schema=T.StructType(fields))


FIXTURE_DELIVERIES = _numeric_ids(DELIVERIES)
FIXTURE_MATERIALS = _numeric_ids(MATERIALS)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> region name.  nation/region are fixed-size (25 / 5 rows)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey)
            .select("s_suppkey", "r_name"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw deliveries (the pipeline's CSV schema), one row per lineitem."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    regions = supplier_regions(spark, sf_dir)
    size = file_bytes(table(spark, sf_dir, "supplier"))
    if size is not None and size <= SUPPLIER_FILE_BYTES:
        regions = F.broadcast(regions)
    joined = li.join(regions, li.l_suppkey == F.col("s_suppkey"))

    tipo = None
    for flag, status, code in TYPE_BY_FLAGS:
        cond = F.col("l_returnflag") == flag
        if status is not None:
            cond = cond & (F.col("l_linestatus") == status)
        tipo = F.when(cond, code) if tipo is None else tipo.when(cond, code)
    tipo = F.when(F.col("l_orderkey") % NULL_TYPE_EVERY == 0, F.lit(None).cast("string")) \
        .otherwise(tipo)

    # A generated column: the optimizer would copy its expression into every place of every filter that names it (the date
    # rule alone has twelve), in code too long to be compiled.
    day = F.when(F.col("l_orderkey") % BAD_DATE_EVERY == 0, F.lit(BAD_DATE_KEY)).otherwise(date_key("l_shipdate")).cast("int")
    return joined.select(
        F.col("r_name").alias("pais"),
        F.inline(F.array(F.struct(day.alias("fecha_proceso")))),
        F.col("l_orderkey").alias("transporte"),
        F.col("l_suppkey").alias("ruta"),
        tipo.alias("tipo_entrega"),
        F.col("l_partkey").alias("material"),
        F.when(F.col("l_partkey") % NEGATIVE_PRICE_EVERY == 0, -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("precio"),
        F.when(F.col("l_quantity") == 2, F.lit(None).cast("double"))
         .when(F.col("l_quantity") == 1, -F.col("l_quantity"))
         .otherwise(F.col("l_quantity")).alias("cantidad"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("CS")).otherwise(F.lit("ST")).alias("unidad"),
    )


def materials_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, untyped material catalog: two price versions per part (strings, like CSV)."""
    part = (table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
            .filter(F.col("p_partkey") % MISSING_PART_EVERY != 0))
    old = part.select(
        F.col("p_partkey").alias("material"),
        F.col("p_retailprice").cast("string").alias("precio_base"),
        F.lit(OLD_VERSION[0]).alias("valid_from"),
        F.lit(OLD_VERSION[1]).alias("valid_to"),
        F.lit(OLD_VERSION[2]).alias("is_current"),
    )
    new = part.select(
        F.col("p_partkey").alias("material"),
        (F.col("p_retailprice") * F.lit(NEW_PRICE_FACTOR)).cast("string").alias("precio_base"),
        F.lit(NEW_VERSION[0]).alias("valid_from"),
        F.when(F.col("p_partkey") % OPEN_END_EVERY == 1, F.lit(None).cast("string"))
         .otherwise(F.lit(NEW_VERSION[1])).alias("valid_to"),
        F.lit(NEW_VERSION[2]).alias("is_current"),
    )
    return old.unionByName(new)
