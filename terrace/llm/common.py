"""Helpers shared by the corpus operators: staged tables, text bytes, components."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "__llm_"


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a local folder is made, but only on a local master: on
    a cluster each executor would write its part to its own disk.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path and sc.getCheckpointDir():
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="terrace-llm-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of this application's own in the shared folder."""
    return f"{shared_folder(spark)}/terrace-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def clear_stages(spark: SparkSession) -> None:
    """Delete all that this application staged.  Results are lazy and read staged tables: call it when
    they have been written."""
    folder = new_path(spark, "x").rpartition("/")[0]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends
    in files that outlive any executor, and consumers do not recompute it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/terrace-llm/" in path:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def add_columns(df: DataFrame, inputs: list[str], new: dict[str, T.DataType],
                fn: Callable[[list[pa.Array]], list[pa.Array]]) -> DataFrame:
    """Append the columns that ``fn`` makes from Arrow arrays of the input columns.

    Columns of ``df`` that already have one of the new names are replaced; all
    others pass through.  One pass over the rows, no shuffle.
    """
    df = df.drop(*new)
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in new.items())])
    at = [df.columns.index(c) for c in inputs]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *fn([batch.column(i) for i in at])], names=names)

    narrow_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def narrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Before Python runs in tasks: whole texts travel in batches of at most ``rows`` rows, and the
    workers get this package's code, wherever they run and whatever their path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship_code(spark)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this subpackage's modules to the executors, once for an application."""
    sc = spark.sparkContext
    here = Path(__file__).resolve().parent
    if sc.applicationId in _shipped or not here.is_dir():  # not a folder: it came with --py-files
        return
    package = here.parent
    folder = tempfile.mkdtemp(prefix="terrace-code-")  # the driver serves it while the application runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{package.name}-{here.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in [package / "__init__.py", *sorted(here.glob("*.py"))]:
            out.write(f, f.relative_to(package.parent).as_posix())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def bytes_of(df: DataFrame, *columns: str) -> int:
    """Exact size of a table's string columns plus 64 bytes a row: what a broadcast of it would hold."""
    size: Column = F.lit(64)
    for c in columns:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])


#: Printable ASCII, line breaks and tabs, and the letters of Latin-1, as Latin-1 bytes.
PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *(b for b in range(0xC0, 0x100) if b not in (0xD7, 0xF7))])


def is_plain(text: str) -> bool:
    """Whether a text has plain characters alone, for which tokenizers' Unicode rules are simple."""
    try:
        return not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """True for the fold whose labels are never learned from; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % folds == 0


def parts_for(rows: float, rows_per_part: float, least: int = 1) -> int:
    return max(least, math.ceil(rows / rows_per_part))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: rows ``(node, root)``
    with the smallest node of the component, for every node of an edge.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond"): each is one aggregation with
    map-side combine and one join whose other side has a single row per key,
    so the edges of a hub are split over tasks.  Rounds grow with the
    logarithm of the component's size.  Every round ends in a staged table.
    """
    cur = stage(edges.where("a <> b")
                .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-edges")
    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(cur)
    while seen[0]:
        # u > v throughout
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.col("v").alias("x"), "m", "u")
        nxt = (small.where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v"))
               .union(low2.select("u", F.col("m").alias("v"))).distinct())
        nxt = stage(nxt, f"{name}-edges")
        now = mark(nxt)
        unstage(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
