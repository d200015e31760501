"""Readers: raw files with a declared schema, layered tables, dependency guards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class MissingTableError(RuntimeError):
    """A required upstream table does not exist (dependency guard)."""


def csv_columns(spark: SparkSession, path: str | list[str], **options) -> list[str]:
    """Column names of a CSV header (the first line, without type inference)."""
    return spark.read.options(**{**options, "header": "true"}).csv(path).columns


def header_schema(columns: list[str], declared: T.StructType) -> T.StructType:
    """The declared types in the order of a file's header; names match whatever their case,
    columns that are not declared are strings."""
    known = {f.name.lower(): f for f in declared.fields}
    return T.StructType([T.StructField(known[c.lower()].name, known[c.lower()].dataType) if c.lower() in known
                         else T.StructField(c, T.StringType()) for c in columns])


def read_source(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                schema: T.StructType | None = None, infer: bool = False,
                corrupt: str | None = None, **options) -> DataFrame:
    """Scan raw files.

    CSV columns are taken by the names in the header: a declared ``schema``
    gives their types, whatever their order; columns that it does not name are
    kept as strings, columns that the file lacks are not made up.  Every file
    must have the header of the first one, else the scan raises.  ``infer``
    reproduces ``header=True, inferSchema=True`` reading, at the price of a
    pass over the data.  Self-describing formats keep their own columns.

    ``corrupt`` names a further column for CSV with a declared schema: the raw
    line where it has more or fewer values than the header, else NULL.  (Without
    it surplus values are cut and missing ones are NULL, and nobody is told.)
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
        if schema is not None:
            found = header_schema(csv_columns(spark, path, **options), schema)
            if corrupt:
                found = T.StructType([*found.fields, T.StructField(corrupt, T.StringType())])
                # a pruned scan would count only the values that it takes
                reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).option(
                    "columnPruning", "false")
            reader = reader.option("enforceSchema", "false").schema(found)
        elif infer:
            reader = reader.option("inferSchema", "true")
    elif schema is not None and fmt not in ("parquet", "orc"):
        reader = reader.schema(schema)
    return reader.load(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               merge_schema: bool = False) -> DataFrame:
    """Read a layered parquet table.

    Pass the table's ``schema`` whenever it is known: reading a hive-partitioned
    directory otherwise infers partition types (a string ``20250101`` comes
    back as int).  ``merge_schema`` unions the file schemas (appends that
    evolved the table).
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem API (no Spark job, no exception)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table: a data file, or a directory with at least
    one visible entry (a data file or a partition directory).

    One non-recursive listing of the table root, no Spark job.  Resolving the
    relation instead would list every partition directory and read a footer:
    on a table with tens of thousands of partitions that is a distributed
    listing job per check.  As in Spark's own file index, names starting with
    ``.`` and names starting with ``_`` without an ``=`` (``_SUCCESS``,
    staging folders, but not a partition ``_tenant_id=x``) are hidden, so the
    root left by an empty partitioned write is not a table.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True

    def visible(name: str) -> bool:
        return not (name.startswith(".") or (name.startswith("_") and "=" not in name))

    return any(visible(s.getPath().getName()) for s in fs.listStatus(p))


def require_table(spark: SparkSession, path: str, what: str = "table") -> None:
    if not table_exists(spark, path):
        raise MissingTableError(f"dependency not met: {what} does not exist at {path}")


def try_read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   merge_schema: bool = False) -> tuple[DataFrame | None, str | None]:
    """Missing-source tolerance: ``(df, None)`` or ``(None, reason)`` instead of raising."""
    if not path_exists(spark, path):
        return None, f"cannot read {path}: PATH_NOT_FOUND"
    try:
        df = read_table(spark, path, schema=schema, merge_schema=merge_schema)
        df.schema  # noqa: B018
        return df, None
    except AnalysisException as exc:
        return None, f"cannot read {path}: {exc.getCondition() or type(exc).__name__}"


def file_bytes(df: DataFrame) -> int | None:
    """Bytes of the files that ``df`` scans; None if it scans none, so that its size is unknown."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = df.inputFiles()
    if not files:
        return None
    total = 0
    for f in files:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total
