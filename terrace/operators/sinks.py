"""Idempotent table writes on plain parquet: full load, partition replace, slice
replace, prefix replace, append, upsert, and a staged (lineage-cutting) materialization.

Parquet has no transaction log, so a write is not atomic.  Writes that merge
old rows into new files (``upsert``, ``replace_slices``) first stage the whole
merged partitions beside the table and remove the stage only after the commit:
if a commit breaks, :func:`recover` (or the next such write) replays it, and no
row is lost.  The other writes are repaired by running them again.  These
functions are the seam where a table format with ACID commits can be swapped in.

Every table carries its columns in a hidden file (the union over all writes),
so a later write never has to guess them from some data file, and columns that
only some files have survive a rewrite.

Every partitioned write goes through a ``REBALANCE`` on the partition
columns: AQE then sizes the write tasks (splitting a hot partition value over
several tasks, merging small ones), instead of one task per partition value
or one file per task and value.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import remove_path, scratch_path
from terrace.sources.files import path_exists, read_table, table_exists

SCHEMA_FILE = "_table_schema.json"   # hidden from readers, as all names with a leading "_"
DUPLICATE = "duplicate upsert key "


class DuplicateKeyError(ValueError):
    """Several source rows share one upsert key."""


def _prepare(df: DataFrame, partition_by: Iterable[str] | None) -> DataFrame:
    pb = list(partition_by or [])
    return df.hint("rebalance", *pb) if pb else df


def _write(df: DataFrame, path: str, mode: str, partition_by: Iterable[str] | None,
           dynamic: bool = False):
    pb = list(partition_by or [])
    w = _prepare(df, pb).write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if pb:
        w = w.partitionBy(*pb)
    w.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_schema(spark: SparkSession, path: str, schema: T.StructType, partition_by: Iterable[str] | None = None,
                 emptied: Iterable[str] = (), laid_out: bool = False) -> None:
    """Note a table's columns and partition columns beside its files (written aside, then renamed).

    ``emptied``: partition folders that a staged commit still has to remove; ``laid_out``: its files lie in
    the folders of their partitions.
    """
    note = {**schema.jsonValue(), "partition_by": None if partition_by is None else list(partition_by),
            "emptied": list(emptied), "laid_out": laid_out}
    fs, target = _hadoop(spark, f"{path}/{SCHEMA_FILE}")
    _, part = _hadoop(spark, f"{path}/{SCHEMA_FILE}.new")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(note).encode("utf-8")))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot write {target}")


def read_note(spark: SparkSession, path: str) -> dict | None:
    """A table's note: its columns, ``partition_by`` (None: not noted) and ``emptied``; None if there is none."""
    fs, p = _hadoop(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The noted columns of a table; None if it was not written by this module."""
    note = read_note(spark, path)
    return None if note is None else T.StructType.fromJson(note)


def table_layout(spark: SparkSession, path: str, given: Iterable[str] | None = None) -> list[str]:
    """The partition columns of a table: as noted, else as given.  A given layout that differs from the note raises."""
    noted = (read_note(spark, path) or {}).get("partition_by")
    if noted is None:
        return list(given or [])
    if given is not None and list(given) != noted:
        raise ValueError(f"{path} is partitioned by {noted}, not by {list(given)}")
    return noted


def _union(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Columns of both; a column of both has the new type."""
    types = {f.name.lower(): f.dataType for f in new.fields}
    fields = [T.StructField(f.name, types.get(f.name.lower(), f.dataType)) for f in (old.fields if old else [])]
    names = {f.name.lower() for f in fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in names])


def table_schema(spark: SparkSession, path: str, like: T.StructType | None = None) -> T.StructType:
    """All columns of an existing table, with the columns of ``like`` added and typed like ``like``.

    They come from the table's own note.  A table that other tools wrote has
    none: its files' schemas are then merged, which reads every footer once.
    """
    found = read_schema(spark, path) or spark.read.option("mergeSchema", "true").parquet(path).schema
    return found if like is None else _union(found, like)


def _note(spark: SparkSession, path: str, old: T.StructType | None, new: T.StructType,
          partition_by: Iterable[str]) -> None:
    schema, note, pb = _union(old, new), read_note(spark, path), list(partition_by)
    if note is None or note.get("partition_by") != pb or T.StructType.fromJson(note) != schema:
        write_schema(spark, path, schema, pb)


def _known(spark: SparkSession, path: str) -> T.StructType | None:
    return table_schema(spark, path) if table_exists(spark, path) else None


def overwrite(df: DataFrame, path: str, partition_by: Iterable[str] | None = None,
              keep_old_columns: bool = False) -> None:
    """Full load.  ``keep_old_columns`` keeps columns of the existing table that the
    new data lacks, as NULLs (what a table format with schema merge does)."""
    if path_exists(df.sparkSession, _pending(path)):
        remove_path(df.sparkSession, _pending(path))   # superseded: the whole table is replaced
    if keep_old_columns and table_exists(df.sparkSession, path):
        old = table_schema(df.sparkSession, path, like=df.schema)
        have = {c.lower() for c in df.columns}
        extra = [f for f in old.fields if f.name.lower() not in have]
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra})
    _overwrite(df, path, partition_by)


def _overwrite(df: DataFrame, path: str, partition_by: Iterable[str] | None = None, stage: str | None = None) -> None:
    """``stage``: a folder of files that hold ``df`` and take the table's place."""
    if stage is None:
        _write(df, path, "overwrite", partition_by)
    else:
        _move(df.sparkSession, stage, path)
    _note(df.sparkSession, path, None, df.schema, partition_by or [])


#: Partition folders that a commit renames at a time.
MOST_MOVES = 16


def replace_partitions(df: DataFrame, path: str, partition_by: Iterable[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition overwrite).

    Same result as a ``replaceWhere`` on the batch's distinct partition values,
    including a NULL partition, without collecting those values to the driver.
    An empty ``df`` changes nothing.
    """
    pb = list(partition_by)
    if not pb:
        raise ValueError("replace_partitions needs partition columns")
    recover(df.sparkSession, path)
    table_layout(df.sparkSession, path, pb)
    _replace_partitions(df, path, pb)


def _replace_partitions(df: DataFrame, path: str, pb: list[str], stage: str | None = None) -> None:
    """``stage``: a folder that holds ``df`` in folders of its partitions, which take the place of the table's."""
    spark, old = df.sparkSession, _known(df.sparkSession, path)
    if stage is None:
        _write(df, path, "overwrite", pb, dynamic=True)
    else:
        folders = _staged_folders(spark, stage, len(pb))
        # a rename is one call that waits for the file system, so many are under way at once
        with ThreadPoolExecutor(max(1, min(MOST_MOVES, len(folders) // 8))) as pool:
            for moved in [pool.submit(_move, spark, f"{stage}/{f}", f"{path.rstrip('/')}/{f}") for f in folders]:
                moved.result()
    _note(df.sparkSession, path, old, df.schema, pb)


def remove_partitions(parts: DataFrame, path: str, partition_by: Iterable[str]) -> int:
    """Remove the folders of the partitions in ``parts``; how many there were.

    One folder a row reaches the driver: each is one call to the file system in any case.
    """
    return _remove_folders(parts.sparkSession, path, partition_folders(parts, partition_by))


def partition_folders(parts: DataFrame, partition_by: Iterable[str]) -> list[str]:
    pb = list(partition_by)
    return ["/".join(partition_dir(c, r[c]) for c in pb) for r in parts.select(*pb).distinct().toLocalIterator()]


def _remove_folders(spark: SparkSession, path: str, folders: Iterable[str]) -> int:
    n = 0
    for folder in folders:
        fs, p = _hadoop(spark, f"{path.rstrip('/')}/{folder}")
        n += bool(fs.delete(p, True))
    return n


def _staged_folders(spark: SparkSession, stage: str, depth: int) -> list[str]:
    """The partition folders of a stage, relative to it; as many reach the driver as a dynamic overwrite moves there."""
    found = [""]
    for _ in range(depth):
        below = []
        for folder in found:
            fs, p = _hadoop(spark, f"{stage}/{folder}" if folder else stage)
            below += [f"{folder}/{f.getPath().getName()}".lstrip("/") for f in fs.listStatus(p)
                      if f.isDirectory() and "=" in f.getPath().getName()]
        found = below
    return found


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to where another may be.  Broken in between, the source is still there to be moved again."""
    fs, to = _hadoop(spark, target)
    _, here = _hadoop(spark, source)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(here, to):
        raise OSError(f"cannot move {source} to {target}")


_ESCAPE = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}


def partition_dir(column: str, value) -> str:
    """Hive-style directory name of one partition value."""
    if value is None or value == "":   # Spark stores both in the default partition
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    text = str(value)
    return f"{column}=" + "".join(f"%{ord(ch):02X}" if ch in _ESCAPE else ch for ch in text)


def replace_prefix(df: DataFrame, path: str, prefix: Mapping[str, object],
                   partition_by: Iterable[str]) -> None:
    """Replace everything under a leading partition prefix, e.g. ``pais='X'``,
    including partitions the batch does not contain (a static partition
    overwrite).  ``prefix`` must be the leading columns of ``partition_by``.
    A row outside the prefix raises, before anything is replaced."""
    pb = table_layout(df.sparkSession, path, list(partition_by))
    keys = list(prefix)
    if pb[:len(keys)] != keys:
        raise ValueError(f"prefix {keys} must lead the partition columns {pb}")
    sub = path.rstrip("/") + "/" + "/".join(partition_dir(c, prefix[c]) for c in keys)
    spark = df.sparkSession
    inside = F.lit(True)
    for c in keys:
        v = prefix[c]
        inside = inside & (F.col(c).isNull() if v is None else F.col(c).eqNullSafe(F.lit(v)))
    outside = F.raise_error(F.concat(F.lit(f"a row is outside the prefix {dict(prefix)}: "),
                                     F.to_json(F.struct(*keys)))).cast("boolean")
    recover(spark, path)
    # Staged first: an overwrite deletes before it writes, so a row outside must be met before that.
    staged, stage = materialize(spark, df.filter(F.when(inside, F.lit(True)).otherwise(outside)), "prefix-batch")
    old = _known(spark, path)
    try:
        _write(staged.drop(*keys), sub, "overwrite", pb[len(keys):])
    except Exception as exc:
        raise RuntimeError(f"overwrite of {sub} failed; the batch is kept at {stage}") from exc
    _note(spark, path, old, df.schema, pb)
    remove_path(spark, stage)


def append(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> None:
    """Append, in the table's own layout (``partition_by`` is for a new table; another layout than the table's raises).
    New columns are allowed: read with ``merge_schema=True`` to see them."""
    recover(df.sparkSession, path)
    pb = table_layout(df.sparkSession, path, partition_by)
    old = _known(df.sparkSession, path)
    _write(df, path, "append", pb)
    _note(df.sparkSession, path, old, df.schema, pb)


def materialize(spark: SparkSession, df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared checkpoint folder; return it read back, and its path.

    Cuts the lineage (a lost executor no longer recomputes the upstream plan)
    and lets several consumers read one evaluated result, each with its own
    column pruning.  Remove the path with :func:`terrace.session.remove_path`
    once every consumer has run.  Its files, which nobody keeps, are compressed
    more than a table's.
    """
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return read_table(spark, path, schema=df.schema), path


def duplicate_keys(df: DataFrame, keys: Iterable[str], null_safe: bool = False) -> DataFrame:
    """Keys that several rows share, with their number in ``rows`` (NULL keys only count when
    matching is null-safe, since plain ``=`` never matches them)."""
    keys = list(keys)
    src = df if null_safe else df.dropna(subset=keys)
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def repeated_hashes(df: DataFrame, keys: Iterable[str], group: str) -> DataFrame:
    """The 64-bit hashes (``__hash``) of ``keys`` that several rows of a ``group``, a column of the key, have."""
    hashes = df.groupBy(group, F.xxhash64(*keys).alias("__hash")).agg(F.count(F.lit(1)).alias("__rows"))
    return hashes.filter(F.col("__rows") > 1).drop("__rows")


def groups_to_check(df: DataFrame, keys: Iterable[str], group: str) -> list:
    """Values of the key column ``group`` in which rows may share a key (NULL keys never match): all in which they do,
    since equal keys have one 64-bit hash, and hardly any other.  A hash is shuffled instead of a key."""
    keys = list(keys)
    return [r[0] for r in repeated_hashes(df.dropna(subset=keys), keys, group).select(group).distinct().collect()]


def assert_unique(df: DataFrame, keys: Iterable[str], null_safe: bool = False) -> None:
    """Raise :class:`DuplicateKeyError` if two rows share a key."""
    keys = list(keys)
    dup = duplicate_keys(df, keys, null_safe).select(F.to_json(F.struct(*keys)).alias("key")).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{DUPLICATE}{dup[0]['key']}")


def check_unique(df: DataFrame, keys: Iterable[str], null_safe: bool = False) -> None:
    """:func:`assert_unique` of rows that are cheap to read twice: keys are looked for by hash, and only rows that
    share one are compared."""
    keys = list(keys)
    src = df if null_safe else df.dropna(subset=keys)
    hashes, where = materialize(df.sparkSession, src.groupBy(F.xxhash64(*keys).alias("__hash")).agg(
        F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > 1).select("__hash"), "repeated-keys")
    try:
        if hashes.head(1):
            assert_unique(src.join(hashes, F.xxhash64(*[src[k] for k in keys]) == hashes["__hash"], "left_semi"), keys, null_safe)
    finally:
        remove_path(df.sparkSession, where)


def _pending(path: str) -> str:
    """Where the merged partitions of a write wait for their commit: beside the table, hidden."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_pending-{name}"


def recover(spark: SparkSession, path: str, partition_by: Iterable[str] | None = None) -> bool:
    """Replay a merge whose commit did not finish; True if there was one.

    The stage's note says which partition columns it replaces and which
    partitions it empties, so nothing else is touched; ``partition_by`` is not
    needed, and another layout than the stage's raises.  Every write calls this
    first (a full load drops the stage instead).  A stage without its note was
    not complete, so its commit had not begun: it is removed.
    """
    pending = _pending(path)
    if not path_exists(spark, pending):
        return False
    note = read_note(spark, pending)
    if note is not None:
        pb = table_layout(spark, pending, partition_by)
        schema, stage = T.StructType.fromJson(note), pending if note.get("laid_out") else None
        # stages of earlier versions are written once more; of one that is moved only the columns are asked for
        staged = read_table(spark, pending, schema=schema) if stage is None else spark.createDataFrame([], schema)
        if pb:
            _replace_partitions(staged, path, pb, stage)
            _remove_folders(spark, path, note.get("emptied") or [])
        else:
            _overwrite(staged, path, None, stage)
    remove_path(spark, pending)
    return note is not None


def _commit(spark: SparkSession, result: DataFrame, path: str, partition_by: list[str],
            processed: DataFrame | None = None) -> None:
    """Stage the merged rows, then put them in place; the stage outlives a broken commit."""
    stage_commit(result, path, partition_by, processed)
    _finish(spark, path)


def _finish(spark: SparkSession, path: str) -> None:
    try:
        recover(spark, path)
    except Exception as exc:
        raise RuntimeError(f"commit to {path} failed; recover() replays it from {_pending(path)}") from exc


def stage_commit(result: DataFrame, path: str, partition_by: Iterable[str], processed: DataFrame | None = None) -> str:
    """Write the rows that are to replace their partitions of ``path`` beside it; :func:`recover` puts them in place.

    They are written once, in folders of their partitions, which the commit renames.  Of the partitions in ``processed``, those without a row in the result are to be emptied.
    """
    pending = _pending(path)
    _write(result, pending, "overwrite", partition_by)
    _note_stage(result.sparkSession, pending, result.schema, list(partition_by), processed)
    return pending


def _note_stage(spark: SparkSession, pending: str, schema: T.StructType, partition_by: list[str],
                processed: DataFrame | None) -> None:
    """A stage's note; with it the stage is complete."""
    emptied: list[str] = []
    if processed is not None and partition_by:
        here = set(_staged_folders(spark, pending, len(partition_by)))
        emptied = [f for f in partition_folders(processed, partition_by) if f not in here]
    write_schema(spark, pending, schema, partition_by, emptied, laid_out=True)


def _match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        r = right[f"__k_{i}"]
        cond = cond & (left[k].eqNullSafe(r) if null_safe else left[k] == r)
    return cond


def upsert(spark: SparkSession, df: DataFrame, path: str, keys: Iterable[str],
           partition_by: Iterable[str] | None = None, null_safe: bool = False,
           check_duplicates: bool = True, stage_source: bool = True, processed: DataFrame | None = None) -> None:
    """Update rows whose key matches, insert the others; create the table if absent.

    Partitioned target: only partitions that the source touches are read and
    rewritten (:func:`touched_partitions` prunes the scan dynamically).  Their
    merged rows, ``touched ▷ source`` on the key and the source, are staged
    beside the table and then replace those partitions; an unpartitioned table
    is staged and replaced whole.  A commit that breaks is replayed from the
    stage by :func:`recover` or the next upsert.

    Columns: the table keeps all it has.  Columns that only the source has are
    added; in a matched row, columns that the source lacks keep their values.

    Matching uses ``=`` (a NULL key never matches, parity with MERGE) unless
    ``null_safe``.  Partition columns must be part of the key, otherwise an
    update could not move a row between partitions.  Two source rows with one
    key raise :class:`DuplicateKeyError` before anything is written; the keys
    are looked for by hash (a source that was staged for this: grouped once, for
    the check and as the anti join's right side).

    ``processed`` (its columns are among the key's and hold the partition columns) lists the
    slices that the source covers in full: old rows of these slices that the
    source does not hold are retracted, and a partition left without rows is removed.

    A source that lacks columns, or whose keys are checked against existing partitions, is consumed several times;
    ``stage_source`` writes it once to the shared folder so its upstream plan is not recomputed for each.  Pass
    False when the source is already a plain scan of staged data; one with all columns then goes straight to the commit's stage
    and is consumed once, as is any other source.
    """
    keys, pb = list(keys), list(partition_by or [])
    outside = [c for c in pb if c not in keys]
    if outside:
        raise ValueError(f"partition columns {outside} must be part of the upsert key")
    _merge(spark, df, path, keys, pb, null_safe, check_duplicates, stage_source, True, processed)


def replace_slices(spark: SparkSession, df: DataFrame, path: str, slices: Iterable[str],
                   partition_by: Iterable[str], stage_source: bool = True, processed: DataFrame | None = None) -> None:
    """Replace the rows whose ``slices`` values occur in ``df``, in a table whose partitions may be coarser.

    ``slices`` must hold the partition columns.  In the partitions that the
    batch touches, rows of other slices stay.  With slices as fine as the
    partitions this is :func:`replace_partitions`.  An empty ``df`` changes
    nothing, unless ``processed`` lists slices: they are replaced as well, by
    nothing where ``df`` has no rows for them.
    """
    slices, pb = list(slices), list(partition_by)
    if not pb or any(c not in slices for c in pb):
        raise ValueError(f"slices {slices} must hold the partition columns {pb}")
    if set(slices) == set(pb) and processed is None:
        replace_partitions(df, path, pb)
    else:
        _merge(spark, df, path, slices, pb, True, False, stage_source, False, processed)


def _merge(spark: SparkSession, df: DataFrame, path: str, keys: list[str], pb: list[str], null_safe: bool,
           unique: bool, stage_source: bool, fill: bool, processed: DataFrame | None = None, staged: bool = False) -> None:
    """``(touched ▷ source ▷ processed) ∪ source`` over the touched partitions, staged and committed.

    A source that need not be filled in goes through :func:`_merge_in_stage`, unless it was ``staged`` before for a
    checked write of partitions, or an unpartitioned table takes it unchecked.
    """
    if processed is not None and any(c not in processed.columns for c in pb):
        raise ValueError(f"processed slices {processed.columns} must hold the partition columns {pb}")
    def lacks() -> bool:
        have = {c.lower() for c in df.columns}
        return any(c.lower() not in have for c in table_schema(spark, path, like=df.schema).names)

    if stage_source and not path_exists(spark, _pending(path)) and (
            not table_exists(spark, path) or bool(pb) != unique and not (fill and lacks())):
        stage_source = False      # its rows are read once
    if stage_source:
        source, stage = materialize(spark, df, "merge-source")
        try:
            _merge(spark, source, path, keys, pb, null_safe, unique, False, fill, processed, staged=True)
        finally:
            remove_path(spark, stage)
        return
    recover(spark, path)
    table_layout(spark, path, pb)
    if not table_exists(spark, path):
        if unique:
            _merge_in_stage(spark, df, path, keys, pb, null_safe, True, fill, processed)
        elif pb:
            replace_partitions(df, path, pb)
        else:
            overwrite(df, path)
        return

    if (pb or unique) and not (pb and unique and staged) and not (fill and lacks()):
        _merge_in_stage(spark, df, path, keys, pb, null_safe, unique, fill, processed)
        return
    target = read_table(spark, path, schema=table_schema(spark, path, like=df.schema))
    if pb:
        touching = df if processed is None else df.select(*pb).unionByName(processed.select(*pb))
        target = touched_partitions(target, touching, pb)
    named = df.groupBy(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("__rows"))
    kept = target.join(named, _match(target, named, keys, null_safe), "left_anti")
    if processed is not None:
        slices = processed.columns
        done = processed.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(slices)]).distinct()
        kept = kept.join(done, _match(kept, done, slices, True), "left_anti")
    have = {c.lower() for c in df.columns}
    lacking = [c for c in target.columns if c.lower() not in have]
    if fill and lacking:
        old = target.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], *lacking)
        source = df.join(old, _match(df, old, keys, null_safe), "left").select(*[df[c] for c in df.columns], *lacking)
    else:
        source = df
    result = kept.unionByName(source, allowMissingColumns=True)
    if unique:
        # A branch without rows, or an error; it reads the same exchange as the anti join.
        twice = F.col("__rows") > 1
        if not null_safe:
            for i in range(len(keys)):
                twice = twice & F.col(f"__k_{i}").isNotNull()
        message = F.raise_error(F.concat(F.lit(DUPLICATE), F.to_json(F.struct(
            *[F.col(f"__k_{i}").alias(k) for i, k in enumerate(keys)]))))
        first, *rest = result.schema.fields
        result = result.unionByName(named.filter(twice).select(
            message.cast(first.dataType).alias(first.name), *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest]))
    try:
        _commit(spark, result, path, pb, processed)
    except Exception as exc:
        if DUPLICATE in str(exc):
            text = str(exc)
            raise DuplicateKeyError(text[text.index(DUPLICATE):].split("\n")[0]) from None
        raise


def _merge_in_stage(spark: SparkSession, df: DataFrame, path: str, keys: list[str], pb: list[str], null_safe: bool,
                    unique: bool, by_key: bool, processed: DataFrame | None) -> None:
    """``(touched ▷ source ▷ processed) ∪ source`` with the source shuffled and written once.

    Its rows go to the commit's stage in folders of their partitions; everything
    else is found from these files' key columns, and the target's rows that stay
    are written beside them.  Where slices decide which rows stay, their distinct
    values are broadcast (up to a bound), so the target is not shuffled for that;
    ``by_key`` looks keys up, but only those outside the processed slices, whose
    old rows go in any case.  Two source rows with one key (``unique``) are
    found in the stage, which then goes: the table is as it was.
    """
    exists, pending = table_exists(spark, path), _pending(path)
    schema = table_schema(spark, path, like=df.schema) if exists else df.schema
    _write(df, pending, "overwrite", pb)
    source = read_table(spark, pending, schema=schema)
    if unique:
        try:
            check_unique(source, keys, null_safe)
        except DuplicateKeyError:
            remove_path(spark, pending)
            raise
    if not exists:
        _note_stage(spark, pending, schema, pb, None)
        _finish(spark, path)
        return
    target = read_table(spark, path, schema=schema)
    stages = []

    def distinct_slices(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str], bool]:
        found, where = materialize(spark, rows.select(*columns).distinct(), "merge-slices")
        stages.append(where)
        return found, columns, found.count() <= MOST_BROADCAST_PARTITIONS

    def without(rows: DataFrame, out: DataFrame, columns: list[str], small: bool, null_safe: bool) -> DataFrame:
        named = out.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(columns)])
        named = F.broadcast(named) if small else named
        return rows.join(named, _match(rows, named, columns, null_safe), "left_anti")

    try:
        replaced = [] if by_key else [distinct_slices(source, keys)]
        if processed is not None:
            replaced.append(distinct_slices(processed, processed.columns))
        touching = [rows.select(*pb) for rows, _, _ in replaced] + ([source.select(*pb)] if by_key else [])
        kept = touched_partitions(target, reduce(DataFrame.unionByName, touching), pb) if pb else target
        for rows, columns, small in replaced:
            kept = without(kept, rows, columns, small, True)
        if by_key:
            looked_up, inside = source.select(*keys), False
            for rows, columns, small in replaced:
                if set(columns) <= set(keys):
                    looked_up, inside = without(looked_up, rows, columns, small, True), True
            if not inside or looked_up.count():
                kept = without(kept, looked_up, keys, False, null_safe)
        _write(kept.select(*schema.names), pending, "append", pb)
        _note_stage(spark, pending, schema, pb, processed)
    finally:
        for where in stages:
            remove_path(spark, where)
    _finish(spark, path)


#: Touched partitions that may be sent to every executor (a row is a few short values).
MOST_BROADCAST_PARTITIONS = 200_000


def touched_partitions(target: DataFrame, source: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Rows of ``target`` in the partitions that ``source`` touches (NULL partitions included).

    The distinct touched partitions are broadcast, once their counted number is
    within a bound.  Spark then prunes the target's scan dynamically to exactly
    these partitions: two days ten years apart read two partitions.  Beyond the
    bound both sides are shuffled.  Nothing but counts reaches the driver.
    """
    pb = list(partition_by)
    named = [F.col(c).alias(f"__k_{i}") for i, c in enumerate(pb)]
    parts = source.select(*named).groupBy(*[f"__k_{i}" for i in range(len(pb))]).agg(F.count(F.lit(1)).alias("__rows"))
    has_null = F.lit(False)
    for i in range(len(pb)):
        has_null = has_null | F.col(f"__k_{i}").isNull()
    n, nulls = parts.agg(F.count(F.lit(1)), F.count_if(has_null)).first()
    # The comparison of the count tells the optimizer that this side selects, which turns the pruning on.
    whole = parts.filter(~has_null & (F.col("__rows") > 0)).drop("__rows")
    if n <= MOST_BROADCAST_PARTITIONS:
        whole = F.broadcast(whole)
    out = target.join(whole, _match(target, whole, pb, False), "left_semi")
    if nulls:
        # "=" never meets a NULL, and only "=" prunes: partitions with one are a branch of their own
        null = F.lit(False)
        for c in pb:
            null = null | F.col(c).isNull()
        rest, some = target.filter(null), parts.filter(has_null)
        out = out.unionByName(rest.join(some, _match(rest, some, pb, True), "left_semi"))
    return out
