"""Sinks: idempotence, untouched partitions, NULL partitions, keys, schema evolution."""

import pytest
from pyspark.sql import functions as F

from terrace.operators import sinks
from terrace.operators.sinks import (
    DuplicateKeyError,
    append,
    overwrite,
    partition_dir,
    replace_partitions,
    replace_prefix,
    upsert,
)
from terrace.sources.files import read_table

SCHEMA = "t string, d int, k int, v double"


def _key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def _rows(df, cols=("t", "d", "k", "v")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_replace_partitions_touches_only_batch_partitions(spark, tmp_table):
    base = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 2, 2, 2.0), ("b", 1, 3, 3.0)], SCHEMA)
    replace_partitions(base, tmp_table, ["t", "d"])
    batch = spark.createDataFrame([("a", 2, 9, 9.0), (None, 5, 7, 7.0)], SCHEMA)
    for _ in range(2):                       # idempotent: twice = once
        replace_partitions(batch, tmp_table, ["t", "d"])
        got = _rows(read_table(spark, tmp_table, schema=base.schema))
        assert got == sorted([("a", 1, 1, 1.0), ("b", 1, 3, 3.0), ("a", 2, 9, 9.0), (None, 5, 7, 7.0)],
                             key=_key)
    replace_partitions(batch.limit(0), tmp_table, ["t", "d"])      # empty batch changes nothing
    assert len(_rows(read_table(spark, tmp_table, schema=base.schema))) == 4


def test_replace_prefix_removes_stale_partitions(spark, tmp_table):
    base = spark.createDataFrame([("X", 1, 1, 1.0), ("X", 2, 2, 2.0), ("Y", 1, 3, 3.0)], SCHEMA)
    overwrite(base, tmp_table, ["t", "d"])
    batch = spark.createDataFrame([("X", 3, 4, 4.0)], SCHEMA)
    replace_prefix(batch, tmp_table, {"t": "X"}, ["t", "d"])
    replace_prefix(batch, tmp_table, {"t": "X"}, ["t", "d"])
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [("X", 3, 4, 4.0), ("Y", 1, 3, 3.0)]
    with pytest.raises(ValueError):
        replace_prefix(batch, tmp_table, {"d": 3}, ["t", "d"])


def test_partition_dir_escaping():
    assert partition_dir("pais", "MIDDLE EAST") == "pais=MIDDLE EAST"
    assert partition_dir("p", "a/b:c") == "p=a%2Fb%3Ac"
    assert partition_dir("p", None) == "p=__HIVE_DEFAULT_PARTITION__"


def test_upsert_partitioned_update_insert_and_rerun(spark, tmp_table):
    target = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 1, 2, 2.0), ("a", 2, 3, 3.0), ("b", 9, 9, 9.0)],
                                   SCHEMA)
    upsert(spark, target, tmp_table, ["t", "d", "k"], ["t", "d"])
    source = spark.createDataFrame([("a", 1, 2, 20.0), ("a", 1, 5, 50.0), ("c", 1, 1, 1.0)], SCHEMA)
    expected = [("a", 1, 1, 1.0), ("a", 1, 2, 20.0), ("a", 1, 5, 50.0), ("a", 2, 3, 3.0),
                ("b", 9, 9, 9.0), ("c", 1, 1, 1.0)]
    for _ in range(2):
        upsert(spark, source, tmp_table, ["t", "d", "k"], ["t", "d"])
        assert _rows(read_table(spark, tmp_table, schema=target.schema)) == sorted(expected, key=_key)


def test_upsert_null_key_parity_and_null_safe(spark, tmp_table):
    src = spark.createDataFrame([("a", 1, None, 1.0)], SCHEMA)
    upsert(spark, src, tmp_table, ["t", "d", "k"], ["t", "d"])
    upsert(spark, src, tmp_table, ["t", "d", "k"], ["t", "d"])
    assert read_table(spark, tmp_table).count() == 2          # plain '=' never matches NULL
    upsert(spark, src, tmp_table, ["t", "d", "k"], ["t", "d"], null_safe=True)
    assert read_table(spark, tmp_table).count() == 1


def test_upsert_rejects_duplicates_and_bad_partitioning(spark, tmp_table):
    dup = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 1, 1, 2.0)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(spark, dup, tmp_table, ["t", "d", "k"], ["t", "d"])
    with pytest.raises(ValueError):
        upsert(spark, dup.limit(1), tmp_table, ["k"], ["t"])


def test_upsert_unpartitioned_is_staged(spark, tmp_table):
    dim = spark.createDataFrame([(1, 1, 1.0), (2, 1, 2.0)], "m int, f int, p double")
    upsert(spark, dim, tmp_table, ["m", "f"])
    upsert(spark, spark.createDataFrame([(2, 1, 5.0), (3, 1, 3.0)], "m int, f int, p double"),
           tmp_table, ["m", "f"])
    got = sorted(tuple(r) for r in read_table(spark, tmp_table).select("m", "f", "p").collect())
    assert got == [(1, 1, 1.0), (2, 1, 5.0), (3, 1, 3.0)]


def test_append_schema_evolution(spark, tmp_table):
    append(spark.createDataFrame([(1, "x")], "a int, b string"), tmp_table)
    append(spark.createDataFrame([(2, "y", 1.5)], "a int, b string, c double"), tmp_table)
    got = sorted(tuple(r) for r in read_table(spark, tmp_table, merge_schema=True).select("a", "b", "c").collect())
    assert got == [(1, "x", None), (2, "y", 1.5)]


def test_overwrite_keeps_old_columns_when_asked(spark, tmp_table):
    overwrite(spark.createDataFrame([(1, "x")], "a int, b string"), tmp_table)
    overwrite(spark.createDataFrame([(2,)], "a int"), tmp_table, keep_old_columns=True)
    rows = read_table(spark, tmp_table).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(2, None)]
    overwrite(spark.createDataFrame([(3,)], "a int"), tmp_table)
    assert read_table(spark, tmp_table).columns == ["a"]


def _scan(capsys, df):
    df.explain()
    return [line for line in capsys.readouterr().out.splitlines() if "FileScan parquet" in line and "k#" in line][0]


def test_touched_partitions_prune_dynamically(spark, tmp_table, capsys):
    """Only the touched partitions of the target are scanned, whatever the source plan and their number."""
    from terrace.operators.sinks import touched_partitions
    base = spark.range(0, 200).select((F.col("id") % 20).cast("int").alias("d"), (F.col("id") % 2).cast("int").alias("e"),
                                      F.col("id").alias("k"))
    replace_partitions(base, tmp_table, ["d", "e"])
    target = read_table(spark, tmp_table, schema=base.schema)
    one = touched_partitions(target, spark.createDataFrame([(3, 1, 1), (None, 1, 2)], "d int, e int, k long"), ["d", "e"])
    assert "dynamicpruning" in _scan(capsys, one)
    assert sorted(r["k"] % 20 for r in one.collect()) == [3] * 10
    wide = spark.range(0, 20).select((F.col("id") + 0).cast("int").alias("d"), (F.col("id") % 2).cast("int").alias("e"))
    assert touched_partitions(target, wide, ["d", "e"]).count() == 200
    gap = spark.createDataFrame([(4, 0), (4, 2)], "d int, e int")   # between 0 and 2, but not 1
    assert sorted(r["k"] % 20 for r in touched_partitions(target, gap, ["d", "e"]).collect()) == [4] * 10
    assert touched_partitions(target, wide.limit(0), ["d", "e"]).count() == 0


def _metric(plan, name):
    """The largest value of a file scan's metric in an executed plan."""
    out, todo = -1, [plan]
    while todo:
        node = todo.pop()
        node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
        node = node.plan() if "QueryStage" in node.nodeName() else node
        found = node.metrics().get(name)
        if "Scan parquet" in node.nodeName() and found.isDefined():
            out = max(out, found.get().value())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


def test_a_sparse_batch_reads_two_partitions(spark, tmp_table):
    base = spark.range(0, 4000).select((F.col("id") % 2).cast("int").alias("t"), (F.col("id") % 100).cast("int").alias("d"),
                                       F.col("id").alias("k"))
    replace_partitions(base, tmp_table, ["t", "d"])
    target = read_table(spark, tmp_table, schema=base.schema)
    days = spark.createDataFrame([(0, 0), (0, 98)], "t int, d int")     # the first and the last day of one tenant
    out = sinks.touched_partitions(target, days, ["t", "d"])
    assert len(out.collect()) == 80
    plan = out._jdf.queryExecution().executedPlan()
    assert _metric(plan, "numPartitions") == 2


def test_columns_are_noted_and_foreign_tables_merged(spark, tmp_table):
    from terrace.operators.sinks import table_schema
    spark.createDataFrame([("a", 1)], "t string, k int").write.partitionBy("t").parquet(tmp_table)
    spark.createDataFrame([("b", 2, 1.5)], "t string, k int, x double").write.mode("append").partitionBy("t").parquet(tmp_table)
    assert set(table_schema(spark, tmp_table).names) == {"t", "k", "x"}          # written by other means
    replace_partitions(spark.createDataFrame([("c", 3, True)], "t string, k int, y boolean"), tmp_table, ["t"])
    assert set(table_schema(spark, tmp_table).names) == {"t", "k", "x", "y"}     # noted from now on
    rows = read_table(spark, tmp_table, schema=table_schema(spark, tmp_table)).collect()
    assert {(r["t"], r["k"], r["x"], r["y"]) for r in rows} == {("a", 1, None, None), ("b", 2, 1.5, None), ("c", 3, None, True)}


@pytest.mark.parametrize("layout", [["t"], []])
def test_upsert_keeps_columns_that_the_source_lacks(spark, tmp_table, layout):
    keys = ["t", "k"]
    upsert(spark, spark.createDataFrame([("a", 1, 1.0)], "t string, k int, v double"), tmp_table, keys, layout)
    upsert(spark, spark.createDataFrame([("b", 1, 2.0, "x"), ("b", 2, 3.0, "y")], "t string, k int, v double, note string"),
           tmp_table, keys, layout)
    upsert(spark, spark.createDataFrame([("b", 1, 9.0), ("b", 3, 4.0)], "t string, k int, v double"), tmp_table, keys, layout)
    upsert(spark, spark.createDataFrame([("b", 2, "z")], "t string, k int, note string"), tmp_table, keys, layout)
    got = sorted((r["t"], r["k"], r["v"], r["note"] or "") for r in read_table(
        spark, tmp_table, schema=sinks.table_schema(spark, tmp_table)).collect())
    assert got == [("a", 1, 1.0, ""), ("b", 1, 9.0, "x"), ("b", 2, 3.0, "z"), ("b", 3, 4.0, "")]


@pytest.mark.parametrize("layout", [["t"], []])
def test_broken_commit_is_replayed(spark, tmp_table, monkeypatch, layout):
    """The commit deletes what it is about to replace and dies: nothing is lost."""
    keys = ["t", "k"]
    rows = [("a", i, float(i)) for i in range(20)] + [("b", 1, 1.0)]
    upsert(spark, spark.createDataFrame(rows, "t string, k int, v double"), tmp_table, keys, layout)

    def broken(df, path, *rest):
        from terrace.session import remove_path
        remove_path(spark, path + ("/t=a" if layout else ""))
        raise OSError("lost in the commit")
    source = spark.createDataFrame([("a", 3, 33.0)], "t string, k int, v double")
    with monkeypatch.context() as m:
        m.setattr(sinks, "_replace_partitions" if layout else "_overwrite", broken)
        with pytest.raises(RuntimeError, match="recover"):
            upsert(spark, source, tmp_table, keys, layout)
    assert sinks.recover(spark, tmp_table, layout) and not sinks.recover(spark, tmp_table, layout)
    want = {(t, k): v for t, k, v in rows} | {("a", 3): 33.0}
    table = read_table(spark, tmp_table, schema=sinks.table_schema(spark, tmp_table))
    assert {(r["t"], r["k"]): r["v"] for r in table.collect()} == want and table.count() == len(want)


WAYS = {
    "recover": lambda s, p, new: sinks.recover(s, p),
    "recover with layout": lambda s, p, new: sinks.recover(s, p, ["t"]),
    "append": lambda s, p, new: append(new, p),
    "append with layout": lambda s, p, new: append(new, p, ["t"]),
    "replace_partitions": lambda s, p, new: replace_partitions(new, p, ["t"]),
    "replace_prefix": lambda s, p, new: replace_prefix(new, p, {"t": "c"}, ["t"]),
    "upsert": lambda s, p, new: upsert(s, new, p, ["t", "k"], ["t"]),
    "overwrite": lambda s, p, new: overwrite(new, p, ["t"]),
}


@pytest.mark.parametrize("way", sorted(WAYS))
def test_every_write_after_a_broken_commit_keeps_all_rows(spark, tmp_table, way):
    """The merge of partition a is staged, and the commit dies before it moves anything."""
    schema = "t string, k int, v double"
    upsert(spark, spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], schema), tmp_table, ["t", "k"], ["t"])
    sinks.stage_commit(spark.createDataFrame([("a", 1, 9.0), ("a", 3, 3.0)], schema), tmp_table, ["t"])
    WAYS[way](spark, tmp_table, spark.createDataFrame([("c", 5, 5.0)], schema))
    got = _rows(read_table(spark, tmp_table, schema=sinks.table_schema(spark, tmp_table)), ("t", "k", "v"))
    old = [] if way == "overwrite" else [("a", 1, 9.0), ("a", 3, 3.0), ("b", 2, 2.0)]
    assert got == old + ([] if way.startswith("recover") else [("c", 5, 5.0)])
    assert not sinks.recover(spark, tmp_table)


def test_another_layout_than_the_tables_raises(spark, tmp_table):
    rows = spark.createDataFrame([("a", 1, 1, 1.0)], SCHEMA)
    replace_partitions(rows, tmp_table, ["t", "d"])
    for write in (lambda: append(rows, tmp_table, ["t"]), lambda: replace_partitions(rows, tmp_table, ["t"]),
                  lambda: upsert(spark, rows, tmp_table, ["t", "d", "k"], []),
                  lambda: replace_prefix(rows, tmp_table, {"t": "a"}, ["t"])):
        with pytest.raises(ValueError, match="partitioned by"):
            write()
    sinks.stage_commit(rows, tmp_table, ["t", "d"])
    with pytest.raises(ValueError, match="partitioned by"):
        sinks.recover(spark, tmp_table, ["t"])
    assert sinks.recover(spark, tmp_table) and _rows(read_table(spark, tmp_table, schema=rows.schema)) == [("a", 1, 1, 1.0)]


def test_processed_slices_are_retracted(spark, tmp_table):
    """Rows of processed slices that the source lacks go; a partition without rows goes; other slices stay."""
    base = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 1, 2, 2.0), ("a", 2, 3, 3.0), ("b", 1, 4, 4.0), ("c", 1, 5, 5.0),
                                  (None, 1, 6, 6.0)], SCHEMA)
    upsert(spark, base, tmp_table, ["t", "d", "k"], ["t"])
    source = spark.createDataFrame([("a", 1, 1, 9.0), ("d", 1, 7, 7.0)], SCHEMA)
    slices = spark.createDataFrame([("a", 1), ("b", 1), ("d", 1), (None, 1)], "t string, d int")
    for _ in range(2):
        upsert(spark, source, tmp_table, ["t", "d", "k"], ["t"], processed=slices)
        assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [
            ("a", 1, 1, 9.0), ("a", 2, 3, 3.0), ("c", 1, 5, 5.0), ("d", 1, 7, 7.0)]
    none = source.limit(0)
    sinks.replace_slices(spark, none, tmp_table, ["t", "d"], ["t"], processed=slices.filter("t = 'a'"))
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [("a", 2, 3, 3.0), ("c", 1, 5, 5.0), ("d", 1, 7, 7.0)]
    with pytest.raises(ValueError, match="processed"):
        upsert(spark, source, tmp_table, ["t", "d", "k"], ["t"], processed=slices.select("d"))


def test_emptied_partitions_are_removed_by_the_replay(spark, tmp_table):
    base = spark.createDataFrame([("a", 1, 1, 1.0), ("b", 1, 4, 4.0)], SCHEMA)
    replace_partitions(base, tmp_table, ["t"])
    sinks.stage_commit(base.filter("t = 'a'"), tmp_table, ["t"], processed=base.select("t", "d"))
    assert sinks.recover(spark, tmp_table)
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [("a", 1, 1, 1.0)]


def test_duplicate_source_keys_stop_before_any_write(spark, tmp_table):
    base = spark.createDataFrame([("a", 1, 1, 1.0)], SCHEMA)
    upsert(spark, base, tmp_table, ["t", "d", "k"], ["t", "d"])
    for t in ("a", "new"):          # also where the touched partition does not exist yet
        dup = spark.createDataFrame([(t, 1, 1, 5.0), (t, 1, 1, 6.0)], SCHEMA)
        with pytest.raises(DuplicateKeyError, match='"k":1'):
            upsert(spark, dup, tmp_table, ["t", "d", "k"], ["t", "d"])
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [("a", 1, 1, 1.0)]


def test_replace_slices_below_the_partitions(spark, tmp_table):
    base = spark.createDataFrame([("a", d, k, 1.0) for d in (1, 2, 3) for k in (1, 2)] + [("b", 1, 1, 1.0), ("a", None, 7, 1.0)], SCHEMA)
    sinks.replace_slices(spark, base, tmp_table, ["t", "d"], ["t"])
    batch = spark.createDataFrame([("a", 2, 9, 9.0), ("c", 5, 5, 5.0), ("a", None, 8, 8.0)], SCHEMA)
    for _ in range(2):
        sinks.replace_slices(spark, batch, tmp_table, ["t", "d"], ["t"])
        want = [("a", d, k, 1.0) for d in (1, 3) for k in (1, 2)] + [("b", 1, 1, 1.0)]
        want += [("a", 2, 9, 9.0), ("c", 5, 5, 5.0), ("a", None, 8, 8.0)]
        assert _rows(read_table(spark, tmp_table, schema=base.schema)) == sorted(want, key=_key)
    with pytest.raises(ValueError):
        sinks.replace_slices(spark, batch, tmp_table, ["d"], ["t"])


def test_replace_prefix_refuses_rows_outside(spark, tmp_table):
    base = spark.createDataFrame([("X", 1, 1, 1.0), ("Y", 1, 3, 3.0)], SCHEMA)
    overwrite(base, tmp_table, ["t", "d"])
    with pytest.raises(Exception, match="outside the prefix"):
        replace_prefix(spark.createDataFrame([("X", 3, 4, 4.0), ("Y", 9, 9, 9.0)], SCHEMA), tmp_table, {"t": "X"}, ["t", "d"])
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == [("X", 1, 1, 1.0), ("Y", 1, 3, 3.0)]
    assert partition_dir("p", "") == partition_dir("p", None)


def test_a_commit_moves_the_staged_files(spark, tmp_table, monkeypatch):
    """Merged rows are written once: the commit renames folders, also when a broken one is replayed half done."""
    schema = "t string, k int, v double"
    upsert(spark, spark.createDataFrame([("a", 1, 1.0), (None, 2, 2.0), ("x/y", 3, 3.0)], schema), tmp_table, ["t", "k"], ["t"])
    written, write, move, moved = [], sinks._write, sinks._move, []
    monkeypatch.setattr(sinks, "_write", lambda df, path, *a, **k: (written.append(path), write(df, path, *a, **k)))

    def once(*args):
        if moved:
            raise OSError("lost in the commit")
        moved.append(args)
        move(*args)
    batch = spark.createDataFrame([("a", 1, 9.0), (None, 4, 4.0), ("x/y", 5, 5.0)], schema)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_move", once)
        with pytest.raises(RuntimeError, match="recover"):
            upsert(spark, batch, tmp_table, ["t", "k"], ["t"], null_safe=True)
    assert sinks.recover(spark, tmp_table) and not sinks.recover(spark, tmp_table)
    assert len(written) == 1
    want = [("a", 1, 9.0), ("x/y", 3, 3.0), ("x/y", 5, 5.0), (None, 2, 2.0), (None, 4, 4.0)]
    got = read_table(spark, tmp_table, schema=sinks.table_schema(spark, tmp_table)).select("t", "k", "v").collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, str(r[0]), r[1])) == want


def test_an_unchecked_source_is_written_once(spark, tmp_table, monkeypatch):
    """Slices and upserts without a check: the source goes straight to the commit's stage, what stays joins it there."""
    base = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 2, 2, 2.0), ("b", 1, 3, 3.0), (None, 1, 4, 4.0)], SCHEMA)
    replace_partitions(base, tmp_table, ["t"])
    seen = spark.sparkContext.accumulator(0)
    read = F.udf(lambda k: (seen.add(1), k)[1], "int").asNondeterministic()
    written, write = [], sinks._write
    monkeypatch.setattr(sinks, "_write", lambda df, path, mode, *a, **k: (written.append(mode), write(df, path, mode, *a, **k)))
    batch = spark.createDataFrame([("a", 2, 9, 9.0), ("c", 5, 5, 5.0), (None, 2, 6, 6.0)], SCHEMA)
    sinks.replace_slices(spark, batch.withColumn("k", read("k")), tmp_table, ["t", "d"], ["t"])
    want = [("a", 1, 1, 1.0), ("a", 2, 9, 9.0), ("b", 1, 3, 3.0), ("c", 5, 5, 5.0), (None, 1, 4, 4.0), (None, 2, 6, 6.0)]
    assert _rows(read_table(spark, tmp_table, schema=base.schema)) == sorted(want, key=_key)
    assert seen.value == 3 and written == ["overwrite", "append"]
    newer = spark.createDataFrame([("a", 2, 9, 10.0, "x"), ("d", 1, 1, 1.0, None), (None, 2, 6, 7.0, "y")], SCHEMA + ", w string")
    upsert(spark, newer, tmp_table, ["t", "d", "k"], ["t"], check_duplicates=False, processed=spark.createDataFrame(
        [("a", 2), ("b", 1)], "t string, d int"))
    got = read_table(spark, tmp_table, schema=sinks.table_schema(spark, tmp_table))
    want = [("a", 1, 1, 1.0, None), ("a", 2, 9, 10.0, "x"), ("c", 5, 5, 5.0, None), ("d", 1, 1, 1.0, None),
            (None, 1, 4, 4.0, None), (None, 2, 6, 6.0, None), (None, 2, 6, 7.0, "y")]     # a NULL key never matches
    assert _rows(got, ("t", "d", "k", "v", "w")) == sorted(want, key=_key)
    old = spark.createDataFrame([("a", 1, 1, 5.0)], SCHEMA)      # lacks a column: matched rows keep theirs
    upsert(spark, old.withColumn("k", F.lit(9)).withColumn("d", F.lit(2)), tmp_table, ["t", "d", "k"], ["t"], check_duplicates=False)
    got = read_table(spark, tmp_table, schema=sinks.table_schema(spark, tmp_table)).filter("t = 'a'")
    assert _rows(got, ("t", "d", "k", "v", "w")) == [("a", 1, 1, 1.0, None), ("a", 2, 9, 5.0, "x")]


def test_groups_to_check_hold_all_shared_keys(spark):
    rows = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 1, 1, 2.0), ("b", 1, 1, 1.0), ("c", None, 1, 1.0), ("c", None, 1, 2.0)], SCHEMA)
    assert sinks.groups_to_check(rows, ["t", "d", "k"], "t") == ["a"]


def test_duplicates_of_a_plain_table_leave_it_as_it_was(spark, tmp_table):
    from terrace.operators import sinks
    from terrace.sources.files import path_exists

    def rows(*some):
        return spark.createDataFrame(list(some), SCHEMA)

    with pytest.raises(DuplicateKeyError, match='"k":1'):
        upsert(spark, rows(("a", 1, 1, 1.0), ("a", 1, 1, 2.0)), tmp_table, ["t", "d", "k"])
    assert not path_exists(spark, tmp_table) and not path_exists(spark, sinks._pending(tmp_table))
    upsert(spark, rows(("a", 1, 1, 1.0), (None, 1, 2, 2.0), (None, 1, 2, 3.0)), tmp_table, ["t", "d", "k"])   # NULL keys equal none
    with pytest.raises(DuplicateKeyError):
        upsert(spark, rows((None, 1, 5, 1.0), (None, 1, 5, 2.0)), tmp_table, ["t", "d", "k"], null_safe=True)
    upsert(spark, rows(("a", 1, 1, 9.0), ("b", 1, 1, 4.0)), tmp_table, ["t", "d", "k"])
    assert sorted(r.v for r in spark.read.parquet(tmp_table).collect()) == [2.0, 3.0, 4.0, 9.0]
    assert not path_exists(spark, sinks._pending(tmp_table))


def test_the_evolved_tables_take_rows_that_were_evaluated_once(spark, monkeypatch):
    from terrace.plans import registry as reg

    files, plain = [], reg.upsert
    monkeypatch.setattr(reg, "upsert", lambda s, df, *a, **k: files.extend(df.inputFiles()) or plain(s, df, *a, **k))
    reg.upsert_evolved_state(spark, "/root/testdata/sf0.001")
    assert files and not any("lineitem" in f for f in files)
