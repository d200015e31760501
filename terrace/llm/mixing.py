"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents in a shuffled, repeatable order (by
the MD5 of doc_id).  A document's virtual finish time is the number of the
source's tokens up to and including it, divided by the source's target.  All
copies (a source may be repeated up to ``max_repeats`` times) are served in
order of virtual time until the budget, the corpus' total size, is used up.

The order is global, yet no task sorts more than one slice of it: running
totals come from slice totals, first per (source, slice of the shuffled
order), then per slice of virtual time.  Only the slice in which the budget
ends is sorted row by row; what it takes is a bounded cut-off (time, source,
position), and each document compares its own copies with it.

Rows with a null or empty text have size 0 and are never taken.  A null source
is a source of its own, last in rank.  Repeated rows queue up one behind the
other.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import parts_for, stage

WEIGHTS = (5.0, 2.0, 1.0)
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, rank, source_size, target) from ``sizes`` (source, source_size).

    Weights repeat over the sources by code point, null last.  Targets share
    the total by weight, no target passes ``max_repeats`` times its source.
    One row per source, so the windows are over the list of sources.
    Water filling in closed form: with the sources in order of cap / weight,
    the first k stop at their caps for the smallest k at which the level of
    the rest does not pass the next one's cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * F.lit(float(max_repeats))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight).withColumn("cap", cap)
    fill = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ranked.select(
        "*", ((F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              / F.sum("w").over(rest)).alias("level"))
    final = F.first(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level")), ignorenulls=True).over(everything)
    return level.withColumn("final", final).select(
        "source", "rank", "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"))


def marks(docs: DataFrame) -> list[Column]:
    """Two hashes of all columns: rows with the same are taken to be equal.  Maps, which have no hash, count as JSON."""
    columns = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
               for f in docs.schema.fields]
    return [F.xxhash64(*columns).alias("mark1"), F.xxhash64(F.lit(1), *columns).alias("mark2")]


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3, text: str = "text",
        rows_per_slice: int = 20_000, least_slices: int = 256) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (= copies * size),
    and ``mark1`` and ``mark2``, two hashes of the whole row.

    ``rows_per_slice`` bounds what one task sorts; it has no effect on the result.
    """
    rows = stage(docs.select("doc_id", "source", word_count(F.col(text)).alias("size"), *marks(docs),
                             F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key")),
                 "mix-sizes")
    n = rows.count()
    slices = parts_for(n, rows_per_slice, least_slices)
    place = F.conv(F.substring("key", 1, 10), 16, 10).cast("long")
    rows = rows.withColumn("slice", F.shiftright(place * F.lit(slices), 40))

    per_slice = stage(rows.groupBy("source", "slice").agg(F.sum("size").alias("n")), "mix-slices")
    goals = stage(targets(per_slice.groupBy("source").agg(F.sum("n").alias("source_size")), weights, max_repeats),
                  "mix-targets")
    in_source = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_slice.select("source", "slice", F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("first"))
    same = firsts["source"].eqNullSafe(goals["source"])
    firsts = firsts.join(goals, same).select(
        firsts["source"].alias("s"), F.col("slice").alias("k"), "first", "rank", "source_size", "target")
    # the rows are the larger side, but each has to meet its slice: merged, not broadcast
    joined = rows.join(firsts.hint("merge"), rows["source"].eqNullSafe(firsts["s"]) & (rows["slice"] == firsts["k"]))
    in_slice = Window.partitionBy("rank", "slice").orderBy("key", "doc_id", "size", "mark1").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    queued = stage(joined.select("doc_id", "source", "size", "source_size", "target", "rank", "mark1", "mark2",
                                 (F.col("first") + F.sum("size").over(in_slice)).alias("upto")), "mix-queue")

    # positions are whole numbers of words, so every copy's time is one division
    def position(copy):
        return F.col("upto") + F.lit(copy) * F.col("source_size")

    total = goals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    steps = parts_for(n * max_repeats, rows_per_slice, least_slices)
    copies = (queued.where("size > 0").select("size", "target", "rank", F.explode(F.array(
        *[position(c) for c in range(max_repeats)])).alias("at"))
        .select("size", "rank", "at", (F.col("at") / F.col("target")).alias("time")))
    last = float(max_repeats)
    step = F.least(F.floor(F.col("time") * F.lit(steps / last)), F.lit(steps * 1000)).cast("long")
    copies = copies.withColumn("step", step)
    so_far = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most one row a slice of virtual time
    by_step = copies.groupBy("step").agg(F.sum("size").alias("n")).withColumn("upto", F.sum("n").over(so_far))
    cut = by_step.where(F.col("upto") > F.lit(total)).orderBy("step").select("step", (F.col("upto") - F.col("n")).alias(
        "before")).first()
    if cut is None:
        taken = F.when(F.col("size") > 0, F.lit(max_repeats)).otherwise(0)
    else:
        order = Window.partitionBy("step").orderBy("time", "rank", "at").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        first_out = (copies.where(F.col("step") == cut["step"]).withColumn("upto", F.sum("size").over(order))
                     .where(F.col("upto") + F.lit(cut["before"]) > F.lit(total))
                     .orderBy("time", "rank", "at").select("time", "rank", "at").first())
        end = F.struct(F.lit(first_out["time"]).alias("time"), F.lit(first_out["rank"]).alias("rank"),
                       F.lit(first_out["at"]).cast("long").alias("at"))
        taken = sum((F.when(F.struct((position(c) / F.col("target")).alias("time"), F.col("rank"),
                                     position(c).alias("at")) < end, 1).otherwise(0)
                     for c in range(max_repeats)), F.lit(0))
        taken = F.when(F.col("size") > 0, taken).otherwise(0)
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("copies"), (
        taken * F.col("size")).cast("long").alias("taken"), "mark1", "mark2")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3,
                    text: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns."""
    taken = mix(docs, weights, max_repeats, text).where("copies > 0").groupBy("mark1", "mark2").agg(
        F.sum("copies").alias("__llm_copies"))
    taken = taken.select(F.col("mark1").alias("__llm_mark1"), F.col("mark2").alias("__llm_mark2"), "__llm_copies")
    first, second = marks(docs)
    rows = docs.select("*", first.alias("__llm_mark1"), second.alias("__llm_mark2")).join(
        taken, ["__llm_mark1", "__llm_mark2"]).dropDuplicates(["__llm_mark1", "__llm_mark2"])
    repeated = rows.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__llm_copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
