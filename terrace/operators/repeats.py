"""Copies and doubled keys, found by a 64-bit hash of the key before whole rows are shuffled.

Equal rows and equal keys have one hash, so a row whose hash occurs once has
neither a copy nor a partner.  Only hashes are shuffled to learn which rows
these are; the others are compared in full, so a chance collision costs a
comparison and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.metrics import dedup
from terrace.operators.sinks import materialize, repeated_hashes
from terrace.session import UNIQUE_KEYS_CONF, session_conf

#: Hashes that may be sent to every executor (8 bytes each).
MOST_BROADCAST_HASHES = 1_000_000


class Repeats:
    """Rows of ``df`` that share the hash of their ``keys`` (NULLs are values here), by ``group``, a column of the key.

    Groups with ``few`` such hashes (all of them together within the bound) have them broadcast; in groups with
    ``many`` every row may be one.  One row a group reaches the driver.  ``df`` is scanned again by :meth:`dedup`, so
    it should be a table.  Remove ``path`` once the frames made here have run.
    """

    def __init__(self, spark: SparkSession, df: DataFrame, keys: Iterable[str], group: str):
        self.keys, self.group = list(keys), group
        with session_conf(spark, UNIQUE_KEYS_CONF):
            self.hashes, self.path = materialize(spark, repeated_hashes(df, self.keys, group), "repeats")
        counts = self.hashes.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()
        self.few, self.many, room = [], [], MOST_BROADCAST_HASHES
        for value, n in sorted(((r[0], r["n"]) for r in counts), key=lambda r: r[1]):
            room -= n
            (self.few if room >= 0 else self.many).append(value)

    def _among(self, groups: list) -> Column:
        some = F.coalesce(F.col(self.group).isin([g for g in groups if g is not None]), F.lit(False))
        return some | F.col(self.group).isNull() if None in groups else some

    def _few(self, df: DataFrame, how: str) -> DataFrame:
        """Rows of ``df`` whose hash is (``left_semi``) or is not (``left_anti``) among those of the groups with few."""
        hashes = F.broadcast(self.hashes.filter(self._among(self.few)).select(F.col("__hash").alias("__repeated")))
        return df.join(hashes, F.xxhash64(*[df[k] for k in self.keys]) == hashes["__repeated"], how)

    def dedup(self, df: DataFrame, collapse: Callable[[DataFrame], DataFrame] = dedup) -> DataFrame:
        """``df`` without copies: rows that can have none stay where they are, ``collapse`` makes the others one."""
        out = df.filter(~self._among(self.many)) if self.many else df
        if self.few:
            out = self._few(out, "left_anti").unionByName(
                collapse(self._few(df.filter(self._among(self.few)), "left_semi")))
        return out.unionByName(collapse(df.filter(self._among(self.many)))) if self.many else out

    def candidates(self, df: DataFrame) -> DataFrame | None:
        """The rows of ``df``, a part of the rows given first, that may share a key; None if there are none."""
        few = self._few(df.filter(self._among(self.few)), "left_semi") if self.few else None
        many = df.filter(self._among(self.many)) if self.many else None
        return few if many is None else many if few is None else few.unionByName(many)
