"""Ids seen in earlier runs, kept in buckets with a Bloom filter each, so that a run reads little of them.

Keys lie in ``buckets`` folders by hash. Next to them lie small bitmaps, 32,768 bits for a *cell* of
keys, in which each key sets ``PROBES`` bits. A new landing first asks the bitmaps of its cells. A key
that misses a bit was never seen. Only for the others the keys themselves are read, and only in the
buckets that hold one of them.

A run writes its bitmaps before its keys. What is lost in between leaves bits without keys, which cost
a look and never a wrong answer, and the run can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .select import dedup_keep_first

PROBES = 4
CELL_BITS = 32_768
#: Keys of a cell at which one in a hundred unseen keys is looked up in vain.
CELL_KEYS = 3_400


@dataclass(frozen=True)
class SeenKeys:
    """A table of seen keys under ``path``, a place that all executors share.

    ``cells`` is the number of bitmaps for the keys that are expected in the end (``expected``); more
    keys than that cost reads, not correctness. Both numbers must stay as they are for one path.
    """

    spark: SparkSession
    path: str
    buckets: int = 256
    expected: int = 10_000_000

    @property
    def cells(self) -> int:
        """Bitmaps, a whole number of them for each bucket."""
        each = -(-self.expected // (CELL_KEYS * self.buckets))
        return each * self.buckets

    def _hashed(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        cell = F.pmod("_h1", F.lit(self.cells)).cast("int")
        hashed = df.withColumns(
            {"_h1": F.xxhash64(*keys), "_h2": F.xxhash64(F.lit(7), *keys)}
        )
        return hashed.withColumn("cell", cell).withColumn(
            "bucket", F.col("cell") % self.buckets
        )

    @staticmethod
    def _bits() -> list[Column]:
        """The bits of a key within its cell, from halves of its second hash."""
        return [
            F.pmod(F.shiftright("_h2", 15 * k), F.lit(CELL_BITS)) for k in range(PROBES)
        ]

    def _table(self, name: str, schema: str) -> DataFrame | None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(where):
            return None
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def maybe_seen(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``df`` (hashed) with ``maybe``, false where the bitmaps rule a key out."""
        filters = self._table("filters", "cell int, bits binary, bucket int")
        if filters is None:
            return df.withColumn("maybe", F.lit(False))
        united = filters.groupBy("cell").agg(F.bitmap_or_agg("bits").alias("bits"))

        def is_set(bit: Column) -> Column:
            at = F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))
            byte = F.conv(F.hex(at), 16, 10).cast("int")
            return byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0

        hit = F.lit(True)
        for bit in self._bits():
            hit = hit & is_set(bit)
        return df.join(united, "cell", "left").withColumn(
            "maybe", F.coalesce(hit, F.lit(False))
        ).drop("bits")

    def known_keys(self, buckets: Sequence[int], columns: str) -> DataFrame | None:
        """The keys of some buckets; the folders of others are not read."""
        table = self._table("keys", f"{columns}, bucket int")
        return None if table is None else table.filter(F.col("bucket").isin(list(buckets)))

    def take_new(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], staging: str
    ) -> DataFrame:
        """The rows of ``df`` whose keys no earlier run has seen, the first in ``order`` of each, and
        remember them. Rows with a null key are left out, as they are never the same as another.

        The result is written under ``staging`` before anything is remembered, and read from there.
        """
        for key in keys:
            df = df.filter(F.col(key).isNotNull())
        first = dedup_keep_first(df, list(keys), list(order))
        asked, _ = stage(self.maybe_seen(self._hashed(first, keys), keys), staging, "asked")
        kept = df.columns
        doubtful = asked.filter("maybe")
        # At most ``self.buckets`` numbers.
        touched = [r["bucket"] for r in doubtful.select("bucket").distinct().collect()]
        kinds = dict(df.dtypes)
        columns = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
        known = self.known_keys(touched, columns) if touched else None
        fresh = asked.filter(~F.col("maybe"))
        if touched:
            cleared = doubtful
            if known is not None:
                # Copies of a key (a repeated run) don't matter here.
                cleared = doubtful.join(known.select(*keys), list(keys), "left_anti")
            fresh = fresh.unionByName(cleared)
        fresh, _ = stage(fresh, staging, "fresh")
        bits = fresh.select("cell", "bucket", F.explode(F.array(*self._bits())).alias("bit"))
        maps = bits.groupBy("cell", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
        maps.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/filters")
        keyed = fresh.select(*keys, "bucket").hint("rebalance", "bucket")
        keyed.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys")
        return fresh.select(kept)
