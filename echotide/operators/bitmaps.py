"""Distinct counts that add up: bitmaps of review ordinals.

Each review gets a number once. A bitmap per day and category then holds which reviews it has, and
bitmaps of days unite to those of months, and those of categories to totals, without another look at
the facts; a review that occurs in several of them still counts once. Bitmaps come in pieces of
32,768 numbers (Spark's ``bitmap_*`` functions), so that a group of any size is many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_ordinals(
    ids: DataFrame, known: DataFrame | None = None, key: str = "review_id"
) -> DataFrame:
    """``key, ordinal`` of the distinct ids that ``known`` lacks, from 1 or above what it holds.

    Numbers of one task follow each other, so bitmaps stay dense. They hold for one evaluation:
    write the result before use, and append it to ``known``. Null ids get none.
    """
    fresh = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    start = F.lit(0)
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
        last = known.agg(F.max("ordinal")).first()[0] or 0
        # Ids of another run begin a bitmap piece of their own.
        start = F.lit(-(-last // 32_768) * 32_768)
    return fresh.withColumn("ordinal", F.monotonically_increasing_id() + start + 1)


def bitmaps(
    fact: DataFrame, ordinals: DataFrame, by: Sequence[str | Column], key: str = "review_id"
) -> DataFrame:
    """``by, piece, bits``: which reviews each group holds. Rows without a known id are left out."""
    names = [c for c in by if isinstance(c, str)]
    rows = fact.select(key, *by).join(ordinals, key)
    columns = [c for c in rows.columns if c not in (key, "ordinal")] if len(names) < len(by) else names
    return rows.groupBy(*columns, F.bitmap_bucket_number("ordinal").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("ordinal")).alias("bits")
    )


def roll_up(maps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser groups: the union of all that fall into one."""
    return maps.groupBy(*by, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(
    maps: DataFrame, by: Sequence[str | Column], name: str = "n_reviews"
) -> DataFrame:
    """Distinct reviews by coarser groups of a table of bitmaps."""
    pieces = roll_up(maps, by)
    columns = [c for c in pieces.columns if c not in ("piece", "bits")]
    return pieces.groupBy(*columns).agg(F.sum(F.bitmap_count("bits")).alias(name))


def counts_with_total(
    maps: DataFrame, by: Sequence[str], name: str = "n_reviews"
) -> DataFrame:
    """The counts at every level of ``by`` and in total. ``level`` is 0 on the groups and larger on
    totals. Pieces are united level by level; no fact is read."""
    pieces = roll_up(maps, by)
    rolled = pieces.rollup("piece", *by).agg(
        F.grouping_id().cast("int").alias("level"), F.bitmap_or_agg("bits").alias("bits")
    )
    # The piece comes first, so that only the row over all pieces lacks it.
    kept = rolled.filter(F.col("level") < (1 << len(by)))
    return kept.groupBy(*by, "level").agg(F.sum(F.bitmap_count("bits")).alias(name))
