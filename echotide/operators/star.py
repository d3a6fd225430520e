"""The star schema: one dimension, two facts, and the joins between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..schemas import CORE_COLUMNS, STAR
from ..session import drop_folder, stage
from .enrich import DEFAULT_ISSUE
from .select import dedup_keep_first, drop_blank


def clean_base(df: DataFrame) -> DataFrame:
    """Trim and clean the two columns that are matched and joined on."""
    cleaned = {c: clean_text(F.col(c)) for c in ("text", "l2_specific_issue") if c in df.columns}
    return df.withColumns(cleaned)


def project_core(df: DataFrame) -> DataFrame:
    """The seven columns of the dimension."""
    return df.select(*CORE_COLUMNS)


def dim_reviews_core(base: DataFrame, order: str | Column = "arrival", extra=()) -> DataFrame:
    """One row per review, the first in ``order``; ``extra`` names columns to keep besides."""
    kept = [*CORE_COLUMNS, *extra]
    first = dedup_keep_first(
        base.select(*kept, (F.col(order) if isinstance(order, str) else order).alias("_order")),
        ["review_id"],
        ["_order"],
    )
    return first.select(*kept)


def fact_l1(base: DataFrame, order: str | Column = "arrival") -> DataFrame:
    """One row per review and pillar, the first in ``order``."""
    columns = ["review_id", "review_date", "sentiment", "l1_category"]
    tagged = drop_blank(
        base.select(*columns, (F.col(order) if isinstance(order, str) else order).alias("_order")),
        "l1_category",
    )
    return dedup_keep_first(tagged, ["review_id", "l1_category"], ["_order"]).select(*columns)


def fact_l2(base: DataFrame, exclude_default: bool = False) -> DataFrame:
    """Review and issue as often as the base holds them, without blank issues. The literal for
    no stated issue stays unless ``exclude_default``."""
    fact = drop_blank(base.select("review_id", "l2_specific_issue"), "l2_specific_issue")
    if exclude_default:
        fact = fact.filter(F.col("l2_specific_issue") != DEFAULT_ISSUE)
    return fact


def with_dim(fact: DataFrame, dim: DataFrame, columns=("platform", "source")) -> DataFrame:
    """Facts with columns of their review. A fact without a review is kept, with nulls."""
    return fact.join(dim.select("review_id", *columns), "review_id", "left")


def in_ids(df: DataFrame, ids: DataFrame, key: str = "review_id") -> DataFrame:
    """Rows whose key is in the set ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def orphan_facts(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Facts without a row in the dimension."""
    return fact.join(dim.select("review_id"), "review_id", "left_anti")


def duplicate_keys(dim: DataFrame, key: str = "review_id") -> DataFrame:
    """Keys that occur more than once or are null, with their number of rows."""
    return (
        dim.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | F.col(key).isNull())
    )


def check_keys(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: how many dimension keys are wrong and how many facts have no review."""
    bad = duplicate_keys(dim).select(F.lit("bad_keys").alias("check"))
    lost = orphan_facts(dim, fact).select(F.lit("orphan_facts").alias("check"))
    counted = bad.unionByName(lost).agg(
        F.count_if(F.col("check") == "bad_keys").alias("bad_keys"),
        F.count_if(F.col("check") == "orphan_facts").alias("orphan_facts"),
    )
    return counted


def build_star(
    base: DataFrame, order: str | Column = "arrival", reviews: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The three tables over one cleaned and tagged base (one row per review and tag). The dimension
    needs no tags: with ``reviews``, the base before tagging, it is made without them."""
    return {
        "dim_reviews_core": dim_reviews_core(base if reviews is None else reviews, order),
        "fact_l1_tags": fact_l1(base, order),
        "fact_l2_tags": fact_l2(base),
    }


def write_star(
    base: DataFrame,
    path: str,
    staging: str,
    order: str | Column = "arrival",
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Write the three tables under ``path``, the dimension split by month. Returns the rows of each
    table, counted by its write.

    The base is first written once to a folder of its own under ``staging``, a place that all
    executors share, so that cleaning and tagging do not run three times; the copy is removed
    afterwards. The base itself is not part of the model and is not written to ``path``.
    """
    spark = base.sparkSession
    staged, folder = stage(base, staging, "star")
    try:
        star = build_star(staged, order)
        dim = star.pop("dim_reviews_core").withColumn(
            "review_month", F.trunc("review_date", "MM")
        )
        # Rebalancing cuts a month that holds most rows into files of even size.
        dim = dim.hint("rebalance", "review_month")
        months, whole = ["review_month"], []
        counts = {}
        for name, table, parts in [
            ("dim_reviews_core", dim, months),
            *((name, fact, whole) for name, fact in star.items()),
        ]:
            # Counted last before the write, where no task counts twice.
            counts[name] = Observation()
            observed = table.observe(counts[name], F.count(F.lit(1)).alias("n_rows"))
            observed.write.mode(mode).partitionBy(*parts).parquet(f"{path}/{name}")
        return {name: seen.get["n_rows"] for name, seen in counts.items()}
    finally:
        drop_folder(spark, folder)


def read_star(spark, path: str) -> dict[str, DataFrame]:
    """The tables ``write_star`` wrote. Types are declared, as a dimension without rows has no files
    to tell them."""
    return {
        name: spark.read.schema(types).parquet(f"{path}/{name}") for name, types in STAR.items()
    }
