"""What a review is given: product, canonical platform, issue tags, sentiment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold, lookup
from ..schemas import computed
from .phrases import finder

# Fixed value: the issue of a review that states none.
DEFAULT_ISSUE = "No Specific Issue Stated"

# Words that name a product, tested in this order, and the product otherwise.
PRODUCT_RULES = (("blinkit", "Blinkit"), ("district", "District"))
DEFAULT_PRODUCT = "Zomato"

# Collected platform name to the documented one.
PLATFORM_NAMES = {"Google Play": "Google Play Store"}


class IssueRule(NamedTuple):
    """A review whose text holds ``keyword`` has the issue ``l2`` of the pillar ``l1``."""

    l1: str
    l2: str
    keyword: str


def product_tag(
    text: Column,
    url: Column,
    rules: Sequence[tuple[str, str]] = PRODUCT_RULES,
    default: str = DEFAULT_PRODUCT,
) -> Column:
    """The product of the first rule whose word the text or the link holds, else ``default``."""
    where = F.concat(fold(F.coalesce(text, F.lit(""))), fold(F.coalesce(url, F.lit(""))))
    hits = [F.when(F.contains(where, F.lit(word)), F.lit(tag)) for word, tag in rules]
    return F.coalesce(*hits, F.lit(default))


def canonical_platform(c: Column, mapping: Mapping[str, str] = PLATFORM_NAMES) -> Column:
    """The documented name of a platform; names the mapping does not know stay."""
    return lookup(c, mapping, c)


_TAG = T.StructType([T.StructField("l1", T.StringType()), T.StructField("l2", T.StringType())])


def tag_issues(
    df: DataFrame, rules: Sequence[IssueRule] | DataFrame, text: str = "text"
) -> DataFrame:
    """Add ``tags``, the array of ``(l1, l2)`` whose rule keyword the text holds, each once, sorted.

    ``rules`` is a list or a table ``(l1, l2, keyword)`` of any size; empty keywords hold nothing.
    Each text is tagged where it stands, whatever its id: rows with repeated or null ids each get
    the tags of their own text.
    """
    if not isinstance(rules, DataFrame):
        rules = df.sparkSession.createDataFrame(
            list(rules), "l1 string, l2 string, keyword string"
        )
    find = finder(rules.select("l1", "l2", "keyword"), "keyword", ["l1", "l2"], _TAG)
    return computed(df, tags=find(F.col(text)))


def with_default_issue(df: DataFrame, label: str = DEFAULT_ISSUE) -> DataFrame:
    """Give a review without tags the one issue that says so, under no pillar."""
    default = F.array(F.struct(F.lit(None).cast("string").alias("l1"), F.lit(label).alias("l2")))
    return df.withColumn("tags", F.when(F.size("tags") > 0, F.col("tags")).otherwise(default))


def explode_tags(df: DataFrame) -> DataFrame:
    """One row per review and tag, as ``l1_category`` and ``l2_specific_issue``; a review
    without tags keeps one row with nulls."""
    kept = [c for c in df.columns if c != "tags"]
    return df.select(*kept, F.explode_outer("tags").alias("_tag")).select(
        *kept,
        F.col("_tag.l1").alias("l1_category"),
        F.col("_tag.l2").alias("l2_specific_issue"),
    )
