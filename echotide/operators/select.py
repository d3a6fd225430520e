"""Filters, duplicates, budgets and order.

Every per-group operator here is written so that no group meets in one task unreduced: a
``row_number`` compared with a constant lets Spark cut each group before the shuffle, and larger
cuts are made in hashed parts first.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import any_of, clean_text, is_blank
from ..schemas import computed
from .phrases import finder

DAYS_PER_MONTH = 30


def _columns(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


# Filters


def since_months(df: DataFrame, ts: str, as_of, months: int) -> DataFrame:
    """Rows no older than ``months`` times 30 days before ``as_of``, never the wall clock."""
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(DAYS_PER_MONTH * months))
    return df.filter(F.col(ts) >= start)


def date_floor(df: DataFrame, col: str, date: datetime.date | str) -> DataFrame:
    """Rows from ``date`` on, that day included."""
    return df.filter(F.col(col) >= F.lit(date).cast("date"))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither null nor blank."""
    return df.filter(~is_blank(F.col(col)))


def drop_empty(df: DataFrame, cols: Sequence[str], all: bool = True) -> DataFrame:
    """Drop rows where all (or any) of the texts are null or empty."""
    empty = [F.coalesce(F.col(c) == "", F.lit(True)) for c in cols]
    return df.filter(~any_of(empty) if not all else any_of(~e for e in empty))


def url_filter(
    df: DataFrame, col: str, include: str | None = None, exclude: str | None = None
) -> DataFrame:
    """Links that hold ``include`` and do not hold ``exclude``."""
    if include is not None:
        df = df.filter(F.contains(F.col(col), F.lit(include)))
    if exclude is not None:
        df = df.filter(~F.contains(F.col(col), F.lit(exclude)))
    return df


# Duplicates


def dedup_keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    drop_null_keys: bool = True,
) -> DataFrame:
    """The first row per key in ``order``. Each map task sends at most one row per key."""
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    w = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dedup_text(
    df: DataFrame, text: str, order: Sequence[str | Column], keep_null: bool = True
) -> DataFrame:
    """The first row per cleaned text. Rows without a text are no copies of each other and stay,
    unless ``keep_null`` is false. Texts are told apart by a digest, so that they are not sorted."""
    keyed = computed(df, _digest=F.sha2(clean_text(F.col(text)), 256))
    if keep_null:  # a key of their own
        own = F.when(F.col("_digest").isNull(), F.monotonically_increasing_id())
    else:
        keyed, own = keyed.filter(F.col("_digest").isNotNull()), F.lit(None).cast("long")
    first = dedup_keep_first(
        keyed.withColumn("_own", own), ["_digest", "_own"], order, drop_null_keys=False
    )
    return first.drop("_digest", "_own")


# Budgets


PARTS = (64, 8)

Budget = int | Mapping[str, int] | DataFrame


def first_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    at_most: int,
    room: Column | None = None,
) -> DataFrame:
    """The first ``at_most`` rows per group, or the first ``room`` of them where given.

    Groups are cut in 64 parts by a hash of the row, then in 8, then as a whole, so a task sees at
    most 8 times ``at_most`` rows of a group of any size once the first cut is made, whatever the
    order: it may carry directions, hold outliers and repeat. ``order`` must be total.
    """
    by = _columns(order)
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(PARTS[0])))
    for parts in (*PARTS, 1):
        w = Window.partitionBy(*keys, "_part").orderBy(*by)
        cut = (
            cut.withColumn("_part", F.col("_part") % parts)
            .withColumn("_n", F.row_number().over(w))
            .filter(F.col("_n") <= at_most)
        )
    if room is not None:
        cut = cut.filter(F.col("_n") <= room)
    return cut.drop("_part", "_n")


def binned_rank(
    df: DataFrame,
    keys: Sequence[str],
    bin: Column,
    order: Sequence[str | Column],
) -> DataFrame:
    """Exact ``row_number`` per group as ``_rank``, with no group in one task.

    ``bin`` must rise with the order (an hour of the time, a range of the id). Rows are counted
    per bin, the counts summed over the bins before, and only rows of one bin are ranked
    together.
    """
    binned = df.withColumn("_bin", bin)
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate((*keys, "_bin"))]
    sizes = binned.groupBy(*named).agg(F.count(F.lit(1)).alias("_bin_size"))
    *groups, at = (f"_key{i}" for i in range(len(named)))
    before = Window.partitionBy(*groups).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_bin_size").over(before), F.lit(0)))
    on = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate((*keys, "_bin"))]
    within = Window.partitionBy(*keys, "_bin").orderBy(*_columns(order))
    ranked = binned.join(starts, on).withColumn(
        "_rank", F.col("_start") + F.row_number().over(within)
    )
    return ranked.select(*df.columns, "_rank")


def budget_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: Budget
) -> DataFrame:
    """The first ``n`` rows per group. A mapping gives each value of the first key its own ``n``, a
    table ``(*keys, target)`` each group; groups that these do not name are dropped."""
    if isinstance(n, int):
        return first_rows(df, keys, order, n)
    if isinstance(n, Mapping):
        kind = dict(df.dtypes)[keys[0]]
        rows = [(k, v) for k, v in n.items()]
        n = df.sparkSession.createDataFrame(rows, f"`{keys[0]}` {kind}, target long")
        on = [keys[0]]
    else:
        on = list(keys)
    targets = n.select(*on, F.col("target").cast("long").alias("_room")).filter("_room > 0")
    most = targets.agg(F.max("_room")).first()[0] or 0
    return first_rows(df.join(targets, on), keys, order, most, F.col("_room")).select(*df.columns)


def budget_global(
    df: DataFrame,
    group_rank: str,
    order: Sequence[str | Column],
    n: int,
    overshoot: bool = False,
) -> DataFrame:
    """The first ``n`` rows when groups are taken one after the other by ``group_rank``.

    With ``overshoot`` the budget is checked only between groups: the group that reaches it is
    kept whole. Groups are counted, not sorted: only the group at the edge is ranked.
    """
    before = Window.orderBy(group_rank).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        df.groupBy(group_rank)
        .agg(F.count(F.lit(1)).alias("_size"))
        # One row per configured group (app, query, site), so one task holds them all.
        .withColumn("_room", n - F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .filter(F.col("_room") > 0)
    )
    open_rows = df.join(sizes, group_rank)
    if overshoot:
        return open_rows.select(*df.columns)
    whole = open_rows.filter(F.col("_size") <= F.col("_room"))
    edge = open_rows.filter(F.col("_size") > F.col("_room")).drop("_size")
    edge = first_rows(edge, [group_rank], order, n, F.col("_room"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))


# Order


def newest_first(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """Newest first; equal times by ``tie``."""
    return df.orderBy(F.col(ts).desc(), F.col(tie))


def top_n(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``by``; equal values by ``tie``."""
    return df.orderBy(F.col(by).desc(), F.col(tie)).limit(n)


# Search


_RANKED = T.StructType([T.StructField("rank", T.LongType()), T.StructField("keyword", T.StringType())])


def keyword_match(df: DataFrame, keywords: Sequence[str] | DataFrame, col: str) -> DataFrame:
    """Rows whose text holds a keyword, case ignored, with the matching one of the least rank.

    ``keywords`` is a list in order or a table ``(keyword, rank)`` of any size. Equal ranks go by
    the keyword. Each text is searched where it stands.
    """
    if not isinstance(keywords, DataFrame):
        keywords = df.sparkSession.createDataFrame(
            list(enumerate(keywords)), "rank long, keyword string"
        )
    table = keywords.select(F.col("rank").cast("long").alias("rank"), "keyword")
    find = finder(table, "keyword", ["rank", "keyword"], _RANKED)
    first = F.get(find(F.col(col)), F.lit(0))["keyword"]
    return computed(df, keyword=first).filter(F.col("keyword").isNotNull())
