"""The measures: aggregations under an explicit set of filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.dates import month
from ..functions.numbers import safe_divide
from ..functions.text import contains_ci, fold
from .select import date_floor
from .star import in_ids

NEGATIVE = "negative"


def is_negative(sentiment: str = "sentiment") -> Column:
    """Case-insensitive, and false rather than null where no sentiment is given."""
    return F.coalesce(fold(F.col(sentiment)) == NEGATIVE, F.lit(False))


def distinct_per(df: DataFrame, by: Sequence[str], id: str, flags: Mapping[str, Column]):
    """Distinct ids per group, in total and for each flag, in one pass.

    Ids are first reduced to one row each next to the data, then counted. Spark's own plan for
    several distinct counts would copy every row once per count.
    """
    per_id = df.groupBy(*by, id).agg(*[F.max(flag).alias(name) for name, flag in flags.items()])
    return per_id.groupBy(*by).agg(
        F.count(id).alias("total"), *[F.count_if(F.col(name)).alias(name) for name in flags]
    )


# Negativity


def negativity_pct(
    dim: DataFrame, by: Sequence[str] = ("month",), floor=None, exclude_ingest_dates: bool = False
) -> DataFrame:
    """Negative rows over all rows, a fraction, with both counts.

    ``month`` may be named in ``by`` without being a column. Rows dated by the day they were
    collected can be left out where the dimension carries that mark.
    """
    if floor is not None:
        dim = date_floor(dim, "review_date", floor)
    if exclude_ingest_dates:
        dim = dim.filter(~F.coalesce("date_is_ingest", F.lit(False)))
    if "month" in by and "month" not in dim.columns:
        dim = dim.withColumn("month", month(F.col("review_date")))
    counted = dim.groupBy(*by).agg(
        F.count_if(is_negative()).alias("n_negative"), F.count(F.lit(1)).alias("n_reviews")
    )
    return counted.withColumn(
        "negativity", safe_divide(F.col("n_negative"), F.col("n_reviews"))
    )


def negative_reviews(
    fact: DataFrame, by: Sequence[str] = ("l1_category",), floor=None
) -> DataFrame:
    """Distinct negative reviews per category."""
    rows = fact.filter(is_negative())
    if floor is not None:
        rows = date_floor(rows, "review_date", floor)
    return rows.groupBy(*by).agg(F.count_distinct("review_id").alias("negative_reviews"))


def with_totals(df: DataFrame, by: Sequence[str], aggs: Iterable[Column]) -> DataFrame:
    """A measure at every level of ``by`` and in total, each level computed from its own rows.

    ``level`` is 0 on the rows of the visual and larger on totals, so that a null category and
    a total can be told apart.
    """
    return df.rollup(*by).agg(F.grouping_id().cast("int").alias("level"), *aggs)


def negative_reviews_with_total(
    fact: DataFrame, by: Sequence[str] = ("l1_category",), floor=None
) -> DataFrame:
    """Distinct negative reviews per category, and over all of them: a review counts once in
    the total however many categories it has."""
    rows = fact.filter(is_negative())
    if floor is not None:
        rows = date_floor(rows, "review_date", floor)
    # One row per category and review before the rollup copies rows.
    slim = rows.select(*by, "review_id").distinct()
    return with_totals(slim, by, [F.count_distinct("review_id").alias("negative_reviews")])


def negative_share(
    fact: DataFrame, share_of: str = "reviews", floor=None, by: Sequence[str] = ()
) -> DataFrame:
    """Each category's share of the negative reviews, within each slice of ``by``.

    Of all negative reviews (shares may exceed one in total, since a review can have several
    categories), or with ``share_of="categories"`` of the sum over categories.
    """
    if share_of not in ("reviews", "categories"):
        raise ValueError("share_of is 'reviews' or 'categories'")
    slices = [*by, "l1_category"]
    if not by and share_of == "reviews":
        # The total is a level of the same pass.
        levels = negative_reviews_with_total(fact, floor=floor)
        rows = F.col("level") == 0
        whole = F.max(F.when(~rows, F.col("negative_reviews"))).over(Window.partitionBy(F.lit(0)))
        share = safe_divide(F.col("negative_reviews"), whole)
        return levels.withColumn("share", share).filter(rows).drop("level")
    counted = negative_reviews(fact, slices, floor)
    # One row per slice and category.
    alone = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    if share_of == "categories":
        counted = counted.withColumn("_whole", F.sum("negative_reviews").over(alone))
    else:
        rows = fact.filter(is_negative())
        if floor is not None:
            rows = date_floor(rows, "review_date", floor)
        whole = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
            F.count_distinct("review_id").alias("_whole")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        counted = counted.join(whole, same).drop(*[f"_{c}" for c in by])
    return counted.select(
        *slices,
        "negative_reviews",
        safe_divide(F.col("negative_reviews"), F.col("_whole")).alias("share"),
    )


def negativity_trend(monthly: DataFrame) -> DataFrame:
    """Change against the month before and the first month, and whether it never fell.

    ``monthly`` has one row per month, so the windows are small.
    """
    run = Window.partitionBy(F.lit(0)).orderBy("month")
    every = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = monthly.withColumn("change", F.col("negativity") - F.lag("negativity").over(run))
    return stepped.withColumns(
        {
            "change_from_first": F.col("negativity") - F.first("negativity").over(every),
            "first_to_last": F.last("negativity").over(every) - F.first("negativity").over(every),
            "never_falls": F.coalesce(F.min(F.col("change") >= 0).over(every), F.lit(True)),
        }
    )


def mark_partial_months(monthly: DataFrame, first_day, last_day) -> DataFrame:
    """Flag months that the collection period covers only in part."""
    start = F.lit(first_day).cast("date")
    end = F.lit(last_day).cast("date")
    partial = (F.col("month") < start) | (F.last_day("month") > end)
    return monthly.withColumn("is_partial", partial)


# Reviews that mention a phrase


def mentions(dim: DataFrame, phrase: str, text: str = "text") -> DataFrame:
    """Reviews whose text holds the phrase, case ignored."""
    return dim.filter(contains_ci(F.col(text), phrase))


def phrase_sentiment(
    dim: DataFrame, phrase: str, by: Sequence[str] = (), blank_counts: bool = False
) -> DataFrame:
    """Distinct reviews that mention the phrase, how many are negative, and their ratio, with 0
    where none mention it."""
    counted = distinct_per(
        mentions(dim, phrase), by, "review_id", {"negative": is_negative()}
    )
    return counted.withColumn(
        "negative_pct", safe_divide(F.col("negative"), F.col("total"), 0.0, blank_counts)
    )


def phrase_issue_pct(
    dim: DataFrame, fact: DataFrame, phrase: str, by: Sequence[str] = ()
) -> DataFrame:
    """Among negative reviews with the phrase, rows of an issue over rows of all issues, x 100.

    ``by`` names columns of the dimension that split both numbers. Counts are of fact rows.
    """
    cohort = mentions(dim, phrase).filter(is_negative()).select("review_id", *by)
    # Without a split the cohort is a set of ids; with one its columns are needed as well.
    rows = fact.join(cohort, "review_id", "inner") if by else in_ids(fact, cohort)
    counted = rows.groupBy(*by, "l2_specific_issue").agg(F.count(F.lit(1)).alias("n_rows"))
    # One row per issue and slice is left, so the total needs no further pass over the facts.
    slice_ = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    total = F.sum("n_rows").over(slice_)
    return counted.withColumn("pct", safe_divide(F.col("n_rows"), total) * 100)


def rank_issues(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank issues by their percentage, the largest first; equal ones share a rank."""
    slice_ = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return df.withColumn("rank", F.rank().over(slice_.orderBy(F.col("pct").desc())))


# Filters of a measure


def filter_set(
    outer: Mapping[str, Column] | None = None,
    override: Mapping[str, Column] | None = None,
    remove: Iterable[str] = (),
    table: Iterable[Column] = (),
) -> tuple[dict[str, Column], list[Column]]:
    """The filters that hold inside a measure.

    A filter on a column replaces the outer one on that column, a removed one is gone, and
    filters on the table come on top of both.
    """
    gone = set(remove)
    columns = {c: p for c, p in (outer or {}).items() if c not in gone}
    columns.update(override or {})
    return columns, list(table)


def measure(
    df: DataFrame,
    aggs: Sequence[Column],
    by: Sequence[str] = (),
    outer: Mapping[str, Column] | None = None,
    override: Mapping[str, Column] | None = None,
    remove: Iterable[str] = (),
    table: Iterable[Column] = (),
) -> DataFrame:
    """Aggregate under a filter context.

    A column of ``by`` is a filter too, one per row of the result. If the measure overrides or
    removes it, all rows that differ only in that column show the same value: the measure is
    computed without it and joined to the values the axis shows.
    """
    remove = list(remove)
    columns, tables = filter_set(outer, override, remove, table)
    rows = _where(df, [*columns.values(), *tables])
    replaced = {*(override or {}), *remove}
    fixed = [c for c in by if c in replaced]
    if not fixed:
        return rows.groupBy(*by).agg(*aggs)
    kept = [c for c in by if c not in replaced]
    axis = _where(df, (outer or {}).values()).select(*by).distinct()
    value = rows.groupBy(*kept).agg(*aggs)
    if kept:
        same = [F.col(f"_axis_{c}").eqNullSafe(F.col(c)) for c in kept]
        named = axis.select(*fixed, *[F.col(c).alias(f"_axis_{c}") for c in kept])
        values = [c for c in value.columns if c not in kept]
        picked = [F.col(c) if c in fixed else F.col(f"_axis_{c}").alias(c) for c in by]
        return named.join(value, same, "left").select(*picked, *values)
    # A single row of totals: put it next to each axis value as scalar subqueries.
    return axis.select(*by, *[value.select(c).scalar().alias(c) for c in value.columns])


def _where(df: DataFrame, predicates: Iterable[Column]) -> DataFrame:
    for predicate in predicates:
        df = df.filter(predicate)
    return df


# Collection


def coverage(
    df: DataFrame, targets: Mapping[str, int] | DataFrame, key: str
) -> DataFrame:
    """Rows collected per configured group against its target; groups without rows show 0."""
    if not isinstance(targets, DataFrame):
        targets = df.sparkSession.createDataFrame(
            list(targets.items()), f"`{key}` string, target bigint"
        )
    collected = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        targets.join(collected, key, "left")
        .withColumn("n_rows", F.coalesce("_rows", F.lit(0)))
        .drop("_rows")
        .withColumn("covered", safe_divide(F.col("n_rows"), F.col("target")))
    )


def observed_coverage(
    df: DataFrame, targets: Mapping[str, int], key: str, write: Callable[[DataFrame], None]
) -> DataFrame:
    """The same as ``coverage``, from the counts that ``write`` makes while it writes the rows it is
    given, all of them once, so that they are not scanned again. ``targets`` is the configured list."""
    counts = Observation()
    each = [F.count_if(F.col(key) == name).alias(f"n{i}") for i, name in enumerate(targets)]
    write(df.observe(counts, F.count(F.lit(1)).alias("all"), *each))
    rows = [(name, targets[name], counts.get[f"n{i}"]) for i, name in enumerate(targets)]
    collected = df.sparkSession.createDataFrame(rows, f"`{key}` string, target bigint, n_rows bigint")
    return collected.withColumn("covered", safe_divide(F.col("n_rows"), F.col("target")))
