"""Measures: known values, edges of the filter context, invariants."""

import datetime

import pytest
from pyspark.sql import functions as F

from echotide.operators import measures as ms
from echotide.plans import fixtures as fx

D = datetime.date


@pytest.fixture(scope="module", params=["0.001", "0.01"])
def known(request):
    """Values both engines gave on these tables when the views were laid down."""
    small = request.param == "0.001"
    return {
        "dir": f"/root/testdata/sf{request.param}",
        "december": 0.227272727 if small else 0.32173913,
        "by_l1": (6, 16, 1) if small else (43, 91, 5),
        "phrase": (1, 3) if small else (9, 39),
        "pct": [100.0] if small else [61.538, 23.077, 15.385],
        "tags": (154, 98) if small else (809, 516),
    }


def test_known_values(spark, known):
    sf = known["dir"]
    months = {
        r["month"]: r["negativity"]
        for r in ms.negativity_pct(fx.dim(spark, sf), floor=fx.FLOOR).collect()
    }
    assert len(months) == 6 and round(months[D(2025, 12, 1)], 9) == known["december"]
    by = {
        r["l1_category"]: r["negative_reviews"]
        for r in ms.negative_reviews(fx.l1(spark, sf), floor=fx.FLOOR).collect()
    }
    names = ("Customer Support", "Fulfillment & Logistics", "Value & Pricing")
    assert tuple(by[n] for n in names) == known["by_l1"]
    row = ms.phrase_sentiment(fx.dim(spark, sf), fx.PHRASE).first()
    assert (row["negative"], row["total"]) == known["phrase"]
    pct = ms.phrase_issue_pct(fx.dim(spark, sf), fx.l2(spark, sf), fx.PHRASE).collect()
    assert sorted((round(r["pct"], 3) for r in pct), reverse=True) == known["pct"]
    l2 = fx.l2(spark, sf)
    assert (l2.count(), l2.select("review_id").distinct().count()) == known["tags"]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [
            ("1", D(2025, 12, 1), "negative", "ACME GOLD is bad", "A"),
            ("2", D(2025, 12, 31), "Positive", "acme gold ok", "A"),
            ("3", D(2025, 11, 30), "Negative", "acme gold", "B"),
            ("4", D(2026, 1, 5), None, "other", "B"),
            ("5", D(2026, 1, 6), "Neutral", "acme gold", "C"),
            ("6", D(2026, 1, 7), "Negative", None, "C"),
        ],
        "review_id string, review_date date, sentiment string, text string, platform string",
    )


@pytest.fixture
def l2(spark):
    return spark.createDataFrame(
        [("1", "x"), ("1", "x"), ("1", "y"), ("2", "x"), ("3", "y"), ("9", "x")],
        "review_id string, l2_specific_issue string",
    )


PHRASE = "Acme Gold"


def test_floor_is_inclusive_and_case_is_ignored(dim):
    rows = ms.negativity_pct(dim, ["month"], "2025-12-01").orderBy("month").collect()
    assert [(r["n_negative"], r["n_reviews"]) for r in rows] == [(1, 2), (1, 3)]
    assert ms.negativity_pct(dim, []).first()["n_reviews"] == 6


def test_ingest_dates_can_be_left_out(dim):
    marked = dim.withColumn("date_is_ingest", F.col("review_id") == "4")
    rows = ms.negativity_pct(marked, [], exclude_ingest_dates=True).first()
    assert rows["n_reviews"] == 5


def test_phrase_measures(dim):
    row = ms.phrase_sentiment(dim, PHRASE).first()
    assert (row["total"], row["negative"], row["negative_pct"]) == (4, 2, 0.5)
    by = {r["platform"]: r for r in ms.phrase_sentiment(dim, PHRASE, ["platform"]).collect()}
    assert by["C"]["negative_pct"] == 0
    blank = ms.phrase_sentiment(dim, PHRASE, ["platform"], blank_counts=True).collect()
    assert {r["platform"]: r["negative_pct"] for r in blank}["C"] is None


def test_empty_cohort(dim, l2):
    row = ms.phrase_sentiment(dim, "no such phrase").first()
    assert (row["total"], row["negative"], row["negative_pct"]) == (0, 0, 0)
    assert ms.phrase_issue_pct(dim, l2, "no such phrase").collect() == []


def test_issue_shares_count_rows_and_sum_to_hundred(dim, l2):
    rows = {r["l2_specific_issue"]: r for r in ms.phrase_issue_pct(dim, l2, PHRASE).collect()}
    assert (rows["x"]["n_rows"], rows["y"]["n_rows"]) == (2, 2)
    assert rows["x"]["pct"] == 50
    sliced = ms.phrase_issue_pct(dim, l2, PHRASE, ["platform"])
    totals = sliced.groupBy("platform").agg(F.round(F.sum("pct"), 6).alias("t")).collect()
    assert {r["platform"]: r["t"] for r in totals} == {"A": 100.0, "B": 100.0}


def test_ranks_are_shared(dim, l2):
    ranked = ms.rank_issues(ms.phrase_issue_pct(dim, l2, PHRASE)).collect()
    assert {r["rank"] for r in ranked} == {1}


@pytest.fixture
def l1(spark):
    return spark.createDataFrame(
        [("1", D(2025, 12, 1), "Negative", "S"), ("1", D(2025, 12, 1), "Negative", "P"),
         ("2", D(2025, 12, 2), "negative", "S"), ("3", D(2025, 12, 2), "Positive", "S"),
         ("4", D(2025, 11, 2), "Negative", "S"), ("5", D(2025, 12, 2), None, "P")],
        "review_id string, review_date date, sentiment string, l1_category string",
    )


def test_total_is_not_the_sum(l1):
    rows = ms.negative_reviews_with_total(l1, floor="2025-12-01").collect()
    got = {(r["l1_category"], r["level"]): r["negative_reviews"] for r in rows}
    assert got == {("S", 0): 2, ("P", 0): 1, (None, 1): 2}


def test_shares(l1):
    reviews = {r["l1_category"]: r["share"] for r in ms.negative_share(l1).collect()}
    assert reviews == {"S": 1.0, "P": 1 / 3}
    cats = {r["l1_category"]: r["share"] for r in ms.negative_share(l1, "categories").collect()}
    assert cats == {"S": 0.75, "P": 0.25}
    with pytest.raises(ValueError):
        ms.negative_share(l1, "other")


def test_trend(spark):
    monthly = spark.createDataFrame(
        [(D(2026, 1, 1), 0.5), (D(2026, 2, 1), 0.75), (D(2026, 3, 1), 0.75)],
        "month date, negativity double",
    )
    rows = ms.negativity_trend(monthly).orderBy("month").collect()
    assert [r["change"] for r in rows] == [None, 0.25, 0.0]
    assert [r["change_from_first"] for r in rows] == [0.0, 0.25, 0.25]
    assert all(r["never_falls"] and r["first_to_last"] == 0.25 for r in rows)
    falling = monthly.withColumn("negativity", -F.col("negativity"))
    assert not ms.negativity_trend(falling).first()["never_falls"]
    partial = ms.mark_partial_months(monthly, "2026-01-02", "2026-03-31").orderBy("month").collect()
    assert [r["is_partial"] for r in partial] == [True, False, False]


def negative_mentions(dim, by, **filters):
    return ms.measure(
        dim,
        [F.count_distinct("review_id").alias("n")],
        by,
        override={
            "text": F.contains(F.lower("text"), F.lit("acme gold")),
            "sentiment": ms.is_negative(),
        },
        **filters,
    )


def test_column_filter_replaces_the_axis(dim):
    rows = negative_mentions(dim, ["sentiment"]).collect()
    assert len(rows) == 5  # negative and Negative are two values of the axis
    assert {r["n"] for r in rows} == {2}
    by = {(r["platform"], r["sentiment"]): r["n"]
          for r in negative_mentions(dim, ["platform", "sentiment"]).collect()}
    assert by[("A", "Positive")] == by[("A", "negative")] == 1
    assert by[("C", "Neutral")] is None


def test_other_outer_filters_still_hold(dim):
    outer = {"platform": F.col("platform") == "A", "sentiment": F.col("sentiment") == "Positive"}
    assert negative_mentions(dim, [], outer=outer).first()["n"] == 1


def test_table_filter_meets_the_outer_one(dim):
    outer = {"sentiment": F.col("sentiment") == "Positive"}
    aggs = [F.count(F.lit(1)).alias("n")]
    assert ms.measure(dim, aggs, outer=outer, table=[ms.is_negative()]).first()["n"] == 0
    removed = ms.measure(dim, aggs, outer=outer, remove=["sentiment"], table=[ms.is_negative()])
    assert removed.first()["n"] == 3


def test_coverage_shows_groups_without_rows(dim):
    rows = {r["platform"]: r for r in
            ms.coverage(dim, {"A": 4, "Z": 5, "B": 0}, "platform").collect()}
    assert (rows["A"]["n_rows"], rows["A"]["covered"]) == (2, 0.5)
    assert (rows["Z"]["n_rows"], rows["Z"]["covered"]) == (0, 0.0)
    assert rows["B"]["covered"] is None and "C" not in rows
