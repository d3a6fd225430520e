"""Invariants of the star schema, and writing it."""

import datetime

import pytest
from pyspark.sql import functions as F

from echotide.operators import measures as ms
from echotide.operators import published as pub
from echotide.operators import star as st
from echotide.plans import fixtures as fx


@pytest.fixture(scope="module")
def star(spark, sf):
    return fx.star(spark, sf)


def test_dimension_key_is_unique(star):
    dim = star["dim_reviews_core"]
    assert st.duplicate_keys(dim).count() == 0
    assert dim.columns == [
        "review_id", "review_date", "sentiment", "text", "source", "username", "platform"
    ]


def test_no_orphans(star):
    for name in ("fact_l1_tags", "fact_l2_tags"):
        assert st.orphan_facts(star["dim_reviews_core"], star[name]).count() == 0
    row = st.check_keys(star["dim_reviews_core"], star["fact_l2_tags"]).first()
    assert tuple(row) == (0, 0)


def test_l1_is_unique_and_l2_keeps_rows(star):
    l1, l2 = star["fact_l1_tags"], star["fact_l2_tags"]
    assert l1.count() == l1.select("review_id", "l1_category").distinct().count()
    assert l2.count() > l2.distinct().count()


def test_first_collected_wins(spark):
    rows = [
        ("a", datetime.date(2025, 12, 1), "Negative", "t1", "in", "u", "p", 2, "L", "x"),
        ("a", datetime.date(2025, 12, 2), "Positive", "t0", "us", "u", "p", 1, "L", "x"),
        (None, datetime.date(2025, 12, 2), "Positive", "t", "us", "u", "p", 0, "L", " "),
        ("b", None, None, "t", "us", "u", "p", 5, None, "No Specific Issue Stated"),
    ]
    base = spark.createDataFrame(
        rows,
        "review_id string, review_date date, sentiment string, text string, source string, "
        "username string, platform string, arrival int, l1_category string, "
        "l2_specific_issue string",
    )
    dim = {r["review_id"]: r["text"] for r in st.dim_reviews_core(base).collect()}
    assert dim == {"a": "t0", "b": "t"}
    extra = st.dim_reviews_core(base, extra=["arrival"])
    assert extra.columns[-1] == "arrival"
    assert [(r["review_id"], r["sentiment"]) for r in st.fact_l1(base).collect()] == [
        ("a", "Positive")
    ]
    assert st.fact_l2(base).count() == 3
    assert st.fact_l2(base, exclude_default=True).count() == 2


def test_fact_without_review_keeps_nulls(spark):
    fact = spark.createDataFrame([("a", "x"), ("z", "y")], "review_id string, l2 string")
    dim = spark.createDataFrame([("a", "p", "s")], "review_id string, platform string, source string")
    got = {r["review_id"]: r["platform"] for r in st.with_dim(fact, dim).collect()}
    assert got == {"a": "p", "z": None}


def test_write_and_read(spark, sf, tmp_path):
    base = fx.collected_twice(spark, sf)
    st.write_star(base, str(tmp_path / "star"), str(tmp_path / "staging"))
    assert list((tmp_path / "staging").iterdir()) == []
    back = st.read_star(spark, str(tmp_path / "star"))
    for name, want in fx.star(spark, sf).items():
        got = back[name].select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "review_month" in back["dim_reviews_core"].columns
    pruned = back["dim_reviews_core"].filter(F.col("review_month") == "2025-12-01")
    assert "PartitionFilters: [isnotnull(review_month" in pruned._jdf.queryExecution().toString()


def test_dimension_is_made_without_tags(spark, sf):
    dim = fx.star(spark, sf)["dim_reviews_core"]
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "tags" not in plan


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_failed_publication_leaves_the_last(spark, sf, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "star"), str(tmp_path / "staging")
    base = fx.collected_twice(spark, sf)
    assert pub.versions(spark, path).count() == 0 and pub.latest_version(spark, path) is None
    with pytest.raises(ValueError, match="no version"):
        pub.read_published(spark, path)
    assert pub.publish_star(base, path, staging) == 1
    before = pub.read_published(spark, path)

    # The third of three writes fails.
    broken = F.raise_error(F.lit("third write")).cast("string")
    whole = st.fact_l2
    monkeypatch.setattr(
        st, "fact_l2", lambda base: whole(base).withColumn("l2_specific_issue", broken)
    )
    with pytest.raises(Exception, match="third write"):
        pub.publish_star(base.filter("arrival % 2 = 0"), path, staging)
    monkeypatch.undo()
    assert pub.latest_version(spark, path) == 1
    assert len(list((tmp_path / "star" / "versions").iterdir())) == 1
    assert list((tmp_path / "staging").iterdir()) == []
    for name, want in fx.star(spark, sf).items():
        assert same(want, pub.read_published(spark, path)[name])

    # A reader of the first version stays in it; the counts are those of the tables.
    assert pub.publish_star(base.limit(0), path, staging) == 2
    counted = {r["version"]: r["n_rows"] for r in pub.versions(spark, path).collect()}
    assert counted[1] == {name: table.count() for name, table in before.items()}
    assert counted[2] == dict.fromkeys(before, 0)
    assert pub.read_published(spark, path)["fact_l2_tags"].count() == 0
    assert same(before["fact_l1_tags"], pub.read_published(spark, path, 1)["fact_l1_tags"])
    assert pub.retire(spark, path, keep=1) == [1] and pub.retire(spark, path, keep=1) == []
    assert pub.latest_version(spark, path) == 2
    with pytest.raises(ValueError, match="newest"):
        pub.retire(spark, path, keep=0)


def test_observed_coverage(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "app string")
    targets = {"a": 4, "b": 2, "zero": 0}
    place = str(tmp_path / "rows")
    got = ms.observed_coverage(rows, targets, "app", lambda df: df.write.parquet(place))
    assert same(ms.coverage(rows, targets, "app"), got)
    assert spark.read.parquet(place).count() == 4
    none = ms.observed_coverage(
        rows.limit(0), targets, "app", lambda df: df.write.parquet(place + "-none")
    )
    assert same(ms.coverage(rows.limit(0), targets, "app"), none)
