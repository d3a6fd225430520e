"""Columns that ignore case, in joins, groups, counts and filters."""

import pytest
from pyspark.sql import functions as F

from echotide.operators import collation, select

IDS = [("a1", 1), ("A1", 2), ("b", 3), (None, 4), ("É", 5), ("é", 6), ("", 7)]


def test_groups_joins_and_filters_ignore_case(spark):
    df = spark.createDataFrame(IDS, "id string, n int")
    free = collation.ignoring_case(df, "id")
    assert free.agg(F.count_distinct("id")).first()[0] == 4
    assert df.agg(F.count_distinct("id")).first()[0] == 6
    assert sorted(r["n"] for r in free.filter(F.col("id") == F.lit("A1")).collect()) == [1, 2]
    other = collation.ignoring_case(spark.createDataFrame([("B",), ("a1",), (None,)], "id string"))
    assert sorted(r["n"] for r in free.join(other, "id").collect()) == [1, 2, 3]
    kept = select.dedup_keep_first(free, ["id"], ["n"])
    assert sorted(r["n"] for r in kept.collect()) == [1, 3, 5, 7]  # rows without an id are no rows
    back = collation.exact_case(free)
    assert back.schema["id"].dataType.simpleString() == "string"
    assert back.agg(F.count_distinct("id")).first()[0] == 6


def test_one_spelling_per_value(spark):
    df = collation.ignoring_case(spark.createDataFrame(IDS, "id string, n int"))
    rows = collation.first_spelling(df, "id").collect()
    assert {r["n"]: r["id"] for r in rows} == {
        1: "A1", 2: "A1", 3: "b", 4: None, 5: "É", 6: "É", 7: "",
    }
    assert collation.first_spelling(df.limit(0), "id").collect() == []


def test_only_texts_can_ignore_case(spark):
    df = spark.createDataFrame(IDS, "id string, n int")
    with pytest.raises(ValueError):
        collation.ignoring_case(df, "n")
