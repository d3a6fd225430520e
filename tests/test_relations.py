"""Filter contexts, bitmaps of ids and seen keys on small tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from echotide.operators import bitmaps as bm
from echotide.operators.context import Model
from echotide.operators.measures import is_negative
from echotide.operators.seen import SeenKeys

DIM, L1 = "dim_reviews_core", "fact_l1_tags"


@pytest.fixture
def model(spark):
    dim = spark.createDataFrame(
        [("1", "Google Play", "a"), ("2", "google play", None), ("3", None, "b"), ("4", "Reddit", "b")],
        "review_id string, platform string, source string",
    )
    rows = [("1", "X", "Negative"), ("1", "Y", "negative"), ("2", "X", "Positive"), ("3", "x", "Negative"),
            ("4", "Y", "Negative"), ("9", "X", "Negative"), (None, "Y", "Negative")]
    fact = spark.createDataFrame(rows, "review_id string, l1_category string, sentiment string")
    return Model({DIM: dim, L1: fact})


def ids(df):
    return sorted((r["review_id"] or "-") for r in df.collect())


def test_filters_go_one_way(model):
    assert ids(model.keep(DIM, "platform", ["GOOGLE PLAY"]).visible(L1)) == ["1", "1", "2"]
    own = model.keep(L1, "l1_category", ["x"])
    assert ids(own.visible(L1)) == ["1", "2", "3", "9"] and ids(own.visible(DIM)) == ["1", "2", "3", "4"]


def test_unknown_member_is_blank(model):
    assert ids(model.visible(L1)) == ["-", "1", "1", "2", "3", "4", "9"]
    assert ids(model.drop(DIM, "platform", ["reddit"]).visible(L1)) == ["-", "1", "1", "2", "3", "9"]
    assert ids(model.keep(DIM, "platform", [None]).visible(L1)) == ["-", "3", "9"]
    assert ids(model.keep(DIM, "platform", [None, "Reddit"]).visible(L1)) == ["-", "3", "4", "9"]
    assert ids(model.drop(DIM, "platform", [None]).visible(L1)) == ["1", "1", "2", "4"]
    assert ids(model.where(DIM, F.col("source") == "b").visible(L1)) == ["3", "4"]
    grouped = model.distinct_reviews(L1, ["platform"], negative=is_negative())
    # The review without a platform and the unknown member are both blank; a null id is no review.
    assert {(r["platform"], r["total"], r["negative"]) for r in grouped.collect()} == {
        ("Google Play", 1, 1), ("google play", 1, 0), (None, 2, 2), ("Reddit", 1, 1)}


def test_later_filters_replace_or_add(model):
    play = model.keep(DIM, "platform", ["Google Play"])
    assert ids(play.keep(DIM, "platform", ["Reddit"]).visible(DIM)) == ["4"]
    assert ids(play.keep(DIM, "platform", ["Reddit"], add=True).visible(DIM)) == []
    assert ids(play.keep(DIM, "source", ["A"]).visible(DIM)) == ["1"]
    assert ids(play.keep(DIM, "source", ["A"]).clear(DIM, "platform").visible(DIM)) == ["1"]
    assert ids(play.clear(DIM).visible(DIM)) == ["1", "2", "3", "4"]
    with pytest.raises(ValueError):
        model.keep("other", "x", [1])


def test_share_of_a_cleared_context(model):
    some = model.keep(L1, "l1_category", ["X"])
    got = some.share(L1, ["l1_category"], ["l1_category"]).collect()
    assert {(r["l1_category"], r["n_rows"], r["n_all"]) for r in got} == {("X", 3, 7), ("x", 1, 7)}


def test_reaching_a_fact_moves_keys_only(model):
    from test_plans import plan  # noqa: PLC0415

    text = plan(model.drop(DIM, "platform", ["reddit"]).visible(L1))
    assert "LeftAnti" in text and text.count("Join") == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_add_up(spark, seed):
    rng = random.Random(seed)
    rows = [(f"r{rng.randrange(900)}", rng.randrange(20), rng.choice(["a", "b", "c", None])) for _ in range(4000)]
    rows += [(None, 3, "a")]
    fact = spark.createDataFrame(rows, "review_id string, day int, cat string")
    early = fact.filter("day < 9")
    known = spark.createDataFrame(
        bm.new_ordinals(early).collect(), "review_id string, ordinal long"
    )
    more = spark.createDataFrame(
        bm.new_ordinals(fact, known).collect(), "review_id string, ordinal long"
    )
    assert known.join(more, "review_id").isEmpty()
    ordinals = known.unionByName(more)
    assert ordinals.select("ordinal").distinct().count() == len({r[0] for r in rows}) - 1
    maps = bm.bitmaps(fact, ordinals, ["day", "cat"])
    want, all_ids = defaultdict(set), set()
    for i, _, cat in rows:
        if i is not None:
            want[cat].add(i)
            all_ids.add(i)
    levels = bm.counts_with_total(maps, ["cat"]).collect()
    got = {r["cat"]: r["n_reviews"] for r in levels if r["level"] == 0}
    assert got == {c: len(s) for c, s in want.items()}
    assert [r["n_reviews"] for r in levels if r["level"] == 1] == [len(all_ids)]
    weeks = bm.distinct_counts(maps, [F.floor(F.col("day") / 7).alias("week")])
    for r in weeks.collect():
        assert r["n_reviews"] == len({i for i, d, _ in rows if i and d // 7 == r["week"]})


def test_seen_over_runs(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "seen"), buckets=8, expected=2_000)
    rng, before = random.Random(5), set()
    for run in range(3):
        rows = [(f"k{rng.randrange(500)}", run, n) for n in range(400)] + [(None, run, 1)] * 3
        df = spark.createDataFrame(rows, "id string, run int, n int")
        new = seen.take_new(df, ["id"], ["n"], str(tmp_path / "staging")).collect()
        first = {}
        for i, r, n in rows:
            if i is not None:
                first.setdefault(i, (i, r, n))
        assert sorted(tuple(r) for r in new) == sorted(v for k, v in first.items() if k not in before)
        before |= set(first)
    again = spark.createDataFrame([(i, 9, 9) for i in sorted(before)], "id string, run int, n int")
    assert seen.take_new(again, ["id"], ["n"], str(tmp_path / "staging")).collect() == []
    empty = spark.createDataFrame([], "id string, run int, n int")
    assert seen.take_new(empty, ["id"], ["n"], str(tmp_path / "staging")).collect() == []


def test_untouched_buckets_are_not_read(spark, tmp_path):
    seen = SeenKeys(spark, str(tmp_path / "seen"), buckets=16, expected=100_000)
    df = spark.range(3_000).selectExpr("cast(id as string) id")
    assert seen.take_new(df, ["id"], ["id"], str(tmp_path / "staging")).count() == 3_000
    fresh = spark.range(1_000_000, 1_000_500).selectExpr("cast(id as string) id")
    asked = seen.maybe_seen(seen._hashed(fresh, ["id"]), ["id"])
    assert asked.filter("maybe").count() < 25  # one in a hundred, at most
    # Folders of other buckets are pruned before the scan lists its files.
    some = seen.known_keys([3], "id string")
    some.collect()
    scans = some._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans.apply(0).metrics().apply("numFiles").value() <= 4 < 16
    assert {r["bucket"] for r in some.collect()} == {3}


def test_bits_without_keys_cost_nothing(spark, tmp_path):
    """A run that stopped between bitmaps and keys is repeated."""
    seen = SeenKeys(spark, str(tmp_path / "seen"), buckets=4, expected=100)
    df = spark.range(50).selectExpr("cast(id as string) id")
    seen.take_new(df, ["id"], ["id"], str(tmp_path / "staging"))
    half = SeenKeys(spark, str(tmp_path / "half"), buckets=4, expected=100)
    filters = spark.read.parquet(str(tmp_path / "seen" / "filters"))
    filters.write.partitionBy("bucket").parquet(str(tmp_path / "half" / "filters"))
    assert half.take_new(df, ["id"], ["id"], str(tmp_path / "staging")).count() == 50
    assert half.take_new(df, ["id"], ["id"], str(tmp_path / "staging")).count() == 0
