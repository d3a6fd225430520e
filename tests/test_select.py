"""Selection against brute force, with one group that holds most rows."""

import itertools

import pytest
from pyspark.sql import functions as F

from echotide.functions.text import lookup
from echotide.operators import select as sel


def skewed_rows():
    """Two thirds of the rows fall in one group; times repeat, ids do not."""
    return [
        ("hot" if i % 3 else f"g{i % 5}", (i * 37) % 400, i, f"text {i % 90}") for i in range(3000)
    ]


@pytest.fixture
def skewed(spark):
    return spark.createDataFrame(skewed_rows(), "g string, t int, id int, text string")


def first(rows, n):
    out = set()
    for group, members in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        limit = n.get(group, 0) if isinstance(n, dict) else n
        out |= {r[2] for r in list(members)[:limit]}
    return out


def ids(df):
    got = [r["id"] for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("n", [1, 7, 250, 5000])
def test_budget_per_group(skewed, n):
    got = sel.budget_per_group(skewed, ["g"], ["t", "id"], n)
    assert ids(got) == first(skewed_rows(), n)
    assert got.columns == skewed.columns


@pytest.mark.parametrize("kind", ["mapping", "table"])
def test_budget_by_group(spark, skewed, kind):
    budget = {"hot": 40, "g0": 3, "absent": 5, "g1": 0}
    n = budget
    if kind == "table":
        n = spark.createDataFrame(list(budget.items()), "g string, target int")
    got = sel.budget_per_group(skewed, ["g"], ["t", "id"], n)
    assert ids(got) == first(skewed_rows(), budget)
    assert got.columns == skewed.columns


def test_budget_by_a_composite_key(spark, skewed):
    half = skewed.withColumn("h", F.col("id") % 2)
    n = spark.createDataFrame([("hot", 0, 4), ("hot", 1, 2), ("g1", 1, 1)], "g string, h int, target int")
    got = ids(sel.budget_per_group(half, ["g", "h"], ["t", "id"], n))
    want = set()
    for g, h, k in [("hot", 0, 4), ("hot", 1, 2), ("g1", 1, 1)]:
        want |= {r[2] for r in sorted(r for r in skewed_rows() if r[0] == g and r[2] % 2 == h)[:k]}
    assert got == want


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_budget_does_not_depend_on_partitions(skewed, partitions):
    got = sel.budget_per_group(skewed.repartition(partitions), ["g"], ["t", "id"], 25)
    assert ids(got) == first(skewed_rows(), 25)


@pytest.mark.parametrize("n", [5, 1300])
def test_newest_first_budget(skewed, n):
    got = ids(sel.budget_per_group(skewed, ["g"], [F.col("t").desc(), F.col("id").desc()], n))
    want = set()
    for g in {r[0] for r in skewed_rows()}:
        rows = sorted((r for r in skewed_rows() if r[0] == g), key=lambda r: (-r[1], -r[2]))
        want |= {r[2] for r in rows[:n]}
    assert got == want


def test_binned_rank_is_row_number(skewed):
    got = sel.binned_rank(skewed, ["g"], F.expr("t div 25"), ["t", "id"])
    for group, members in itertools.groupby(sorted(skewed_rows()), key=lambda r: r[0]):
        want = {r[2]: i for i, r in enumerate(members, 1)}
        have = {r["id"]: r["_rank"] for r in got.filter(F.col("g") == group).collect()}
        assert have == want


def test_binned_rank_counts_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", 1, 3)], "g string, t int, id int")
    got = {r["id"]: r["_rank"] for r in sel.binned_rank(df, ["g"], F.col("t"), ["t"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("n", [0, 1, 150, 700, 2500, 9999])
def test_global_budget(skewed, n):
    ranks = {"g0": 1, "g3": 2, "hot": 3, "g1": 4, "g2": 5, "g4": 6}
    ranked = skewed.withColumn("r", lookup(F.col("g"), ranks))
    got = sel.budget_global(ranked, "r", ["t", "id"], n)
    want = sorted(skewed_rows(), key=lambda r: (ranks[r[0]], r[1], r[2]))[:n]
    assert ids(got) == {r[2] for r in want}


def test_global_budget_with_overshoot(skewed):
    ranked = skewed.withColumn("r", F.when(F.col("g") == "g0", 1).when(F.col("g") == "hot", 2)
                               .otherwise(3))
    in_first = sum(r[0] == "g0" for r in skewed_rows())
    got = ids(sel.budget_global(ranked, "r", ["t", "id"], in_first + 1, overshoot=True))
    assert got == {r[2] for r in skewed_rows() if r[0] in ("g0", "hot")}


def test_keep_first_is_idempotent_and_exact(skewed):
    once = sel.dedup_keep_first(skewed, ["g", "text"], ["t", "id"])
    best = {}
    for g, t, i, text in skewed_rows():
        best[g, text] = min(best.get((g, text), (t, i)), (t, i))
    assert ids(once) == {i for _, i in best.values()}
    assert ids(sel.dedup_keep_first(once, ["g", "text"], ["t", "id"])) == ids(once)


def test_keep_first_and_null_or_cased_keys(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), ("A", 3), (None, 4), (None, 5)], "k string, id int"
    )
    assert ids(sel.dedup_keep_first(df, ["k"], ["id"])) == {1, 3}
    assert ids(sel.dedup_keep_first(df, ["k"], ["id"], drop_null_keys=False)) == {1, 3, 4}


def test_same_id_in_two_countries(spark):
    df = spark.createDataFrame([("a", "in", 1), ("a", "us", 2), ("a", "in", 3)],
                               "k string, country string, id int")
    assert ids(sel.dedup_keep_first(df, ["k", "country"], ["id"])) == {1, 2}
    assert ids(sel.dedup_keep_first(df, ["k"], ["id"])) == {1}


def test_dedup_text_uses_cleaned_text(spark):
    df = spark.createDataFrame([(1, "a b"), (2, " a b\n"), (3, "a\nb"), (4, None)],
                               "id int, text string")
    assert ids(sel.dedup_text(df, "text", ["id"])) == {1, 3, 4}
    assert ids(sel.dedup_text(df, "text", ["id"], keep_null=False)) == {1, 3}


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "", "x"), (2, " \t", ""), (3, None, None), (4, "y", None)], "id int, a string, b string"
    )
    assert ids(sel.drop_blank(df, "a")) == {4}
    assert ids(sel.drop_empty(df, ["a", "b"])) == {1, 2, 4}
    assert ids(sel.drop_empty(df, ["a", "b"], all=False)) == set()


def test_cutoff_is_thirty_days_a_month(spark):
    df = spark.sql("select id, timestamp '2026-06-01' - make_dt_interval(cast(id as int)) ts "
                   "from range(100)")
    assert ids(sel.since_months(df, "ts", "2026-06-01", 2)) == set(range(61))


@pytest.mark.parametrize("kind", ["few", "many", "table"])
def test_first_keyword_wins(spark, kind):
    df = spark.createDataFrame([(1, "Gold refund"), (2, "refund"), (3, "none"), (4, None)],
                               "id int, title string")
    keywords = ["refund", "gold"]
    if kind == "many":
        keywords += [f"never {i}" for i in range(300)]
    if kind == "table":
        keywords = spark.createDataFrame([("gold", 1), ("refund", 0)], "keyword string, rank int")
    got = sel.keyword_match(df, keywords, "title")
    assert got.columns == ["id", "title", "keyword"]
    assert {(r["id"], r["keyword"]) for r in got.collect()} == {(1, "refund"), (2, "refund")}


def test_order(skewed):
    newest = [(r["t"], r["id"]) for r in sel.newest_first(skewed, "t", "id").collect()]
    assert newest == sorted(newest, key=lambda p: (-p[0], p[1]))
    top = [(r["t"], r["id"]) for r in sel.top_n(skewed, "t", "id", 5).collect()]
    assert top == newest[:5]
