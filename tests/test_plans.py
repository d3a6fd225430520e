"""Properties of the physical plans that results cannot show."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from echotide.operators import select as sel
from echotide.operators.sentiment import lexicon_score, rule_score

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


STREAMS = {"stream_daily", "stream_dedup", "stream_budget_per_app", "stream_budget_global",
           "stream_cursor_feed"}
CORPUS = {n for n in contract.queries() if n.startswith("op") or n == "pipeline"}


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - STREAMS - CORPUS))
def test_no_query_pairs_all_rows(spark, sf, name):
    text = plan(contract.queries()[name](spark, sf))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_groups_are_cut_before_the_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    for df in (
        sel.dedup_keep_first(events, ["user_id"], ["ts", "event_id"]),
        sel.budget_per_group(events, ["event_type"], ["ts", "event_id"], 50),
    ):
        text = plan(df)
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit", text)


def test_date_floor_reaches_the_scan_and_columns_are_pruned(spark, tmp_path):
    spark.sql("select id, date '2025-12-01' d, 'x' text, 'y' other from range(10)").write.parquet(
        str(tmp_path / "t")
    )
    df = sel.date_floor(spark.read.parquet(str(tmp_path / "t")), "d", "2025-12-01").select("id")
    text = plan(df)
    assert "GreaterThanOrEqual(d,2025-12-01)" in text
    assert "ReadSchema: struct<id:bigint,d:date>" in text


def test_text_queries_read_without_a_shuffle(spark, sf):
    for name in ("clean_text", "html_text", "tag_rules_table", "keyword_match_table", "page_links"):
        text = plan(contract.queries()[name](spark, sf))
        assert "Exchange" not in text, name


def test_texts_are_scored_where_they_stand(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for scored in (lexicon_score(docs, [("good", 1.9)]), rule_score(docs, [("good", 1.9)])):
        text = plan(scored.filter("sentiment_score > 0"))
        assert "Exchange" not in text
        assert text.count("FileScan") == 1 and text.count("ArrowEvalPython") == 1


def test_heavy_columns_are_computed_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = plan(sel.dedup_text(docs, "text", [F.col("doc_id")]))
    assert text.count("regexp_replace") == 1


def test_links_stay_in_their_row(spark, sf):
    from echotide.sources.pages import extract_links

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert "Exchange" not in plan(extract_links(pages, "example.com", cap=3))
