"""Tags, products and sentiment against brute force."""

import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from echotide.operators import enrich, phrases, sentiment
from echotide.operators.enrich import IssueRule

RULES = [
    IssueRule("Support", "No Reply", "no reply"),
    IssueRule("Support", "Rude", "rude"),
    IssueRule("Support", "Rude", "shout"),
    IssueRule("Price", "Fee", "fee"),
    IssueRule("Price", "Short", "x"),
]
TEXTS = ["No reply and a FEE", "they shout, rude", "coffee", "", None, "all good", "X", "x\nfee"]


def brute(text, rules):
    low = (text or "").lower()
    return {(r.l1, r.l2) for r in rules if r.keyword.lower() in low}


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(TEXTS)], "review_id string, text string"
    )


def tags(df):
    return {r["review_id"]: [tuple(t) for t in r["tags"]] for r in df.collect()}


@pytest.mark.parametrize("kind", ["list", "long list", "table", "many blocks"])
def test_all_rules_tag_alike(spark, reviews, kind, monkeypatch):
    rules = RULES
    if kind == "long list":
        rules = RULES + [IssueRule("None", "None", f"never {i}") for i in range(200)]
    elif kind != "list":
        if kind == "many blocks":
            monkeypatch.setattr(phrases, "BLOCK_CHARACTERS", 5)
        rows = [*RULES, *RULES, IssueRule("a", "b", ""), IssueRule("a", "b", None)]
        rules = spark.createDataFrame(rows, "l1 string, l2 string, keyword string")
    got = tags(enrich.tag_issues(reviews, rules))
    assert got == {str(i): sorted(brute(t, RULES)) for i, t in enumerate(TEXTS)}


def test_repeated_and_missing_ids_keep_their_own_tags(spark):
    rows = [("1", "fee"), ("1", "rude"), (None, "no reply"), (None, None), ("1", "fee")]
    df = spark.createDataFrame(rows, "review_id string, text string")
    got = enrich.tag_issues(df, RULES).collect()
    assert sorted((str(r["review_id"]), [t["l2"] for t in r["tags"]]) for r in got) == sorted(
        [("1", ["Fee"]), ("1", ["Rude"]), ("None", ["No Reply"]), ("None", []), ("1", ["Fee"])]
    )
    plan = enrich.tag_issues(df, RULES)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_no_rules_no_tags(reviews):
    assert set(map(tuple, tags(enrich.tag_issues(reviews, [])).values())) == {()}


def test_default_issue(reviews):
    rows = enrich.explode_tags(enrich.with_default_issue(enrich.tag_issues(reviews, RULES)))
    plain = rows.filter(F.col("review_id") == "5").collect()
    assert [(r["l1_category"], r["l2_specific_issue"]) for r in plain] == [
        (None, "No Specific Issue Stated")
    ]
    assert rows.filter("review_id = '0'").count() == 2


def test_product_rules_are_ordered(spark):
    df = spark.createDataFrame(
        [("Blinkit in the district", ""), ("District app", ""), ("food", "https://x/BLINKIT"),
         ("food", None), (None, None)], "t string, u string"
    )
    got = [r[0] for r in df.select(enrich.product_tag(F.col("t"), F.col("u"))).collect()]
    assert got == ["Blinkit", "District", "Blinkit", "Zomato", "Zomato"]


def test_canonical_platform(values):
    assert values(enrich.canonical_platform, ["Google Play", "Reddit", None]) == [
        "Google Play Store", "Reddit", None,
    ]


LEXICON = [("good", 1.9), ("bad", -2.5), (":)", 2.0), ("awful", -2.0), ("é", 0.5)]
SAID = ["Good, good... (bad)!", ":) fine", "", None, "awful\nAWFUL", "É «good»", "goods"]


def brute_score(text):
    punctuation = sentiment.PUNCTUATION
    total = 0.0
    for piece in (text or "").lower().split():
        bare = piece.strip(punctuation)
        total += dict(LEXICON).get(piece if len(bare) <= 2 else bare, 0.0)
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.fixture(params=["held", "joined"])
def way(request, monkeypatch):
    """Both ways to the same scores: a lexicon within the bound, and one beyond it."""
    if request.param == "joined":
        monkeypatch.setattr(sentiment, "HELD_CHARACTERS", 0)


@pytest.mark.parametrize("kind", ["list", "table"])
def test_scores(spark, kind, way):
    rows = list(enumerate(SAID)) + [(0, SAID[4]), (None, SAID[0]), (None, SAID[0])]
    df = spark.createDataFrame(rows, "review_id int, text string")
    lexicon = LEXICON
    if kind == "table":
        lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    got = sentiment.lexicon_score(df, lexicon).collect()
    assert sorted((str(r["review_id"]), r["text"] or "", r["sentiment_score"]) for r in got) == sorted(
        (str(i), t or "", brute_score(t)) for i, t in rows
    )


def test_first_spelling_of_a_word_counts(spark, way):
    df = spark.createDataFrame([(1, "good")], "review_id int, text string")
    words = [("good", 1.0), ("Good", 3.0), ("Good", 2.0), (None, 1.0), ("bad", None)]
    score = sentiment.lexicon_score(df, words).first()["sentiment_score"]
    assert score == round(2 / math.sqrt(4 + 15), 4)


def test_many_words_are_found(spark):
    lexicon = [(f"word{i}", (i % 9 - 4) / 2) for i in range(5000)]
    df = spark.range(0, 5000, 97).select(
        F.col("id").alias("review_id"), F.concat(F.lit("word"), "id").alias("text")
    )
    rows = sentiment.lexicon_score(df, lexicon).collect()
    for r in rows:
        v = (r["review_id"] % 9 - 4) / 2
        assert r["sentiment_score"] == round(v / math.sqrt(v * v + 15), 4)


def test_texts_of_a_batch_become_strings_slice_by_slice(spark, monkeypatch):
    """However large a batch, few of its texts are Python strings at once, with the same results."""
    texts = ["good day " * 50, None, "", "bad é " * 70, "good"] * 40
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    parts = list(phrases.slices(pa.array(texts)))
    assert [t for part in parts for t in part] == texts
    assert all(sum(len((t or "").encode()) for t in part[:-1]) < 500 for part in parts)
    assert list(phrases.slices(pa.array([], pa.string()))) == []
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rules = [enrich.IssueRule("a", "b", "day"), enrich.IssueRule("a", "c", "é")]
    found = sentiment.lexicon_score(enrich.tag_issues(df, rules), [("good", 1.0), ("bad", -1.0)])
    for r in found.collect():
        t = r["text"] or ""
        assert [x["l2"] for x in r["tags"]] == ["b"] * ("day" in t) + ["c"] * ("é" in t)
        assert (r["sentiment_score"] > 0) == ("good" in t) and (r["sentiment_score"] < 0) == ("bad" in t)


def test_label_thresholds(values):
    scores = [0.05, 0.0499, 0.0, -0.0499, -0.05]
    assert values(sentiment.sentiment_label, scores, "double") == [
        "Positive", "Neutral", "Neutral", "Neutral", "Negative",
    ]


# Valences of a few words, and the scores the model's authors state for these sentences.
STATED = [("smart", 1.7), ("handsome", 2.2), ("funny", 1.9), ("good", 1.9), ("horrible", -2.5)]
SENTENCES = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("The book was good.", 0.4404),
    ("At least it isn't a horrible book.", 0.431),
    ("", 0.0),
    (None, 0.0),
    ("nothing known!!", 0.0),
]


def test_context_rules(spark, way):
    df = spark.createDataFrame(
        [(i, t) for i, (t, _) in enumerate(SENTENCES)], "review_id int, text string"
    )
    rows = sentiment.rule_score(df, STATED).orderBy("review_id").collect()
    assert [r["sentiment_score"] for r in rows] == [score for _, score in SENTENCES]


def test_but_never_and_questions(spark, way):
    said = ["good but horrible", "never so good", "without doubt good", "horrible??", "good???? ok"]
    df = spark.createDataFrame(list(enumerate(said)), "review_id int, text string")
    rows = sentiment.rule_score(df, STATED).orderBy("review_id").collect()
    sums = [
        1.9 * 0.5 - 2.5 * 1.5,
        # "so" boosts by itself, then "never so" strengthens.
        (1.9 + 0.293) * 1.25,
        1.9,
        -2.5 - 2 * 0.18,
        1.9 + 0.96,
    ]
    want = [round(s / math.sqrt(s * s + 15), 4) for s in sums]
    assert [r["sentiment_score"] for r in rows] == want


def test_both_ways_agree_on_whole_texts(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = [(-1, "NOT\u00a0so very\u2003Good, İ ß good BUT\x1cbad"), (-2, " good"), (-3, None), (-3, "bad")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    words = [("good", 1.9), ("bad", -2.5), ("the", 0.5), ("data", 1.1), ("query", -0.7), ("", 3.0)]
    raised = {"is": 0.3, "of": -0.2}

    def both():
        scored = sentiment.lexicon_score(docs, words).withColumnRenamed("sentiment_score", "plain")
        return sorted(map(repr, sentiment.rule_score(scored, words, boosters=raised).collect()))

    held = both()
    monkeypatch.setattr(sentiment, "HELD_CHARACTERS", 0)
    assert both() == held
