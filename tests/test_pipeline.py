"""From landed posts to a measure, the way a user would write it."""

import datetime
import json

from pyspark.sql import functions as F

from echotide import schemas
from echotide.operators import enrich, measures, star
from echotide.operators.sentiment import lexicon_score, sentiment_label
from echotide.sources import feeds, files

LEXICON = [("good", 1.9), ("bad", -2.5), ("awful", -2.0)]
RULES = [
    enrich.IssueRule("Support", "No Reply", "reply"),
    enrich.IssueRule("Price", "Fee", "fee"),
]


def post(i, text, day):
    created = datetime.datetime.fromisoformat(f"{day}T08:00:00+00:00").timestamp()
    return {"id": i, "title": "t", "selftext": text, "created_utc": created}


def test_landed_posts_to_measure(spark, tmp_path):
    posts = [
        post("a", "acme gold is bad, no reply, and a fee\n", "2025-12-03"),
        post("b", "acme gold is good", "2025-12-04"),
        post("c", "awful fee", "2026-01-04"),
        post("d", "bad", "2025-11-04"),
        post("a", "the same id again, good", "2025-12-05"),
    ]
    page = {"data": posts, "sub": "s", "keyword": "k"}
    (tmp_path / "posts.json").write_text(json.dumps(page))
    landed = files.read_payloads(spark, str(tmp_path / "posts.json"), schemas.FORUM_PAGE)
    typed = star.clean_base(files.type_collected(feeds.normalize_reddit(landed)))
    scored = lexicon_score(typed, LEXICON)
    tagged = enrich.explode_tags(enrich.with_default_issue(enrich.tag_issues(scored, RULES)))
    base = tagged.withColumn("sentiment", sentiment_label(F.col("sentiment_score")))
    star.write_star(base, str(tmp_path / "star"), str(tmp_path / "staging"), "created")
    tables = star.read_star(spark, str(tmp_path / "star"))
    dim, l1, l2 = (tables[n] for n in ("dim_reviews_core", "fact_l1_tags", "fact_l2_tags"))

    months = measures.negativity_pct(dim, ["month"], "2025-12-01").orderBy("month").collect()
    assert [(r["n_negative"], r["n_reviews"]) for r in months] == [(1, 2), (1, 1)]
    by = {r[0]: r[1] for r in measures.negative_reviews(l1, floor="2025-12-01").collect()}
    assert by == {"Support": 1, "Price": 2}
    row = measures.phrase_sentiment(dim, "Acme Gold").first()
    assert (row["total"], row["negative"], row["negative_pct"]) == (2, 1, 0.5)
    pct = {r["l2_specific_issue"]: r["n_rows"] for r in
           measures.phrase_issue_pct(dim, l2, "acme gold").collect()}
    # Facts keep a row per collected copy, so the repeated post counts with its default issue.
    assert pct == {"No Reply": 1, "Fee": 1, enrich.DEFAULT_ISSUE: 1}
    assert star.duplicate_keys(dim).count() == 0
    assert dim.filter("review_id = 'a'").first()["text"].endswith("a fee")
