"""Readers, normalisers and page extraction on edge rows."""

import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from echotide import schemas
from echotide.sources import blocks, feeds, files, pages

APPS = [feeds.App("Zed", "42", "Brand", 100)]


def landed(spark, path, records, schema):
    path.write_text("\n".join(json.dumps(r) for r in records))
    return files.read_payloads(spark, str(path), schema)


def test_csv_types_headers_and_quotes(spark, tmp_path):
    names = [n for n, _, _ in schemas.FLAT_FILE_COLUMNS]
    rows = [
        "007,Reddit,r/x,31/12/2025,u,,\"two\nlines, \"\"quoted\"\"\",5,B,http://x,Negative,-0.5,L1,L2",
        "8,Reddit,r/x,2025-12-01,u,T,plain,,B,http://x,Positive,0.25,L1,",
        "9,Reddit,r/x,1/2/2025,u,T,plain,five,B,http://x,Positive,n/a,L1,L2",
        "short,row",
    ]
    path = tmp_path / "reviews.csv"
    path.write_text("\n".join([",".join(names), *rows]) + "\n")
    got = {r["review_id"]: r for r in files.read_reviews_csv(spark, str(path), multiline=True).collect()}
    assert got["007"]["review_date"] == datetime.date(2025, 12, 31)
    assert got["007"]["text"] == 'two\nlines, "quoted"'
    assert (got["007"]["star_rating"], got["007"]["sentiment_score"]) == (5, -0.5)
    assert got["8"]["review_date"] == datetime.date(2025, 12, 1)
    assert got["9"]["review_date"] is None and got["9"]["star_rating"] is None
    assert got["short"]["_corrupt_record"] == "short,row"
    assert len(got) == 4


def test_csv_with_other_header_is_refused(spark, tmp_path):
    names = [n for n, _, _ in schemas.FLAT_FILE_COLUMNS]
    path = tmp_path / "reviews.csv"
    path.write_text(",".join(reversed(names)) + "\n" + ",".join("x" * len(names)) + "\n")
    with pytest.raises(Exception):
        files.read_reviews_csv(spark, str(path), multiline=True).collect()


def label(v):
    return {"label": v}


def test_app_store_pages(spark, tmp_path):
    meta = {"id": label("app"), "im:name": label("Zed"), "title": label("Zed")}
    review = {
        "id": label("1"), "title": label("T"), "content": label(""), "summary": label("S"),
        "im:rating": label("4"), "author": {"name": label("ann")},
        "updated": label("2025-12-01T02:00:00+05:30"),
        "link": {"attributes": {"href": "http://l"}},
    }
    titled = {"id": label("2"), "title": label("only title"), "updated": label("nonsense text")}
    empty = {"id": label("3"), "title": label(""), "content": label("")}
    base = {"country": "in", "page": 1, "app_label": "Zed"}
    records = [
        {"feed": {"entry": [meta, review]}, **base},
        {"feed": {"entry": [titled, meta, empty]}, **base, "page": 2},
        {"feed": {}, **base, "page": 3},
        {"feed": {"entry": [review]}, **base, "app_label": "Unknown"},
    ]
    df = landed(spark, tmp_path / "a.json", records, schemas.APP_STORE_PAGE)
    rows = {r["review_id"]: r for r in feeds.normalize_app_store(df, APPS, ["page"]).collect()}
    assert set(rows) == {"1", "2", "app"}
    one = rows["1"]
    assert (one["text"], one["date"], one["score_raw"], one["url"]) == (
        "S", "01/12/2025", "4", "http://l",
    )
    assert (one["source"], one["country"], one["product_tag"]) == ("App Store — Zed", "in", "Brand")
    assert rows["2"]["url"] == "https://apps.apple.com/app/id42"
    assert rows["2"]["date"] == "nonsense t"
    assert rows["app"]["position"] == 1


def test_same_review_in_two_countries(spark, tmp_path):
    from echotide.operators.select import dedup_keep_first

    entry = {"id": label("1"), "title": label("T"), "content": label("x")}
    records = [
        {"feed": {"entry": [entry, entry]}, "country": c, "page": 1, "app_label": "Zed"}
        for c in ("in", "us")
    ]
    df = landed(spark, tmp_path / "a.json", records, schemas.APP_STORE_PAGE)
    rows = feeds.normalize_app_store(df, APPS, ["page"])
    assert dedup_keep_first(rows, ["review_id", "country"], ["page", "position"]).count() == 2
    assert dedup_keep_first(rows, ["review_id"], ["country", "position"]).count() == 1


def test_forum_posts(spark, tmp_path):
    posts = [
        {"id": "a", "title": " T ", "selftext": "[deleted] ", "created_utc": 1764550800},
        {"id": "b", "title": "", "selftext": "[removed]"},
        {"id": "c", "title": "T", "selftext": "", "body": " B\n", "created_utc": "1764550800.9"},
        {"id": "", "title": "no id"},
        {"title": "no id either"},
        {"id": "d", "title": None, "selftext": "x", "score": 7, "author": "ann"},
    ]
    df = landed(spark, tmp_path / "r.json", [{"data": posts, "sub": "s", "keyword": "k"}, {
        "data": None, "sub": "s", "keyword": "k"}], schemas.FORUM_PAGE)
    rows = {r["review_id"]: r for r in feeds.normalize_reddit(df).collect()}
    assert set(rows) == {"a", "c", "d"}
    assert (rows["a"]["text"], rows["a"]["date"]) == ("T", "01/12/2025")
    assert (rows["c"]["text"], rows["c"]["date"]) == ("B", "01/12/2025")
    assert (rows["d"]["score_raw"], rows["d"]["date"], rows["d"]["username"]) == ("7", "", "ann")
    assert rows["d"]["url"] == "https://www.reddit.com/r/s/comments/d/"


def test_tweets(spark, tmp_path):
    tweets = [
        {"tweet-id": "1", "text": "x", "likes": "1,234", "date": "Dec 1, 2025 · 3:45 PM UTC"},
        {"id": "2", "text": "", "content": "y", "stats": {"likes": "5"}, "link": "", "url": "u",
         "user": {"username": "ann"}},
        {"id": "3", "text": ""},
        {"tweet-id": "", "id": "4", "text": "z", "stats": {}},
    ]
    df = landed(spark, tmp_path / "t.json", [{"tweets": tweets, "query": "q"}], schemas.TWEET_PAGE)
    rows = {r["text"]: r for r in feeds.normalize_tweets(df).collect()}
    assert set(rows) == {"x", "y", "z"}
    assert (rows["x"]["score_raw"], rows["x"]["date"]) == ("1234", "01/12/2025")
    assert (rows["y"]["score_raw"], rows["y"]["url"], rows["y"]["username"]) == ("5", "", "ann")
    # An id that is present but empty does not give way to the other.
    assert (rows["z"]["review_id"], rows["z"]["score_raw"]) == ("", "0")


def test_collected_rows_are_typed(spark, tmp_path):
    df = spark.createDataFrame(
        [("Google Play", "31/12/2025", "5", "x"), ("Reddit", "", "5", None)],
        "platform string, date string, score_raw string, text string",
    )
    rows = {r["platform"]: r for r in files.type_collected(df).collect()}
    assert rows["Google Play Store"]["star_rating"] == 5
    assert rows["Google Play Store"]["review_date"] == datetime.date(2025, 12, 31)
    assert rows["Reddit"]["star_rating"] is None and rows["Reddit"]["review_date"] is None


def test_fallback_is_per_query(spark):
    one = spark.createDataFrame([("a", 1)], "q string, x int")
    two = spark.createDataFrame([("a", 2), ("b", 3)], "q string, y int")
    got = {(r["q"], r["x"], r["y"]) for r in files.fallback_union(one, two, "q").collect()}
    assert got == {("a", 1, None), ("b", None, 3)}


# Pages


def page(spark, *html):
    return spark.createDataFrame(
        [(f"http://p/{i}", h, "site") for i, h in enumerate(html)],
        "url string, html string, site_name string",
    )


LONG = "long enough to be kept as a comment"


def comments(spark, *html, **options):
    rows = pages.extract_page_comments(page(spark, *html), as_of="2026-06-01", **options).collect()
    return [(r["url"][-1], r["text"], r["username"]) for r in sorted(rows, key=lambda r: (
        r["url"], r["position"]))]


def test_first_selector_that_yields_wins(spark):
    both = f'<div class="comment-body">{LONG} A</div><p class="comment">{LONG} B</p>'
    second = f'<div class="comment-body">short</div><p class="comment">{LONG} B</p>'
    under = f'<ul class="comments-list"><li class="x comment">{LONG} C</li></ul>'
    part = f'<div class="my-comments"><b>{LONG}</b> D</div>'
    got = comments(spark, both, second, under, part, "<p>none</p>", None)
    assert [(p, t) for p, t, _ in got] == [
        ("0", f"{LONG} A"), ("1", f"{LONG} B"), ("2", f"{LONG} C"), ("3", f"{LONG} D"),
    ]


def test_cap_repeats_and_author(spark):
    block = '<div class="c"><div class="comment-body">{}</div><span class="name"> Ann </span></div>'
    html = "".join(block.format(f"{LONG} {i // 2}") for i in range(8))
    got = comments(spark, html, per_page=5)
    assert got == [("0", f"{LONG} {i}", "Ann") for i in range(3)]


def test_comment_ids_and_ingest_date(spark):
    df = pages.extract_page_comments(
        page(spark, f'<title>T</title><div class="comment-body">{LONG * 5}</div>'), as_of="2026-06-01"
    )
    row = df.first()
    digest = hashlib.md5(f"http://p/0|{(LONG * 5)[:80]}".encode()).hexdigest()[:12]
    assert (row["review_id"], row["date"], row["date_is_ingest"]) == (digest, "01/06/2026", True)
    assert (row["title"], row["source"], row["platform"]) == ("T", "site", "News")


P = "a paragraph that is long enough to be read as an answer because it has over eighty characters"


def answers(spark, html, **options):
    rows = pages.extract_answers(page(spark, html), **options).collect()
    return [r["text"] for r in sorted(rows, key=lambda r: r["position"])]


def test_paragraphs_unclosed_and_in_scripts(spark):
    html = f'<script>var t="<p>{P} no</p>";</script><p>{P} 1<p>{P} 2</p><div>x</div><p>short</p>'
    assert answers(spark, html) == [f"{P} 1", f"{P} 2"]


def test_five_paragraphs_at_most(spark):
    assert answers(spark, "".join(f"<p>{P} {i}</p>" for i in range(7))) == [
        f"{P} {i}" for i in range(5)
    ]


def test_cap_applies_before_the_length_filter(spark):
    html = "".join(
        f'<div class="q-text">{"short" if i == 1 else P + str(i)}</div>' for i in range(7)
    )
    assert answers(spark, html) == [f"{P}{i}" for i in (0, 2, 3, 4)]


def test_nested_answer_blocks(spark):
    html = f'<div class="Spacing_Log">{P} <div class="q-text">{P} inner</div></div><p>{P}</p>'
    assert answers(spark, html) == [f"{P} {P} inner", f"{P} inner"]


def test_answer_class_outside_the_tree(spark):
    html = f'<!-- <div class="q-text">no</div> --><div data-x=1 CLASS=other>x</div><p>{P} 1<p>{P} 2'
    assert answers(spark, html) == [f"{P} 1", f"{P} 2"]
    unquoted = f"<div id=a class=Q-Text>{P} A</div><p>{P}</p>"
    assert answers(spark, unquoted) == [f"{P} A"]
    other = f'<div data-class="q-text">x</div><p>{P} 1</p>'
    assert answers(spark, other) == [f"{P} 1"]


def test_comment_classes_are_case_sensitive(spark):
    assert comments(spark, f'<div class="Comment">{LONG}</div>') == []


def test_links(spark):
    wrapped = '<a class="result__a" href="//s/?uddg=https%3A%2F%2Fwww.quora.com%2F{}&amp;rut=1">x</a>'
    html = "".join(
        [wrapped.format(t) for t in ("b", "a", "q%2Fspace", "b")]
        + ['<a class="other" href="https://www.quora.com/z">x</a>',
           '<a class="result__a" href="https://fr.quora.com/y">x</a>',
           '<A href=\'https://quora.com/c\' class=\'big result__a\'>x</A>']
    )
    got = pages.extract_links(
        page(spark, html), "quora.com", pages.QUESTION_EXCLUDE, pages.QUESTION_LINKS_PER_PAGE,
        keep_prefixes=pages.QUESTION_SITES,
    ).orderBy("position")
    assert [r["url"] for r in got.collect()] == [
        "https://www.quora.com/b", "https://www.quora.com/a", "https://quora.com/c",
    ]
    capped = pages.extract_links(page(spark, html), "quora.com", cap=2)
    assert capped.count() == 2


def test_search_results(spark):
    html = (
        '<div class="result results_links"><h2><a rel="n" class="result__a" href="https://linkedin.com/1">'
        'One <b>two</b></a></h2><a class="result__snippet" href="x">Snip <b>pet</b></a></div>'
        '<div class="result"><a class="result__a" href="https://linkedin.com/2">No snippet</a></div>'
        '<div class="result"><a class="result__a" href="https://elsewhere/3">x</a></div>'
    )
    rows = pages.extract_results(page(spark, html), "linkedin.com").orderBy("position").collect()
    assert [(r["url"][-1], r["title"], r["text"]) for r in rows] == [
        ("1", "Onetwo", "Snippet"), ("2", "No snippet", ""),
    ]
    other = (
        '<li class="b_algo"><h2><a href="https://linkedin.com/4">T</a></h2>'
        '<div class="b_caption"><p>S</p></div></li><li class="b_algo"><p>no link</p></li>'
    )
    rows = pages.extract_results(page(spark, other), "linkedin.com", "fallback").collect()
    assert [(r["url"][-1], r["title"], r["text"]) for r in rows] == [("4", "T", "S")]


def test_first_result_per_link(spark):
    rows = [
        ("q1", 1, "http://a", "x" * 300, "y" * 29),
        ("q1", 2, "http://a", "x" * 300, " " + "District " * 400),
        ("q2", 1, "http://a", "t", "z" * 40),
        ("q2", 2, "", "t", "z" * 40),
    ]
    df = spark.createDataFrame(rows, "query string, position int, url string, title string, text string")
    df = df.withColumn("author", F.lit("")).withColumn("date", F.lit(""))
    (row,) = feeds.normalize_search_results(df).collect()
    assert (len(row["title"]), len(row["text"]), row["product_tag"]) == (200, 2000, "District")


@pytest.mark.parametrize("text", ["div.a", ".a", "div[class*='a']", "ul .a", "p"])
def test_selector_forms(text):
    tree = blocks.parse('<ul><li><div class="a b">1</div></ul><p class="ab">2')
    found = {blocks.text_of(n, "") for n in blocks.select(tree, blocks.Selector.of(text))}
    assert found == {"div.a": {"1"}, ".a": {"1"}, "div[class*='a']": {"1"}, "ul .a": {"1"},
                     "p": {"2"}}[text]
