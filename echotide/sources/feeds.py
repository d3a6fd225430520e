"""Normalisers of JSON payloads. Each keeps ``carry`` columns of its input, and the place of a
row in its payload as ``position``, so that the caller can order rows as they arrived."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import format_dmy, parse_date_any, parse_epoch_or_iso, wall_dmy
from ..functions.html import html_to_text
from ..functions.links import short_id, url_from
from ..functions.numbers import safe_int
from ..functions.text import (
    DELETED_MARKERS,
    collapse_ws,
    first_nonempty,
    first_present,
    lookup,
    min_chars,
    null_placeholders,
    trim_all,
    truncate,
)
from ..operators.enrich import product_tag
from ..operators.select import dedup_keep_first
from ..schemas import collected, computed

# How each platform and its pages are named in collected rows.
PLAY_STORE, APP_STORE, REDDIT = "Google Play", "Apple App Store", "Reddit"
TWITTER, NEWS, LINKEDIN = "Twitter", "News", "LinkedIn"
TWITTER_SOURCE = "Twitter (unofficial)"
PLAY_STORE_SOURCE, APP_STORE_SOURCE = "Play Store — {}", "App Store — {}"
PLAY_STORE_URL = "https://play.google.com/store/apps/details?id={}"
APP_STORE_URL = "https://apps.apple.com/app/id{}"
REDDIT_URL = "https://www.reddit.com/r/{}/comments/{}/"

# Shortest comment and search text kept, longest search title and text.
MIN_COMMENT, MIN_SEARCH_TEXT = 10, 30
MAX_SEARCH_TITLE, MAX_SEARCH_TEXT = 200, 2000


class App(NamedTuple):
    """A configured app: its label, store id, product, and the number of reviews wanted."""

    label: str
    app_id: str
    product: str
    target: int = 0


def normalize_play_store(
    df: DataFrame, apps: Sequence[App], carry: Sequence[str] = ()
) -> DataFrame:
    """Play Store reviews of the configured apps."""
    label = F.col("app_label")
    return collected(
        df.filter(label.isin(*[a.label for a in apps])),
        *carry,
        review_id=first_present(F.col("reviewId")),
        platform=F.lit(PLAY_STORE),
        source=url_from(PLAY_STORE_SOURCE, label),
        date=F.coalesce(F.date_format("at", "dd/MM/yyyy"), F.lit("")),
        date_is_ingest=F.lit(False),
        username=first_present(F.col("userName")),
        title=first_present(F.col("title")),
        text=first_present(F.col("content")),
        score_raw=F.col("score").cast("string"),
        product_tag=lookup(label, {a.label: a.product for a in apps}),
        url=url_from(PLAY_STORE_URL, lookup(label, {a.label: a.app_id for a in apps})),
    )


def skip_metadata_entry(df: DataFrame) -> DataFrame:
    """Drop an entry that describes the app; only the first of a page can be one."""
    return df.filter((F.col("position") > 0) | F.col("entry.`im:name`").isNull())


def normalize_app_store(
    df: DataFrame, apps: Sequence[App], carry: Sequence[str] = ()
) -> DataFrame:
    """App Store feed pages of the configured apps, one row per review."""
    label = F.col("app_label")
    entries = df.filter(label.isin(*[a.label for a in apps])).select(
        *carry,
        label,
        "country",
        F.posexplode("feed.entry").alias("position", "entry"),
    )
    title = first_present(F.col("entry.title.label"))
    text = first_nonempty(F.col("entry.content.label"), F.col("entry.summary.label"))
    link = url_from(APP_STORE_URL, lookup(label, {a.label: a.app_id for a in apps}))
    return collected(
        skip_metadata_entry(entries).filter((text != "") | (title != "")),
        *carry,
        "position",
        review_id=first_present(F.col("entry.id.label")),
        platform=F.lit(APP_STORE),
        source=url_from(APP_STORE_SOURCE, label),
        country=F.col("country"),
        date=wall_dmy(F.col("entry.updated.label")),
        date_is_ingest=F.lit(False),
        username=first_present(F.col("entry.author.name.label")),
        title=title,
        text=text,
        score_raw=first_present(F.col("entry.`im:rating`.label")),
        product_tag=lookup(label, {a.label: a.product for a in apps}),
        url=first_present(F.col("entry.link.attributes.href"), link),
    )


def normalize_app_store_catalog(
    df: DataFrame, apps: Sequence[App], carry: Sequence[str] = ()
) -> DataFrame:
    """App Store catalogue pages. A review without an id gets one made from its text."""
    label = F.col("app_label")
    rows = df.filter(label.isin(*[a.label for a in apps])).select(
        *carry, label, F.posexplode("data").alias("position", "item")
    )
    text = first_present(F.col("item.attributes.body"))
    return collected(
        rows.filter(text != ""),
        *carry,
        "position",
        review_id=F.coalesce(F.nullif(F.col("item.id"), F.lit("")), short_id(label, text)),
        platform=F.lit(APP_STORE),
        source=url_from(APP_STORE_SOURCE, label),
        date=F.lit(""),
        date_is_ingest=F.lit(False),
        text=text,
        product_tag=lookup(label, {a.label: a.product for a in apps}),
        url=url_from(APP_STORE_URL, lookup(label, {a.label: a.app_id for a in apps})),
    )


def normalize_reddit(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Forum posts. A removed text gives way to the title; posts with neither, or without an
    id, are dropped. ``created`` keeps the time of the post for cutoffs."""
    posts = df.select(
        *carry, "sub", "keyword", F.posexplode("data").alias("position", "post")
    )
    title = trim_all(first_present(F.col("post.title")))
    text = trim_all(first_nonempty(F.col("post.selftext"), F.col("post.body")))
    body = first_nonempty(null_placeholders(text, DELETED_MARKERS), title)
    pid = first_present(F.col("post.id"))
    created = parse_epoch_or_iso(F.col("post.created_utc"))
    return collected(
        posts.withColumn("created", created).filter((body != "") & (pid != "")),
        *carry,
        "position",
        "created",
        review_id=pid,
        platform=F.lit(REDDIT),
        source=F.col("sub"),
        date=format_dmy(F.col("created")),
        date_is_ingest=F.lit(False),
        username=first_present(F.col("post.author")),
        title=title,
        text=body,
        score_raw=F.coalesce("post.score", F.lit(0)).cast("string"),
        keyword=F.col("keyword"),
        url=url_from(REDDIT_URL, F.col("sub"), pid),
    )


def normalize_tweets(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Tweets with a text, under any of the field names the payload uses."""
    tweets = df.select(*carry, "query", F.posexplode("tweets").alias("position", "tweet"))
    text = first_nonempty(F.col("tweet.text"), F.col("tweet.content"))
    stated = F.col("tweet.date")
    date = F.coalesce(
        F.date_format(parse_date_any(stated), "dd/MM/yyyy"), truncate(stated, 10), F.lit("")
    )
    likes = F.when(F.col("tweet.stats").isNotNull(), F.col("tweet.stats.likes")).otherwise(
        F.col("tweet.likes")
    )
    return collected(
        tweets.filter(text != ""),
        *carry,
        "position",
        review_id=first_present(F.col("tweet.`tweet-id`"), F.col("tweet.id")),
        platform=F.lit(TWITTER),
        source=F.lit(TWITTER_SOURCE),
        date=date,
        date_is_ingest=F.lit(False),
        username=first_present(F.col("tweet.user.username")),
        title=F.lit(""),
        text=text,
        score_raw=safe_int(likes).cast("string"),
        keyword=F.col("query"),
        url=first_present(F.col("tweet.link"), F.col("tweet.url")),
    )


def normalize_thread_comments(
    df: DataFrame, order: Sequence[str] = ("page_url", "position"), carry: Sequence[str] = ()
) -> DataFrame:
    """Comments of an article thread: HTML to text, short ones dropped, first per id kept."""
    posts = df.select(
        *carry,
        "page_url",
        "site_name",
        "query",
        F.posexplode("response").alias("position", "post"),
    )
    text = collapse_ws(html_to_text(first_present(F.col("post.raw_message")), " "))
    kept = dedup_keep_first(
        computed(posts, _text=text)
        .filter(min_chars(F.col("_text"), MIN_COMMENT))
        .withColumn("_id", first_present(F.col("post.id"))),
        ["_id"],
        order,
    )
    return collected(
        kept,
        *carry,
        "position",
        review_id=F.col("_id"),
        platform=F.lit(NEWS),
        source=F.col("site_name"),
        date=wall_dmy(F.col("post.createdAt")),
        date_is_ingest=F.lit(False),
        username=first_present(F.col("post.author.name")),
        title=F.lit(""),
        text=F.col("_text"),
        score_raw=F.coalesce("post.likes", F.lit(0)).cast("string"),
        keyword=F.col("query"),
        url=F.col("page_url"),
    )


def normalize_search_results(
    df: DataFrame, order: Sequence[str] = ("query", "position"), carry: Sequence[str] = ()
) -> DataFrame:
    """Search results with a link and enough text, the first per link, with the product that
    the whole text or the link names."""
    text = trim_all(first_present(F.col("_raw")))
    usable = computed(df.withColumnRenamed("text", "_raw"), text=text).filter(
        (first_present(F.col("url")) != "") & min_chars(F.col("text"), MIN_SEARCH_TEXT)
    )
    return collected(
        dedup_keep_first(usable, ["url"], order),
        *carry,
        review_id=short_id(F.col("url")),
        platform=F.lit(LINKEDIN),
        source=F.lit(LINKEDIN),
        date=first_present(F.col("date")),
        date_is_ingest=F.lit(False),
        username=first_present(F.col("author")),
        title=truncate(first_present(F.col("title")), MAX_SEARCH_TITLE),
        text=truncate(F.col("text"), MAX_SEARCH_TEXT),
        score_raw=F.lit(""),
        product_tag=product_tag(F.col("text"), F.col("url")),
        keyword=F.lit(LINKEDIN),
        url=F.col("url"),
    )
