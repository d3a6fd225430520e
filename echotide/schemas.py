"""Row types as DDL: the canonical flat review, the star schema, and each raw payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVIEWS_BASE = (
    "review_id STRING, platform STRING, source STRING, country STRING, review_date DATE, "
    "date_is_ingest BOOLEAN, username STRING, title STRING, text STRING, score_raw STRING, "
    "star_rating INT, product_tag STRING, url STRING, sentiment STRING, sentiment_score DOUBLE, "
    "l1_category STRING, l2_specific_issue STRING, keyword STRING"
)

# What a normaliser emits. Dates stay text here (DD/MM/YYYY); typing follows in one place.
COLLECTED = (
    ("review_id", "string"),
    ("platform", "string"),
    ("source", "string"),
    ("country", "string"),
    ("date", "string"),
    ("date_is_ingest", "boolean"),
    ("username", "string"),
    ("title", "string"),
    ("text", "string"),
    ("score_raw", "string"),
    ("product_tag", "string"),
    ("keyword", "string"),
    ("url", "string"),
)

CORE_COLUMNS = ["review_id", "review_date", "sentiment", "text", "source", "username", "platform"]

# The tables of the written star, the dimension with the month that splits it.
STAR = {
    "dim_reviews_core": "review_id STRING, review_date DATE, sentiment STRING, text STRING, "
    "source STRING, username STRING, platform STRING, review_month DATE",
    "fact_l1_tags": "review_id STRING, review_date DATE, sentiment STRING, l1_category STRING",
    "fact_l2_tags": "review_id STRING, l2_specific_issue STRING",
}

# Header names of the flat file, with the canonical name and the type each is locked to.
FLAT_FILE_COLUMNS = [
    ("Review_ID", "review_id", "string"),
    ("Platform", "platform", "string"),
    ("Source", "source", "string"),
    ("Date", "review_date", "date"),
    ("Username", "username", "string"),
    ("Title", "title", "string"),
    ("Text", "text", "string"),
    ("Score", "star_rating", "int"),
    ("Product_Tag", "product_tag", "string"),
    ("URL", "url", "string"),
    ("Sentiment", "sentiment", "string"),
    ("Sentiment_Score", "sentiment_score", "double"),
    ("L1_Category", "l1_category", "string"),
    ("L2_Specific_Issue", "l2_specific_issue", "string"),
]

PLAY_STORE_REVIEW = (
    "reviewId STRING, userName STRING, title STRING, content STRING, score INT, at TIMESTAMP, "
    "app_label STRING"
)

_LABEL = "STRUCT<label: STRING>"
APP_STORE_PAGE = (
    f"feed STRUCT<entry: ARRAY<STRUCT<id: {_LABEL}, title: {_LABEL}, content: {_LABEL}, "
    f"summary: {_LABEL}, `im:rating`: {_LABEL}, `im:name`: {_LABEL}, "
    f"author: STRUCT<name: {_LABEL}>, updated: {_LABEL}, "
    "link: STRUCT<attributes: STRUCT<href: STRING>>>>>, "
    "country STRING, page INT, app_label STRING"
)

APP_STORE_CATALOG_PAGE = (
    "data ARRAY<STRUCT<id: STRING, attributes: STRUCT<body: STRING>>>, app_label STRING"
)

FORUM_PAGE = (
    "data ARRAY<STRUCT<id: STRING, title: STRING, selftext: STRING, body: STRING, "
    "author: STRING, score: BIGINT, created_utc: STRING>>, sub STRING, keyword STRING"
)

TWEET_PAGE = (
    "tweets ARRAY<STRUCT<`tweet-id`: STRING, id: STRING, text: STRING, content: STRING, "
    "date: STRING, link: STRING, url: STRING, likes: STRING, user: STRUCT<username: STRING>, "
    "stats: STRUCT<likes: STRING>>>, query STRING"
)

THREAD_PAGE = (
    "response ARRAY<STRUCT<id: STRING, raw_message: STRING, createdAt: STRING, likes: BIGINT, "
    "author: STRUCT<name: STRING>>>, page_url STRING, site_name STRING, query STRING"
)

SEARCH_RESULT = (
    "url STRING, title STRING, text STRING, author STRING, date STRING, query STRING, "
    "position INT"
)

# One review as it lands for the incremental job.
LANDED_REVIEW = (
    "review_id STRING, platform STRING, ts TIMESTAMP, text STRING, sentiment STRING"
)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row. A filter on an ordinary column is pushed below
    it and computes it a second time; one on the output of a generator is not."""
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def collected(df: DataFrame, *extra: str, **columns: Column) -> DataFrame:
    """Project ``df`` on the collected row type; columns not given are null of their type.

    ``extra`` names columns of ``df`` to carry along (an arrival order, say).
    """
    picked = [
        columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in COLLECTED
    ]
    return df.select(*picked, *extra)
