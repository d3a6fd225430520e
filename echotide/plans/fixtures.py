"""Views that give the given tables the shape of reviews, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..operators.enrich import IssueRule, explode_tags, tag_issues
from ..operators.star import build_star, clean_base, fact_l1, fact_l2
from .registry import table

FLOOR = "2025-12-01"
PHRASE = "license"

RULES = (
    IssueRule("Customer Support", "Premium Support Failures", "of the"),
    IssueRule("Fulfillment & Logistics", "Speed of Delivery", "was"),
    IssueRule("Fulfillment & Logistics", "Item Condition & Packaging", "under the"),
    IssueRule("Value & Pricing", "Gold Delivery Radius/Distance Cap", "to be"),
)

_QUOTED = WHITESPACE.replace("'", "''")


def sql_trim(c: str) -> str:
    return f"trim({c}, '{_QUOTED}')"


def sql_collapse(c: str) -> str:
    return sql_trim(f"regexp_replace({c}, '[{_QUOTED}]+', ' ', 'g')")


def sql_clean(c: str) -> str:
    return f"regexp_replace({sql_trim(c)}, '[\\x00-\\x1F\\x7F]', '', 'g')"


SQL_CORE = """
core as (
  select cast(d.doc_id as varchar) review_id,
         case d.doc_id % 3 when 0 then 'Google Play' when 1 then 'Apple App Store'
              else 'Reddit' end platform,
         d.source, 'user_' || (d.doc_id % 50) username,
         cast(date '2025-09-01' + to_days(cast(d.doc_id * 7 % 270 as int)) as date) review_date,
         d.text,
         case when l.toxic = 1 or l.quality = 0 then 'Negative'
              when l.quality = 1 then 'Positive'
              when d.n_chars % 3 = 0 then 'Negative'
              when d.n_chars % 3 = 1 then 'Positive' else 'Neutral' end sentiment,
         d.doc_id arrival
  from documents d left join labels l on d.doc_id = l.doc_id)"""

SQL_RULES = "rules(l1, l2, kw) as (values {})".format(
    ", ".join(f"('{r.l1}', '{r.l2}', '{r.keyword}')" for r in RULES)
)

SQL_TAGGED = f"""{SQL_CORE}, {SQL_RULES},
f as (select review_id, sentiment, review_date, l1, l2, arrival
      from core join rules on contains(lower(text), kw))"""

SQL_FACT_L1 = f"""{SQL_TAGGED},
fact_l1 as (select distinct review_id, sentiment, review_date, l1 l1_category from f)"""


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of three platforms over nine months, with a sentiment."""
    d = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    offset = (F.col("doc_id") * 7 % 270).cast("int")
    return d.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.when(F.col("doc_id") % 3 == 0, "Google Play")
        .when(F.col("doc_id") % 3 == 1, "Apple App Store")
        .otherwise("Reddit")
        .alias("platform"),
        "source",
        F.concat(F.lit("user_"), F.col("doc_id") % 50).alias("username"),
        F.date_add(F.lit("2025-09-01").cast("date"), offset).alias("review_date"),
        "text",
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), "Negative")
        .when(F.col("quality") == 1, "Positive")
        .when(F.col("n_chars") % 3 == 0, "Negative")
        .when(F.col("n_chars") % 3 == 1, "Positive")
        .otherwise("Neutral")
        .alias("sentiment"),
        F.col("doc_id").alias("arrival"),
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with one row per issue, or one with nulls."""
    return explode_tags(tag_issues(core(spark, sf_dir), RULES))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension. Documents are unique by id, so it needs no removal of duplicates."""
    return core(spark, sf_dir).drop("arrival")


def l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_l1(tagged(spark, sf_dir))


def l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_l2(tagged(spark, sf_dir))


def reviews_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of which every fourth was collected again later, in another community and with
    blanks around the text; cleaned."""
    first = core(spark, sf_dir)
    again = first.filter(F.col("arrival") % 4 == 0).withColumns(
        {
            "arrival": F.col("arrival") + 1_000_000_000_000,
            "source": F.lit("again"),
            "text": F.concat(F.lit("\t"), "text", F.lit(" \n")),
        }
    )
    return clean_base(first.unionByName(again))


def collected_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, tagged, one row per issue."""
    return explode_tags(tag_issues(reviews_twice(spark, sf_dir), RULES))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    reviews = reviews_twice(spark, sf_dir)
    return build_star(explode_tags(tag_issues(reviews, RULES)), reviews=reviews)


SQL_STAR = f"""{SQL_CORE}, {SQL_RULES},
twice as (
  select * from core
  union all by name
  select review_id, platform, 'again' source, username, review_date,
         chr(9) || text || ' ' || chr(10) as text, sentiment,
         arrival + 1000000000000 arrival
  from core where arrival % 4 = 0),
cleaned as (select * replace ({sql_clean('text')} as text) from twice),
base as (select c.*, r.l1, r.l2 from cleaned c left join rules r on contains(lower(c.text), r.kw))"""
