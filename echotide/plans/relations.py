"""Measures under a filter context, distinct counts from bitmaps, and ids seen over runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import bitmaps as bm
from ..operators.context import Model
from ..operators.measures import is_negative
from ..operators.seen import SeenKeys
from ..session import checkpoint_root, stage
from . import fixtures as fx
from .registry import day, query

# Every seventh review is left out of the dimension; its facts belong to the unknown member.
_SQL_MODEL = f"""{fx.SQL_FACT_L1},
dim as (select * from core where arrival % 7 <> 0),
l1 as (select f.*, d.platform, d.source, d.review_id is not null known
  from fact_l1 f left join dim d using (review_id)),
l2 as (select f.review_id, f.l2, d.platform, d.source, d.text, d.sentiment
  from f left join dim d using (review_id))"""


def _model(spark, sf_dir):
    dim = fx.core(spark, sf_dir).filter(F.col("arrival") % 7 != 0).drop("arrival")
    facts = {"fact_l1_tags": fx.l1(spark, sf_dir), "fact_l2_tags": fx.l2(spark, sf_dir)}
    return Model({"dim_reviews_core": dim, **facts})


@query(
    f"""with {_SQL_MODEL}
        select l1_category, count(distinct review_id) negative_reviews from l1
        where sentiment = 'Negative' and platform in ('Google Play', 'Reddit')
          and source is distinct from 'web'
        group by 1"""
)
def model_filtered_l1(spark, sf_dir):
    """Filters of the dimension reach the fact; the unknown member is not on any platform."""
    model = _model(spark, sf_dir).keep("dim_reviews_core", "platform", ["google play", "REDDIT"])
    model = model.drop("dim_reviews_core", "source", ["WEB"])
    return model.negative_reviews("fact_l1_tags", ["l1_category"])


@query(
    f"""with {_SQL_MODEL}
        select platform, l1_category, count(distinct review_id) total,
               count(distinct case when sentiment = 'Negative' then review_id end) negative
        from l1 where platform is distinct from 'Reddit' group by 1, 2"""
)
def model_unknown_member(spark, sf_dir):
    """All but one platform: facts without a review stay visible, under a blank platform."""
    model = _model(spark, sf_dir).drop("dim_reviews_core", "platform", ["reddit"])
    return model.distinct_reviews(
        "fact_l1_tags", ["platform", "l1_category"], negative=is_negative()
    )


@query(
    f"""with {_SQL_MODEL},
        cohort as (select * from l2 where contains(lower(text), '{fx.PHRASE}')
          and sentiment = 'Negative')
        select platform, l2 l2_specific_issue, count(*) n_rows, any_value(n_all) n_all,
               count(*)::double / any_value(n_all) share
        from cohort join (select platform, count(*) n_all from cohort group by 1) using (platform)
        where l2 <> 'Speed of Delivery' group by 1, 2"""
)
def model_cleared_share(spark, sf_dir):
    """The issues of a phrase's negative reviews, over all of them whatever their issue."""
    phrase = F.contains(F.lower("text"), F.lit(fx.PHRASE))
    model = _model(spark, sf_dir).where("dim_reviews_core", phrase)
    model = model.keep("dim_reviews_core", "sentiment", ["negative"])
    model = model.drop("fact_l2_tags", "l2_specific_issue", ["speed of delivery"])
    return model.share(
        "fact_l2_tags", ["platform", "l2_specific_issue"], ["l2_specific_issue"]
    )


@query(
    f"""with {fx.SQL_FACT_L1}
        select l1_category, case when grouping(l1_category) = 1 then 1 else 0 end as level,
               count(distinct review_id) negative_reviews
        from fact_l1 where sentiment = 'Negative' group by rollup(l1_category)"""
)
def bitmap_totals(spark, sf_dir):
    """Negative reviews by category and over all, from bitmaps by day and category."""
    return bm.counts_with_total(_day_maps(spark, sf_dir), ["l1_category"], "negative_reviews")


@query(
    f"""with {fx.SQL_FACT_L1}
        select strftime(date_trunc('month', review_date), '%Y-%m-%d') as month, l1_category,
               count(distinct review_id) negative_reviews
        from fact_l1 where sentiment = 'Negative' group by all"""
)
def bitmap_months(spark, sf_dir):
    """Negative reviews by month and category, from bitmaps by day and category."""
    months = F.trunc("review_date", "MM").alias("month")
    counted = bm.distinct_counts(
        _day_maps(spark, sf_dir), [months, "l1_category"], "negative_reviews"
    )
    return counted.withColumn("month", day("month"))


def _day_maps(spark, sf_dir):
    """Bitmaps by day and category, of two runs: ids of the second go on from the first."""
    place = f"{checkpoint_root(spark)}/bitmaps-{uuid.uuid4().hex}"
    fact = fx.l1(spark, sf_dir).filter(is_negative())
    first = fact.filter("review_date < '2025-12-01'")
    known, _ = stage(bm.new_ordinals(first), place, "ordinals")
    more, _ = stage(bm.new_ordinals(fact, known), place, "ordinals")
    ordinals = known.unionByName(more)
    maps, _ = stage(bm.bitmaps(fact, ordinals, ["review_date", "l1_category"]), place, "days")
    return maps


@query(
    f"""with {fx.SQL_CORE},
        landed as (
          select review_id, platform, 1 landing, arrival from core where arrival % 3 <> 0
          union all select review_id, platform, 2, arrival from core where arrival % 2 = 0
          union all select review_id, platform, 3, arrival from core)
        select review_id, platform, min(landing) landing from landed group by 1, 2"""
)
def seen_over_runs(spark, sf_dir):
    """Three landings that overlap; each id is taken from the first that holds it."""
    place = f"{checkpoint_root(spark)}/seen-{uuid.uuid4().hex}"
    core = fx.core(spark, sf_dir).select("review_id", "platform", "arrival")
    third, even = F.col("arrival") % 3 != 0, F.col("arrival") % 2 == 0
    seen = SeenKeys(spark, f"{place}/seen", buckets=16, expected=100_000)
    taken = None
    for number, landing in enumerate((core.filter(third), core.filter(even), core), 1):
        new = seen.take_new(landing, ["review_id", "platform"], ["arrival"], f"{place}/staging")
        new = new.select("review_id", "platform", F.lit(number).alias("landing"))
        taken = new if taken is None else taken.unionByName(new)
    return taken
