"""The star schema over documents collected twice, cleaned and tagged."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import published
from ..operators import star as st
from ..session import checkpoint_root
from . import fixtures as fx
from .registry import day, query


@query(
    f"""with {fx.SQL_STAR}
        select review_id, strftime(review_date, '%Y-%m-%d') review_date, sentiment, text, source,
               username, platform
        from (select distinct on (review_id) * from cleaned order by review_id, arrival)"""
)
def dim_core(spark, sf_dir):
    dim = fx.star(spark, sf_dir)["dim_reviews_core"]
    return dim.withColumn("review_date", day("review_date"))


@query(
    f"""with {fx.SQL_STAR}
        select distinct review_id, strftime(review_date, '%Y-%m-%d') review_date, sentiment,
               l1 l1_category
        from base where l1 is not null"""
)
def fact_l1(spark, sf_dir):
    fact = fx.star(spark, sf_dir)["fact_l1_tags"]
    return fact.withColumn("review_date", day("review_date"))


@query(
    f"""with {fx.SQL_STAR}
        select review_id, l2 l2_specific_issue from base where l2 is not null"""
)
def fact_l2(spark, sf_dir):
    return fx.star(spark, sf_dir)["fact_l2_tags"]


_SQL_WRITTEN = f"""with {fx.SQL_STAR}, written as (
        select 'dim' as part, review_id, strftime(review_date, '%Y-%m') as what, text
        from (select distinct on (review_id) * from cleaned order by review_id, arrival)
        union all select distinct 'l1', review_id, l1, null from base where l1 is not null
        union all select 'l2', review_id, l2, null from base where l2 is not null)
        select * from written"""


def _written(star):
    """Rows of the three tables that were written, one below the other."""
    none = F.lit(None).cast("string")
    dim = star["dim_reviews_core"].select(
        F.lit("dim").alias("part"),
        "review_id",
        F.date_format("review_month", "yyyy-MM").alias("what"),
        "text",
    )
    l1 = star["fact_l1_tags"].select(F.lit("l1"), "review_id", "l1_category", none)
    l2 = star["fact_l2_tags"].select(F.lit("l2"), "review_id", "l2_specific_issue", none)
    return dim.union(l1).union(l2)


@query(_SQL_WRITTEN)
def star_roundtrip(spark, sf_dir):
    """The star written and read back."""
    place = f"{checkpoint_root(spark)}/star-{uuid.uuid4().hex}"
    st.write_star(fx.collected_twice(spark, sf_dir), f"{place}/star", f"{place}/staging")
    return _written(st.read_star(spark, f"{place}/star"))


@query(
    f"""{_SQL_WRITTEN}
        union all select 'rows', 'dim_reviews_core', '2', cast(count(*) as varchar)
        from written where part = 'dim'
        union all select 'rows', 'fact_l1_tags', '2', cast(count(*) as varchar)
        from written where part = 'l1'
        union all select 'rows', 'fact_l2_tags', '2', cast(count(*) as varchar)
        from written where part = 'l2'"""
)
def star_published(spark, sf_dir):
    """The second of two published versions, and the rows that its writes counted."""
    place = f"{checkpoint_root(spark)}/published-{uuid.uuid4().hex}"
    base = fx.collected_twice(spark, sf_dir)
    for version in (base.filter(F.col("review_date") >= fx.FLOOR), base):
        published.publish_star(version, f"{place}/star", f"{place}/staging")
    published.retire(spark, f"{place}/star", keep=1)
    newest = published.versions(spark, f"{place}/star").orderBy(F.desc("version")).limit(1)
    counted = newest.select(F.explode("n_rows").alias("name", "n"), "version").select(
        F.lit("rows").alias("part"),
        F.col("name").alias("review_id"),
        F.col("version").cast("string").alias("what"),
        F.col("n").cast("string").alias("text"),
    )
    return _written(published.read_published(spark, f"{place}/star")).union(counted)


# Facts of reviews that the dimension lacks: every seventh review is left out of it.
_SQL_PART = f"{fx.SQL_TAGGED}, part as (select * from core where arrival % 7 <> 0)"


def _part(spark, sf_dir):
    return fx.core(spark, sf_dir).filter(F.col("arrival") % 7 != 0)


@query(
    f"""with {_SQL_PART}
        select f.review_id, f.l2 l2_specific_issue, p.platform, p.source
        from f left join part p on f.review_id = p.review_id"""
)
def star_join(spark, sf_dir):
    return st.with_dim(fx.l2(spark, sf_dir), _part(spark, sf_dir))


@query(
    f"""with {_SQL_PART}
        select review_id, l2 l2_specific_issue from f
        where review_id in (select review_id from part where sentiment = 'Negative')"""
)
def semi_ids(spark, sf_dir):
    ids = _part(spark, sf_dir).filter("sentiment = 'Negative'")
    return st.in_ids(fx.l2(spark, sf_dir), ids)


@query(
    f"""with {_SQL_PART}
        select review_id, l2 l2_specific_issue from f
        where review_id not in (select review_id from part)"""
)
def integrity_orphans(spark, sf_dir):
    return st.orphan_facts(_part(spark, sf_dir), fx.l2(spark, sf_dir))


@query(
    f"""with {fx.SQL_STAR} select review_id, count(*) n_rows from cleaned
        group by review_id having count(*) > 1"""
)
def integrity_dups(spark, sf_dir):
    again = fx.core(spark, sf_dir).filter(F.col("arrival") % 4 == 0)
    return st.duplicate_keys(fx.core(spark, sf_dir).unionByName(again))


@query(
    f"""with {_SQL_PART}
        select (select count(*) from (select review_id from part group by 1 having count(*) > 1))
                 bad_keys,
               (select count(*) from f where review_id not in (select review_id from part))
                 orphan_facts"""
)
def integrity_summary(spark, sf_dir):
    return st.check_keys(_part(spark, sf_dir), fx.l2(spark, sf_dir))
