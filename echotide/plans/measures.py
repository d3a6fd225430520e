"""The measures on documents as reviews."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import collation
from ..operators import measures as ms
from ..operators.context import Model
from ..operators.select import top_n
from ..operators.star import with_dim
from ..session import checkpoint_root
from . import fixtures as fx
from .registry import day, query, table

_FROM = f"review_date >= date '{fx.FLOOR}'"
_SQL_MONTHLY = f"""monthly as (
  select date_trunc('month', review_date) m, count_if(sentiment = 'Negative') n_negative,
         count(*) n_reviews,
         cast(count_if(sentiment = 'Negative') as double) / count(*) negativity
  from core where {_FROM} group by 1)"""


@query(
    f"""with {fx.SQL_CORE}, {_SQL_MONTHLY}
        select strftime(m, '%Y-%m-%d') as month, cast(n_negative as bigint) n_negative, n_reviews,
               negativity from monthly"""
)
def negativity_monthly(spark, sf_dir):
    monthly = ms.negativity_pct(fx.dim(spark, sf_dir), ["month"], fx.FLOOR)
    return monthly.withColumn("month", day("month"))


@query(
    f"""with {fx.SQL_CORE}, {_SQL_MONTHLY},
        steps as (select *, negativity - lag(negativity) over (order by m) change from monthly)
        select strftime(m, '%Y-%m-%d') as month, round(negativity, 9) negativity,
               round(change, 9) change,
               round(negativity - first_value(negativity) over w, 9) change_from_first,
               round(last_value(negativity) over w - first_value(negativity) over w, 9)
                 first_to_last,
               coalesce(min(case when change < 0 then 0 when change >= 0 then 1 end) over w, 1) = 1
                 never_falls,
               last_day(cast(m as date)) > date '2026-05-20' is_partial
        from steps
        window w as (order by m rows between unbounded preceding and unbounded following)"""
)
def negativity_trend(spark, sf_dir):
    monthly = ms.negativity_pct(fx.dim(spark, sf_dir), ["month"], fx.FLOOR)
    trend = ms.mark_partial_months(ms.negativity_trend(monthly), fx.FLOOR, "2026-05-20")
    rounded = {
        c: F.round(c, 9) for c in ("negativity", "change", "change_from_first", "first_to_last")
    }
    return trend.withColumns(rounded).select(
        day("month").alias("month"), *rounded, "never_falls", "is_partial"
    )


@query(
    f"""with {fx.SQL_FACT_L1}
        select l1_category, count(distinct review_id) negative_reviews from fact_l1
        where sentiment = 'Negative' and {_FROM} group by 1"""
)
def neg_by_l1(spark, sf_dir):
    return ms.negative_reviews(fx.l1(spark, sf_dir), floor=fx.FLOOR)


@query(
    f"""with {fx.SQL_FACT_L1}
        select l1_category, cast(grouping(l1_category) as int) as level,
               count(distinct review_id) negative_reviews
        from fact_l1 where sentiment = 'Negative' and {_FROM} group by rollup (l1_category)"""
)
def neg_by_l1_rollup(spark, sf_dir):
    return ms.negative_reviews_with_total(fx.l1(spark, sf_dir), floor=fx.FLOOR)


_SQL_BY_L1 = f"""with {fx.SQL_FACT_L1},
  n as (select l1_category, count(distinct review_id) negative_reviews from fact_l1
        where sentiment = 'Negative' and {_FROM} group by 1)"""


@query(
    f"""{_SQL_BY_L1}
        select l1_category, negative_reviews, cast(negative_reviews as double) /
               (select count(distinct review_id) from fact_l1
                where sentiment = 'Negative' and {_FROM}) as share
        from n"""
)
def neg_share_l1(spark, sf_dir):
    return ms.negative_share(fx.l1(spark, sf_dir), floor=fx.FLOOR)


@query(
    f"""{_SQL_BY_L1}
        select l1_category, negative_reviews,
               cast(negative_reviews as double) / (select sum(negative_reviews) from n) as share
        from n"""
)
def neg_share_l1_of_categories(spark, sf_dir):
    return ms.negative_share(fx.l1(spark, sf_dir), share_of="categories", floor=fx.FLOOR)


_SQL_SLICED = f"""with {fx.SQL_FACT_L1},
  sliced as (select f.*, c.platform from fact_l1 f join core c using (review_id)
             where f.sentiment = 'Negative' and f.review_date >= date '{fx.FLOOR}'),
  n as (select platform, l1_category, count(distinct review_id) negative_reviews from sliced
        group by all)"""


def _sliced(spark, sf_dir):
    return with_dim(fx.l1(spark, sf_dir), fx.dim(spark, sf_dir))


@query(f"{_SQL_SLICED} select * from n")
def neg_by_l1_platform(spark, sf_dir):
    return ms.negative_reviews(_sliced(spark, sf_dir), ["platform", "l1_category"], fx.FLOOR)


@query(
    f"""{_SQL_SLICED} select n.*, cast(negative_reviews as double) / w as share
        from n join (select platform, count(distinct review_id) w from sliced group by 1)
        using (platform)"""
)
def neg_share_l1_platform(spark, sf_dir):
    return ms.negative_share(_sliced(spark, sf_dir), floor=fx.FLOOR, by=["platform"])


_MENTIONS = f"contains(lower(text), '{fx.PHRASE}')"


@query(
    f"""with {fx.SQL_CORE} select count(distinct review_id) total from core where {_MENTIONS}"""
)
def phrase_total(spark, sf_dir):
    return ms.phrase_sentiment(fx.dim(spark, sf_dir), fx.PHRASE).select("total")


@query(
    f"""with {fx.SQL_CORE} select count(distinct review_id) negative from core
        where {_MENTIONS} and sentiment = 'Negative'"""
)
def phrase_negative(spark, sf_dir):
    return ms.phrase_sentiment(fx.dim(spark, sf_dir), fx.PHRASE).select("negative")


@query(
    f"""with {fx.SQL_CORE},
        n as (select platform, count(distinct review_id) total,
                     count(distinct case when sentiment = 'Negative' then review_id end) negative
              from core where {_MENTIONS} group by platform)
        select *, cast(negative as double) / total negative_pct from n"""
)
def phrase_negative_pct(spark, sf_dir):
    return ms.phrase_sentiment(fx.dim(spark, sf_dir), fx.PHRASE, ["platform"])


_SQL_COHORT = f"""with {fx.SQL_TAGGED},
  n as (select l2, count(*) n_rows from f where review_id in
          (select review_id from core where {_MENTIONS} and sentiment = 'Negative') group by l2),
  p as (select l2 l2_specific_issue, n_rows,
               cast(n_rows as double) / (select sum(n_rows) from n) * 100 pct from n)"""


@query(f"{_SQL_COHORT} select l2_specific_issue, n_rows, round(pct, 9) pct from p")
def phrase_l2_pct(spark, sf_dir):
    pct = ms.phrase_issue_pct(fx.dim(spark, sf_dir), fx.l2(spark, sf_dir), fx.PHRASE)
    return pct.withColumn("pct", F.round("pct", 9))


@query(
    f"""with {fx.SQL_TAGGED},
        n as (select platform, l2 l2_specific_issue, count(*) n_rows
              from f join (select review_id, platform from core
                           where {_MENTIONS} and sentiment = 'Negative') using (review_id)
              group by all)
        select *, round(cast(n_rows as double) / sum(n_rows) over (partition by platform) * 100, 9)
               pct from n"""
)
def phrase_l2_pct_by_platform(spark, sf_dir):
    pct = ms.phrase_issue_pct(
        fx.dim(spark, sf_dir), fx.l2(spark, sf_dir), fx.PHRASE, ["platform"]
    )
    return pct.withColumn("pct", F.round("pct", 9))


@query(
    f"""{_SQL_COHORT} select l2_specific_issue, n_rows, round(pct, 9) pct,
              cast(rank() over (order by pct desc) as int) as rank
        from p order by pct desc, l2_specific_issue limit 3"""
)
def top_issue(spark, sf_dir):
    pct = ms.phrase_issue_pct(fx.dim(spark, sf_dir), fx.l2(spark, sf_dir), fx.PHRASE)
    ranked = ms.rank_issues(pct)
    return top_n(ranked, "pct", "l2_specific_issue", 3).withColumn("pct", F.round("pct", 9))


@query(
    f"""with {fx.SQL_CORE},
        late as (select * from core where {_FROM}),
        axis as (select distinct platform, sentiment from late),
        v as (select platform, count(distinct review_id) overridden from late
              where {_MENTIONS} and sentiment = 'Negative' group by platform),
        t as (select platform, sentiment,
                     count(distinct case when sentiment = 'Negative' then review_id end) intersected
              from late group by all)
        select a.platform, a.sentiment, v.overridden, t.intersected,
               (select count(distinct review_id) from late) as removed
        from axis a left join v using (platform)
             left join t on a.platform = t.platform and a.sentiment = t.sentiment"""
)
def filter_override(spark, sf_dir):
    dim = fx.dim(spark, sf_dir)
    axis = ["platform", "sentiment"]
    late = {"review_date": F.col("review_date") >= F.lit(fx.FLOOR).cast("date")}
    ids = F.count_distinct("review_id")
    # A filter on the column replaces the one of the axis ...
    overridden = ms.measure(
        dim,
        [ids.alias("overridden")],
        axis,
        outer=late,
        override={
            "text": F.contains(F.lower("text"), F.lit(fx.PHRASE)),
            "sentiment": ms.is_negative(),
        },
    )
    # ... one on the table meets it, and removal of all filters on the axis leaves the total.
    negative = F.count_distinct(F.when(ms.is_negative(), F.col("review_id")))
    intersected = ms.measure(dim, [negative.alias("intersected")], axis, outer=late)
    removed = ms.measure(dim, [ids.alias("removed")], axis, outer=late, remove=axis)
    return overridden.join(intersected, axis).join(removed, axis)


_SQL_COVERAGE = """with targets as (select distinct source, 60 target from documents
                        union all select 'nowhere', 60),
            rows_ as (select source, count(*) n from documents group by 1)
       select source, cast(target as bigint) target, coalesce(n, 0) n_rows,
              cast(coalesce(n, 0) as double) / target covered
       from targets left join rows_ using (source)"""
_TARGETS = {f"src{i}": 60 for i in range(20)} | {"nowhere": 60}


@query(_SQL_COVERAGE)
def coverage(spark, sf_dir):
    return ms.coverage(table(spark, sf_dir, "documents"), _TARGETS, "source")


@query(_SQL_COVERAGE)
def coverage_observed(spark, sf_dir):
    """Coverage from the counts made while the collected rows are written."""
    place = f"{checkpoint_root(spark)}/collected-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    return ms.observed_coverage(docs, _TARGETS, "source", lambda rows: rows.write.parquet(place))


# Ids and categories that differ in case only: every review has two facts, each in its own spelling.
_SQL_SPELLED = """reviews as (
  select 'Doc-' || doc_id review_id, case when doc_id % 5 < 2 then 'negative' else 'Positive' end
         sentiment from documents),
spelled as (
  select case k when 0 then 'doc-' else 'DOC-' end || doc_id review_id,
         case when (doc_id + k) % 2 = 0 then name else upper(name) end l1_category
  from (select doc_id, case doc_id % 3 when 0 then 'Login' when 1 then 'Price' else 'Speed' end name
        from documents), (values (0), (1)) t(k))"""


def _spelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    name = F.get(F.array(*map(F.lit, ("Login", "Price", "Speed"))), (F.col("doc_id") % 3).cast("int"))
    sentiment = F.when(F.col("doc_id") % 5 < 2, "negative").otherwise("Positive")
    dim = docs.select(
        F.concat(F.lit("Doc-"), "doc_id").alias("review_id"), sentiment.alias("sentiment")
    )
    copies = docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    own = F.when(F.col("k") == 0, "doc-").otherwise("DOC-")
    fact = copies.select(
        F.concat(own, "doc_id").alias("review_id"),
        F.when((F.col("doc_id") + F.col("k")) % 2 == 0, name)
        .otherwise(F.upper(name))
        .alias("l1_category"),
    )
    return {"dim_reviews_core": dim, "fact_l1_tags": fact}


@query(
    f"""with {_SQL_SPELLED}
        select upper(l1_category) l1_category, count(distinct lower(s.review_id)) total
        from spelled s join reviews r on lower(s.review_id) = lower(r.review_id)
        where lower(sentiment) = 'negative' group by 1"""
)
def model_ignoring_case(spark, sf_dir):
    """Distinct negative reviews per category where ids and categories are equal in any case."""
    tables = collation.model_ignoring_case(
        _spelled(spark, sf_dir), "review_id", "l1_category", "sentiment"
    )
    fact = collation.first_spelling(tables["fact_l1_tags"], "l1_category")
    model = Model({**tables, "fact_l1_tags": fact})
    negative = model.keep("dim_reviews_core", "sentiment", ["Negative"])
    counted = negative.distinct_reviews("fact_l1_tags", ["l1_category"], any=F.lit(True))
    return collation.exact_case(counted.select("l1_category", "total"))


@query(
    f"""with {_SQL_SPELLED}
        select l1_category, count(distinct s.review_id) total,
               count(distinct r.review_id) known
        from spelled s left join reviews r on s.review_id = r.review_id group by 1"""
)
def model_exact_case(spark, sf_dir):
    """The same tables compared letter by letter: each spelling counts, and none has a review."""
    tables = {name: collation.exact_case(df) for name, df in _spelled(spark, sf_dir).items()}
    model = Model(tables)
    rows = model.related("fact_l1_tags", ["sentiment"])
    known = F.count_distinct(F.when(F.col("sentiment").isNotNull(), F.col("review_id")))
    return rows.groupBy("l1_category").agg(
        F.count_distinct("review_id").alias("total"), known.alias("known")
    )
