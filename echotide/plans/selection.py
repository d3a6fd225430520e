"""Filters, duplicates, budgets and order on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import select as sel
from . import fixtures as fx
from .registry import day, query, table

AS_OF = "2024-02-10"
TYPE_RANK = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}
TYPE_BUDGET = {"view": 300, "click": 20, "purchase": 5}
_SQL_RANK = "case event_type {} end".format(
    " ".join(f"when '{k}' then {v}" for k, v in TYPE_RANK.items())
)
_SQL_BUDGET = "case event_type {} else 0 end".format(
    " ".join(f"when '{k}' then {v}" for k, v in TYPE_BUDGET.items())
)


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _ranked(spark, sf_dir):
    from ..functions.text import lookup

    return _events(spark, sf_dir).withColumn(
        "type_rank", lookup(F.col("event_type"), TYPE_RANK)
    )


@query(
    f"""select event_id, event_type from events
        where ts >= timestamp '{AS_OF}' - interval 30 day"""
)
def cutoff_window(spark, sf_dir):
    return sel.since_months(_events(spark, sf_dir), "ts", AS_OF, 1).select(
        "event_id", "event_type"
    )


@query(
    f"""with {fx.SQL_CORE} select review_id, strftime(review_date, '%Y-%m-%d') review_date
        from core where review_date >= date '{fx.FLOOR}'"""
)
def date_floor(spark, sf_dir):
    rows = sel.date_floor(fx.core(spark, sf_dir), "review_date", fx.FLOOR)
    return rows.select("review_id", day("review_date").alias("review_date"))


@query(
    """select page_id, url from pages where contains(url, '.example.')
       and not contains(url, '/en/')"""
)
def url_filter(spark, sf_dir):
    return sel.url_filter(table(spark, sf_dir, "pages"), "url", ".example.", "/en/").select(
        "page_id", "url"
    )


@query(
    """select conv_id, turn from conversations
       where case when role = 'system' then '' else role end <> '' or turn % 2 = 0"""
)
def drop_empty(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", "").otherwise(F.col("role")).alias("title"),
        F.when(F.col("turn") % 2 == 0, F.col("text")).alias("body"),
    )
    return sel.drop_empty(rows, ["title", "body"]).select("conv_id", "turn")


_SQL_NTH = "row_number() over (partition by event_type order by ts, event_id)"


@query(f"select event_id, event_type from events qualify {_SQL_NTH} <= 100")
def budget_per_group(spark, sf_dir):
    return sel.budget_per_group(
        _events(spark, sf_dir), ["event_type"], ["ts", "event_id"], 100
    ).select("event_id", "event_type")


@query(f"select event_id, event_type from events qualify {_SQL_NTH} <= {_SQL_BUDGET}")
def budget_per_app(spark, sf_dir):
    return sel.budget_per_group(
        _events(spark, sf_dir),
        ["event_type"],
        ["ts", "event_id"],
        TYPE_BUDGET,
    ).select("event_id", "event_type")


@query(
    """select event_id, event_type from events
       qualify row_number() over (partition by event_type order by ts desc, event_id) <= 1500"""
)
def budget_newest(spark, sf_dir):
    order = [F.col("ts").desc(), "event_id"]
    rows = sel.budget_per_group(_events(spark, sf_dir), ["event_type"], order, 1500)
    return rows.select("event_id", "event_type")


_SQL_OUTLIERS = """e as (
  select event_id, event_type, case when event_id = 7 then timestamp '0001-01-02 00:00:00'
         when event_id = 11 then timestamp '9999-12-30 00:00:00' else ts end ts from events)"""


@query(
    f"""with {_SQL_OUTLIERS} select event_id, event_type from e
        qualify row_number() over (partition by event_type order by ts, event_id) <= 1200"""
)
def budget_outlier(spark, sf_dir):
    ts = (
        F.when(F.col("event_id") == 7, F.lit("0001-01-02 00:00:00").cast("timestamp"))
        .when(F.col("event_id") == 11, F.lit("9999-12-30 00:00:00").cast("timestamp"))
        .otherwise(F.col("ts"))
    )
    rows = _events(spark, sf_dir).withColumn("ts", ts)
    return sel.budget_per_group(rows, ["event_type"], ["ts", "event_id"], 1200).select(
        "event_id", "event_type"
    )


_SQL_TARGETS = """targets as (
  select event_type, user_id, 1 + user_id % 3 target from events group by all having user_id % 2 = 0)"""


@query(
    f"""with {_SQL_TARGETS}, kept as (
          select event_id, e.event_type, e.ts, {_SQL_RANK.replace("event_type", "e.event_type")} r
          from events e join targets t on e.event_type = t.event_type and e.user_id = t.user_id
          qualify row_number() over (partition by e.event_type, e.user_id
                                     order by e.ts, event_id) <= target)
        select event_id, event_type from kept
        qualify row_number() over (order by r, ts, event_id) <= 700"""
)
def budget_nested(spark, sf_dir):
    rows = _ranked(spark, sf_dir)
    targets = (
        rows.filter(F.col("user_id") % 2 == 0)
        .select("event_type", "user_id", (1 + F.col("user_id") % 3).alias("target"))
        .distinct()
    )
    kept = sel.budget_per_group(rows, ["event_type", "user_id"], ["ts", "event_id"], targets)
    return sel.budget_global(kept, "type_rank", ["ts", "event_id"], 700).select(
        "event_id", "event_type"
    )


@query(f"select event_id, event_type, {_SQL_NTH} as rank from events")
def rank_in_feed(spark, sf_dir):
    return sel.binned_rank(
        _events(spark, sf_dir), ["event_type"], F.date_trunc("hour", "ts"), ["ts", "event_id"]
    ).select("event_id", "event_type", F.col("_rank").alias("rank"))


_SQL_GLOBAL = f"row_number() over (order by {_SQL_RANK}, ts, event_id)"


@query(f"select event_id, event_type from events qualify {_SQL_GLOBAL} <= 5000")
def budget_global(spark, sf_dir):
    return sel.budget_global(
        _ranked(spark, sf_dir), "type_rank", ["ts", "event_id"], 5000
    ).select("event_id", "event_type")


@query(
    f"""with sizes as (select {_SQL_RANK} r, count(*) n from events group by 1),
             before as (select r, coalesce(sum(n) over (order by r rows between unbounded preceding
                               and 1 preceding), 0) b from sizes)
        select event_id, event_type from events join before on r = {_SQL_RANK} where b < 5000"""
)
def budget_overshoot(spark, sf_dir):
    return sel.budget_global(
        _ranked(spark, sf_dir), "type_rank", ["ts", "event_id"], 5000, overshoot=True
    ).select("event_id", "event_type")


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') ts from events")
def newest_first(spark, sf_dir):
    rows = sel.newest_first(_events(spark, sf_dir), "ts", "event_id")
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query(
    """select event_id, event_type, user_id from events
       qualify row_number() over (partition by event_type, user_id order by ts, event_id) = 1"""
)
def dedup_keep_first(spark, sf_dir):
    return sel.dedup_keep_first(
        _events(spark, sf_dir), ["event_type", "user_id"], ["ts", "event_id"]
    ).select("event_id", "event_type", "user_id")


_SQL_SOME_TEXT = "select doc_id, case when doc_id % 9 > 0 then text end text from documents"


@query(
    f"""with d as ({_SQL_SOME_TEXT})
        select min(doc_id) doc_id from d where text is not null group by {fx.sql_clean('text')}
        union all select doc_id from d where text is null"""
)
def dedup_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 9 > 0, F.col("text")).alias("text")
    )
    return sel.dedup_text(rows, "text", ["doc_id"]).select("doc_id")


KEYWORDS = ("License", "that is", "dans", "the")


@query(
    """with k(kw, r) as (values ('License', 0), ('that is', 1), ('dans', 2), ('the', 3))
       select conv_id, turn, arg_min(kw, r) keyword
       from conversations join k on contains(lower(text), lower(kw)) group by all"""
)
def keyword_match(spark, sf_dir):
    return sel.keyword_match(table(spark, sf_dir, "conversations"), KEYWORDS, "text").select(
        "conv_id", "turn", "keyword"
    )


@query(
    """with k as (select item_id, text kw from benchmark)
       select doc_id, arg_min(kw, item_id) keyword
       from documents join k on contains(lower(text), lower(kw)) group by doc_id"""
)
def keyword_match_table(spark, sf_dir):
    keywords = table(spark, sf_dir, "benchmark").select(
        F.col("text").alias("keyword"), F.col("item_id").alias("rank")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sel.keyword_match(docs, keywords, "text").select("doc_id", "keyword")
