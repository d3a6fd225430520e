"""Streaming jobs over the events table, and the batch query they must agree with."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from ..streaming import cursor
from ..streaming import reviews as st
from .registry import day, query, table

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"

_SQL_DAILY = """select strftime(ts, '%Y-%m-%d') as day,
       count_if(event_type = 'error')::bigint n_negative, count(*) n_reviews
  from events group by 1"""


def _sentiment(events):
    """Events as reviews: an error is a negative one."""
    return events.withColumn(
        "sentiment", F.when(F.col("event_type") == "error", "Negative").otherwise("Positive")
    )


def _stream(spark, sf_dir):
    # A pattern matches the table whether it is a folder of files or a single file; a plain path
    # would have to be a folder.
    return st.stream_reviews(spark, f"{sf_dir}/events.parque[t]", _EVENTS, format="parquet")


def _run(spark, start, df, name):
    """Run a stream to the end in a fresh place of the shared folder; return where it wrote."""
    place = f"{name}-{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/{place}-out"
    start(df, place, path).awaitTermination()
    return path


@query(_SQL_DAILY)
def stream_daily_batch_twin(spark, sf_dir):
    daily = st.stream_daily_negativity(_sentiment(table(spark, sf_dir, "events")))
    return daily.withColumn("day", day("day"))


@query(_SQL_DAILY)
def stream_daily(spark, sf_dir):
    timed = _sentiment(_stream(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = st.stream_daily_negativity(timed.withWatermark("ts", "7 days"))
    path = _run(spark, st.upsert_once, counts, "stream_daily")
    return st.written(spark, path, counts.schema).withColumn("day", day("day"))


@query(
    f"""select day[:7] || '-01' as month, sum(n_negative)::bigint n_negative,
               sum(n_reviews)::bigint n_reviews,
               sum(n_negative)::double / sum(n_reviews) negativity
        from ({_SQL_DAILY}) group by 1"""
)
def stream_months(spark, sf_dir):
    daily = st.stream_daily_negativity(_sentiment(table(spark, sf_dir, "events")))
    return st.months_of_days(daily).withColumn("month", day("month"))


@query("select distinct event_type, user_id from events where ts >= timestamp '2024-01-05'")
def stream_dedup(spark, sf_dir):
    floor = st.stream_floor(_stream(spark, sf_dir), "ts", "2024-01-05")
    first = st.stream_dedup(floor, ["event_type", "user_id"], "ts", "60 days")
    ids = first.select("event_type", "user_id")
    path = _run(spark, st.append_once, ids, "stream_dedup")
    return st.written(spark, path, ids.schema)


def _landings(spark, sf_dir, n=3):
    """The events as they would land: ``n`` spans of time, one after the other."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    edges = events.agg(F.min(seconds), F.max(seconds)).first()
    first, last = (edges[0] or 0), (edges[1] or 0)
    span = F.floor((seconds - first) * n / (last - first + 1))
    return [events.filter(span == i) for i in range(n)]


def _over_runs(spark, sf_dir, name, budget):
    """A stream that is run, and stopped, once for each landing."""
    place = f"{name}-{uuid.uuid4().hex}"
    root = checkpoint_root(spark)
    landed, path = f"{root}/{place}-in", f"{root}/{place}-out"
    for rows in _landings(spark, sf_dir):
        rows.write.mode("append").parquet(landed)
        kept = budget(st.stream_reviews(spark, landed, _EVENTS, format="parquet"))
        st.append_once(kept, place, path).awaitTermination()
    return st.written(spark, path, kept.schema).select("event_id", "event_type")


@query(
    """select event_id, event_type from events where event_type in ('error', 'click')
       qualify row_number() over (partition by event_type order by ts, event_id)
               <= case event_type when 'error' then 300 else 900 end"""
)
def stream_budget_per_app(spark, sf_dir):
    """Budgets of two event types that last over three runs."""
    targets = {"error": 300, "click": 900}
    return _over_runs(
        spark, sf_dir, "stream_budget",
        lambda df: st.stream_budget(df, ["event_type"], ["ts", "event_id"], targets),
    )


@query("select event_id, event_type from events order by ts, event_id limit 700")
def stream_budget_global(spark, sf_dir):
    """One budget over all rows that lasts over three runs."""
    return _over_runs(
        spark, sf_dir, "stream_budget_global",
        lambda df: st.stream_budget(df, [], ["ts", "event_id"], 700),
    )


def _pages(spark, sf_dir, size=5000):
    """Events as pages of a feed per event type, each naming the next; ``late`` pages land last."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type").filter(
        "event_type is not null and event_id is not null"
    )
    placed = events.select(
        F.col("event_type").alias("feed"),
        F.floor(F.col("event_id") / size).alias("page"),
        F.to_json(F.struct("event_id")).alias("payload"),
    )
    # One row a page.
    w = Window.partitionBy("feed").orderBy("page")
    chain = placed.select("feed", "page").distinct().select(
        "feed",
        "page",
        F.when(F.row_number().over(w) == 1, cursor.FIRST)
        .otherwise(F.concat(F.lit("p/"), "page"))
        .alias("cursor"),
        F.concat(F.lit("p/"), F.coalesce(F.lead("page").over(w), F.lit(-1))).alias("next"),
        (F.row_number().over(w) > 1).alias("late"),
    )
    return placed.join(chain, ["feed", "page"])


@query(
    """select event_type feed, event_id from events
       where event_type is not null and event_id is not null"""
)
def stream_cursor_feed(spark, sf_dir):
    """Pages of a feed that land in two goes, each read once over two runs."""
    place = f"stream_cursor_feed-{uuid.uuid4().hex}"
    root = checkpoint_root(spark)
    landed, path = f"{root}/{place}-in", f"{root}/{place}-out"
    pages = _pages(spark, sf_dir)
    for late in (False, True):
        cursor.land_pages(pages.filter(F.col("late") == late), landed)
        entries = cursor.stream_feed(spark, landed).select(
            "feed", F.get_json_object("payload", "$.event_id").cast("bigint").alias("event_id")
        )
        st.append_once(entries, place, path).awaitTermination()
    return st.written(spark, path, entries.schema)
