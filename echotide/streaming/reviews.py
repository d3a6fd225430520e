"""Landed reviews as a stream: read once, first of each id kept, counted by day."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StructType

from ..functions.numbers import safe_divide
from ..operators.measures import is_negative
from ..schemas import LANDED_REVIEW
from ..session import checkpoint_root


def stream_reviews(
    spark: SparkSession,
    path: str,
    schema: str | StructType = LANDED_REVIEW,
    files_per_trigger: int = 1000,
    format: str = "json",
    **options: str,
) -> DataFrame:
    """New files of a folder, each read once. ``files_per_trigger`` bounds a batch, and with it
    how many rows of one hot id can meet in a task."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.options(**options).format(format).load(path)


def stream_floor(df: DataFrame, ts: str, date) -> DataFrame:
    """Rows from ``date`` on. Rows that are only late are dropped by the watermark instead."""
    return df.filter(F.col(ts) >= F.lit(date).cast("timestamp"))


def stream_dedup(
    df: DataFrame,
    keys: Sequence[str] = ("platform", "review_id"),
    ts: str = "ts",
    delay: str = "7 days",
) -> DataFrame:
    """The first row per key within the delay; later ones are dropped, state is bounded by it.

    Times without a zone are read as UTC, as a watermark needs a full timestamp.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def stream_budget(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int | Mapping,
) -> DataFrame:
    """The first ``n`` rows per group that ever arrive, over all triggers and restarts; without
    ``keys``, the first ``n`` of all. Within a trigger ``order`` decides, which must be total.

    A mapping gives each value of the first key its own ``n``; groups it does not name are dropped.
    The state of a group is the number of rows it has had. Before rows meet by group, each partition
    keeps no more than the first ``n`` of a group, so a group of any size reaches its task as at most
    ``n`` rows of every partition, and a budget that is used up takes none.
    """
    by, names, given = list(keys), list(order), df.schema
    # As decimals, whole numbers stay exact in pandas next to nulls.
    whole = {f.name for f in given if isinstance(f.dataType, IntegralType)}
    df = df.select(
        *(F.col(c).cast("decimal(20,0)").alias(c) if c in whole else c for c in given.names)
    )
    kind = df.schema
    most = n if isinstance(n, int) else max(n.values(), default=0)
    if not isinstance(n, int):
        df = df.filter(F.col(by[0]).isin([k for k, room in n.items() if room > 0]))

    def first(rows: pd.DataFrame, room: int) -> pd.DataFrame:
        rows = rows.sort_values(names, kind="stable", na_position="first")
        if not by:
            return rows.head(room)
        return rows.groupby(by, sort=False, dropna=False).head(room)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            kept = first(batch if kept is None else pd.concat([kept, batch]), most)
        if kept is not None:
            yield kept

    def take(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        had = state.get[0] if state.exists else 0
        room = (n if isinstance(n, int) else n[key[0]]) - had
        kept = None
        for batch in batches:
            if room > 0:
                kept = first(batch if kept is None else pd.concat([kept, batch]), room)
        if kept is not None:
            state.update((had + len(kept),))
            yield kept[kind.names]

    cut_down = df.mapInPandas(cut, kind)
    if not by:
        cut_down = cut_down.withColumn("_all", F.lit(0))
    taken = cut_down.groupBy(*(by or ["_all"])).applyInPandasWithState(
        take, kind, "had long", "append", GroupStateTimeout.NoTimeout
    )
    return taken.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in given))


def stream_daily_negativity(
    df: DataFrame, ts: str = "ts", sentiment: str = "sentiment", by: Sequence[str] = ()
) -> DataFrame:
    """Negative and all reviews per day. Works on a stream with a watermark and on a table."""
    counted = df.groupBy(F.window(F.col(ts).cast("timestamp"), "1 day"), *by).agg(
        F.count_if(is_negative(sentiment)).alias("n_negative"),
        F.count(F.lit(1)).alias("n_reviews"),
    )
    return counted.select(F.to_date("window.start").alias("day"), *by, "n_negative", "n_reviews")


def months_of_days(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily counts rolled up to calendar months, which no window of fixed length is."""
    counted = daily.groupBy(F.trunc("day", "MM").alias("month"), *by).agg(
        F.sum("n_negative").alias("n_negative"), F.sum("n_reviews").alias("n_reviews")
    )
    return counted.withColumn(
        "negativity", safe_divide(F.col("n_negative"), F.col("n_reviews"))
    )


def append_once(df: DataFrame, name: str, path: str) -> StreamingQuery:
    """Take in everything that has landed, append it to Parquet under ``path``, and stop.

    Progress is kept in the shared folder, so the next run, or a restart, goes on from there.
    """
    return (
        df.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint_root(df.sparkSession)}/{name}")
        .trigger(availableNow=True)
        .start()
    )


def upsert_once(
    df: DataFrame, name: str, path: str, keys: Sequence[str] = ("day",)
) -> StreamingQuery:
    """Take in everything that has landed into running counts, and stop.

    Each batch replaces the folders of the ``keys`` it changed and leaves the others, so there is
    one version of every day, however many batches ran, and a repeated batch replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        replaced = batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy(*keys).parquet(path)

    return (
        df.writeStream.queryName(name)
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint_root(df.sparkSession)}/{name}")
        .trigger(availableNow=True)
        .start()
    )


def written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``append_once`` or ``upsert_once`` wrote of a stream with ``schema``. Before anything
    has landed there is no output yet, which is the same as no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
