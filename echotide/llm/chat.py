"""Logged conversations collapsed to the longest snapshots, and rendered.

A log often holds a conversation several times, each snapshot with a few turns more. Every turn
gets a rolling hash of the conversation up to it. A conversation whose last hash is the hash of an
earlier turn of another one is a prefix of that, and an anti-join drops it. Of equal conversations
the least id stays. Only the conversations that remain are rendered.

The rolling hash combines one hash per place, role and text, so it is a running aggregate: first
inside blocks of ``BLOCK`` turns, then over the blocks. A conversation of very many turns is
therefore never sorted in one task, and no conversation is gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK = 1024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
KEY = ["length", "hash_a", "hash_b"]


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, turn, role, text`` with ``length`` (place from 1) and two rolling hashes.

    Turns are ordered by ``turn``, then role and text, nulls first; repeated rows are one turn.
    Rows without ``conv_id`` belong to no conversation and are left out. A null text or role
    differs from an empty one.
    """
    rows = (
        turns.select("conv_id", "turn", "role", "text")
        .filter(F.col("conv_id").isNotNull())
        .distinct()
        .withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / block))
    )
    inside = Window.partitionBy("conv_id", "block")
    order = inside.orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # Turns of earlier blocks, one row for each block.
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    starts = sizes.select(
        "conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    placed = rows.join(starts, ["conv_id", "block"]).withColumn(
        "length", F.col("start") + F.row_number().over(order)
    )

    def hashed(seed: int):
        return F.xxhash64(
            F.lit(seed), "length", F.col("role").isNull(), "role", F.col("text").isNull(), "text"
        )

    placed = placed.withColumn("own_a", hashed(1)).withColumn("own_b", hashed(2))
    block_hash = placed.groupBy("conv_id", "block").agg(
        F.bit_xor("own_a").alias("all_a"), F.bit_xor("own_b").alias("all_b")
    )

    def earlier(name):
        return F.coalesce(F.bit_xor(name).over(before), F.lit(0))

    offsets = block_hash.select(
        "conv_id", "block", earlier("all_a").alias("pre_a"), earlier("all_b").alias("pre_b")
    )
    return placed.join(offsets, ["conv_id", "block"]).select(
        "conv_id",
        "turn",
        "role",
        "text",
        "length",
        F.col("pre_a").bitwiseXOR(F.bit_xor("own_a").over(so_far)).alias("hash_a"),
        F.col("pre_b").bitwiseXOR(F.bit_xor("own_b").over(so_far)).alias("hash_b"),
    )


def maximal(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns, with ``length``, of conversations that are no prefix of a longer one and have the
    least id among equal ones; ``copies`` counts the latter, the kept one included."""
    rolled = staged(prefixes(turns, block), "turns")
    ends = rolled.groupBy("conv_id").agg(F.max("length").alias("length"))
    last = rolled.join(ends, ["conv_id", "length"]).select("conv_id", *KEY)
    kept = last.groupBy(KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    # A hash before the end of its conversation is that of a proper prefix. The least length of a
    # conversation that goes on is enough, so copies reduce next to the data.
    inner = (
        rolled.join(ends.withColumnRenamed("length", "all"), "conv_id")
        .filter("length < all")
        .select(KEY)
        .distinct()
    )
    kept = kept.join(inner, KEY, "left_anti").select("conv_id", "copies")
    return rolled.join(kept, "conv_id").select(
        "conv_id", "length", "turn", "role", "text", "copies"
    )


def render(turns: DataFrame) -> DataFrame:
    """One row per kept turn with ``segment``, its part of the training text: the segments of a
    conversation in order of ``length``, one after the other, are the whole.

    A null role is written ``unknown``, a null text as empty. Control marks inside a text are
    broken up, so that a text can't open or close a turn.
    """
    safe = F.coalesce("text", F.lit(""))
    for mark in (OPEN, CLOSE):
        safe = F.replace(safe, F.lit(mark), F.lit(mark.replace("|", " |", 1)))
    segment = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), safe, F.lit(CLOSE + "\n")
    )
    return turns.withColumn("segment", segment)


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, length, role, copies, segment`` of maximal conversations. An empty table gives an
    empty one."""
    return render(maximal(turns)).select("conv_id", "length", "role", "copies", "segment")


SQL = f"""
with t as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
p as (select *, row_number() over (partition by conv_id
        order by turn nulls first, role nulls first, text nulls first) length from t),
c as (select conv_id, count(*) n, list({{'r': role, 't': text}} order by length) turns
      from p group by conv_id),
u as (select min(conv_id) conv_id, n, turns, count(*) copies from c group by n, turns),
pre as (select distinct list_slice(turns, 1, k) turns
        from (select turns, unnest(range(1, n)) k from u)),
kept as (select conv_id, copies from u where not exists (select 1 from pre where pre.turns = u.turns))
select p.conv_id, p.length, p.role, k.copies,
  '{OPEN}' || coalesce(role, 'unknown') || chr(10)
  || replace(replace(coalesce(text, ''), '{OPEN}', '< |im_start|>'), '{CLOSE}', '< |im_end|>')
  || '{CLOSE}' || chr(10) as segment
from p join kept k using (conv_id)
"""
