"""Sources mixed to target weights by Sainte-Laguë apportionment of equal-token blocks.

Seats are blocks of ``BLOCK`` words. They go to sources by highest quotients ``target / (2 k + 1)``,
and the seats of a source in the same way to its shards, bounded parts of its documents dealt by a
seeded hash. A shard lays its documents on a line in seeded order and takes whole turns of the line
and then, of the blocks of the line, the seeded choice that makes up the rest. Quotas are whole
numbers, so a rerun takes the same blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_TIMES = 2
BLOCK = 256
SHARD_WORDS = 4_000_000
SEED = 7


def words(text: str = "text") -> Column:
    """The number of words; a null text has none."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long")
    )


def apportion(parties: DataFrame, group: list[str], claim: str, seats: Column) -> DataFrame:
    """``parties`` with ``quota``: ``seats`` of each group dealt by highest quotients
    ``claim / (2 k + 1)``; ties go by ``party``.

    A party first gets what its share surely yields; the remaining seats are dealt one by one among
    the next quotients of each party.
    """
    whole = Window.partitionBy(*group)
    # The divisor method gives a party no less than its share rounded down, less a slack that covers
    # the rare violations of the lower quota, and no more than it rounded up, plus the same.
    slack = 2
    share = F.when(
        F.col("total") > 0, F.col(claim) * F.col("seats") / F.col("total")
    ).otherwise(0.0)
    sized = (
        parties.withColumn("seats", seats)
        .withColumn("total", F.sum(claim).over(whole))
        .withColumn("sure", F.greatest(F.floor(share) - slack, F.lit(0)))
        .withColumn("open", F.col("seats") - F.sum("sure").over(whole))
    )
    quotients = sized.filter(F.col(claim) > 0).select(
        *group,
        "party",
        "open",
        F.explode(F.sequence(F.lit(0), F.lit(2 * slack + 2))).alias("k"),
        (F.col(claim) / (2 * (F.col("sure") + F.col("k")) + 1)).alias("quotient"),
    )
    by_quotient = Window.partitionBy(*group).orderBy(F.desc("quotient"), "party", "k")
    won = (
        quotients.withColumn("place", F.row_number().over(by_quotient))
        .filter(F.col("place") <= F.col("open"))
        .groupBy(*group, "party")
        .agg(F.count("*").alias("won"))
    )
    return (
        sized.join(won, [*group, "party"], "left")
        .withColumn("quota", F.col("sure") + F.coalesce("won", F.lit(0)))
        .drop("seats", "total", "sure", "open", "won")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """``source, rank, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, weigh ``WEIGHTS`` in turn and share ``SHARE`` of all words. A
    target stops at ``MOST_TIMES`` the size of its source; the excess is shared by weight among the
    others until no target is above. That is a level: with the sources in order of size per weight,
    the first ones stop, and the others get what is left by weight. One row per source meets here.
    """
    by_name = Window.partitionBy("all").orderBy(F.col("source").isNull(), "source")
    most = F.col("source_size") * F.lit(float(MOST_TIMES))
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("int")
    ).cast("double")
    ranked = (
        sizes.withColumn("all", F.lit(0))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("most", most)
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy("all")) * SHARE)
    )
    by_ratio = Window.partitionBy("all").orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    stops = F.col("most") <= F.col("level") * F.col("weight")
    # The level of the first source that does not stop holds for all after it.
    final = F.min(F.when(~F.col("stops"), F.struct("place", "level"))).over(Window.partitionBy("all"))
    return (
        ranked.withColumn("level", level)
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("stops", stops)
        .withColumn("final", final)
        .select(
            "source",
            "rank",
            "source_size",
            F.when(
                F.col("final").isNotNull() & (F.col("place") >= F.col("final.place")),
                F.col("final.level") * F.col("weight"),
            )
            .otherwise(F.col("most"))
            .alias("target"),
        )
    )


def seeded(*columns: str, seed: int = SEED) -> Column:
    return F.xxhash64(*columns, F.lit(seed))


def _identified(rows: DataFrame, identity: Sequence[str]) -> DataFrame:
    """``rows`` (with ``row`` and ``_part``, the partition they were written in) with ``key_a``,
    ``key_b`` and ``copy``: hashes of the ``identity`` columns, and a number from 0 among equal
    rows. Which of these gets which number makes no difference; that they are told apart keeps
    copies from meeting in one shard. Numbers run within parts, and then over the parts of a key."""
    keys = ["key_a", "key_b"]
    hashed = rows.withColumn("key_a", F.xxhash64(*identity)).withColumn(
        "key_b", F.xxhash64(F.lit(1), *identity)
    )
    parts = hashed.groupBy(*keys, "_part").agg(F.count("*").alias("n"))
    several = parts.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 1")
    if several.isEmpty():
        return hashed.withColumn("copy", F.lit(0).cast("long"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    local = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("row"))
    numbered = hashed.withColumn("copy", local).join(starts, [*keys, "_part"])
    return numbered.withColumn("copy", F.col("copy") + F.col("start") - 1).drop("start")


def mix(
    docs: DataFrame,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    identity: Sequence[str] = ("doc_id", "source", "size"),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every row of ``docs`` (``doc_id,
    source, size``), with ``turns``, how often the whole document is taken, and ``parts``, the
    ranges of words (from 0, end excluded) taken once more.

    ``taken`` counts the words that the mix takes of a document, repeats counted; it is never above
    ``MOST_TIMES`` its size. Each source's taken words are its target, rounded to a word, short only of what
    the limit holds back. A null source is a source of its own; null ids and repeated rows are rows
    like any other, told apart by a number of their own. Shards and the order in them depend on the
    ``identity`` columns alone, not on files, partitions or cores, so every run takes the same.
    Documents without words are in no shard. Empty tables give an empty result.
    """
    columns = dict.fromkeys(["doc_id", "source", "size", *identity])
    numbers = {"row": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}
    rows = staged(docs.select(*columns).withColumns(numbers), "sizes")
    sources = staged(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources"
    )
    sources = sources.withColumn(
        "shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    )
    own = sources.withColumnRenamed("source", "name")
    known = rows.join(own, rows["source"].eqNullSafe(own["name"])).drop("name")
    keyed = _identified(rows.filter("size > 0").select("row", "_part", *identity), identity)
    content = ["key_a", "key_b", "copy"]
    shard = F.pmod(seeded(*content, seed=seed), F.col("shards"))
    # Steps that several later ones use are staged, so that no plan holds the steps before it again.
    placed = staged(
        known.join(keyed.select("row", *content), "row").select(
            "row", "rank", "size", shard.alias("shard"), *content
        ),
        "placed",
    )
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size"))

    # Blocks by source, then by shard.
    total = F.round(F.sum("target").over(Window.partitionBy("all")) / block).cast("long")
    seats = apportion(
        sources.select("rank", "target", F.col("rank").alias("party"), F.lit(0).alias("all")),
        ["all"],
        "target",
        total,
    ).select(
        "rank",
        F.col("quota").alias("source_quota"),
        F.round("target").cast("long").alias("words"),
    )
    dealt = apportion(
        shards.join(seats, "rank").withColumn("party", F.col("shard")),
        ["rank"],
        "shard_size",
        F.col("source_quota"),
    )
    # What the target has beyond or below whole blocks falls to the largest shard of the source.
    largest = Window.partitionBy("rank").orderBy(F.desc("shard_size"), "shard")
    beyond = F.when(
        F.row_number().over(largest) == 1, F.col("words") - F.col("source_quota") * block
    ).otherwise(0)
    wanted = F.greatest(
        F.least(F.col("quota") * block + F.col("beyond"), F.col("shard_size") * MOST_TIMES),
        F.lit(0),
    )
    # Whole turns of the line, then blocks of it, never more than MOST_TIMES.
    line = staged(
        dealt.withColumn("beyond", beyond)
        .withColumn("wanted", wanted)
        .filter("shard_size > 0")
        .select(
            "rank",
            "shard",
            "shard_size",
            F.floor(F.col("wanted") / F.col("shard_size")).alias("turns"),
            (F.col("wanted") % F.col("shard_size")).alias("rest"),
            F.ceil(F.col("shard_size") / block).alias("blocks"),
        ),
        "shards",
    )
    # Of the blocks of a line, those of least seeded hash until the rest is made up; the last one
    # is taken in part.
    each = line.filter("rest > 0").select(
        "rank",
        "shard",
        "rest",
        "shard_size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"),
    )
    length = F.least(F.lit(block), F.col("shard_size") - F.col("b") * block)
    drawn = Window.partitionBy("rank", "shard").orderBy(
        seeded("rank", "shard", "b", seed=seed), "b"
    )
    use = F.least("length", F.col("rest") - (F.col("sum") - F.col("length")))
    chosen = staged(
        each.withColumn("length", length)
        .withColumn("sum", F.sum("length").over(drawn))
        .withColumn("use", use)
        .filter("use > 0")
        .select("rank", "shard", "b", "use"),
        "blocks",
    )
    order = Window.partitionBy("rank", "shard").orderBy(
        seeded(*content, seed=seed + 1), *content
    )
    on_line = staged(
        placed.withColumn("start", F.sum("size").over(order) - F.col("size"))
        .drop(*content),
        "lines",
    )
    end = F.col("start") + F.col("size")
    spans = on_line.select(
        "row",
        "rank",
        "shard",
        "start",
        end.alias("end"),
        F.explode(
            F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
        ).alias("b"),
    )
    overlap = F.greatest(
        F.least("end", F.col("b") * block + F.col("use"))
        - F.greatest("start", F.col("b") * block),
        F.lit(0),
    )
    begin = F.greatest("start", F.col("b") * block) - F.col("start")
    parts = (
        spans.join(chosen, ["rank", "shard", "b"])
        .select("row", overlap.alias("part"), begin.alias("begin"))
        .filter("part > 0")
        .groupBy("row")
        .agg(
            F.sum("part").alias("part"),
            F.array_sort(
                F.collect_list(
                    F.struct(F.col("begin").alias("start"), (F.col("begin") + F.col("part")).alias("end"))
                )
            ).alias("parts"),
        )
    )
    turns = on_line.join(line.select("rank", "shard", "turns"), ["rank", "shard"]).select(
        "row", "turns"
    )
    taken = F.coalesce(F.col("turns") * F.col("size"), F.lit(0)) + F.coalesce("part", F.lit(0))
    return (
        known.join(turns, "row", "left")
        .join(parts, "row", "left")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            taken.cast("long").alias("taken"),
            F.coalesce("turns", F.lit(0)).cast("long").alias("turns"),
            "parts",
        )
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_words(text: str, parts: list[dict]) -> str:
    """The ranges of words of a text, as written, one line for each range that does not touch the
    one before."""
    joined: list[list[int]] = []
    for p in parts:
        if joined and joined[-1][1] == p["start"]:
            joined[-1][1] = p["end"]
        else:
            joined.append([p["start"], p["end"]])
    places = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[places[a][0] : places[b - 1][1]] for a, b in joined)


def taken_texts(rows: DataFrame) -> DataFrame:
    """The rows as often as the mix takes them: ``turns`` times as they are, and once more cut to
    ``parts``, where there are any. Columns other than ``turns`` and ``parts`` are kept."""
    whole = rows.filter("turns > 0").withColumn(
        "_turn", F.explode(F.array_repeat(F.lit(0), F.col("turns").cast("int")))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [
                cut_words(t or "", p)
                for t, p in zip(
                    batch.column("text").to_pylist(), batch.column("parts").to_pylist(), strict=True
                )
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, pa.string()))

    some = rows.filter(F.col("parts").isNotNull())
    return (
        whole.drop("_turn").unionByName(some.mapInArrow(cut, rows.schema)).drop("turns", "parts")
    )
