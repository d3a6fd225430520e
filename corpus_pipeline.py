"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes the columns of ``documents`` and, but for the last, returns them. Rows stand for
themselves: null or repeated ids, null texts and empty tables pass through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echotide.llm import lines, minhash, mixing, packing, quality
from echotide.llm.common import numbered, staged
from echotide.llm.queries import public_vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor meet a learned one."""
    docs = docs.select(*COLUMNS)
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(quality.statistics(docs, COLUMNS), rules).filter("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are near copies of earlier ones. One of which no line is
    left stays, with an empty text."""
    cleaned = lines.dedup_lines(docs.select(*COLUMNS))
    n_chars = F.when(
        F.col("n_copies") + F.col("n_near") > 0, F.char_length("text").cast("long")
    ).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the least id. Repeated rows are
    copies as well."""
    rows = numbered(docs.select(*COLUMNS), "near")
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    kept = found.filter("kept").select(F.col("doc_id").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last time cut to the words it takes."""
    rows = numbered(docs.select(*COLUMNS), "mix")
    sizes = rows.select(
        F.col("row").alias("doc_id"),
        F.col("doc_id").alias("id"),
        "source",
        mixing.words().alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )
    taken = mixing.mix(sizes, identity=("id", "source", "size", "text_hash")).select(F.col("doc_id").alias("row"), "turns", "parts")
    # Read twice: for whole documents and for the cut ones.
    taken = staged(taken.filter("turns > 0 or parts is not null"), "taken")
    chosen = mixing.taken_texts(rows.join(taken, "row"))
    n_chars = F.char_length("text").cast("long")
    return chosen.withColumn("n_chars", n_chars).select(*COLUMNS)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens, with their sequence and their place in it."""
    return packing.pack(packing.token_pieces(docs, *public_vocabulary()))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("token_packing", token_packing),
]

#: Learned rules, seeded blocks and packing have no equal in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
