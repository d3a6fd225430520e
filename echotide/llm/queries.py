"""The queries of this folder on the given tables, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    chat,
    collocations,
    decontaminate,
    language,
    lines,
    minhash,
    mixing,
    packing,
    quality,
    suffixes,
    toxicity,
    trie,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def public_vocabulary() -> tuple[str, str, str]:
    """Tokenizer file, rank file and split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir), *public_vocabulary())
    return packing.pack(pieces)


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def fold(parts: int):
    """The remainder that splits learning from held-out rows."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def held_out(parts: int, rest: int):
    """Whether a row is of the fold that nothing is learned from; a row without an id is of none."""
    return F.coalesce(fold(parts) == rest, F.lit(False)).alias("held_out")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    filters = language.fit(docs.filter(fold(4) != 2))
    out = language.predict(docs, filters)
    return out.select("doc_id", held_out(4, 2), "lang_pred", "score")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(quality.statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "rule", "kept",
    )


@query
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


@query
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).drop("spans")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold(5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.withColumn("held_out", held_out(5, 0))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = documents(spark, sf_dir).select("doc_id", "source", mixing.words().alias("size"))
    return mixing.mix(sizes)


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLES["op1_chat_formatting"] = chat.SQL


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_lines", "n_copies", "n_near", F.sha2("text", 256).alias("text_sha256")
    )


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, sf_dir), items)


ORACLES["op11_decontamination"] = decontaminate.SQL


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


ORACLES["op13_collocations"] = collocations.SQL


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLES["op12_prefix_trie"] = trie.SQL
