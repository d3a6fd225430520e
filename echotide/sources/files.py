"""Reading the flat table and landed payloads, and stacking sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.dates import parse_dmy
from ..functions.numbers import star_rating
from ..functions.text import first_present, trim_all
from ..operators.enrich import canonical_platform, product_tag
from ..schemas import FLAT_FILE_COLUMNS, REVIEWS_BASE

CORRUPT = "_corrupt_record"


def read_reviews_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The raw flat table: the first row names the columns, every column gets its type.

    Rows that do not fit the header are kept, with their text in ``_corrupt_record``. Quoted
    line breaks need ``multiline``, which reads each file in one task.
    """
    names = [name for name, _, _ in FLAT_FILE_COLUMNS]
    schema = StructType([StructField(n, StringType()) for n in (*names, CORRUPT)])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return enforce_types(raw)


def enforce_types(raw: DataFrame) -> DataFrame:
    """Lock each column of the flat table to its type: ids as text, dates as dates, metrics as
    numbers. A text that does not read as its type becomes null. Other columns pass."""
    typed = []
    for name, canonical, kind in FLAT_FILE_COLUMNS:
        if name not in raw.columns:
            continue
        text = F.col(name)
        if kind == "date":
            value = parse_dmy(trim_all(text))
        elif kind == "string":
            value = text.cast("string")
        else:
            value = trim_all(text).try_cast(kind)
        typed.append(value.alias(canonical))
    known = {name for name, _, _ in FLAT_FILE_COLUMNS}
    return raw.select(*typed, *[c for c in raw.columns if c not in known])


def read_payloads(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Landed JSON payloads of one source, one per line, under a declared schema.

    A line that is no JSON, or holds a field of another type, keeps its text in
    ``_corrupt_record``, next to the fields that could be read: see ``corrupt_lines``.
    """
    declared = spark.createDataFrame([], schema).schema
    if CORRUPT not in declared.names:
        declared = StructType([*declared.fields, StructField(CORRUPT, StringType())])
    return spark.read.schema(declared).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def corrupt_lines(payloads: DataFrame) -> DataFrame:
    """The lines of ``read_payloads`` or ``read_reviews_csv`` that did not read as declared."""
    return payloads.filter(F.col(CORRUPT).isNotNull())


def union_sources(*dfs: DataFrame) -> DataFrame:
    """All sources in one table; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def reviews_base(*sources: DataFrame) -> DataFrame:
    """All collected sources as one table of the row type ``REVIEWS_BASE``: dates and stars typed,
    platform names canonical, and the product of rows that carry none read off text and link."""
    typed = type_collected(union_sources(*sources))
    product = F.coalesce("product_tag", product_tag(F.col("text"), F.col("url")))
    filled = typed.withColumn("product_tag", product)
    declared = filled.sparkSession.createDataFrame([], REVIEWS_BASE).schema
    none = F.lit(None)
    return filled.select(
        *(
            (F.col(f.name) if f.name in filled.columns else none).cast(f.dataType).alias(f.name)
            for f in declared.fields
        )
    )


def thread_first(threads: DataFrame, page_comments: DataFrame) -> DataFrame:
    """Comments of article threads, and those read off the page for articles whose thread yields
    none."""
    return fallback_union(threads, page_comments, "url")


def fallback_union(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """Rows of ``primary``, and rows of ``secondary`` for keys that ``primary`` lacks."""
    missing = secondary.join(primary.select(key), key, "left_anti")
    return primary.unionByName(missing, allowMissingColumns=True)


def type_collected(df: DataFrame) -> DataFrame:
    """Collected rows with canonical platform names, a date, and a star rating."""
    platform = canonical_platform(F.col("platform"))
    return (
        df.withColumn("platform", platform)
        .withColumn("review_date", parse_dmy(F.col("date")))
        .withColumn("star_rating", star_rating(F.col("score_raw"), F.col("platform")))
        .withColumn("text", first_present(F.col("text")))
        .drop("date")
    )
