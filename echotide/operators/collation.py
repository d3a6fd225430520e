"""Texts that are equal whatever their case, as ids and categories of the reports are.

A collated column carries the rule with it: joins, groups, distinct counts, filters and order all
ignore case, with no lower-cased copy of a column to keep next to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

IGNORING, EXACT = "UTF8_LCASE", "UTF8_BINARY"


def ignoring_case(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with text ``columns``, all of them if none is named, equal in any case. Values keep their
    spelling, nulls stay."""
    return _collated(df, IGNORING, columns)


def exact_case(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with text ``columns`` compared letter by letter again, as files and unions need it."""
    return _collated(df, EXACT, columns)


def _collated(df: DataFrame, rule: str, columns: Sequence[str]) -> DataFrame:
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    unknown = set(columns) - set(texts)
    if unknown:
        raise ValueError(f"no text columns: {sorted(unknown)}")
    chosen = columns or texts
    return df.withColumns({c: F.collate(F.col(c), rule) for c in chosen})


def model_ignoring_case(
    tables: Mapping[str, DataFrame], *columns: str
) -> dict[str, DataFrame]:
    """Tables of a model with the same rule on every one of ``columns`` that a table has, so that they
    still join with each other."""
    return {
        name: ignoring_case(df, *here) if (here := [c for c in columns if c in df.columns]) else df
        for name, df in tables.items()
    }


def first_spelling(df: DataFrame, column: str) -> DataFrame:
    """Rows with one spelling per value: the smallest by letters among those that differ in case
    only. Case decides nothing else, so measures by the column stay the same."""
    folded = f"_{column}"
    spellings = (
        exact_case(df, column)
        .groupBy(F.collate(F.col(column), IGNORING).alias(folded))
        .agg(F.min(column).alias("_spelling"))
    )
    joined = df.join(
        spellings, F.collate(F.col(column), IGNORING).eqNullSafe(F.col(folded))
    )
    return joined.withColumn(column, F.col("_spelling")).select(*df.columns)
