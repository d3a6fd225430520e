"""Payloads whose fields change: read as variants, so that no key and no line is lost.

A declared reading has a type for each field it knows. Where a source sends another type, that one
field is converted if it can be and null if not, and the rest of the payload stays; keys that are not
declared stay too. ``files.read_payloads`` is for sources that keep to their schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from .files import CORRUPT

PAYLOAD = "_payload"


def _at(name: str) -> str:
    """The path of a key of any spelling."""
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def keys_of(payload: Column) -> Column:
    """The keys of an object in order; null for what is no object."""
    return F.array_sort(F.map_keys(F.try_variant_get(payload, "$", "map<string, variant>")))


def as_declared(value: Column, kind: DataType) -> Column:
    """A variant as a declared type. A value that does not convert is null, and so is a struct where
    there is no object, or an array where there is no array; their neighbours stay. Text takes
    anything: objects and arrays as their JSON."""
    if isinstance(kind, StructType):
        fields = [
            as_declared(F.try_variant_get(value, _at(f.name), "variant"), f.dataType).alias(f.name)
            for f in kind
        ]
        return F.when(keys_of(value).isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        return F.transform(items, lambda item: as_declared(item, kind.elementType))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        text = F.try_variant_get(value, "$", "string")
        return text.try_cast(kind)
    return F.try_variant_get(value, "$", kind.simpleString())


def undeclared(payload: Column, schema: str | StructType, spark: SparkSession) -> Column:
    """The keys of a payload's top level that ``schema`` does not name, in order."""
    return F.array_except(keys_of(payload), F.array(*map(F.lit, _struct(spark, schema).names)))


def _struct(spark: SparkSession, schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema


def open_payloads(lines: DataFrame, line: str, schema: str | StructType) -> DataFrame:
    """JSON texts, one payload each, as the columns of ``schema``, with the whole payload as a variant
    in ``_payload`` and, of texts that are no JSON object, the text in ``_corrupt_record``.

    Other columns of ``lines`` pass, but for those that the schema names. Null and blank texts are
    left out. A text that names a key twice in one object is no JSON here. Keys are matched by case.
    """
    declared = _struct(lines.sparkSession, schema)
    taken = {n.lower() for n in (*declared.names, PAYLOAD, CORRUPT, line)}
    others = [c for c in lines.columns if c.lower() not in taken]
    read = lines.filter(F.trim(line) != "").select(
        *others, F.col(line).alias("_line"), F.try_parse_json(line).alias(PAYLOAD)
    )
    whole = keys_of(F.col(PAYLOAD)).isNotNull()
    fields = [
        as_declared(F.try_variant_get(PAYLOAD, _at(f.name), "variant"), f.dataType).alias(f.name)
        for f in declared
    ]
    return read.select(
        *others,
        *fields,
        F.when(whole, F.col(PAYLOAD)).alias(PAYLOAD),
        F.when(~whole, F.col("_line")).alias(CORRUPT),
    )


def read_open_payloads(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Landed JSON payloads, one per line, see ``open_payloads``."""
    return open_payloads(spark.read.text(path), "value", schema)
