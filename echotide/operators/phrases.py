"""Substring search of many phrases at once, in place.

One automaton finds all phrases in a single pass over a text, so a text is never moved, repeated or
paired with phrases it does not hold. Phrases reach the tasks in blocks of a bounded number of
characters, cut by a hash; a table of any size is a number of such blocks, and the result is the
same for any cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BLOCK_CHARACTERS = 4_000_000
MOST_BUILT = 32
#: Texts that a task holds as Python strings at once.
SLICE_BYTES = 1_000_000
_BUILT: dict[int, tuple] = {}


def blocks_of(phrases: DataFrame, phrase: str) -> list[list[dict]]:
    """The distinct rows with a non-empty lower-cased ``_phrase``, in blocks of about
    ``BLOCK_CHARACTERS``; Spark sums the lengths first, so no more than one block is asked for at a
    time."""
    rows = phrases.withColumn("_phrase", F.lower(phrase)).filter("_phrase != ''").distinct()
    total = rows.agg(F.sum(F.char_length("_phrase"))).first()[0] or 0
    n = math.ceil(total / BLOCK_CHARACTERS)
    part = F.pmod(F.xxhash64("_phrase"), F.lit(max(n, 1)))
    blocks = ([r.asDict() for r in rows.filter(part == b).collect()] for b in range(n))
    return [block for block in blocks if block]


def slices(texts: pa.Array) -> Iterator[list]:
    """The texts of a batch in lists of about ``SLICE_BYTES``: the batch itself stays in Arrow, and
    its size is the session's choice."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    part = (np.cumsum(lengths) - lengths) // SLICE_BYTES
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
    for a, b in zip(starts, np.r_[starts[1:], len(texts)], strict=False):
        yield texts.slice(a, b - a).to_pylist()


def joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """The results of the slices of a batch, of which there may be none."""
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _automaton(block: list):
    """The automaton of a block, built once in each worker. The block is kept with it, so that its
    identity stays its own."""
    if id(block) not in _BUILT:
        import ahocorasick

        found: dict[str, list[tuple]] = {}
        for phrase, row in block:
            found.setdefault(phrase, []).append(row)
        built = ahocorasick.Automaton()
        for phrase, rows in found.items():
            built.add_word(phrase, tuple(rows))
        built.make_automaton()
        if len(_BUILT) >= MOST_BUILT:
            _BUILT.clear()
        _BUILT[id(block)] = block, built
    return _BUILT[id(block)][1]


def _search(shared, columns: list[str], result: T.ArrayType):
    """The rows of one block that each text of a batch holds."""

    kind = to_arrow_type(result)

    @F.arrow_udf(result)
    def search(texts: pa.Array) -> pa.Array:
        automaton = _automaton(shared.value)

        def of(text: str | None) -> list[dict]:
            rows = {r for _, found in automaton.iter(text) for r in found} if text else ()
            return [dict(zip(columns, r, strict=True)) for r in rows]

        return joined([pa.array([of(t) for t in part], kind) for part in slices(texts)], kind)

    return search


def finder(
    phrases: DataFrame, phrase: str, columns: list[str], kind: T.StructType
) -> Callable[[Column], Column]:
    """A function from a text to the sorted array of the distinct ``columns`` of those phrases that
    it holds, case ignored. A null text holds none."""
    context = phrases.sparkSession.sparkContext
    result = T.ArrayType(kind)
    searches = [
        _search(
            context.broadcast([(r["_phrase"], tuple(r[c] for c in columns)) for r in block]),
            columns,
            result,
        )
        for block in blocks_of(phrases, phrase)
    ]
    none = F.array().cast(result)

    def find(text: Column) -> Column:
        found = [s(F.lower(text)) for s in searches]
        return F.array_sort(F.array_distinct(F.concat(*found))) if found else none

    return find
