"""Bytes of passages that occur more than once, found by a sparse suffix array.

Suffixes are taken at anchors only: the least hashed position of every ``WINDOW`` consecutive ones.
Which position that is depends on nothing but the bytes of that window, so two copies of a
``LENGTH``-byte string have their anchor at the same place in it. All strings with one anchor share
the bytes from the anchor on, less ``WINDOW``: these form the leading tokens of the suffix.

Suffixes are range-partitioned by their leading tokens along sampled splitters (with the place as
last key, so a token held by very many suffixes is split over several buckets). A bucket sorts
locally by multikey quicksort and compares neighbours; first and last suffix of every bucket are
compared across boundaries. An anchor whose whole surroundings recur has all its strings repeated.
Where surroundings differ, near the ends of a repeated passage, each string that starts there is
sorted and compared in the same way, so the result is exact to the byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, numbered, prefix_hashes, slices, staged

LENGTH = 400
WINDOW = 96
GRAM = 8
SMALL = 2048
SUFFIX = "t1 long, t2 long, around long, doc_id long, low long, high long"


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes one after the other, and starts and ends of the texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    return data, ends - lengths, ends


def anchors(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last string start it serves, and text number, over joined bytes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none
    grams = np.ndarray((n - GRAM + 1,), "<u8", data.tobytes(), strides=(1,))
    value = mix(grams) >> np.uint64(32) << np.uint64(32)
    value |= np.arange(len(value), dtype=np.uint64)  # ties go to the first
    # Least of each window by doubling: after each step `value[p]` covers `wide` positions.
    wide = 1
    while wide < window:
        step = min(wide, window - wide)
        value = np.minimum(value[:-step], value[step:])
        wide += step
    valid = ends - length + 1 - starts > 0
    first, last, text = starts[valid], ends[valid] - length, np.flatnonzero(valid)
    counts = last - first + 1
    at = np.repeat(first - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    chosen = (value[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(text, counts)
    new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])])
    end = np.r_[new[1:], len(at)] - 1 if len(at) else none
    return chosen[new], at[new], at[end], text[new]


def _suffix_rows(
    texts: list[bytes], ids: np.ndarray, length: int, window: int
) -> pd.DataFrame:
    data, starts, ends = _joined(texts)
    anchor, low, high, text = anchors(data, starts, ends, length, window)
    sums, down = prefix_hashes(data)

    def stretch(a, b):
        return mix((sums[b] - sums[a]) * down[a])

    core = length - window + 1
    half = core // 2
    around = stretch(low, high + length)
    around = mix(around ^ ((anchor - low) << 32 | (high - low)).astype(np.uint64))
    return pd.DataFrame(
        {
            "t1": stretch(anchor, anchor + half).view(np.int64),
            "t2": stretch(anchor + half, anchor + core).view(np.int64),
            "around": around.view(np.int64),
            "doc_id": ids[text],
            "low": low - starts[text],
            "high": high - starts[text],
        }
    )


def _encoded(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def multikey_quicksort(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several tokens: parted in three by a pivot of one token, the middle
    part moving on to the next token. Small parts are sorted at once."""
    order = np.arange(len(keys[0]))
    todo = [(0, len(order), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < 2 or depth == len(keys):
            continue
        rows = order[a:b]
        if b - a <= SMALL:
            order[a:b] = rows[np.lexsort([k[rows] for k in reversed(keys[depth:])])]
            continue
        token = keys[depth][rows]
        pivot = np.sort(token[[0, len(token) // 4, len(token) // 2, -len(token) // 4, -1]])[2]
        less, more = token < pivot, token > pivot
        same = ~(less | more)
        order[a:b] = np.concatenate([rows[less], rows[same], rows[more]])
        i, j = a + int(less.sum()), b - int(more.sum())
        todo += [(a, i, depth), (i, j, depth + 1), (j, b, depth)]
    return order


def _neighbours(keys: list[np.ndarray]) -> np.ndarray:
    """How many leading tokens each sorted row shares with the next one; 0 after the last."""
    shared = np.zeros(len(keys[0]), np.int64)
    same = np.ones(max(len(shared) - 1, 0), bool)
    for k in keys:
        same = same & (k[1:] == k[:-1])
        shared[:-1] += same
    return shared


def _bucket(part: pd.DataFrame, leading: int, tokens: list[str]) -> pd.DataFrame:
    """The rows of a bucket that share ``leading`` tokens or more with a neighbour, and the first
    and last run, whose neighbours may lie in other buckets.

    ``most`` is the number of tokens shared with the nearer neighbour. ``mixed`` marks one row of
    each set of equal rows in a run of equal leading tokens that holds several such sets."""
    keys = [part[t].to_numpy() for t in tokens]
    order = multikey_quicksort(keys)
    part, keys = part.iloc[order], [k[order] for k in keys]
    after = _neighbours(keys)
    before = np.r_[0, after[:-1]]
    most = np.maximum(before, after)
    run = np.cumsum(before < leading)
    edge = (run == run[0]) | (run == run[-1])
    place = np.zeros(len(part), np.int64)  # 1: first row of the bucket, 2: last, 3: both
    place[0] += 1
    place[-1] += 2
    first = before < len(tokens)
    several = np.bincount(run, weights=first)[run] > 1
    out = part.assign(most=most, mixed=first & (several | edge), place=place)
    return out[(most >= leading) | edge]


def _compared(rows: DataFrame, columns: str, leading: int, tokens: list[str], name: str) -> DataFrame:
    """``rows`` of all buckets that recur; ``most`` counts shared tokens, across boundaries too."""
    dealt = rows.repartitionByRange(*tokens, "doc_id", "low")

    def sort(batches):
        parts = [b for b in batches if len(b)]
        if parts:
            yield _bucket(pd.concat(parts), leading, tokens)

    found = staged(
        dealt.mapInPandas(sort, columns + ", most long, mixed boolean, place long").withColumn(
            "bucket", F.spark_partition_id()
        ),
        name,
    )
    # At most two rows of each bucket.
    edges = found.filter("place > 0").select("bucket", "place", "most", *tokens, "doc_id", "low")
    edges = sorted(edges.collect(), key=lambda r: (r["bucket"], r["place"] == 2))
    raised = []
    for a, b in zip(edges, edges[1:], strict=False):
        if a["bucket"] != b["bucket"]:
            shared = 0
            while shared < len(tokens) and a[tokens[shared]] == b[tokens[shared]]:
                shared += 1
            raised += [(r["doc_id"], r["low"], shared) for r in (a, b) if shared > r["most"]]
    if raised:
        higher = found.sparkSession.createDataFrame(raised, "doc_id long, low long, higher long")
        higher = higher.groupBy("doc_id", "low").agg(F.max("higher").alias("higher"))
        found = found.join(F.broadcast(higher), ["doc_id", "low"], "left").withColumn(
            "most", F.greatest("most", F.coalesce("higher", F.lit(0)))
        )
    return found


def repeated_starts(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """``row, low, high``: ranges of starts of strings of ``length`` bytes that start at another
    place as well. ``docs`` has a unique ``row`` and ``text``; matches stay within texts."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("row").to_numpy()
            out = _suffix_rows(_encoded(batch.column("text")), ids, length, window)
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    rows = docs.select("row", "text").mapInArrow(suffixes, SUFFIX)
    found = _compared(rows, SUFFIX, 2, ["t1", "t2", "around"], "suffixes")
    whole = found.filter("most = 3").select(F.col("doc_id").alias("row"), "low", "high")
    mixed = (
        found.filter("mixed")
        .groupBy(F.col("doc_id").alias("row"))
        .agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    )

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row, text, ranges in zip(
                batch.column("row").to_pylist(),
                _encoded(batch.column("text")),
                batch.column("ranges").to_pylist(),
                strict=True,
            ):
                sums, down = prefix_hashes(np.frombuffer(text, np.uint8))
                at = np.concatenate([np.arange(r["low"], r["high"] + 1) for r in ranges])
                whole = (sums[at + length] - sums[at]) * down[at]
                half = (sums[at + length // 2] - sums[at]) * down[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mix(whole).view(np.int64)),
                        pa.array(mix(half ^ np.uint64(1)).view(np.int64)),
                        pa.array(np.full(len(at), row, np.int64)),
                        pa.array(at),
                    ],
                    ["t1", "t2", "doc_id", "low"],
                )

    border = docs.join(mixed, "row").mapInArrow(
        strings, "t1 long, t2 long, doc_id long, low long"
    )
    alone = _compared(
        border, "t1 long, t2 long, doc_id long, low long", 2, ["t1", "t2"], "strings"
    ).filter("most = 2")
    return whole.unionByName(
        alone.select(F.col("doc_id").alias("row"), "low", F.col("low").alias("high"))
    )


def merge(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in the ranges cover."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + length)
        else:
            out.append([low, high + length])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """Every row's ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Texts are UTF-8 bytes, a null text is empty. Each byte covered by a ``length``-byte string that
    starts at another place too, in this text or another, is removed; strings are judged on the
    input. Rows count one by one, also with null or repeated ids. An empty table gives an empty
    one.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("long"), "text"), "texts")
    found = repeated_starts(rows, length, window).groupBy("row").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, ranges in zip(
                _encoded(batch.column("text")), batch.column("ranges").to_pylist(), strict=True
            ):
                spans = merge([(r["low"], r["high"]) for r in ranges or ()], length)
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                removed = sum(b - a for a, b in spans)
                out.append((len(text), removed, len(spans), kept.hexdigest(), spans))
            n, removed, count, kept, spans = map(list, zip(*out, strict=True))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(kept),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return rows.join(found, "row", "left").mapInArrow(
        digest,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
        " spans array<struct<start long, end long>>",
    )
