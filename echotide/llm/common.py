"""What several operators share: staged tables and word hashes of whole texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that a task holds arrays of at once: some 50 bytes for each of these.
SLICE_BYTES = 1_000_000
_ODD = 0x9E3779B97F4A7C15
_POWER = 0xD6E8FEB86659FD93


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets a fresh folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="echotide-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later steps neither
    recompute it nor depend on the executors that made it. The copy lies under
    ``spark.checkpoint.dir`` until that folder is emptied, as the result is read from it."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str = "rows") -> DataFrame:
    """``docs`` with a unique long ``row``: ``doc_id`` itself where it is unique and never null, and
    else a number of its own, fixed by writing the rows once."""
    ids = docs.select(F.col("doc_id").cast("long").alias("row"))
    doubtful = ids.groupBy("row").agg(F.count("*").alias("n")).filter("n > 1 or row is null")
    if doubtful.isEmpty():
        return docs.withColumn("row", F.col("doc_id").cast("long"))
    return staged(docs.withColumn("row", F.monotonically_increasing_id()), name)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice hold about ``size`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.asarray(
            pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64
        )
        part = (np.cumsum(lengths) - lengths) // size
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``mix`` made ``x`` of."""
    inverse = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    x = x ^ (x >> np.uint64(32))
    x = x * inverse
    x = x ^ (x >> np.uint64(32))
    x = x * inverse
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse. Those for one slice are kept; longer
    ones are made for the one text that needs them."""

    def __init__(self):
        self.kept = None

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(_POWER, -1, 1 << 64)
        if n > 2 * SLICE_BYTES:
            return _powers(_POWER, n), _powers(inverse, n)
        if self.kept is None or len(self.kept[0]) < n:
            size = max(n, SLICE_BYTES + SLICE_BYTES // 8)
            self.kept = _powers(_POWER, size), _powers(inverse, size)
        return self.kept[0][:n], self.kept[1][:n]


POWERS = Powers()
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For bytes, sums whose differences identify any stretch: the hash of ``[s, e)`` is
    ``(sums[e] - sums[s]) * down[s]``."""
    up, down = POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return sums, down


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _word_end(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on with a byte that ends a word, or the end."""
    while at < len(data):
        found = np.flatnonzero(SPACE[data[at : at + 4096]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than space and 0x09-0x0D) of all texts.

    Returns a 64-bit hash per word, word starts and ends in the joined bytes, and for each text
    the index of its first word, with the total at the end. Arrays of a number per byte are made
    for stretches of ``SLICE_BYTES``, whatever the length of a text."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    parts, at = [], 0
    while at < len(data) or not parts:
        end = _word_end(data, at + SLICE_BYTES)
        part = data[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~SPACE[part]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums, down = prefix_hashes(part)
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        parts.append((hashes, starts + at, ends + at))
        at = max(end, at + 1)
    hashes, starts, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.r_[0, np.cumsum(lengths)]
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words, by its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_POWER) + hashes[k : k + n]
    return mix(out)
