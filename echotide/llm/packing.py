"""Documents packed into token sequences of fixed capacity, with a certificate per partition.

Token ids are made once, next to the data; only piece lengths move. Pieces are dealt evenly over
partitions of bounded size and packed by best fit in decreasing order. Dual feasible functions
give a lower bound on the sequences any packing of a partition needs. A partition that meets its
bound is final. Those with a gap hand the pieces of their unfilled sequences to a common pool,
which is dealt anew over fewer partitions and packed again; a round counts only if it saves
sequences. Everything is a bounded group per task, whatever the number of documents.
"""

from __future__ import annotations

import base64
import math
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged

CAPACITY = 2048
PIECES_PER_PART = 60_000
ROUNDS = 4

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "row long, bin long, offset long, fill long, bins long, bound long"

class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    The rank table of the same byte-level vocabulary gives the tokenizer's ids several times faster;
    texts that name a special token go through the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        ).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        ids = array("I", ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of ``n`` ids; the first takes the remainder."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, each closed by id 0.

    ``docs`` has ``doc_id`` and ``text``; a null text is an empty one, so it is the id 0 alone.
    Null or repeated ids are kept row by row.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, ranks, pattern)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                ids = encode(text or "") + b"\0\0\0\0"
                for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length: longest first, each into the fullest bin that takes it."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            b, left, made = made, capacity, made + 1
        bins[i], offsets[i] = b, capacity - left
        left -= n
        if not room[left]:
            open_rooms |= 1 << left
        room[left].append(b)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, steps: int = 32) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions.

    A threshold t counts lengths above ``capacity - t`` as whole bins and drops those below t. A
    step k rounds ``(k + 1) x / capacity`` down to k-ths, unless it is whole.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    number, volume = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * sizes)]
    t = np.arange(0, capacity // 2 + 1)
    large = (number[-1] - number[capacity - t + 1]) * capacity
    middle = volume[capacity - t + 1] - volume[t]
    best = int(np.max(-(-(large + middle) // capacity)))
    for k in range(1, steps + 1):
        whole = (sizes * (k + 1)) % capacity == 0
        # Over capacity * k, so that both cases stay whole numbers.
        value = np.where(whole, sizes * k, (sizes * (k + 1)) // capacity * capacity)
        best = max(best, -(-int(np.dot(count, value)) // (capacity * k)))
    return best


def _pack_part(part: pd.DataFrame, capacity: int) -> pd.DataFrame:
    lengths = part["length"].to_numpy(np.int64)
    bins, offsets = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    return pd.DataFrame(
        {
            "row": part["row"].to_numpy(),
            "bin": bins,
            "offset": offsets,
            "fill": fill[bins],
            "bins": len(fill),
            "bound": lower_bound(lengths, capacity),
        }
    )


def _deal(pieces: DataFrame, n: int, turn: int, per_part: int, capacity: int) -> DataFrame:
    """The pieces packed in parts of about ``per_part``; sequences get numbers of this turn."""
    parts = max(1, math.ceil(n / per_part))
    dealt = pieces.select(
        "row", "length", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(parts)).alias("part")
    )
    packed = dealt.groupBy("part").applyInPandas(
        lambda key, part: _pack_part(part, capacity).assign(part=key[0]), PACKED + ", part long"
    )
    number = F.col("part") * F.lit(1 << 24) + F.col("bin") + F.lit(turn << 56)
    return packed.select(
        "row", number.alias("sequence_id"), "offset", "fill", "bins", "bound", "part"
    )


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    per_part: int = PIECES_PER_PART,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every row of ``pieces`` (with ``length``) with its ``sequence_id`` and ``offset``.

    Lengths lie between 1 and ``capacity``. An empty table gives an empty result. Rows are told
    apart by a number of their own, so repeated rows are all placed. ``per_part`` bounds what one
    task packs. ``certified`` says that the part a row was packed in met its lower bound.
    """
    table = staged(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = table.count()
    placed = staged(_deal(table, total, 0, per_part, capacity), "packed")
    settled, gap = [], placed
    for turn in range(1, rounds + 1):
        # What is full stays; the rest of the parts above their bound goes to the pool.
        free = (F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)
        pool = gap.filter(free)
        n, used = pool.agg(F.count("*"), F.countDistinct("sequence_id")).first()
        if not n:
            break
        again = staged(
            _deal(table.join(pool.select("row"), "row"), n, turn, per_part, capacity), "packed"
        )
        saved = used - again.agg(F.countDistinct("sequence_id")).first()[0]
        if saved <= 0:
            break
        settled.append(gap.filter(~free))
        gap = again
    for done in settled:
        gap = gap.unionByName(done)
    return table.join(
        gap.select(
            "row", "sequence_id", "offset", (F.col("bins") <= F.col("bound")).alias("certified")
        ),
        "row",
    ).drop("row")
