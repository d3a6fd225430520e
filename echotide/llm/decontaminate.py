"""Passages of test items in documents: one Aho-Corasick automaton, each text scanned once.

Words are runs of digits, letters ``a-z`` (``A-Z`` folded) and characters beyond ASCII. The patterns
are windows of ``WINDOW`` consecutive words of an item; an item of fewer words is one window. Every
word of the items has a code, so that a pattern is a string of at most ``WINDOW`` codes and a text
a string of one code per word; all codes of a text go through the automaton in one scan. Only
where something was found are words traced back to their characters in the original text.

The automaton goes to the tasks as the items' words, ``BLOCK_BYTES`` of them at most. A larger set of
items is cut into blocks, each with an automaton and a scan of its own; hits of blocks are joined by
row, and only rows with hits move.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, slices, staged

WINDOW = 10
BLOCK_BYTES = 500_000
PIECE_WORDS = 4_096
STRETCH = 1 << 20
UNKNOWN = "\x01"

#: Bytes that belong to words, ``A-Z`` folded; every other byte becomes a space.
WORD_BYTES = bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
FOLD = bytearray(b" " * 256)
for _b in WORD_BYTES:
    FOLD[_b] = _b
for _b in range(0x41, 0x5B):
    FOLD[_b] = _b + 32
FOLD = bytes(FOLD)

HITS = (
    "row long, doc_id long, n_words long, runs array<struct<first:long,last:long,start:long,"
    "end:long>>, items array<string>"
)
RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))


def stretches(folded: bytes, size: int = STRETCH) -> Iterator[tuple[int, bytes]]:
    """The folded text in parts that end between words, each with its first byte."""
    at = 0
    while at < len(folded):
        end = at + size
        if end < len(folded):
            end = folded.find(b" ", end)
            end = len(folded) if end < 0 else end
        yield at, folded[at:end]
        at = end


def _binary(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def pieces(items: DataFrame) -> DataFrame:
    """``item, words, n_bytes``: folded words of items, joined by spaces. Very long items come in
    parts of ``PIECE_WORDS`` words that overlap by all but one word of a window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            ids = batch.column("item").to_pylist()
            for item, text in zip(ids, _binary(batch.column("text")), strict=True):
                words = text.translate(FOLD).split()
                for a in range(0, max(len(words) - WINDOW + 1, min(len(words), 1)), PIECE_WORDS):
                    part = b" ".join(words[a : a + PIECE_WORDS + WINDOW - 1])
                    out.append((item, part, len(part) + len(item or "")))
            if out:
                item, words, size = map(list, zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.string()), pa.array(words, pa.binary()), pa.array(size)],
                    ["item", "words", "n_bytes"],
                )

    named = items.select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(cut, "item string, words binary, n_bytes long")


def blocks_of(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Blocks of pieces, each of about ``block_bytes`` and at most twice that, or of one piece."""
    cut = staged(pieces(items), "items")
    total = cut.agg(F.sum("n_bytes"), F.count("*")).first()
    n = -(-(total[0] or 0) // block_bytes)
    while n:
        blocked = cut.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n)))
        most = blocked.groupBy("block").agg(F.sum("n_bytes").alias("size")).agg(F.max("size"))
        if n == 1 or n >= 4 * total[1] or most.first()[0] <= 2 * block_bytes:
            break
        n *= 2
    for k in range(n):
        rows = blocked.filter(F.col("block") == k).select("item", "words").distinct().collect()
        if rows:
            yield [(r["item"], bytes(r["words"])) for r in rows]


class Finder:
    """The automaton of a block, and the items of each of its windows."""

    def __init__(self, block: list[tuple[str | None, bytes]]):
        self.codes: dict[bytes, str] = {}
        self.names = sorted({item for item, _ in block if item is not None})
        rank = {name: k for k, name in enumerate(self.names)}
        held: dict[str, set[int]] = {}
        for item, words in block:
            codes = "".join(self._code(w) for w in words.split())
            for a in range(max(len(codes) - WINDOW + 1, 1)):
                items = held.setdefault(codes[a : a + WINDOW], set())
                if item is not None:
                    items.add(rank[item])
        self.items = [np.fromiter(items, np.int64, len(items)) for items in held.values()]
        self.automaton = ahocorasick.Automaton()
        for k, window in enumerate(held):
            self.automaton.add_word(window, (k, len(window)))
        if held:
            self.automaton.make_automaton()

    def _code(self, word: bytes) -> str:
        if word not in self.codes:
            k = len(self.codes) + 2
            self.codes[word] = chr(k if k < 0xD800 else k + 0x800)  # no surrogates
        return self.codes[word]

    def __call__(self, text: bytes) -> tuple[int, list[dict[str, int]], list[str]]:
        """Number of words, runs of hit words, and the sorted items found. A run has its first
        and last word and its first and last character (exclusive) in the original text."""
        folded, code = text.translate(FOLD), self.codes.get
        parts, bounds = [], [0]
        for _, part in stretches(folded):
            parts.append("".join([code(w, UNKNOWN) for w in part.split()]))
            bounds.append(bounds[-1] + len(parts[-1]))
        if not self.items or not bounds[-1]:
            return bounds[-1], [], []
        hit, found = None, set()
        for end, (k, length) in self.automaton.iter("".join(parts)):
            if hit is None:
                hit = np.zeros(bounds[-1] + 2, np.int8)
            hit[end - length + 2 : end + 2] = 1
            found.add(k)
        if hit is None:
            return bounds[-1], [], []
        steps = np.diff(hit)
        first, last = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) - 1
        start, end = trace(text, folded, bounds, first, last)
        flags = np.zeros(len(self.names), bool)
        for k in found:
            flags[self.items[k]] = True
        columns = (x.tolist() for x in (first, last, start, end))
        runs = [dict(zip(("first", "last", "start", "end"), r)) for r in zip(*columns, strict=True)]
        return bounds[-1], runs, [self.names[k] for k in np.flatnonzero(flags)]


def trace(
    text: bytes, folded: bytes, bounds: list[int], first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """First character of the words ``first`` and the end of the words ``last`` in the original."""
    start, end, seen = np.zeros_like(first), np.zeros_like(last), 0
    for (at, part), a, b in zip(stretches(folded), bounds, bounds[1:], strict=False):
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = np.frombuffer(part, np.uint8) != 0x20
        steps = np.diff(inside)
        original = np.frombuffer(text, np.uint8, len(part), at)
        # Characters before each byte: bytes that continue a character do not count.
        chars = seen + np.r_[0, np.cumsum((original & 0xC0) != 0x80)]
        for words, out, edge in ((first, start, 1), (last, end, -1)):
            own = (words >= a) & (words < b)
            out[own] = chars[np.flatnonzero(steps == edge)[words[own] - a]]
        seen = int(chars[-1])
    return start, end


def _scan(docs: DataFrame, block: list[tuple[str | None, bytes]]) -> DataFrame:
    """One scan of all texts for the windows of a block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in slices(batches):
            out = [finder(text) for text in _binary(batch.column("text"))]
            n_words, runs, items = map(list, zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(runs, RUNS),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "doc_id", "n_words", "runs", "items"],
            )

    return docs.select("row", "doc_id", "text").mapInArrow(find, HITS)


def _united(found: DataFrame) -> DataFrame:
    """One row per document from the hits of several blocks."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for lists in batch.column("runs").to_pylist():
                out: list[dict[str, int]] = []
                for r in sorted((r for runs in lists for r in runs), key=lambda r: r["first"]):
                    if out and r["first"] <= out[-1]["last"] + 1:
                        if r["last"] > out[-1]["last"]:
                            out[-1] |= {"last": r["last"], "end": r["end"]}
                    else:
                        out.append(r)
                runs.append(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(runs, RUNS), batch.column("items")],
                ["row", "runs", "items"],
            )

    lists = found.groupBy("row").agg(
        F.collect_list("runs").alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    kinds = HITS.split(", ", 3)[3]
    return lists.mapInArrow(unite, f"row long, {kinds}")


def find_items(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row's ``doc_id, n_words, runs, items``: the runs of words inside an occurrence of a
    window, with first and last word and the characters ``start`` to ``end`` of the original
    text, and the ids of all items with a window that occurs, sorted as strings.

    A null or empty text has no words. Rows count one by one, also with null or repeated ids.
    Items without words have no window; rows of one ``item_id`` are one item; items without an id
    hit words but are not listed. Empty tables give empty results, no items give no hits. Texts
    are scanned whole, in stretches of bounded memory. Other columns, whatever their names, are
    not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = blocks_of(items, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    columns = ["doc_id", "n_words", "runs", "items"]
    if second is None:
        return _scan(docs.withColumn("row", F.lit(0).cast("long")), first).select(columns)
    docs = numbered(docs, "decontaminate")
    whole = staged(_scan(docs, first), "hits")
    hits = [whole.filter("size(runs) > 0").select("row", "runs", "items")]
    while second is not None:
        found = _scan(docs, second).filter("size(runs) > 0").select("row", "runs", "items")
        hits.append(staged(found, "hits"))
        second = next(blocks, None)
    every = hits[0]
    for more in hits[1:]:
        every = every.unionByName(more)
    none = whole.select("row", "doc_id", "n_words", F.col("runs").alias("_r"), F.col("items").alias("_i"))
    return none.join(_united(every), "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("runs", "_r").alias("runs"),
        F.coalesce("items", "_i").alias("items"),
    )


def contamination(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``find_items`` as counts: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return find_items(docs, items, block_bytes).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(table: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({table}.text, ''), '{_UPPER}', '{_LOWER}'),"
        r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


SQL = f"""
with i as (select cast(item_id as varchar) item, {_sql_words('benchmark')} w from benchmark),
iw as (select distinct item, least(len(w), {WINDOW}) k,
    list_slice(w, p, p + least(len(w), {WINDOW}) - 1) win
  from (select item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) p from i where len(w) > 0)),
d as materialized (select row_number() over () r, doc_id, {_sql_words('documents')} w from documents),
s as (select distinct k from iw),
f as (select distinct list_extract(win, 1) a from iw),
o as materialized (select r, p, k, list_slice(w, p, p + k - 1) win
  from (select r, w, unnest(range(1, len(w) + 1)) p from d) x, s
  where p + k - 1 <= len(w) and list_extract(w, p) in (select a from f)),
h as materialized (select o.r, o.p, o.k, iw.item from o join iw on o.k = iw.k and o.win = iw.win),
words as (select r, count(distinct q) n_hit
  from (select r, unnest(range(p, p + k)) q from h) group by r),
items as (select r, count(*) n_items, string_agg(item, ',' order by item) l
  from (select distinct r, item from h where item is not null) group by r)
select d.doc_id, cast(len(d.w) as bigint) n_words, coalesce(n_hit, 0) n_hit,
  coalesce(n_items, 0) n_items, sha256(coalesce(l, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from d left join words using (r) left join items using (r)
"""
