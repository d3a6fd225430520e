"""Frequent phrases and how strongly their words hold together, by partitioned suffix trees.

As in elastic-range suffix tree building, the text is never sorted as a whole. Scans count word
prefixes of growing length, up to ``PREFIX`` words; these are the top of the tree. A prefix too
rare to lead to a phrase is pruned. The suffixes below the others are dealt over groups by prefix, a
prefix with more occurrences than a group's memory budget by a longer one. Each group builds the
subtrees of its prefixes, truncated at ``LONGEST`` words: its suffixes are sorted, neighbours
compared, and every node is counted from the totals of the leaves below it.

Between the scans travel counts, and to the scans only bitmaps of ``1 << SLOT_BITS`` places, set
where a prefix is frequent enough: another prefix in the same place costs work, never a result. Words
are 64-bit hashes; that no two words share one is checked, and else another seed is taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, mix, slices, staged, unmix

LONGEST = 5
PREFIX = 3
LEAST = 100
TOP = 2_000
UNKNOWN = "und"
SLOT_BITS = 26
#: Occurrences of a group's prefixes. There are never more than ``MOST_HEAVY`` prefixes of one length
#: with more than that, as the budget of very large texts is a fixed part of them.
BUDGET = 1_000_000
MOST_HEAVY = 10_000
KEPT = 1_000_000
BITMAP_BITS = 32_768  # of one value of Spark's bitmap functions
_STEP = 0x9E3779B97F4A7C15

#: What ends a piece becomes a newline, tabs become spaces, ``A-Z`` are folded.
FOLD = bytearray(range(256))
FOLD[0x41:0x5B] = range(0x61, 0x7B)
for _b in b".,;:!?\n\x0b\x0c\r":
    FOLD[_b] = 0x0A
FOLD[0x09] = 0x20
FOLD = bytes(FOLD)
AHEAD = re.compile(rb" *(?:[^ \n]+ +){0,%d}[^ \n]*" % (LONGEST - 2))

HASHES = [f"h{k}" for k in range(1, LONGEST + 1)]


def portions(
    batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES
) -> Iterator[tuple[str, bytes, int | None]]:
    """Folded text of one language in portions of about ``size`` bytes, cut between pieces. Of a
    piece longer than that, a portion goes on by the words that its last phrases need; the number
    of words that start in the portion itself is given then."""
    for batch in slices(batches, size):
        texts: dict[str, list[bytes]] = {}
        langs = batch.column("lang").to_pylist()
        for lang, text in zip(langs, batch.column("text").cast(pa.binary()), strict=True):
            if text.is_valid:
                texts.setdefault(lang, []).append(text.as_py().translate(FOLD))
        for lang, folded in texts.items():
            joined, at = b"\n".join(folded), 0
            while at < len(joined):
                cut = len(joined) if at + size >= len(joined) else joined.rfind(b"\n", at, at + size)
                if cut <= at:  # a long piece
                    ends = [joined.find(c, at + size) for c in (b" ", b"\n")]
                    ends = [e if e >= 0 else len(joined) for e in ends]
                    cut = min(ends)
                    if ends[0] < ends[1]:
                        own = joined[at:cut]
                        end = AHEAD.match(joined, cut).end()
                        yield lang, joined[at:end], len(own.split())
                        at = cut
                        continue
                yield lang, joined[at:cut], None
                at = cut + 1


def encode(part: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word numbers, piece numbers, and the distinct words of a portion."""
    pieces = pc.split_pattern(pa.array([part], pa.binary()), pattern=b"\n").values
    split = pc.split_pattern(pieces, pattern=b" ")
    coded = split.values.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    piece = np.repeat(np.arange(len(split), dtype=np.int32), np.diff(split.offsets.to_numpy()))
    words = coded.dictionary.to_pylist()
    if b"" in words:
        full = codes != words.index(b"")
        codes, piece = codes[full], piece[full]
    return codes, piece, words


def word_hash(word: bytes, lang: str, seed: int) -> int:
    """The hash of a word of one language."""
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode(), seed))


def _tokens(part: bytes, lang: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and piece numbers."""
    codes, piece, words = encode(part)
    hashes = np.fromiter((word_hash(w, lang, seed) for w in words), np.uint64, len(words))
    return hashes[codes], piece


class Slots:
    """Which prefixes are frequent enough, by place of their key in a bitmap."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def slots(frequent: DataFrame, key: str) -> np.ndarray:
    """The bitmap of a column of keys; built in parts by Spark, of a fixed size as a whole."""
    place = F.shiftrightunsigned(key, 64 - SLOT_BITS) + 1  # bitmap places count from 1
    rows = (
        frequent.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    width = BITMAP_BITS // 8
    for r in rows:
        at = (r["bucket"] - 1) * width
        out[at : at + width] = np.frombuffer(r["bits"], np.uint8)
    return out


def _longer(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix(keys * np.uint64(_STEP) + hashes)


def _last(keys: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """The last words of prefixes: what ``_longer`` added to the prefixes one word shorter."""
    return unmix(keys) - parents * np.uint64(_STEP)


def prefix_keys(hashes: np.ndarray, length: int) -> np.ndarray:
    """A key of the ``length`` words from each place on, as far as there are so many."""
    keys = hashes[: max(len(hashes) - length + 1, 0)]
    for k in range(1, length):
        keys = _longer(keys, hashes[k : k + len(keys)])
    return keys


def reached(
    hashes: np.ndarray, piece: np.ndarray, length: int, filters: list[Slots]
) -> np.ndarray:
    """Whether a phrase of ``length`` words from each place on lies in one piece and consists of
    frequent prefixes only, as far as the filters know. ``filters`` are by length from 1 on."""
    n = max(len(hashes) - length + 1, 0)
    if not n:
        return np.zeros(0, bool)
    ok = piece[:n] == piece[length - 1 :]
    for k, known in enumerate(filters[:length], 1):
        if k == len(filters) or k == length:  # shorter ones are implied
            frequent = known(prefix_keys(hashes, k))
            for shift in range(length - k + 1):
                ok &= frequent[shift : shift + n]
    return ok


class Sums:
    """Counts by key, and by what belongs to the key, merged whenever there are many."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray, *rest: np.ndarray) -> bool:
        self.parts.append((keys, counts, *rest))
        self.size += len(keys)
        if self.size > KEPT:
            merged = self.merged()
            self.parts, self.size = [merged], len(merged[0])
        return self.size > KEPT // 2

    def merged(self) -> tuple[np.ndarray, ...]:
        keys, counts, *rest = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        sums = np.bincount(inverse, counts, len(keys)).astype(np.int64)
        return keys, sums, *(x[first] for x in rest)

    def empty(self) -> tuple[np.ndarray, ...]:
        out = self.merged()
        self.parts, self.size = [], 0
        return out


def words(docs: DataFrame, seed: int) -> DataFrame:
    """``lang, h, word, f``: how often each word occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bytes], int] = {}

        def rows():
            langs, found = zip(*seen, strict=True)
            hashes = (word_hash(w, lang, seed) for lang, w in seen)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()),
                    pa.array(np.fromiter(hashes, np.uint64, len(seen)).view(np.int64)),
                    pa.array(found, pa.binary()).cast(pa.string()),
                    pa.array(seen.values(), pa.int64()),
                ],
                ["lang", "h", "word", "f"],
            )

        for lang, part, own in portions(batches):
            codes, _, distinct = encode(part)
            counts = np.bincount(codes[:own], minlength=len(distinct)).tolist()
            for word, n in zip(distinct, counts, strict=True):
                if n:
                    seen[lang, word] = seen.get((lang, word), 0) + n
            if len(seen) > 200_000:
                yield rows()
                seen.clear()
        if seen:
            yield rows()

    found = docs.mapInArrow(count, "lang string, h long, word string, f long")
    return found.groupBy("lang", "h", "word").agg(F.sum("f").alias("f"))


def prefixes(docs: DataFrame, length: int, filters: list, seed: int, least: int) -> DataFrame:
    """``key, parent, h, n``: prefixes of ``length`` words that occur ``least`` times or more and
    whose parts do so too, as far as the filters know, with the key of the prefix one word shorter
    and the last word."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = [Slots(b) for b in sent.value], Sums()

        def rows():
            keys, n, parents = sums.empty()
            arrays = [pa.array(x.view(np.int64)) for x in (keys, parents)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(n)], ["key", "parent", "n"])

        for lang, part, own in portions(batches):
            hashes, piece = _tokens(part, lang, seed)
            ok = np.flatnonzero(reached(hashes, piece, length, known)[:own])
            if len(ok):
                parents = prefix_keys(hashes, length - 1)
                keys = _longer(parents[ok], hashes[ok + length - 1])
                keys, first, n = np.unique(keys, return_index=True, return_counts=True)
                if sums.add(keys, n, parents[ok[first]]):
                    yield rows()
        if sums.size:
            yield rows()

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parents = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "parent"))
            yield batch.append_column("h", pa.array(_last(keys, parents).view(np.int64)))

    # With the key of the shorter prefix a key belongs to one last word only: counts are exact.
    found = docs.mapInArrow(count, "key long, parent long, n long").groupBy("key", "parent")
    frequent = found.agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return frequent.mapInArrow(last, "key long, parent long, n long, h long")


def suffixes(docs: DataFrame, filters: list, heavy: list[int], groups: int, seed: int) -> DataFrame:
    """``grp, depth, h1, ..., n``: truncated suffixes of more than ``PREFIX`` words as far as
    frequent prefixes reach, with the group of their prefix. Nodes above ``depth`` have leaves in
    other groups too."""
    sent = docs.sparkSession.sparkContext.broadcast((filters, heavy))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, large = sent.value
        known, large, sums = [Slots(b) for b in bits], np.array(large, np.int64), Sums()

        def rows():
            keys, n, grp, depth, *found = sums.empty()
            arrays = [pa.array(grp), pa.array(depth), *(pa.array(h.view(np.int64)) for h in found)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(n)], ["grp", "depth", *HASHES, "n"])

        for lang, part, own in portions(batches):
            hashes, piece = _tokens(part, lang, seed)
            start = np.flatnonzero(reached(hashes, piece, PREFIX + 1, known)[:own])
            if not len(start):
                continue
            prefix = prefix_keys(hashes, PREFIX)[start]
            found = [hashes[start + k] for k in range(PREFIX + 1)]
            key = _longer(prefix, found[-1])
            alive = np.ones(len(start), bool)
            for length in range(PREFIX + 2, LONGEST + 1):  # 0 from where it is no longer frequent
                on = reached(hashes, piece, length, known)
                alive &= np.r_[on, np.zeros(len(hashes) - len(on), bool)][start]
                word = np.zeros(len(start), np.uint64)
                word[alive] = hashes[start[alive] + length - 1]
                key = np.where(alive, _longer(key, word), key)
                found.append(word)
            extend = np.isin(prefix.view(np.int64), large)
            depth = np.where(extend, LONGEST, PREFIX).astype(np.int32)
            prefix = np.where(extend, key, prefix)
            grp = (mix(prefix ^ np.uint64(13)) % np.uint64(groups)).astype(np.int32)
            keys, first, n = np.unique(key, return_index=True, return_counts=True)
            if sums.add(keys, n, grp[first], depth[first], *(h[first] for h in found)):
                yield rows()
        if sums.size:
            yield rows()

    columns = ", ".join(f"{h} long" for h in HASHES)
    found = docs.mapInArrow(collect, f"grp int, depth int, {columns}, n long")
    return found.groupBy("grp", "depth", *HASHES).agg(F.sum("n").alias("n"))


def subtree(part: pd.DataFrame, least: int) -> pd.DataFrame:
    """The nodes of a group's subtrees below their prefixes, with the totals of their leaves.

    Nodes of fewer than ``least`` occurrences are left out, unless they have leaves in other groups
    as well."""
    levels = [part[h].to_numpy() for h in HASHES]
    order = np.lexsort(levels[::-1])
    levels = [x[order] for x in levels]
    n, depth = part["n"].to_numpy()[order], part["depth"].to_numpy()[order]
    new, out = np.zeros(len(n), bool), []
    new[:1] = True
    for d, level in enumerate(levels, 1):
        new[1:] |= level[1:] != level[:-1]
        if d <= PREFIX:
            continue
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first)
        above = np.maximum.reduceat(depth, first) > d
        first, total = (x[(level[first] != 0) & (above | (total >= least))] for x in (first, total))
        words = {h: x[first] if k < d else 0 for k, (h, x) in enumerate(zip(HASHES, levels))}
        out.append(pd.DataFrame({"size": d, **words, "a": total}))
    return pd.concat(out)


def frequent_phrases(docs: DataFrame, known: DataFrame, seed: int, least: int, budget: int) -> DataFrame:
    """``lang, words, a``: phrases of 2 to ``LONGEST`` words, as arrays of hashes, that occur
    ``least`` times or more. ``known`` are the words that do."""
    filters = [slots(known, "h")]
    shorter = known.select(F.col("h").alias("parent"), F.array("h").alias("words"))
    top = []
    for length in range(2, PREFIX + 1):
        found = prefixes(docs, length, filters, seed, least).join(shorter, "parent")
        found = found.select("key", F.array_append("words", F.col("h")).alias("words"), "n")
        top.append(staged(found, "prefixes"))
        filters.append(slots(top[-1], "key"))
        shorter = top[-1].select(F.col("key").alias("parent"), "words")
    total = top[-1].agg(F.sum("n")).first()[0] or 0
    budget = max(budget, total // MOST_HEAVY)
    heavy = [r["key"] for r in top[-1].filter(F.col("n") > budget).select("key").collect()]
    groups = max(1, -(-2 * total // budget))
    columns = ", ".join(f"{h} long" for h in HASHES)
    nodes = (
        suffixes(docs, filters, heavy, groups, seed)
        .groupBy("grp")
        .applyInPandas(lambda part: subtree(part, least), f"size int, {columns}, a long")
        .groupBy("size", *HASHES)
        .agg(F.sum("a").alias("a"))
        .filter(F.col("a") >= least)
        .select(F.slice(F.array(*HASHES), F.lit(1), F.col("size")).alias("words"), "a")
    )
    for found in top:
        nodes = nodes.unionByName(found.select("words", F.col("n").alias("a")))
    lang = known.select(F.col("h").alias("h1"), "lang")
    return nodes.withColumn("h1", F.col("words")[0]).join(lang, "h1").select("lang", "words", "a")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(18,0)")


def scored(phrases: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, words, a, l, r, n, score`` of phrases that no longer one makes needless."""
    # A longer phrase with as many occurrences implies one that is longer by a single word.
    size = F.size("words")
    inner = phrases.filter(size > 2).select(
        "lang",
        F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"),
        "a",
    )
    longer = inner.groupBy("lang", "words").agg(F.max("a").alias("longer"))
    kept = phrases.join(longer, ["lang", "words"], "left").filter("longer is null or longer < a")
    single = known.select("lang", F.array("h").alias("words"), F.col("f").alias("a"))
    counts = staged(phrases.unionByName(single), "counts")
    cuts = kept.select(
        "lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "*",
        F.slice("words", F.lit(1), F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    head = counts.select("lang", F.col("words").alias("head"), F.col("a").alias("l"))
    rest = counts.select("lang", F.col("words").alias("rest"), F.col("a").alias("r"))
    parts = cuts.join(head, ["lang", "head"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    # Integer division of decimals: exact, and the quotient is at most 1000 n.
    thousand = F.lit(1000).cast("decimal(4,0)")
    products = parts.select(
        "lang", "words", "a", "n", "k", "l", "r",
        (thousand * _exact("a") * _exact("n")).alias("_above"),
        (_exact("l") * _exact("r")).alias("_below"),
    )
    score = F.expr("_above div _below")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return products.groupBy("lang", "words", "a", "n").agg(least).select(
        "lang", "words", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, budget: int = BUDGET
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: of each language the ``top`` phrases of 2 to 5
    words by score, then ``a``, then phrase.

    ``A-Z`` are folded; ``.,;:!?`` and line ends part pieces, spaces and tabs part words; phrases
    lie in one piece. ``n`` counts the words of the language, ``a`` the occurrences of the phrase,
    overlaps included, which are ``least`` or more. A phrase is cut where its two parts, with
    ``l`` and ``r`` occurrences, make ``floor(1000 a n / (l r))`` least, at the first such cut. A
    phrase inside a longer one with as many occurrences is left out. A null ``lang`` counts as
    ``und``, a null or empty text has no words; repeated rows count each. An empty table gives an
    empty one. Long texts are read in portions; other columns, whatever their names, are not read.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    for seed in range(1, 9):
        found = staged(words(docs, seed), "words")
        if found.groupBy("h").agg(F.count("*").alias("words")).filter("words > 1").isEmpty():
            break
    else:
        raise RuntimeError("words share 64-bit hashes with every seed")
    totals = staged(found.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    known = staged(found.filter(F.col("f") >= least), "known")
    phrases = staged(frequent_phrases(docs, known, seed, least, budget), "phrases")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = scored(phrases, known, totals).withColumn("_rank", F.rank().over(order))
    best = staged(best.filter(F.col("_rank") <= top).drop("_rank"), "best")
    spelled = (
        best.select("lang", "words", F.posexplode("words").alias("place", "h"))
        .join(known.select("lang", "h", "word"), ["lang", "h"])
        .groupBy("lang", "words")
        .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelled"))
        .select("lang", "words", F.array_join(F.col("spelled.word"), " ").alias("phrase"))
    )
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(spelled, ["lang", "words"])
        .withColumn("rank", F.row_number().over(final).cast("long"))
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


SQL = rf"""
with p as (select coalesce(lang, '{UNKNOWN}') lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) piece from documents),
w as materialized (select lang, w from (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from p) where len(w) > 0),
g as (select lang, list_slice(w, i, i + k - 1) g from (
    select lang, w, k, unnest(range(1, len(w) - k + 2)) i
    from w, (select unnest(range(1, {LONGEST + 1})) k) where len(w) >= k)),
f as materialized (select lang, g, len(g) m, count(*) f from g group by lang, g),
n as (select lang, sum(f) n from f where m = 1 group by lang),
c as materialized (select * from f where m > 1 and f >= {LEAST}),
gone as (select distinct lang, sub from (
    select lang, f, unnest([list_slice(g, i, i + k - 1) for i in range(1, m - k + 2)]) sub
    from (select *, unnest(range(2, m)) k from c)) x
  where exists (select 1 from c where c.lang = x.lang and c.g = x.sub and 100 * x.f >= 100 * c.f)),
kept as (select * from c where not exists
  (select 1 from gone where gone.lang = c.lang and gone.sub = c.g)),
cuts as (select kept.*, unnest(range(1, m)) k from kept),
s as (select cuts.lang, cuts.g, cuts.f a, k, l.f l, r.f r, n.n,
    cast((1000::hugeint * cuts.f * n.n) // (l.f::hugeint * r.f) as bigint) score
  from cuts join n on n.lang = cuts.lang
  join f l on l.lang = cuts.lang and l.g = list_slice(cuts.g, 1, k)
  join f r on r.lang = cuts.lang and r.g = list_slice(cuts.g, k + 1, cuts.m)),
b as (select * from s qualify row_number() over (partition by lang, g order by score, k) = 1),
o as (select lang, array_to_string(g, ' ') phrase, a, l, r, n, score from b)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) "rank",
  phrase, a, l, r, cast(n as bigint) n, score
from o qualify "rank" <= {TOP}
"""
