"""Near duplicates by circulant MinHash, with every link confirmed on full shingle sets.

One permutation scatters shingles over a universe of ``UNIVERSE`` places; a second one, read from
the place on and shifted by one for each coordinate, gives all ``COORDINATES`` values. In memory the
shifted reads of one shingle are one stretch of the second permutation.

Documents with equal sets collapse to one. Signatures are cut into bands; documents that share a
band are candidates. Instead of all pairs of a bucket, each member is first held against the
bucket's centre, the member that meets most others over all bands. What that links is joined into
components. Members that are still outside the largest component of their bucket are then compared
with all its members, in blocks of bounded size, by their signatures and by parities of their sets:
first their closest partners are confirmed, and in the end every partner whose signature and parities
leave a link possible. Pairs are
therefore counted where they lie and only likely links leave a task, but none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, numbered, slices, staged, windows, words_of
from .graph import components

SHINGLE = 5
PERCENT = 75
UNIVERSE = 1 << 20
ROWS = 6
BANDS = 64
COORDINATES = ROWS * BANDS
SEED = 5
#: A pair at the threshold agrees in 288 of 384 coordinates on average; fewer than this many would
#: be a deviation of five sigma, and is taken for no candidate.
LEAST_AGREEING = 246
#: Bits that tell whether the number of shingles of a set with that place is odd. Where those of two
#: sets differ, so do the sets; any number of bits gives the same links.
ODD_BITS = 2048
CENTRE_TURNS = 2
CLOSEST = 2
BLOCK = 2_000


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text; a text of fewer words has one shingle of all."""
    words, _, _, first = words_of([t.lower() for t in texts])  # bytes: A-Z only
    runs = windows(words, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(windows(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Signer:
    """Signatures of sets of 64-bit hashes."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        second = rng.permutation(UNIVERSE).astype(np.uint32)
        self.salt = np.uint64(rng.integers(1 << 62))
        self.shifted = np.lib.stride_tricks.sliding_window_view(
            np.r_[second, second[:COORDINATES]], COORDINATES
        )

    def __call__(self, values: np.ndarray) -> np.ndarray:
        places = (mix(values ^ self.salt) >> np.uint64(44)).astype(np.int64)
        out = np.full(COORDINATES, UNIVERSE, np.uint32)
        for s in range(0, len(places), 1024):
            np.minimum(out, self.shifted[places[s : s + 1024]].min(axis=0), out=out)
        return out


def odd_places(values: np.ndarray) -> bytes:
    """``ODD_BITS`` bits: whether an odd number of values has that place."""
    places = (mix(values * np.uint64(3)) % np.uint64(ODD_BITS)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=ODD_BITS).astype(np.uint8) & 1).tobytes()


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows), kind))


def signatures(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n_shingles, set_a, set_b, signature, odd, bands`` of every row; the pair of
    sums identifies the set. Bands hash whole coordinates, the signature keeps a byte of each."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for batch in slices(batches):
            sets = shingle_sets(_encoded(batch))
            signed = np.vstack([signer(s) for s in sets])
            bands = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sets), 1))
            for k in range(ROWS):
                bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + signed[:, k::ROWS])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([mix(s).sum(dtype=np.uint64).astype(np.int64) for s in sets]),
                    pa.array(
                        [
                            np.bitwise_xor.reduce(mix(s ^ signer.salt)).astype(np.int64)
                            for s in sets
                        ]
                    ),
                    pa.array([r.tobytes() for r in signed.astype(np.uint8)], pa.binary()),
                    pa.array([odd_places(s ^ signer.salt) for s in sets], pa.binary()),
                    _lists(list(bands.view(np.int64)), pa.int64()),
                ],
                ["row", "doc_id", "n_shingles", "set_a", "set_b", "signature", "odd", "bands"],
            )

    return docs.select("row", "doc_id", "text").mapInArrow(
        sign,
        "row long, doc_id long, n_shingles long, set_a long, set_b long, signature binary,"
        " odd binary, bands array<long>",
    )


def full_sets(docs: DataFrame) -> DataFrame:
    """``id, shingles``: whole sets by row, for confirming links."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    _lists(
                        [s.view(np.int64) for s in shingle_sets(_encoded(batch))], pa.int64()
                    ),
                ],
                ["id", "shingles"],
            )

    return docs.select("row", "text").mapInArrow(
        sets, "id long, shingles array<long>"
    )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (``a, b``) whose sets share 100 * common >= PERCENT * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    total = F.size("of_a") + F.size("of_b")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(common * 100 >= (total - common) * PERCENT)
        .select("a", "b")
    )


def _bytes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), COORDINATES)


def _sizes_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * PERCENT


def likely(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The ``pairs`` whose sizes allow a link and whose signatures agree often enough."""
    sides = [
        signed.select(
            F.col("row").alias(x),
            F.col("n_shingles").alias(f"n_{x}"),
            F.col("signature").alias(f"s_{x}"),
        )
        for x in "ab"
    ]

    def agree(batches):
        for part in batches:
            if len(part):
                equal = (_bytes(part["s_a"]) == _bytes(part["s_b"])).sum(axis=1)
                fit = _sizes_fit(part["n_a"].to_numpy(), part["n_b"].to_numpy())
                yield part.loc[(equal >= LEAST_AGREEING) & fit, ["a", "b"]]

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInPandas(agree, "a long, b long")


MEET = ["band", "i", "j"]
KEPT = ["ask", "place", "id", "root", "n_shingles"]


def _arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """The columns of members of buckets, with a row of numbers for signature and bands."""
    out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in KEPT}
    n = batch.num_rows
    signed = b"".join(batch.column("signature").to_pylist())
    out["signature"] = np.frombuffer(signed, np.uint8).reshape(n, COORDINATES)
    odd = b"".join(batch.column("odd").to_pylist())
    out["odd"] = np.frombuffer(odd, np.uint64).reshape(n, ODD_BITS // 64)
    out["bands"] = batch.column("bands").flatten().to_numpy().reshape(n, BANDS)
    return out


def partners(rows: dict[str, np.ndarray], most: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Likely links of the members of a block that ``ask`` with the others, of other components,
    for each the ``most`` closest ones or all. Of those whose signatures agree often enough, the ones
    go that surely differ in too many shingles. A pair that shares several bands counts in the first
    of them."""
    asking, other = np.flatnonzero(rows["ask"]), np.flatnonzero(~rows["ask"])
    root, n, ids = (rows[c][other] for c in ("root", "n_shingles", "id"))
    signed, odd, bands = (rows[c][other] for c in ("signature", "odd", "bands"))
    a, b = [], []
    for x in asking.tolist():
        fit = np.flatnonzero((root != rows["root"][x]) & _sizes_fit(n, rows["n_shingles"][x]))
        if len(fit):
            count = (signed[fit] == rows["signature"][x]).sum(axis=1)
            close = count >= LEAST_AGREEING
            fit, count = fit[close], count[close]
        if len(fit):
            # Sets differ in as many shingles at least as these bits do; a link leaves room for few.
            differ = np.bitwise_count(odd[fit] ^ rows["odd"][x]).sum(axis=1, dtype=np.int64)
            total = n[fit] + rows["n_shingles"][x]
            near = differ * (100 + PERCENT) <= total * (100 - PERCENT)
            fit, count = fit[near], count[near]
        if len(fit):
            first = (bands[fit] == rows["bands"][x]).argmax(axis=1) == rows["place"][x]
            fit, count = fit[first], count[first]
            if most is not None:
                fit = fit[np.lexsort((ids[fit], -count))[:most]]
            a.append(np.full(len(fit), rows["id"][x]))
            b.append(ids[fit])
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _met(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
    """``partners`` of every block, of which the rows follow each other."""

    def found(parts):
        rows = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        return partners(rows, most)

    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows, links = _arrays(batch), []
        keys = np.stack([batch.column(c).to_numpy() for c in MEET])
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        for s, e in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            key = tuple(keys[:, s].tolist())
            if key != at and held:
                links.append(found(held))
                held = []
            at = key
            held.append({c: x[s:e] for c, x in rows.items()})
        if links:
            yield _pairs(links)
    if held:
        yield _pairs([found(held)])


def _pairs(links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    sides = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
    return pa.RecordBatch.from_arrays(sides, ["a", "b"])


def outsiders(placed: DataFrame, signed: DataFrame, most: int | None) -> DataFrame:
    """Likely links of all members of a bucket that lie outside its largest component. Both they and
    the whole bucket are cut into blocks of about ``BLOCK`` rows."""
    parts = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    buckets = (
        parts.groupBy("band")
        .agg(
            F.max(F.struct("n", "root")).alias("largest"),
            F.sum("n").alias("all"),
            F.count("*").alias("roots"),
        )
        .filter("roots > 1")
        .select(
            "band",
            F.col("largest.root").alias("inside"),
            F.ceil((F.col("all") - F.col("largest.n")) / BLOCK).alias("i_blocks"),
            F.ceil(F.col("all") / BLOCK).alias("j_blocks"),
        )
    )
    rows = (
        placed.join(buckets, "band")
        .select("band", "place", "id", "root", "inside", "i_blocks", "j_blocks")
        .join(signed.select(F.col("row").alias("id"), "n_shingles", "signature", "odd", "bands"), "id")
    )
    rows = staged(rows, "outsiders")

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def one(n):
        return F.pmod(F.xxhash64("id"), F.col(n))

    columns = [*MEET, *KEPT, "signature", "odd", "bands"]
    ask = rows.filter("root != inside").withColumns({"i": one("i_blocks"), "ask": F.lit(True)})
    ask = ask.withColumn("j", each("j_blocks")).select(columns)
    answer = rows.withColumns({"j": one("j_blocks"), "ask": F.lit(False)})
    answer = answer.withColumn("i", each("i_blocks")).select(columns)
    blocks = ask.unionByName(answer).repartition(*MEET).sortWithinPartitions(*MEET)
    return blocks.mapInArrow(lambda batches: _met(batches, most), "a long, b long").distinct()


def centres(placed: DataFrame, again: bool) -> DataFrame:
    """``a, b``: each member of a bucket of several components with the heaviest centre of its
    buckets. ``again`` takes the centre of those that are outside the first one's component."""
    heaviest = F.max(F.struct("weight", (-F.col("id")).alias("id"), "root")).alias("centre")
    mixed = (
        placed.groupBy("band")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"), heaviest)
        .filter("least != most")
    )
    if again:
        first = mixed.select("band", F.col("centre.root").alias("done"))
        mixed = placed.join(first, "band").filter("root != done").groupBy("band").agg(heaviest)
    return (
        placed.join(mixed.select("band", "centre"), "band")
        .filter(F.col("root") != F.col("centre.root"))
        .groupBy("id")
        .agg(F.max("centre").alias("centre"))
        .select(F.col("id").alias("a"), (-F.col("centre.id")).alias("b"))
    )


def linked(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """``id, root`` of rows that share a band with others. ``signed`` holds one row per set."""
    filed = signed.filter("n_shingles > 0").select(
        F.col("row").alias("id"), F.posexplode("bands").alias("place", "band")
    )
    shared = filed.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    met = staged(filed.join(shared, "band"), "met")
    weight = met.groupBy("id").agg(F.sum("members").alias("weight"))
    buckets = staged(met.join(weight, "id").drop("members"), "buckets")
    ids = staged(weight.select("id"), "ids")
    touched = ids.withColumnRenamed("id", "row")
    some = staged(signed.join(touched, "row", "left_semi"), "signed")
    roots = ids.withColumn("root", F.col("id"))
    sets = None
    for turn in range(CENTRE_TURNS + 2):
        placed = staged(buckets.join(roots, "id"), "placed")
        if turn < CENTRE_TURNS:
            pairs = likely(centres(placed, again=turn > 0), some)
        else:
            pairs = outsiders(placed, some, CLOSEST if turn == CENTRE_TURNS else None)
        pairs = staged(pairs, "pairs")
        if pairs.isEmpty():
            continue
        if sets is None:
            sets = staged(full_sets(docs.join(touched, "row", "left_semi")), "sets")
        new = staged(confirmed(pairs, sets), "links")
        if new.isEmpty():
            continue
        # Only components that a new link joins are looked at again.
        ends = [roots.select(F.col("id").alias(x), F.col("root").alias(f"of_{x}")) for x in "ab"]
        between = new.join(ends[0], "a").join(ends[1], "b")
        joined = components(between.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
        joined = joined.select(F.col("id").alias("root"), F.col("root").alias("least"))
        roots = staged(
            roots.join(joined, "root", "left").select(
                "id", F.coalesce("least", "root").alias("root")
            ),
            "roots",
        )
    return roots


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id, n_shingles, component_id, kept``.

    Words are runs of characters other than space and U+0009-U+000D, with A-Z in lower case. A set
    is the distinct runs of five words; fewer words are one shingle; a null or wordless text has
    an empty set and is linked with nothing. Documents are linked when their sets have a
    similarity of at least 0.75. ``component_id`` is the smallest id reachable, the document's own
    included, and ``kept`` marks the rows that carry it. Rows without an id stay, with a null
    component, are kept and link nothing. Of repeated ids each text is judged for itself: sets are
    linked by a row of their own, and ids come in only where the components are known. An empty
    table gives an empty one.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "near_rows")
    signed = staged(signatures(rows), "signatures")
    known = signed.filter(F.col("doc_id").isNotNull())
    key = ["set_a", "set_b", "n_shingles"]
    first = staged(
        known.filter("n_shingles > 0")
        .groupBy(key)
        .agg(F.min("row").alias("row"), F.min("doc_id").alias("least")),
        "first",
    )
    one = known.join(first.select("row"), "row", "left_semi")
    roots = linked(rows, one).withColumnRenamed("id", "row")
    if not rows.filter(~F.col("row").eqNullSafe(F.col("doc_id"))).isEmpty():
        # Rows have numbers of their own: a component goes by the least id of all its sets.
        least = roots.join(first, "row").groupBy("root").agg(F.min("least").alias("id"))
        roots = roots.join(least, "root").select("row", F.col("id").alias("root"))
    member = first.join(roots, "row", "left").select(*key, F.coalesce("root", "least").alias("root"))
    out = signed.select("doc_id", *key).join(member, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
