"""Language of texts by bit-sliced Bloom filters over letter n-grams.

All languages share one filter: a place holds a bit mask, with one bit per language, in as many
64-bit words as they need. The masks at the places of an n-gram, combined by AND, name all languages
that contain it in one look-up for each word. A text
counts, for each language, the n-grams whose mask has its bit. A filter answers wrongly with a known
chance, by how full the slice of the language is, so counts are corrected for it before they are
compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices

SIZES = (1, 2, 3)
BITS = 20
HASHES = 2
MOST_ROWS = 40_000
LEAST_SHARE = 0.02
WORD_BITS = 64
MOST_COUNTS = 4_000_000
UNDETERMINED = "und"
_SPACE = ord(" ")


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, one after the other, each with a space at its ends
    and one space for every run of other characters than letters; and where each text begins."""
    points = [np.array([_SPACE], np.uint32)]
    bounds = [0]
    for text in texts:
        raw = text.lower().encode("utf-32-le", "surrogatepass")
        points.append(np.frombuffer(raw, "<u4"))
        points.append(np.array([_SPACE], np.uint32))
        bounds.append(bounds[-1] + len(raw) // 4 + 1)
    data = np.concatenate(points)
    is_letter = _LETTERS[np.minimum(data, len(_LETTERS) - 1)]
    data = np.where(is_letter, data, _SPACE)
    keep = np.r_[True, (data[1:] != _SPACE) | (data[:-1] != _SPACE)]
    starts = np.cumsum(keep)[np.asarray(bounds)] - 1
    return data[keep], starts


# True for letters of the basic plane; higher planes count as letters.
_LETTERS = np.array([chr(c).isalpha() for c in range(0x10000)] + [True])


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` code points; 0 where it holds a space in its inside or
    nothing but a space."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out << np.uint64(21)) | data[k : k + n]
    blank = data == _SPACE
    useless = blank[:n].copy() if size == 1 else np.zeros(n, bool)
    for k in range(1, size - 1):
        useless |= blank[k : k + n]
    if size == 2:
        useless |= blank[:n] & blank[1 : 1 + n]
    return np.where(useless, np.uint64(0), mix(out))


@dataclass
class Filters:
    languages: list[str]
    masks: np.ndarray  # by word of WORD_BITS languages, then by place
    chance: np.ndarray  # of a wrong yes, by language

    def look(self, hashes: np.ndarray, word: int = 0) -> np.ndarray:
        masks = self.masks[word]
        out = masks[(hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)]
        for k in range(1, HASHES):
            place = (hashes >> np.uint64(BITS * k)) & np.uint64((1 << BITS) - 1)
            out = out & masks[place.astype(np.int64)]
        return out


def nothing() -> Filters:
    return Filters([], np.zeros((0, 1 << BITS), np.uint64), np.zeros(0))


def build(table: pd.DataFrame, languages: list[str]) -> Filters:
    """``table``: ``lang`` and ``gram`` of all n-grams a language contains."""
    masks = np.zeros((-(-len(languages) // WORD_BITS), 1 << BITS), np.uint64)
    grams_of = dict(iter(table.groupby("lang", observed=True)["gram"]))
    full = np.zeros(len(languages))
    for at, lang in enumerate(languages):
        if lang not in grams_of:
            continue
        word, bit = divmod(at, WORD_BITS)
        hashes = grams_of[lang].to_numpy(np.int64).view(np.uint64)
        places = []
        for k in range(HASHES):
            place = (hashes >> np.uint64(BITS * k)) & np.uint64((1 << BITS) - 1)
            places.append(place.astype(np.int64))
        places = np.unique(np.concatenate(places))
        masks[word][places] |= np.uint64(1 << bit)
        full[at] = len(places) / (1 << BITS)
    return Filters(languages, masks, full**HASHES)


def fit(docs: DataFrame, most: int = MOST_ROWS, share: float = LEAST_SHARE) -> Filters:
    """Filters from at most about ``most`` rows of ``text`` and non-null ``lang``, chosen by a hash
    of the row.

    A language contains an n-gram if at least ``share`` of its texts do and it is no less than half
    as frequent there as in the language that has it most: texts hold quotations of others, and an
    n-gram that is rare in a language says nothing for it. Every value of ``lang`` is learned: of
    each language the text of the least hash is always taken.
    """
    known = docs.filter("text is not null and lang is not null").select("text", "lang")
    spark = docs.sparkSession
    known = known.withColumn("place", F.pmod(F.xxhash64("text", F.lit(9)), F.lit(1_000_000)))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    sizes = sizes.collect()
    if not sizes:
        return nothing()
    each = max(1, most // len(sizes))
    # One row for each language: broadcast, so that no text moves.
    parts = [
        (r["lang"], max(int(min(1.0, each / r["n"]) * 1_000_000), r["least"] + 1)) for r in sizes
    ]
    parts = F.broadcast(spark.createDataFrame(parts, "lang string, part long"))
    sample = known.join(parts, "lang").filter("place < part").select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs = np.array(batch.column("lang").to_pylist())
            data, starts = letters(batch.column("text").to_pylist())
            frames = []
            for size in SIZES:
                h = grams(data, size)
                text = np.searchsorted(starts, np.arange(len(h)), "right") - 1
                text = np.minimum(text, len(langs) - 1)
                pairs = pd.DataFrame({"text": text[h != 0], "gram": h[h != 0].view(np.int64)})
                frames.append(pairs.drop_duplicates())
            found = pd.concat(frames)
            found["lang"] = langs[found["text"].to_numpy()]
            out = found.groupby(["lang", "gram"], sort=False).size().reset_index(name="n")
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    counted = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )
    drawn = sample.groupBy("lang").agg(F.count("*").alias("n")).collect()
    drawn = sorted((r["lang"], r["n"]) for r in drawn)
    languages = [lang for lang, _ in drawn]
    rows = [(lang, n, at) for at, (lang, n) in enumerate(drawn)]
    rows = F.broadcast(spark.createDataFrame(rows, "lang string, drawn long, at int"))
    rated = counted.join(rows, "lang").withColumn("rate", F.col("n") / F.col("drawn"))
    rated = rated.filter(F.col("rate") >= share)
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    table = rated.join(top, "gram").filter(F.col("rate") * 2 >= F.col("top")).select("at", "gram")
    # What occurs in LEAST_SHARE of a bounded number of texts is bounded as well.
    table = table.toPandas()
    table["lang"] = pd.Categorical.from_codes(table.pop("at"), languages)
    return build(table, languages)


def predict(docs: DataFrame, filters: Filters, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row, from its whole ``text``.

    ``und`` with score 0 for a null text, one without a letter, or if nothing was learned. The
    score is the share of the winner in the corrected counts of all languages, less what the others
    would have by chance; ties go to the first language by name.
    """
    shared = filters
    n = len(filters.languages)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of so few texts that their counts are bounded for any number of languages."""
        size = max(1, MOST_COUNTS // max(n, 1))
        for batch in slices(batches):
            for s in range(0, batch.num_rows, size):
                yield batch.slice(s, size)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            data, starts = letters(texts)
            counts = np.zeros((len(texts), n))
            total = np.zeros(len(texts))
            for size in SIZES:
                h = grams(data, size)
                use = h != 0
                at = np.minimum(starts[:-1], max(len(h) - 1, 0))
                if len(h):
                    total += np.add.reduceat(use.astype(np.int64), at)
                    for b in range(n):
                        word, place = divmod(b, WORD_BITS)
                        if place == 0:
                            mask = np.where(use, shared.look(h, word), np.uint64(0))
                        bit = ((mask >> np.uint64(place)) & np.uint64(1)).astype(np.int64)
                        counts[:, b] += np.add.reduceat(bit, at)
            known = [any(map(str.isalpha, t)) for t in texts]
            langs, scores = [], []
            for k, has_letter in enumerate(known):
                if not has_letter or not n:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                right = np.maximum((counts[k] - total[k] * shared.chance) / (1 - shared.chance), 0)
                best = int(np.argmax(right))
                langs.append(shared.languages[best])
                scores.append(float(right[best] / right.sum()) if right.sum() > 0 else 1.0 / n)
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs), pa.array(scores)], [*keep, "lang_pred", "score"]
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string, score double"])
    return docs.select(*keep, "text").mapInArrow(read, schema)
