"""Toxicity from a weighted lexicon, matched after folding disguised spellings.

Texts are folded: compatibility forms and accents are taken apart, look-alike letters of other
alphabets and digits that stand for letters become the letter. One Aho-Corasick automaton then finds
all terms and all exception phrases in a single pass over the text. A term counts where it is a whole
word and lies in no exception phrase. The summed weights, divided by a power of the length, go
through a logistic curve.

Terms, weights and exceptions are learned from labelled texts; a caller may add phrases.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged

MOST_LABELLED = 20_000
MOST_TERMS = 2_000
LEAST_TEXTS = 5
LEAST_DEVIATION = 5.0
LEAST_WEIGHT = 1.0
POWERS = (0.0, 0.25, 0.5, 1.0)

# Letters that look like a Latin one, and digits written for a letter.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ⅼ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i"}

_TABLE = str.maketrans(LOOKALIKES)
# Words with a digit or sign in them. Those at the end of a word, unless digits, are punctuation.
_WRITTEN = re.compile(r"[^\W\d_]*[0134578@$!][\w@$!]*")
_NUMBER = re.compile(r"[\d@$!]*(?:(?<=\d)[^\W\d_]{1,2})?\Z")
_LETTER = str.maketrans(DIGITS | SIGNS)
_MARKS = re.compile(r"[̀-ͯ​-‍­]+")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The text in lower case, with disguised letters as plain ones."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower()
    if not text.isascii():
        text = text.translate(_TABLE)
    return _WRITTEN.sub(_plain, text)


def _plain(found: re.Match) -> str:
    """A word with its digits read as letters; numbers, ordinals and units stay as they are."""
    word = found[0].rstrip("@$!")
    if _NUMBER.match(word):
        return found[0]
    return word.translate(_LETTER) + found[0][len(word) :]


@dataclass
class Lexicon:
    """Weights of terms, phrases in which terms do not count, and the logistic curve."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    power: float = 0.5
    slope: float = 1.0
    shift: float = -1.0

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), None))
        for term, weight in self.weights.items():
            a.add_word(term, (len(term), weight))
        a.make_automaton()
        return a if len(a) else None

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        x = self.slope * np.log1p(total / np.maximum(words, 1) ** self.power) + self.shift
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def hits(folded: str, automaton) -> list[tuple[int, int, float]]:
    """Start, end and weight of every term that counts."""
    found, excepted = [], []
    n = len(folded)
    for end, (size, weight) in automaton.iter(folded):
        start, end = end - size + 1, end + 1
        if (start and folded[start - 1].isalnum()) or (end < n and folded[end].isalnum()):
            continue
        (excepted if weight is None else found).append((start, end, weight))
    if excepted:
        found = [
            h for h in found if not any(a <= h[0] and h[1] <= b for a, b, _ in excepted)
        ]
    return found


def measure(text: str | None, automaton) -> tuple[float, int]:
    """Summed weights and number of words."""
    if not text:
        return 0.0, 0
    folded = fold(text)
    total = sum(w for *_, w in hits(folded, automaton)) if automaton else 0.0
    return total, len(text.split())


def _phrases(folded: str, terms: set[str]) -> Iterable[str]:
    """Two-word phrases around each term, as written (single spaces only)."""
    words = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(folded)]
    for (a, _, end), (b, start, _) in zip(words, words[1:], strict=False):
        if (a in terms or b in terms) and folded[end:start] == " ":
            yield f"{a} {b}"


def _counted(rows: DataFrame, items) -> DataFrame:
    """In how many toxic and clean texts each item occurs, summed next to the data first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen = (Counter(), Counter())
            for text, toxic in zip(
                batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True
            ):
                seen[toxic].update(set(items(fold(text or ""))))
            names = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([seen[1][x] for x in names], pa.int64()),
                    pa.array([seen[0][x] for x in names], pa.int64()),
                ],
                ["item", "toxic", "clean"],
            )

    return (
        rows.mapInArrow(count, "item string, toxic long, clean long")
        .groupBy("item")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Slope, shift and mean loss of a one-dimensional logistic fit, by Newton's method."""
    scale = max(float(np.abs(x).max()), 1e-9)
    a = np.c_[x / scale, np.ones_like(x)]
    w = np.zeros(2)
    penalty = np.diag([ridge, ridge])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        gradient = a.T @ (p - y) / len(y) + penalty @ w
        curve = (a * (p * (1 - p))[:, None]).T @ a / len(y) + penalty
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -40, 40))), 1e-12, 1 - 1e-12)
    loss = float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    return float(w[0] / scale), float(w[1]), loss


def fit(
    docs: DataFrame, labels: DataFrame, exceptions: Iterable[str] = (), most: int = MOST_LABELLED
) -> Lexicon:
    """A lexicon from at most ``most`` labelled texts (``doc_id``, ``toxic`` 0 or 1), those of the
    least hash. Other labels are left out; without both kinds of label the lexicon is empty and
    every score is below one half."""
    chosen = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id")
        .limit(most)
    )
    # At most `most` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = staged(rows, "labelled")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    t, c = sizes.get(1, 0), sizes.get(0, 0)
    if not t or not c:
        return Lexicon({})
    expected = (F.col("toxic") + F.col("clean")) * (t / (t + c))
    weight = F.log(
        (F.col("toxic") + 0.5) / (t + 1.0) / ((F.col("clean") + 0.5) / (c + 1.0))
    )
    learned = (
        _counted(rows, lambda folded: _WORD.findall(folded))
        .withColumn("weight", weight)
        .withColumn("deviation", (F.col("toxic") - expected) / F.sqrt(expected))
        .filter(F.col("toxic") >= LEAST_TEXTS)
        .filter((F.col("deviation") >= LEAST_DEVIATION) & (F.col("weight") >= LEAST_WEIGHT))
        .orderBy(F.desc("deviation"), "item")
        .limit(MOST_TERMS)
        .collect()
    )
    lexicon = Lexicon({r["item"]: float(r["weight"]) for r in learned}, [fold(e) for e in exceptions])
    terms = set(lexicon.weights)
    if not terms:
        return lexicon
    harmless = (
        _counted(rows, lambda folded: _phrases(folded, terms))
        .withColumn("weight", weight)
        .filter((F.col("clean") >= LEAST_TEXTS) & (F.col("weight") <= 0))
        .orderBy(F.desc("clean"), "item")
        .limit(MOST_TERMS)
        .collect()
    )
    lexicon.exceptions += [r["item"] for r in harmless]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in slices(batches):
            found = [measure(x, automaton) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a for a, _ in found], pa.float64()),
                    pa.array([b for _, b in found], pa.int64()),
                    batch.column("toxic"),
                ],
                ["total", "words", "toxic"],
            )

    sample: pd.DataFrame = rows.mapInArrow(read, "total double, words long, toxic int").toPandas()
    y = sample["toxic"].to_numpy(float)
    best = math.inf
    for power in POWERS:
        x = np.log1p(sample["total"].to_numpy() / np.maximum(sample["words"].to_numpy(), 1) ** power)
        slope, shift, loss = logistic(x, y)
        if slope > 0 and loss < best:
            best, lexicon.power, lexicon.slope, lexicon.shift = loss, power, slope, shift
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score, predicted, terms`` of every row, from its whole text.

    A null or empty text has no terms and gets the score of a text without any. Rows stand alone:
    null or repeated ids and repeated rows are scored row by row.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in slices(batches):
            totals, words, terms = [], [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text or "")
                found = hits(folded, automaton) if automaton and folded else []
                totals.append(sum(w for *_, w in found))
                words.append(len((text or "").split()))
                terms.append(sorted({folded[a:b] for a, b, _ in found}))
            scores = lexicon.score(np.array(totals, float), np.array(words, float))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.array(terms, pa.list_(pa.string())),
                ],
                ["doc_id", "score", "predicted", "terms"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id long, score double, predicted int, terms array<string>"
    )
