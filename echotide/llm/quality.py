"""Quality rules: text statistics, and a decision list learned from labelled documents.

Sequential covering in the manner of RIPPER: to find rules for the rejected class, conjunctions of
thresholds are grown on one part of the labelled rows, each condition being the one with the largest
information gain, and pruned on the rest, by dropping the last conditions while that raises
precision. Rows that a rule covers leave, and the next rule is learned, until no rule is precise
enough. The list is small, readable and ordered, and is applied as one Spark expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, windows, words_of

SYMBOLS = re.compile(rb"[#*$%&|<>]")
WINDOW = 8
MOST_LABELLED = 100_000
LEAST_PRECISION = 0.9
LEAST_COVERED = 5
MOST_RULES = 12
MOST_CONDITIONS = 4
CUTS = 64

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars_all", "n_upper", "n_digits", "n_punct", "n_bars", "n_lines", "n_distinct", "n_twins",
    "n_ends",
)
#: What rules may test, as SQL over the counts; a null statistic (no words) meets no condition.
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "digit_share": "n_digits / word_chars",
    "punct_per_word": "n_punct / n_words",
    "bars_per_word": "n_bars / n_words",
    "distinct_share": "n_distinct / n_words",
    "twin_share": "n_twins / n_words",
    "ends_per_word": "n_ends / n_words",
}
_UPPER = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯΑ-Ω]")
_DIGIT = re.compile(r"\d")
_PUNCT = re.compile(r"[!?.,;:]")
_NO_WORD = b"\x20\t\n\x0b\x0c\r"


def repeated_in_windows(hashes: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in a run of ``size`` words found twice or more in the text."""
    runs = windows(hashes, size)
    if not len(runs):
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(hashes) + 1, np.int64)
    hit = np.zeros(len(runs), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    at = np.flatnonzero(hit)
    np.add.at(twice, at, 1)
    np.add.at(twice, at + size, -1)
    return int((np.cumsum(twice)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    lines = [x for x in text.split(b"\n") if x.strip(_NO_WORD)]
    return len(lines) - len(set(lines)), len(lines)


def statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the counts of ``COUNTS`` over the whole text of every row.

    Words are runs of characters other than space and U+0009-U+000D; a null text has none. Rows
    stand alone: null or repeated ids and repeated rows are counted row by row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            hashes, starts, ends, first = words_of(data)
            joined = np.frombuffer(b"\n".join(data), np.uint8)
            # Code points are bytes that do not continue another.
            points = np.r_[0, np.cumsum((joined & 0xC0) != 0x80)]
            in_words = np.r_[0, np.cumsum(points[ends] - points[starts])]
            rows = []
            for k, (text, raw) in enumerate(zip(texts, data, strict=True)):
                a, b = first[k], first[k + 1]
                own = hashes[a:b]
                dup, lines = repeated_lines(raw)
                rows.append(
                    (
                        int(b - a),
                        int(in_words[b] - in_words[a]),
                        len(SYMBOLS.findall(raw)),
                        dup,
                        repeated_in_windows(own),
                        len(text),
                        len(_UPPER.findall(text)),
                        len(_DIGIT.findall(text)),
                        len(_PUNCT.findall(text)),
                        raw.count(b"|"),
                        lines,
                        len(np.unique(own)),
                        int((own[1:] == own[:-1]).sum()),
                        raw.count(b"."),
                    )
                )
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *columns], [*keep, *COUNTS]
            )

    kinds = dict(docs.dtypes)
    schema = [*(f"`{c}` {kinds[c]}" for c in keep), *(f"{c} long" for c in COUNTS)]
    return docs.select(*dict.fromkeys((*keep, "text"))).mapInArrow(count, ", ".join(schema))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def feature(name: str) -> Column:
    """A statistic as a column; null where it is not defined."""
    parts = FEATURES[name].split(" / ")
    top = F.col(parts[0]).cast("double")
    return top if len(parts) == 1 else F.try_divide(top, F.col(parts[1]).cast("double"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        x = rows[self.feature].to_numpy()
        return x >= self.value if self.above else x <= self.value

    def column(self) -> Column:
        x = feature(self.feature)
        return x >= self.value if self.above else x <= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(rows) for c in rule), np.ones(len(rows), bool))


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0.0)


def grow(rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """Conditions added while they gain most, until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(rows), bool)
    while len(rule) < MOST_CONDITIONS and (inside & ~bad).any() and (inside & bad).any():
        p0, n0 = float((inside & bad).sum()), float((inside & ~bad).sum())
        best, choice = 1e-9, None
        for name in FEATURES:
            x = rows[name].to_numpy()
            known = inside & ~np.isnan(x)
            if not (known & bad).any():
                continue
            cuts = np.unique(np.quantile(x[known & bad], np.linspace(0, 1, CUTS)))
            good, worse = np.sort(x[known & ~bad]), np.sort(x[known & bad])
            for above in (True, False):
                side = "left" if above else "right"
                p = np.searchsorted(worse, cuts, side).astype(float)
                n = np.searchsorted(good, cuts, side).astype(float)
                if above:
                    p, n = len(worse) - p, len(good) - n
                gains = _gain(p, n, p0, n0)
                k = int(np.argmax(gains))
                if gains[k] > best:
                    best, choice = gains[k], Condition(name, above, float(cuts[k]))
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.holds(rows)
    return tuple(rule)


def prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The shortest start of the rule with the best (covered bad - covered good) share."""
    best, kept = -2.0, rule
    for k in range(1, len(rule) + 1):
        inside = covers(rule[:k], rows)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best:
            best, kept = worth, rule[:k]
    return kept


def learn(rows: pd.DataFrame, bad: np.ndarray, seed: int = 10) -> list[Rule]:
    """An ordered list of rules for the rows to reject."""
    rng = np.random.default_rng(seed)
    growing = rng.random(len(rows)) < 2 / 3
    left = np.ones(len(rows), bool)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and (left & growing & bad).any():
        on, off = left & growing, left & ~growing
        rule = grow(rows[on], bad[on])
        if not rule:
            break
        rule = prune(rule, rows[off], bad[off])
        inside = covers(rule, rows) & left
        hits, held = int((inside & bad).sum()), inside & off
        precise = (held & bad).sum() >= LEAST_PRECISION * max(held.sum(), 1)
        if hits < LEAST_COVERED or not precise or hits < LEAST_PRECISION * inside.sum():
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[Rule]:
    """Rules from at most ``most`` labelled documents, those of the least hash of their id.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1; other rows are left out). Without labelled
    rows of both kinds there are no rules."""
    chosen = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .select("doc_id", "quality")
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id", F.lit(10)), "doc_id")
        .limit(most)
    )
    # At most `most` rows of two numbers.
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = (
        statistics(known, ("doc_id", "quality"))
        .filter(~base_failed())
        .select("doc_id", "quality", *(feature(f).alias(f) for f in FEATURES))
        .toPandas()
        .sort_values(["doc_id", "quality"], kind="stable", ignore_index=True)
    )
    bad = rows["quality"].to_numpy() == 0
    return learn(rows, bad) if bad.any() and not bad.all() else []


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, from 1; null if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        holds = reduce(lambda a, b: a & b, (c.column() for c in rule))
        out = F.when(holds, k) if out is None else out.when(holds, k)
    return F.lit(None).cast("int") if out is None else out.cast("int")


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (the first that rejects) and ``kept``."""
    return (
        stats.withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
