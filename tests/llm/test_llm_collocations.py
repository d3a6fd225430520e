"""Phrases and their scores against brute force, with groups and heavy prefixes of any size."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import LOWER, SCHEMA, awkward

from echotide.llm import collocations as c


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute(rows, least, top):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            total[lang or "und"] += len(words)
            for k in range(1, 6):
                f.update((lang or "und", *words[p : p + k]) for p in range(len(words) - k + 1))
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    gone = set()
    for (lang, *g), a in found.items():
        for k in range(2, len(g)):
            for p in range(len(g) - k + 1):
                if 100 * a >= 100 * f[lang, *g[p : p + k]]:
                    gone.add((lang, *g[p : p + k]))
    out = []
    for (lang, *g), a in found.items():
        if (lang, *g) in gone:
            continue
        n, cuts = total[lang], []
        for k in range(1, len(g)):
            left, right = f[lang, *g[:k]], f[lang, *g[k:]]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(g), a, left, right, n, score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, ranked = Counter(), []
    for r in out:
        rank[r[0]] += 1
        if rank[r[0]] <= top:
            ranked.append((r[0], rank[r[0]], *r[1:]))
    return ranked


def table():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünder", "größe", "…", "*"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = awkward()
    for i in range(300):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice(["  ", " ", "\t", ", ", ".\n", "!", " "]) for w in words)
        lang = rng.choice(["en", "en", "en", "de", None, "und"])
        rows.append((1000 + i, text + "w1 in front of the house W1", lang, None, None))
    rows.append((2000, "in front of the house " * 700, "fr", None, None))
    return rows


@pytest.mark.parametrize("budget", [c.BUDGET, 200, 1])
def test_like_brute_force(spark, budget):
    rows = table()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n long, phrase string")
    got = c.collocations(docs.repartition(3), least=20, top=40, budget=budget).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 20, 40))


def test_empty(spark):
    for rows in ([], [(1, None, None, None, None), (2, " ;, \n", "en", "s", 3)]):
        assert c.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_portions_lose_and_repeat_nothing(size):
    rng = random.Random(3)
    text = "".join(rng.choice(["ab", "é", "longer"]) + rng.choice([" ", "  ", " ", "\t", ". "]) for _ in range(400))
    texts = [text, None, "", "word " * 300, "x" * 500, "a b c d e f g"]
    want, got = Counter(), Counter()
    for t in texts:
        for words in pieces(t):
            for k in range(1, 6):
                want.update(tuple(words[p : p + k]) for p in range(len(words) - k + 1))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": pa.array(texts, pa.string())})
    for _, part, own in c.portions(iter([batch]), size):
        codes, piece, words = c.encode(part)
        for k in range(1, 6):
            for p in range(len(codes) - k + 1):
                if (own is None or p < own) and piece[p] == piece[p + k - 1]:
                    got[tuple(words[x].decode() for x in codes[p : p + k])] += 1
    assert got == want


def test_sums_merge():
    sums, rng = c.Sums(), np.random.default_rng(1)
    want = Counter()
    for _ in range(5):
        keys = np.unique(rng.integers(0, 50, 30)).astype(np.uint64)
        sums.add(keys, np.full(len(keys), 2), keys * 3)
        want.update({int(k): 2 for k in keys})
    keys, n, rest = sums.empty()
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == want and (rest == keys * 3).all()
