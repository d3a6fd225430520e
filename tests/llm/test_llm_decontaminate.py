"""Contaminated passages against brute force, on awkward rows and over several blocks."""

import hashlib
import random
import re

from echotide.llm import decontaminate as d

from cases import LOWER, SCHEMA, awkward, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [(m[0], *m.span()) for m in WORDS.finditer((text or "").translate(LOWER))]


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = [x for x, _, _ in words(text)]
        for p in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[p : p + 10]), set()).add(item)
    out = []
    for row in docs:
        found, hit, at = set(), set(), words(row[1])
        w = [x for x, _, _ in at]
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit |= set(range(p, p + k))
                    found |= windows[tuple(w[p : p + k])]
        spans, last = [], None
        for p in sorted(hit):
            if last is not None and p == last + 1:
                spans[-1] = (spans[-1][0], at[p][2])
            else:
                spans.append((at[p][1], at[p][2]))
            last = p
        out.append((row[0], len(w), len(hit), sorted(x for x in found if x is not None), spans))
    return sorted(out, key=repr)


def table():
    rng = random.Random(4)
    docs = awkward()
    items = [("7", docs[6][1].split("\n")[0].upper()), ("10", docs[3][1]), ("2", "x"), ("2", "")]
    items += [("9", None), ("11", "…!?"), (None, docs[4][1]), ("7", "12, 34"), ("8", "same " * 40)]
    items += [("5", prose(rng, 9000)), ("6", "é ÀÉ\n" * 3)]
    long = items[9][1]
    docs += [
        (100, "A—b… " + docs[6][1][:200].replace(" ", ",\n") + " the end", None, None, None),
        (101, "Öffnen; " * 60_000 + docs[6][1] + "." * 700_000 + " X ", None, None, None),
        (102, "y" * 1_200_000 + " x", None, None, None),
        (103, "before " + long[20_000:45_000] + " after", None, None, None),
        (None, "x", None, None, None),
        (100, "x x", None, None, None),
    ]
    return docs, items


def check(spark, docs, items, **options):
    left = spark.createDataFrame(docs, SCHEMA + ", row long, item string")
    right = spark.createDataFrame(items, "item_id string, text string, row long")
    got = d.find_items(left.repartition(5), right, **options).collect()
    out = []
    for r in got:
        n_hit = sum(x["last"] - x["first"] + 1 for x in r["runs"])
        spans = [(x["start"], x["end"]) for x in r["runs"]]
        out.append((r["doc_id"], r["n_words"], n_hit, list(r["items"]), spans))
    assert sorted(out, key=repr) == brute(docs, [i[:2] for i in items])


def test_found_like_brute_force(spark):
    docs, items = table()
    rows, named = [(*r, 1, "z") for r in docs], [(*i, 2) for i in items]
    check(spark, rows, named)
    check(spark, rows, named, block_bytes=20_000)


def test_empty_tables(spark):
    docs, items = table()
    rows, named = [(*r, 1, "z") for r in docs[:4]], [(*i, 2) for i in items]
    check(spark, rows, [])
    check(spark, [], named)
    check(spark, [], [])


def test_digest(spark):
    docs = spark.createDataFrame([(1, "a b 10"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(10, "B"), (9, "a"), (9, "c")], "item_id long, text string")
    one, two = d.contamination(docs, items).orderBy("doc_id").collect()
    assert (one["n_words"], one["n_hit"], one["n_items"], one["contaminated"]) == (3, 2, 2, True)
    assert one["items_sha256"] == hashlib.sha256(b"10,9").hexdigest()
    assert (two["n_hit"], two["contaminated"]) == (0, False)
    assert two["items_sha256"] == hashlib.sha256(b"").hexdigest()
