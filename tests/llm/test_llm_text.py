"""Toxicity, language and quality rules."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from cases import SCHEMA, WORD, awkward, prose

from echotide.llm import language, quality, queries, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.mark.parametrize(
    ("written", "plain"),
    [
        ("ID1OT", "idiot"), ("Ιdіоt", "idiot"), ("1d10t", "idiot"), ("$cum!", "scum!"),
        ("tr@sh", "trash"), ("worthle55", "worthless"), ("idíot", "idiot"), ("2013", "2013"),
        ("1st 4am", "1st 4am"), ("of$$$", "of$$$"), ("ｉｄｉｏｔ", "idiot"), ("", ""),
    ],
)
def test_fold(written, plain):
    assert toxicity.fold(written) == plain


def test_terms_count_as_whole_words_outside_exceptions():
    lexicon = toxicity.Lexicon({"scum": 2.0, "trash": 1.0}, ["trash can"])
    automaton = lexicon.automaton()
    assert toxicity.measure("Scum, scumble trash", automaton) == (3.0, 3)
    assert toxicity.measure("a trash can and trash", automaton) == (1.0, 5)
    assert toxicity.measure(None, automaton) == (0.0, 0)
    assert toxicity.measure("x", toxicity.Lexicon({}).automaton()) == (0.0, 1)


def test_toxicity_learns_terms_and_exceptions(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(rng, 30)
        if bad:
            text += " " + rng.choice(["mudhead", "mudh3ad", "grubling"]) + " " + prose(rng, 3)
        elif i % 40 == 1:
            text += " old grubling stew"
        rows.append((i, text, "x"))
        labels.append((i, int(bad)))
    labels += [(None, 1), (7, None), (9999, 1)]
    rows += [(None, None, "x"), (1000, "", "x"), (1001, "Mudhéad", "x"), (1001, "Mudhéad", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, marked)
    assert {"mudhead", "grubling"} <= set(lexicon.weights)
    assert "grubling stew" in lexicon.exceptions
    out = toxicity.score(docs, lexicon).toPandas()
    assert len(out) == len(rows) and out["score"].between(0, 1).all()
    by = out[out["doc_id"] < 400].set_index("doc_id")
    assert all(by["predicted"][i] == int(i % 4 == 0) for i in range(400))
    assert out[out["doc_id"] == 1001]["predicted"].tolist() == [1, 1]
    assert out[out["doc_id"].isna() | (out["doc_id"] == 1000)]["predicted"].tolist() == [0, 0]


def test_toxicity_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, none)
    out = toxicity.score(docs, lexicon).toPandas()
    assert len(out) == len(awkward()) and (out["predicted"] == 0).all()
    assert toxicity.score(docs.limit(0), lexicon).count() == 0


def test_language(spark):
    rng = random.Random(5)
    kinds = {"aa": "aeioukl", "bb": "aeioszt", "cc": "éèàaoprt"}
    rows = [
        (i, prose(rng, 40, kinds[lang]), lang, "k") for i in range(150) for lang in [list(kinds)[i % 3]]
    ]
    rows += [(200, None, "aa", "k"), (201, " 12 …", "bb", "k"), (202, "", None, "k")]
    rows += [(203, prose(rng, 20_000, "aeioukl"), None, "k"), (None, "kalu keli", None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    filters = language.fit(docs.filter("doc_id < 120 or doc_id > 199"))
    out = language.predict(docs, filters).toPandas()
    assert len(out) == len(rows) and out["score"].between(0, 1).all()
    by = out.dropna(subset="doc_id").set_index("doc_id")["lang_pred"]
    assert all(by[i] == list(kinds)[i % 3] for i in range(150))
    assert [by[i] for i in (200, 201, 202, 203)] == ["und", "und", "und", "aa"]
    empty = language.fit(docs.limit(0))
    assert set(language.predict(docs, empty).toPandas()["lang_pred"]) == {"und"}


def test_every_language_is_learned(spark):
    """More languages than a mask word has bits, one of few texts and one of copies only."""
    rng = random.Random(7)
    rows = []
    for k in range(140):
        alphabet = "".join(chr(0x4E00 + 9 * k + j) for j in range(9))
        copies = prose(rng, 30, alphabet)
        for i in range(1 if k == 3 else 4):
            rows.append((len(rows), copies if k == 5 else prose(rng, 30, alphabet), f"l{k:03}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    # At most one text of each language where its hash allows.
    for most in (40_000, 140):
        filters = language.fit(docs, most=most)
        assert len(filters.languages) == 140
        out = language.predict(docs, filters, ("doc_id", "lang")).toPandas()
        assert len(out) == len(rows) and (out["lang_pred"] == out["lang"]).mean() > 0.99


def test_filters_name_all_languages_and_know_their_error():
    rng = np.random.default_rng(1)
    grams = language.mix(rng.integers(1, 1 << 62, 60_000).astype(np.uint64)).view(np.int64)
    table = pd.DataFrame({"lang": np.repeat(["a", "b"], 30_000), "gram": grams})
    table.loc[len(table)] = ["b", grams[0]]
    filters = language.build(table, ["a", "b"])
    mask = filters.look(grams.view(np.uint64))
    assert (mask[:30_000] & 1 == 1).all() and (mask[30_000:] & 2 == 2).all() and mask[0] == 3
    wrong = (mask[1:30_000] & 2 == 2).mean()
    assert abs(wrong - filters.chance[1]) < 0.3 * filters.chance[1] + 1e-3


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = set()
    for k in range(len(words) - 7):
        if seen[tuple(words[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_statistics(spark):
    rows = awkward() + [
        (90, "a b\na b\n \n \nc", "en", "s", 1), (90, "a#*$%&|<>", "en", "s", 1),
        (None, "one two three four five six seven eight " * 2, "en", "s", 1),
        (91, "w " * 9, "en", "s", 1), (92, "\x1ca b \x0bc", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = quality.statistics(docs, ("doc_id", "text")).toPandas()
    assert len(got) == len(rows)
    for r in got.itertuples():
        own = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert own == brute_statistics(r.text), r.text
    assert quality.statistics(docs.limit(0)).count() == 0


def test_rules_are_learned_pruned_and_applied(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = prose(rng, 60)
        if bad:
            text = text.replace(" ", "%%% ") if i % 2 else text.upper()
        rows.append((i, text, "en", "s", 0))
        labels.append((i, int(not bad), i))
    rows += [(None, None, None, None, None), (700, "", "en", "s", 0), (700, prose(rng, 50), "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marked = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, n_words long")
    rules = quality.fit(docs, marked)
    assert 1 <= len(rules) <= 4 and all(len(r) <= quality.MOST_CONDITIONS for r in rules)
    out = quality.judge(quality.statistics(docs), rules).toPandas()
    assert len(out) == len(rows)
    assert out["base_failed"].tolist() == [
        r[1] is None or len(r[1].split()) < 20 for r in rows
    ]
    known = out[(out["doc_id"] < 600)]
    assert (known["kept"] == (known["doc_id"] % 3 != 0)).mean() > 0.99
    none = quality.fit(docs, marked.limit(0))
    assert none == []
    free = quality.judge(quality.statistics(docs), none).toPandas()
    assert (free["kept"] == ~free["base_failed"]).all()


def test_fitting_takes_at_most_the_stated_number_of_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, quality int")
    assert isinstance(quality.fit(docs, labels, most=5), list)


def test_held_out_is_never_null(spark):
    ids = spark.createDataFrame([(None,), (0,), (1,), (2,), (3,)], "doc_id long")
    got = {r[0]: r[1] for r in ids.select("doc_id", queries.held_out(4, 2)).collect()}
    assert got[None] is False
    assert all(got[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(4))
