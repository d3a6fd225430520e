"""MinHash, suffixes, lines and components against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, awkward, distance, edited, groups, lines_left, near_duplicates, prose, removed
from pyspark.sql import functions as F

from echotide.llm import graph, lines, minhash, suffixes
from echotide.llm.common import numbered


@pytest.mark.parametrize("shape", ["chain", "star", "mixed", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)] + [(7, 7)],
        "mixed": [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] * 2,
        "none": [],
    }[shape]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    assert {r["id"]: r["root"] for r in got} == groups(nodes, edges) and len(got) == len(nodes)


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    signer = minhash.Signer()
    pool = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for common in (500, 1000, 1800):
        a, b = pool[: 1000 + common // 2], pool[1000 - common // 2 : 2000]
        similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        agree = (signer(a) == signer(b)).mean()
        assert abs(agree - similarity) < 4 * (similarity * (1 - similarity) / minhash.COORDINATES) ** 0.5


def families() -> list[tuple]:
    rng = random.Random(8)
    rows = []
    for _ in range(12):
        base = prose(rng, rng.randint(8, 150))
        for share in (0.0, 0.005, 0.02, 0.04, 0.3):
            rows.append(edited(rng, base, share) if share else base)
    # A chain: neighbours are similar, the ends are not.
    words = prose(rng, 200).split(" ")
    rows += [" ".join(words[k : k + 100]) for k in range(0, 100, 8)]
    rng.shuffle(rows)
    return [(100 + i, t, "en", "s", 0) for i, t in enumerate(rows)]


def test_near_duplicates(spark):
    rows = awkward() + families()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("kept", F.lit("x"))
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    want = near_duplicates(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want


@pytest.mark.parametrize(("turns", "block"), [(2, 2000), (0, 7)])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, turns, block):
    """Members that the centre of their bucket does not reach are still linked, in any blocks."""
    rng = random.Random(9)
    base = prose(rng, 120)
    rows = [(i, edited(rng, base, 0.025), "en", "s", 0) for i in range(80)]
    monkeypatch.setattr(minhash, "CENTRE_TURNS", turns)
    monkeypatch.setattr(minhash, "BLOCK", block)
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = near_duplicates(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want


def test_partners_leave_out_sets_that_surely_differ():
    """Members of a group that are just too unlike are told apart before their sets are compared."""
    rng = np.random.default_rng(17)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    changed = [80] * 60 + [24] * 6  # of 400 shingles
    sets = [np.r_[base[rng.permutation(400)[k:]], rng.integers(0, 1 << 62, k).astype(np.uint64)] for k in changed]
    signer, n = minhash.Signer(), 2 * len(sets)
    odd = np.frombuffer(b"".join(map(minhash.odd_places, sets)), np.uint64).reshape(len(sets), -1)
    one = {"n_shingles": np.full(len(sets), 400), "odd": odd, "id": np.arange(len(sets))}
    one["signature"] = np.vstack([signer(s) for s in sets]).astype(np.uint8)
    rows = {c: np.concatenate([x, x]) for c, x in one.items()}
    rows |= {"root": rows["id"], "ask": np.arange(n) < len(sets), "place": np.zeros(n, np.int64)}
    rows["bands"] = np.zeros((n, minhash.BANDS), np.int64)
    found = set(zip(*(x.tolist() for x in minhash.partners(rows, None)), strict=True))
    common = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    every = {(a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b}
    links = {(a, b) for a, b in every if common(a, b) * 100 >= (800 - common(a, b)) * minhash.PERCENT}
    assert len(links) >= 30 and links <= found
    assert len(found) <= len(links) + len(every) // 20


def test_near_duplicates_of_odd_ids(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (1, "A B c d e f"), (5, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got)
    assert found == [(-1, 1, False), (1, 1, True), (3, 1, False), (3, 1, False), (5, 5, True)] or found[1:] == [
        (1, 1, True), (3, 1, False), (3, 1, False), (5, 5, True)
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0


def test_texts_of_a_repeated_id_are_judged_for_themselves(spark):
    """Each row against the groups of rows; a group goes by its least id."""
    rng = random.Random(10)
    rows = []
    for k in range(8):
        a, b = prose(rng, 60), prose(rng, 60)
        i = 10 * k
        # Both texts of i + 1 have a near copy of their own: of a smaller and of a larger id.
        rows += [(i, edited(rng, a, 0.02)), (i + 1, a), (i + 1, b), (i + 2, edited(rng, b, 0.02))]
        rows += [(i + 1, prose(rng, 60)), (i + 3, a), (None, b), (None, prose(rng, 20))]
    rows += [(None, None), (5, None), (5, ""), (5, "x y"), (5, "x y")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    own = near_duplicates([(k, t) for k, (i, t) in enumerate(rows) if i is not None])
    least = {}
    for k, (_, root, _) in own.items():
        least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    want = []
    for k, (i, t) in enumerate(rows):
        if i is None:
            n = near_duplicates([(0, t)])[0][0]
            want.append((None, n, None, True))
        else:
            n, root, _ = own[k]
            want.append((i, n, least[root], i == least[root]))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_multikey_quicksort():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5000, 40_000):
        keys = [rng.integers(0, 5, n), rng.integers(0, 50, n), rng.integers(0, 1 << 40, n)]
        order = suffixes.multikey_quicksort(keys)
        want = np.lexsort(keys[::-1])
        assert all((k[order] == k[want]).all() for k in keys)


def passages() -> list:
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(5, 60), "abcdé") for _ in range(40)]
    shared = [prose(rng, 14, "abcd") for _ in range(4)]
    for k in range(60):
        a, b = rng.choice(texts), rng.choice(texts)
        texts.append(a[: rng.randint(0, len(a))] + rng.choice(shared) + b[rng.randint(0, len(b)) :])
    texts += [texts[3], texts[3], None, "", "ab" * 200, "x" * 300, "x" * 299, "x" * 40, "y" * 41]
    return texts


@pytest.mark.parametrize(("length", "window"), [(40, 8), (64, 16)])
def test_repeats_are_removed_to_the_byte(spark, length, window):
    texts = passages()
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(5)
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(docs, length, window).collect()}
    raw = [(t or "").encode() for t in texts]
    assert len(got) == len(texts)
    for i, (t, gone) in enumerate(zip(raw, removed(raw, length), strict=True)):
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(t), sum(gone), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_repeats_of_odd_ids(spark):
    same = "q" + prose(random.Random(1), 30)
    rows = [(None, same), (4, same), (4, same), (None, None)]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 40, 8)
    assert sorted(r["n_removed"] for r in got.collect()) == [0] + [len(same)] * 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(700):
        a = [rng.choice("abé😀") for _ in range(rng.randint(1, 14))]
        b = list(a)
        for _ in range(rng.randint(0, edits + 2)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        a, b = "".join(a), "".join(b)
        if b:
            pairs.append((a, b) if len(a) >= len(b) else (b, a))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", lines.within(F.split("a", ""), F.split("b", ""), edits).alias("near"))
    assert all(r["near"] == (distance(r["a"], r["b"]) <= edits) for r in got.collect())
    named = df.select("a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
    near = sorted((r["a"], r["b"]) for r in lines.near_pairs(named, edits).collect())
    assert near == sorted(p for p in pairs if distance(*p) <= edits)


def line_rows() -> list[tuple]:
    rng = random.Random(15)
    pool = [prose(rng, rng.randint(1, 12), "abcé") for _ in range(60)]
    head = prose(rng, 6)  # very common first segment
    pool += [head + prose(rng, 3) for _ in range(30)]
    rows = []
    for i in range(70):
        out = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(line) + 1)
                line = line[:at] + rng.choice(["", "z"]) + line[at + rng.randint(0, 1) :]
            out.append(line)
            if rng.random() < 0.2:
                out.append(rng.choice(["", "  ", "short"]))
        rows.append((i * 3, "\n".join(out), "en", "s", 0))
    return rows + [(500, None, None, None, None), (501, "", "en", "s", 0)]


@pytest.mark.parametrize(("edits", "often"), [(1, 100), (2, 100), (2, 0), (2, 2)])
def test_line_dedup(spark, edits, often, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_OFTEN", often)
    rows = line_rows() + [(1000 + r[0], *r[1:]) for r in awkward()]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("r")).withColumn("place", F.lit("p"))
    out = lines.dedup_lines(docs, edits).collect()
    want = lines_left(rows, edits, lines.LEAST_CHARS)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_copies"], r["n_near"]) for r in out}
    assert got == want and len(out) == len(rows)
    assert {(r["row"], r["place"]) for r in out} == {("r", "p")}


def test_line_dedup_of_odd_ids(spark):
    line = "a line that is long enough"
    rows = [(2, line), (2, line), (None, line + "s"), (None, None)]
    out = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in out) == [
        (-1, ""), (-1, line + "s"), (2, ""), (2, "")
    ]
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_template_lines_meet_without_pairs(spark):
    """Lines of one template that differ by words share keys, but only near ones become pairs."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzабвгдежзиклмно"
    head = prose(rng, 12, letters)
    middle = ["".join(rng.choices(letters, k=30)) for _ in range(60)]  # of one length
    family = [f"{head} {words} {head}" for words in middle]
    rows = [(i, line) for i, line in enumerate([*family, family[7] + "z"])]
    docs = spark.createDataFrame(rows, "row long, text string")
    docs = docs.withColumn("doc_id", F.col("row"))
    found = lines.numbered_lines(docs).select("row", "place", *lines._identity("line"))
    firsts = found.withColumn("n_lines", F.lit(1).cast("long"))
    shared = lines.sharing(lines.numbered_lines(docs), firsts, 2)
    assert shared.select(*lines.LINE).distinct().count() == len(rows)
    texts = lines.first_texts(docs, found)
    texts = texts.withColumn("n", F.char_length("line"))
    texts = texts.withColumn("odd", lines.parities(F.col("line")))
    pairs = lines.met(shared, texts, 2)
    assert 1 <= pairs.count() <= len(rows)
    assert lines.near_links(docs, firsts, 2).count() == 1


def test_lines_with_letters_at_several_places_meet_without_pairs(spark):
    """Copies of a long line, each with letters added at places of its own, have equal lengths and
    often like parities of characters; their neighbouring characters tell them apart."""
    rng = random.Random(16)
    words = prose(rng, 60).split(" ")
    family = []
    for _ in range(120):
        at = rng.randrange(len(words))
        added = "".join(rng.choices("abcdefghijklmnop", k=4))
        family.append(" ".join([*words[:at], words[at] + added, *words[at + 1 :]]))
    near = [family[0] + "z", family[1][:-1], "z" + family[2][:40] + family[2][41:]]
    docs = spark.createDataFrame(list(enumerate([*family, *near])), "row long, text string")
    docs = docs.withColumn("doc_id", F.col("row"))
    found = lines.numbered_lines(docs).select("row", "place", *lines._identity("line"))
    firsts = found.withColumn("n_lines", F.lit(1).cast("long"))
    shared = lines.sharing(lines.numbered_lines(docs), firsts, 2)
    texts = lines.first_texts(docs, found)
    texts = texts.withColumn("n", F.char_length("line"))
    texts = texts.withColumn("odd", lines.parities(F.col("line")))
    pairs = lines.met(shared, texts, 2)
    assert pairs.count() <= 4 * len(family)
    every = [*family, *near]
    unlike = lambda a, b: ((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).total()
    few = [(a, b) for i, a in enumerate(every) for b in every[:i] if a != b and unlike(a, b) <= 4]
    few = [(a, b) for a, b in few if unlike([*zip(a, a[1:])], [*zip(b, b[1:])]) <= 8]
    want = sum(distance(a, b) <= 2 for a, b in few)
    assert want >= len(near) and lines.near_links(docs, firsts, 2).count() == want


def test_line_dedup_has_no_python(spark):
    docs = spark.createDataFrame(line_rows(), SCHEMA)
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_rows_get_numbers_only_where_ids_do_not_serve(spark):
    good = numbered(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"))
    assert {(r["doc_id"], r["row"]) for r in good.collect()} == {(1, 1), (2, 2)}
    bad = numbered(spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, text string"))
    assert len({r["row"] for r in bad.collect()}) == 3
