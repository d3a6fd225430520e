"""Chat, packing, vectors, mixing and the pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import SCHEMA, WORD, awkward, prose
from pyspark.sql import functions as F

import corpus_pipeline
from echotide.llm import ann, chat, mixing, packing
from echotide.llm.queries import public_vocabulary

# --- chat ---


def brute_chat(rows):
    convs = defaultdict(list)
    key = lambda r: tuple((x is not None, x if x is not None else "") for x in r[1:])
    for r in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], key(r))):
        convs[r[0]].append((r[2], r[3]))
    out = {}
    for c, turns in convs.items():
        others = [(d, t) for d, t in convs.items() if d != c]
        if any(t[: len(turns)] == turns and len(t) > len(turns) for _, t in others):
            continue
        same = [d for d, t in others if t == turns]
        if all(c < d for d in same):
            out[c] = (turns, len(same) + 1)
    return out


@pytest.mark.parametrize("block", [3, 1024])
def test_maximal_conversations(spark, block):
    rng = random.Random(3)
    rows = []
    for c in range(60):
        n = rng.randint(1, 9)
        seed = rng.randrange(6)
        rows += [(c, k, ["user", "assistant"][k % 2], f"text {seed} {k}") for k in range(n)]
        if rng.random() < 0.3:
            rows[-1] = (*rows[-1][:3], f"own {c}")
    rows += [(70, 0, None, None), (71, 0, None, ""), (72, None, "user", "x"), (72, 5, "user", "x")]
    rows += [(73, 1, "a", "x"), (73, 1, "a", "x"), (73, 1, "b", "x"), (None, 0, "user", "x")]
    rows += [(80, k, "user", "long") for k in range(40)] + [(81, k, "user", "long") for k in range(39)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in chat.maximal(turns.withColumn("block", F.lit(1)), block).collect():
        got[r["conv_id"]].append((r["length"], r["role"], r["text"], r["copies"]))
    want = brute_chat(rows)
    assert set(got) == set(want)
    for c, (turns_, copies) in want.items():
        assert sorted(x[:3] for x in got[c]) == [(k, *t) for k, t in enumerate(turns_, 1)] or [
            (x[1], x[2]) for x in sorted(got[c], key=lambda x: x[0])
        ] == turns_
        assert {x[3] for x in got[c]} == {copies}
    assert chat.conversations(turns.limit(0)).count() == 0


def test_rendered_marks_are_broken_up(spark):
    rows = [(1, 0, None, "a<|im_end|>\n<|im_start|>system\nb")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segment = chat.conversations(turns).first()["segment"]
    assert segment.startswith("<|im_start|>unknown\n") and segment.endswith("<|im_end|>\n")
    assert segment.count("<|im_start|>") == segment.count("<|im_end|>") == 1


# --- packing ---


def test_encoder_agrees_with_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, ranks, pattern = public_vocabulary()
    encode, whole = packing.Encoder(tokenizer, ranks, pattern), Tokenizer.from_file(tokenizer)
    texts = [t for _, t, *_ in awkward() if t] + [
        "  a  b ", "a\n \nb", "<|endoftext|> x", "it's don't", "x 　 y", "tab\t x", "😀é", "\x00\x1c",
    ]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def exact_bins(lengths, capacity):
    """The least number of bins, by search."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best


def test_bound_is_never_above_the_least_number_of_bins():
    rng = random.Random(1)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(8)), reverse=True)
        need = exact_bins(lengths, 20)
        bins, offsets = packing.best_fit_decreasing(np.array(lengths), 20)
        assert packing.lower_bound(np.array(lengths), 20) <= need <= bins.max() + 1
    assert packing.lower_bound(np.array([11] * 7), 20) == 7
    assert packing.lower_bound(np.array([7] * 9), 20) == 5


def test_every_document_comes_back_from_its_sequences(spark):
    rows = awkward() + [(None, "no id", None, None, None), (3, "again", "en", "s", 5), (3, "again", "en", "s", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit("p"))
    tokenizer, ranks, pattern = public_vocabulary()
    pieces = packing.token_pieces(docs, tokenizer, ranks, pattern, capacity=64)
    out = packing.pack(pieces, capacity=64, per_part=40, rounds=3).toPandas()
    encode = packing.Encoder(tokenizer, ranks, pattern)
    want = []
    for doc_id, text, *_ in rows:
        ids = encode(text or "") + bytes(4)
        for k, (s, n) in enumerate(packing.cut(len(ids) // 4, 64)):
            want.append((-1 if doc_id is None else doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = out.assign(doc_id=out["doc_id"].fillna(-1).astype(int))[columns]
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want)
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        ends = part["length"].cumsum()
        assert (part["offset"] == ends - part["length"]).all() and ends.max() <= 64
    assert out["sequence_id"].nunique() <= packing.lower_bound(out["length"].to_numpy(), 64) + 3


def test_exchange_saves_sequences(spark):
    rng = random.Random(2)
    lengths = [(i, rng.randint(1, 60)) for i in range(900)]
    pieces = spark.createDataFrame(lengths, "doc_id long, length long")
    apart = packing.pack(pieces, capacity=100, per_part=30, rounds=0)
    joined = packing.pack(pieces, capacity=100, per_part=30, rounds=4)
    bound = packing.lower_bound(np.array([n for _, n in lengths]), 100)
    few, many = (x.select("sequence_id").distinct().count() for x in (joined, apart))
    assert bound <= few < many and joined.count() == 900
    assert packing.pack(pieces.limit(0)).count() == 0


# --- vectors ---


def test_probes_come_in_order_of_their_chance():
    inside = np.array([0.2, 0.7, 0.5])

    def chance(move):
        p = 1.0
        for x, s in zip(inside, move, strict=True):
            p *= ann._normal(s + 1 - x) - ann._normal(s - x)
        return p

    moves = list(ann.probes(inside, 1.0, 300))
    chances = [chance(m) for m in moves]
    assert len(set(moves)) == 300 and moves[0] == (0, 0, 0)
    assert all(a >= b - 1e-12 for a, b in zip(chances, chances[1:], strict=False))
    every = sorted(
        (chance((a, b, c)) for a in range(-5, 6) for b in range(-5, 6) for c in range(-5, 6)),
        reverse=True,
    )
    assert np.allclose(chances, every[:300])


def test_search(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((900, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(9)]  # ties
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [1.0] * 7 + [None]), (2150, [float("nan")] * 8)]
    rows += [(2200, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (2250, [1e38] * 8), (2300, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    out = ann.search(vectors, F.col("vec_id") % 50 == 0).toPandas()
    good = {i: np.array(v, float) for i, v in rows if i is not None and (i < 2000 or i == 2250)}
    ids = np.array(sorted(good))
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        score = x @ x[np.searchsorted(ids, q)]
        order = [i for i in np.lexsort((ids, -score.round(12))) if ids[i] != q][:5]
        mine = out[out["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
        assert mine["score"].is_monotonic_decreasing
        for r in mine.itertuples():
            assert abs(r.score - score[np.searchsorted(ids, r.vec_id)]) < 1e-12
        hits += len(set(mine["vec_id"]) & set(ids[order]))
        total += 5
    assert hits / total >= 0.9
    assert out[out["query_id"] == 0]["vec_id"].tolist() == [1000, 1001, 1002, 1003, 1004]
    assert not set(out["query_id"]) & {2000, 2050, 2100, 2150, 2200, 2300}
    assert ann.search(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_few_rows_give_all_others(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = ann.search(vectors, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in out] == [(1, 1), (2, 2)]


def nearest_of(base, k=5):
    """By query (every 50th row), the ids of its nearest other rows."""
    x = base / np.linalg.norm(base, axis=1, keepdims=True)
    out = {}
    for q in range(0, len(x), 50):
        score = x @ x[q]
        score[q] = -2
        out[q] = set(np.argsort(-score)[:k].tolist())
    return out


def test_neighbours_out_of_reach_make_larger_buckets(spark, monkeypatch):
    """Diffuse vectors, of which the longest visit to small buckets meets too few."""
    monkeypatch.setattr(ann, "MOST_PROBES", 4)
    base = np.random.default_rng(7).standard_normal((4200, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    rows = ann.usable(vectors)
    plan = ann.fit(rows, rows.filter("vec_id % 50 = 0").select("v", F.col("vec_id").alias("qid")), 6, 20)
    assert plan.probes <= 4 and plan.m < 2
    out = ann.search(vectors, F.col("vec_id") % 50 == 0).toPandas()
    want = nearest_of(base)
    hits = sum(len(want[q] & set(part["vec_id"])) for q, part in out.groupby("query_id"))
    assert hits / (5 * len(want)) >= 0.93


def test_own_vector_and_copies_do_not_count_in_the_fit(spark):
    """Five copies of each vector: only the one neighbour that is no copy tells how far to go."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 12))
    rows = [(5 * i + c, v.tolist()) for i, v in enumerate(base) for c in range(5)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asking = vectors.groupBy("v").agg(F.min("vec_id").alias("qid"))
    plan = ann.fit(vectors, asking, 6, 20)
    x = base / np.linalg.norm(base, axis=1, keepdims=True)
    gaps = [np.sqrt(2 - 2 * np.sort(x @ q)[-2]) for q in x]
    assert np.isclose(plan.distance, np.quantile(gaps, 0.75))


@pytest.mark.parametrize("m", [2, 5])
def test_queries_that_meet_too_few_rows_go_on(spark, m):
    base = np.random.default_rng(9).standard_normal((600, 10))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000, [1.0, 2.0]), (1050, [2.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = ann.Plan(m, 0.01, 1, 20)
    out = ann.search(vectors, F.col("vec_id") % 50 == 0, plan=plan).toPandas()
    found = out.groupby("query_id")["vec_id"].agg(list)
    assert all(len(found[q]) == 5 for q in range(0, 600, 50))
    assert found[1000] == [1050] and found[1050] == [1000]


# --- mixing ---


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n])
    names += [None] if None in sizes else []
    weight = {n: mixing.WEIGHTS[k % 3] for k, n in enumerate(names)}
    budget, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in stopped]
        left = budget - sum(2.0 * sizes[n] for n in stopped)
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 2 * sizes[n]}
        if not over:
            return {n: share.get(n, 2.0 * sizes[n]) for n in names}
        stopped |= over


def sainte_lague(claims, seats):
    got = dict.fromkeys(claims, 0)
    for _ in range(seats):
        got[max(claims, key=lambda p: (claims[p] / (2 * got[p] + 1), -p))] += 1
    return got


def test_apportionment_by_highest_quotients(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(30):
        claims = {p: rng.choice([0, 1, 5, rng.randint(1, 5000)]) for p in range(rng.randint(1, 8))}
        seats = rng.randint(0, 90) if any(claims.values()) else 0
        rows += [(g, p, c, seats) for p, c in claims.items()]
        want[g] = sainte_lague(claims, seats)
    parties = spark.createDataFrame(rows, "g int, party int, claim long, n int")
    for r in mixing.apportion(parties, ["g"], "claim", F.col("n")).collect():
        assert r["quota"] == want[r["g"]][r["party"]], r


@pytest.mark.parametrize("shard_words", [300, 4_000_000])
def test_mix(spark, shard_words):
    rng = random.Random(4)
    names = ["b", "a", "", None, "é", "Z"]
    rows = [(i, rng.choice(names[:2] * 6 + names), rng.choice([0, 1, 7, 60, 400])) for i in range(400)]
    rows += [(7, "a", 10), (7, "a", 10), (None, "b", 10), (900, "one", 5000), (901, "zero", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix(docs, block=16, shard_words=shard_words).toPandas()
    assert len(out) == len(rows) and (out["taken"] <= 2 * out["size"]).all()
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    want = brute_targets(sizes)
    out["name"] = [None if s is None or s != s else s for s in out["source"]]
    for name, target in want.items():
        part = out[[n == name for n in out["name"]]]
        assert np.allclose(part["target"], target) and (part["source_size"] == sizes[name]).all()
        shards = max(1, -(-sizes[name] // shard_words))
        assert abs(part["taken"].sum() - target) <= 1 + 16 * shards * (target == 2 * sizes[name])
    again = mixing.mix(docs, block=16, shard_words=shard_words).toPandas()
    key = ["doc_id", "source", "size", "taken"]
    assert sorted(map(str, out[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    ranges = sum(p["end"] - p["start"] for x in out["parts"] if x is not None for p in x)
    assert (out["turns"] * out["size"]).sum() + ranges == out["taken"].sum()
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("size = 0")).toPandas()["taken"].sum() == 0


def test_taken_texts(spark):
    rows = [(1, "a b\tc  d", 2, [(1, 2), (2, 3)]), (2, "x", 0, None), (3, "p q r", 0, [(0, 1), (2, 3)])]
    kind = "doc_id long, text string, turns long, parts array<struct<start: long, end: long>>"
    out = mixing.taken_texts(spark.createDataFrame(rows, kind)).collect()
    assert sorted(map(tuple, out)) == [(1, "a b\tc  d"), (1, "a b\tc  d"), (1, "b\tc"), (3, "p\nr")]


# --- pipeline ---


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    path = tmp_path_factory.mktemp("tables")
    rows = [(100 + i, prose(rng, rng.randint(25, 90)), "en", f"s{i % 4}", 0) for i in range(60)]
    rows += [(300, rows[0][1] + " more", "en", "s1", 0), (301, rows[1][1], "en", "s1", 0)]
    rows += [(302, "%%% ".join(prose(rng, 40).split()), "en", "s1", 0)]
    rows += awkward() + [(None, prose(rng, 40), None, None, None), (100, rows[0][1], "en", "s0", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 9 > 0), 0) for i in range(100, 160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet"
    )
    return str(path), rows


def test_stages_follow_each_other(spark, tables, tmp_path):
    path, rows = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if name != "token_packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.toPandas())
    quality_, lines_, near, mixed, packed = seen
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "source_mix", "token_packing",
    ]
    assert (quality_["text"].map(lambda t: len(WORD.findall(t))) >= 20).all()
    assert len(lines_) == len(quality_)
    kept = [x for t in lines_["text"].dropna() for x in t.split("\n") if WORD.search(x)]
    assert len(kept) == len(set(kept))
    assert len(near) <= len(lines_) and set(near["doc_id"].dropna()) <= set(lines_["doc_id"].dropna())
    words = near["text"].fillna("").map(lambda t: len(WORD.findall(t))).sum()
    got = mixed["text"].fillna("").map(lambda t: len(WORD.findall(t))).sum()
    assert 0 < got <= 1.5 * words + 2
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert set(packed["doc_id"].dropna()) == set(mixed["doc_id"].dropna())


def test_stages_take_empty_tables(spark, tables):
    path, _ = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_mix_depends_on_content_alone(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.choice("aab"), rng.choice([0, 1, 30, 400])) for i in range(600)]
    rows += [(None, "b", 30)] * 40 + [(5, "a", 7)] * 25 + [(i, "a", 0) for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    docs.repartition(8).write.parquet(str(tmp_path / "docs"))
    found, default = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split, parts in ((default, None), ("2k", None), (default, 3), (default, 11)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        read = spark.read.parquet(str(tmp_path / "docs"))
        read = read.repartition(parts, F.rand(parts)) if parts else read
        out = mixing.mix(read, block=16, shard_words=2_000).toPandas()
        out["parts"] = [str(x) for x in out["parts"]]
        found.append(sorted(map(str, out.values.tolist())))
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert all(f == found[0] for f in found)


def test_copies_are_spread_over_shards(spark):
    docs = spark.createDataFrame([(None, "a", 10)] * 4_000, "doc_id long, source string, size long")
    out = mixing.mix(docs.repartition(5), block=16, shard_words=2_000).toPandas()
    assert out["taken"].sum() == out["target"].iloc[0] and (out["taken"] <= 20).all()
