"""The prefix trie against brute force, with shards and blocks of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from echotide.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, a string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = xxhash.xxh64_intdigest(text, 42)
            mark -= (mark >> 63) << 64
            own[conv].append((turn is not None, turn or 0, role.encode(), mark, text))
    for turns in own.values():
        turns.sort()
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = own.get(conv - (abs(conv) % 100) * (1 if conv >= 0 else -1), [])
        built[conv] = tuple((r, x) for _, _, r, _, x in head[:h] + turns[h:])
    members = defaultdict(list)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        value = (len(convs) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += value
            leaves[path[:d]] += not kids[path]
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == path)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), kids[path], leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table():
    rng, rows = random.Random(6), []
    def add(conv, texts):
        for k, text in enumerate(texts):
            rows.append((conv, k, "user" if k % 2 == 0 else "assistant", text))
    common = ["hello there", "hi, what can I do?"]
    for conv in [*range(0, 60), *range(100, 140), *range(300, 330), -5, -100, -101, 407, 512]:
        kind = rng.random()
        start = common if kind < 0.6 else []
        add(conv, start + [rng.choice(["é" * 3, "b", "c d", ""]) for _ in range(rng.randint(0, 7))])
    add(700, [f"turn {k}" for k in range(150)])
    add(701, [f"turn {k}" for k in range(140)] + ["other"] * 5)
    for conv in range(705, 760):
        add(conv, [f"turn {k}" for k in range(9)])
    rows += [(900, None, None, None), (900, None, None, None), (900, 3, None, "x"), (900, 3, "a", "y")]
    rows += [(900, 3, "a", "x"), (900, 3, "a", "x"), (None, 1, "user", "nobody"), (901, -4, "", "")]
    rows += [(999, 0, "user", "long " * 100_000), (999, 1, None, "long " * 100_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, block, most", [(20_000, 1024, 1000), (40, 7, 3), (1, 1024, 1), (300, 3, 2)])
def test_like_brute_force(spark, shard, block, most):
    rows = [(*r, 5, "z") for r in table()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = trie.prefix_trie(df, shard=shard, block=block, most=most).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_empty(spark):
    for rows in ([], [(None, 1, "user", "x", 1, "a")]):
        assert trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect() == []


@pytest.mark.parametrize("most", [1, 3, 50])
def test_queue_gives_messages_in_order(most):
    rng, queue, sent, got = random.Random(most), trie.Queue(most), [], []
    places = sorted({(rng.randint(-9, 0), rng.randint(-3, 3), rng.randint(0, 3)) for _ in range(120)})
    for k, place in enumerate(places):
        got += queue.take(place)
        for _ in range(rng.randint(0, 4)):
            if k + 1 < len(places):
                m = (*rng.choice(places[k + 1 :]), rng.randint(0, 5), 1, 2)
                sent.append(m)
                queue.push(m)
    assert [m[:3] for m in got] == sorted(m[:3] for m in sent) and sorted(got) == sorted(sent)
