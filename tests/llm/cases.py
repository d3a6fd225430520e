"""Small tables with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, alphabet: str = "aeiounrst") -> str:
    return " ".join(
        "".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)
    )


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def awkward(seed: int = 1) -> list[tuple]:
    """Null, empty and blank texts, long ones, copies exact and near, null fields."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (3, 4, 5, 30, 80, 80, 200)]
    base += [base[4], edited(rng, base[4], 0.02), edited(rng, base[6], 0.01), base[3].upper()]
    base += [None, "", " \t\n ", "é", "x", "x", "ÀÉ " * 30, "same " * 3000, prose(rng, 6000)]
    base += [base[6] + "\n" + base[5], "begin " + base[6] + " end", "12 34", "…"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(base)]
    rows[5] = (5, base[5], None, None, None)
    return rows


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def groups(ids: list, links: list[tuple]) -> dict:
    """The least id each one reaches."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(rows: list[tuple]) -> dict:
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                links.append((a, b))
    root = groups(ids, links)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def removed(texts: list[bytes], length: int) -> list[list[bool]]:
    counts = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        out.append(gone)
    return out


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines_left(rows: list[tuple], edits: int, least: int) -> dict:
    """By id, the text left and the counts of lines, copies and near lines."""
    first: dict[str, tuple] = {}
    for doc_id, text, *_ in sorted(rows, key=lambda r: r[0]):
        for place, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                first.setdefault(line, (doc_id, place))
    near = set()
    long = sorted((x for x in first if len(x) >= least), key=first.get)
    for k, line in enumerate(long):
        if any(
            abs(len(line) - len(e)) <= edits and distance(line, e) <= edits for e in long[:k]
        ):
            near.add(line)
    out = {}
    for doc_id, text, *_ in rows:
        kept, n, copies, close = [], 0, 0, 0
        for place, line in enumerate((text or "").split("\n")):
            if not WORD.search(line):
                kept.append(line)
                continue
            n += 1
            if first[line] != (doc_id, place):
                copies += 1
            elif line in near:
                close += 1
            else:
                kept.append(line)
        out[doc_id] = (None if text is None else "\n".join(kept), n, copies, close)
    return out
