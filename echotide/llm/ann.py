"""Nearest vectors by cosine, through multiprobe p-stable hashing.

Vectors are scaled to length one, where the nearest by cosine are the nearest by distance. A table
hashes a vector by the slots of width ``WIDTH`` that its projections on ``m`` random Gaussian
directions fall into. A query visits the buckets around its own in the order of the chance that a
neighbour at the measured distance falls into them. Candidates of all tables are merged and ranked
by exact cosine in double precision.

How many buckets are visited is not guessed: for a bounded sample of queries the true neighbours
are found by one linear pass over all rows, and the shortest visit that reaches the wanted recall
on them is used for all. If no visit of at most ``MOST_PROBES`` buckets does, there are fewer
functions, so larger buckets, until one does. A query that meets too few rows visits further
buckets, and in the end is held against all rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

TABLES = 2
WIDTH = 1.0
RECALL = 0.96
SAMPLE = 200
MOST_PROBES = 20_000
BLOCK = 4_000
REACH = 5  # slots to either side that a probe may move
FURTHER = 8  # times as many probes for queries that met too few rows


@dataclass
class Plan:
    """The fitted search: functions per table, distance of neighbours, probes per table. Without
    functions all rows of a length are in one bucket, and the search is exact."""

    m: int
    distance: float
    probes: int
    seed: int
    tables: int = TABLES

    def exact(self) -> Plan:
        return replace(self, m=0, probes=1, tables=1)

    def most(self) -> int:
        """The number of buckets that a visit can reach at most."""
        return min(MOST_PROBES, (2 * REACH + 1) ** self.m)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors in double precision that are not null, not zero and wholly finite."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long"), v.alias("v")
    ).filter(
        finite & F.exists("v", lambda x: x != 0)
    )


def directions(dim: int, table: int, m: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, table, dim])
    return rng.standard_normal((dim, m)), rng.uniform(0, WIDTH, m)


def unit(v: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square over- or underflows.
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def slots(v: np.ndarray, table: int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Slot numbers of unit vectors, and where in its slot each projection lies (0 to 1)."""
    a, b = directions(v.shape[1], table, plan.m, plan.seed)
    x = (v @ a + b) / WIDTH
    number = np.floor(x)
    return number.astype(np.int64), x - number


def code(number: np.ndarray) -> np.ndarray:
    """One long for the slot numbers of a bucket."""
    out = np.full(number.shape[:-1], 17, np.int64)
    with np.errstate(over="ignore"):
        for k in range(number.shape[-1]):
            out = out * np.int64(1_000_003) + number[..., k]
    return out


def _normal(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def probes(inside: np.ndarray, distance: float, most: int) -> Iterator[tuple[int, ...]]:
    """Moves of the slot numbers, likeliest bucket first.

    The projection of a neighbour differs by a Gaussian of deviation ``distance``; the chance of a
    bucket is the product over its slots. Best first search over the slots of each direction in
    order of their chance."""
    lists = []
    for x in inside:
        chance = [
            (
                -math.log(
                    _normal((s + 1 - x) * WIDTH / distance)
                    - _normal((s - x) * WIDTH / distance)
                    + 1e-30
                ),
                s,
            )
            for s in range(-REACH, REACH + 1)
        ]
        lists.append(sorted(chance))
    m = len(lists)
    heap = [(sum(c[0][0] for c in lists), (0,) * m, 0)]
    while heap and most > 0:
        cost, at, last = heapq.heappop(heap)
        yield tuple(lists[i][k][1] for i, k in enumerate(at))
        most -= 1
        # Each choice is reached once: only positions from the last moved one on may advance.
        for i in range(last, m):
            if at[i] + 1 < len(lists[i]):
                step = lists[i][at[i] + 1][0] - lists[i][at[i]][0]
                heapq.heappush(heap, (cost + step, (*at[:i], at[i] + 1, *at[i + 1 :]), i))


def cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row by row, the same for equal rows wherever they stand."""
    q, v = q / np.abs(q).max(axis=1, keepdims=True), v / np.abs(v).max(axis=1, keepdims=True)
    return (q * v).sum(1) / np.sqrt((q * q).sum(1) * (v * v).sum(1))


def best(q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` nearest rows of ``v`` for each row of ``q``: index in ``q``, id, cosine."""
    rough = unit(q) @ unit(v).T
    if v.shape[0] > k:
        edge = np.partition(rough, v.shape[0] - k, axis=1)[:, v.shape[0] - k]
        i, j = np.nonzero(rough >= edge[:, None] - 1e-9)
    else:
        i, j = map(np.ravel, np.indices(rough.shape))
    score = cosine(q[i], v[j])
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    rank = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
    keep = rank < k
    return i[keep], ids[j[keep]], score[keep]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy())


def _top(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    return (
        scored.groupBy("qid", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
    )


def places(
    vectors: dict[int, np.ndarray], near: dict[int, list], plan: Plan
) -> list[int] | None:
    """The place in the visit at which each true neighbour is met, or nothing as soon as too many
    are out of reach for the wanted recall."""
    total = sum(map(len, near.values()))
    spare = total - 1 - math.ceil(RECALL * (total - 1))
    out = []
    for qid, others in near.items():
        q = unit(vectors[qid])
        place = np.full(len(others), MOST_PROBES + 1)
        for t in range(plan.tables):
            own, inside = slots(q, t, plan)
            there = slots(unit(np.vstack(others)), t, plan)[0] - own
            wanted = {}
            for i, move in enumerate(map(tuple, there.tolist())):
                wanted.setdefault(move, []).append(i)
            for rank, move in enumerate(probes(inside[0], plan.distance, MOST_PROBES), 1):
                for i in wanted.pop(move, ()):
                    place[i] = min(place[i], rank)
                if not wanted:
                    break
        spare -= int((place > MOST_PROBES).sum())
        if spare < 0:
            return None
        out.extend(place.tolist())
    return out


def fit(rows: DataFrame, queries: DataFrame, k: int, seed: int) -> Plan:
    """The number of functions by the number of rows, and the shortest visit that finds the true
    neighbours of at most ``SAMPLE`` queries with the wanted recall. The query's own vector and its
    copies, which are met at once, do not count. Where no visit finds enough, there is a function
    less, down to none."""
    n = rows.count()
    m = max(1, round(math.log(max(n, 1) / 500) / math.log(4))) if n > 500 else 1
    plan = Plan(m, 1.0, 1, seed)
    sample = queries.orderBy(F.xxhash64("qid"), "qid").limit(SAMPLE).collect()
    if not sample:
        return plan
    known = {}
    for r in sample:
        known.setdefault(len(r["v"]), []).append((r["qid"], r["v"]))
    known = {d: (np.array([a for a, _ in x]), np.array([b for _, b in x])) for d, x in known.items()}

    def scan(batches):
        for part in batches:
            for dim, some in part.groupby(part["v"].map(len)):
                if dim in known:
                    qid, q = known[dim]
                    i, ids, score = best(q, some["vec_id"].to_numpy(), _matrix(some["v"]), k)
                    yield pd.DataFrame({"qid": qid[i], "vec_id": ids, "score": score})

    true = _top(rows.mapInPandas(scan, "qid long, vec_id long, score double"), k)
    own = {r["qid"]: r["v"] for r in sample}
    found = true.join(rows, "vec_id").select("qid", "v", "score").collect()
    found = [r for r in found if r["v"] != own[r["qid"]]]
    if not found:
        return plan
    vectors = {qid: np.array([v]) for qid, v in own.items()}
    gaps = [math.sqrt(max(2 - 2 * r["score"], 1e-4)) for r in found]
    plan.distance = float(np.quantile(gaps, 0.75))
    near: dict[int, list] = {}
    for r in found:
        near.setdefault(r["qid"], []).append(np.array([r["v"]]))
    while plan.m:
        met = places(vectors, near, plan)
        if met is not None:
            plan.probes = int(np.quantile(met, RECALL, method="higher"))
            return plan
        plan.m -= 1
    return plan.exact()


def met(rows: DataFrame, asking: DataFrame, plan: Plan, k: int) -> DataFrame:
    """``qid, vec_id, score``: the ``k`` nearest of the rows that each query of ``asking`` meets on
    its visit, its own vector among them."""

    def index(batches):
        for part in batches:
            for dim, some in part.groupby(part["v"].map(len)):
                u = unit(_matrix(some["v"]))
                for t in range(plan.tables):
                    bucket = code(slots(u, t, plan)[0])
                    yield some.assign(dim=dim, t=t, bucket=bucket)

    def visit(batches):
        for part in batches:
            for qid, v in zip(part["qid"], part["v"], strict=True):
                u = unit(np.array([v]))
                for t in range(plan.tables):
                    own, inside = slots(u, t, plan)
                    moves = np.array(list(probes(inside[0], plan.distance, plan.probes)))
                    yield pd.DataFrame(
                        {"qid": qid, "dim": len(v), "t": t, "bucket": code(own + moves)}
                    )

    place = ["dim", "t", "bucket"]
    filed = staged(
        rows.mapInPandas(index, "vec_id long, v array<double>, dim int, t int, bucket long"),
        "filed",
    )
    visits = staged(asking.mapInPandas(visit, "qid long, dim int, t int, bucket long"), "visits")
    # Buckets that both sides reach, cut into blocks of a bounded number of rows and queries.
    blocks = (
        filed.groupBy(place).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("row_blocks"))
        .join(
            visits.groupBy(place).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("query_blocks")),
            place,
        )
    )
    blocks = staged(blocks, "blocks")

    def each(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def one(n, key):
        return F.pmod(F.xxhash64(key), F.col(n))

    left = (
        filed.join(blocks, place)
        .withColumn("i", one("row_blocks", "vec_id"))
        .withColumn("j", each("query_blocks"))
        .select(*place, "i", "j", "vec_id", "v")
    )
    right = (
        visits.join(blocks, place)
        .withColumn("j", one("query_blocks", "qid"))
        .withColumn("i", each("row_blocks"))
        .select(*place, "i", "j", "qid")
        .join(asking, "qid")
    )

    def rank(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []})
        qid, q = b["qid"].to_numpy(), _matrix(b["v"])
        ids, v = a["vec_id"].to_numpy(), _matrix(a["v"])
        out = []
        for s in range(0, len(qid), 500):
            i, j, score = best(q[s : s + 500], ids, v, k)
            out.append(pd.DataFrame({"qid": qid[s + i], "vec_id": j, "score": score}))
        return pd.concat(out)

    keys = [*place, "i", "j"]
    scored = (
        left.groupBy(keys)
        .cogroup(right.groupBy(keys))
        .applyInPandas(rank, "qid long, vec_id long, score double")
    )
    return _top(scored, k).select("qid", "vec_id", "score")


def search(
    vectors: DataFrame, is_query: object, k: int = 5, seed: int = 20, plan: Plan | None = None
) -> DataFrame:
    """For every row of ``vectors`` (``vec_id``, ``embedding``) where ``is_query`` holds, its ``k``
    nearest other rows: ``query_id, rank, vec_id, score``, ties to the smaller id.

    Vectors that are null, zero or not wholly finite take no part, nor do rows without an id.
    Rows are compared with rows of the same length only. Copies of a vector are searched once: of
    each group of equal vectors the ``k + 1`` smallest ids can be among anyone's nearest, so the
    others are only queries. An empty table gives an empty result. A query gets fewer than ``k`` rows
    only if there are no more of its length.
    """
    everyone = staged(usable(vectors).withColumn("is_query", is_query), "vectors")
    same = Window.partitionBy("v").orderBy("vec_id")
    rows = staged(
        everyone.withColumn("copy", F.row_number().over(same))
        .filter(F.col("copy") <= k + 1)
        .select("vec_id", "v"),
        "index",
    )
    asking = staged(
        everyone.filter("is_query").groupBy("v").agg(F.min("vec_id").alias("qid")), "asking"
    )
    plan = plan or fit(rows, asking, k + 1, seed)

    nearest = staged(met(rows, asking, plan, k + 1), "nearest")
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(
        F.least(F.count("*"), F.lit(k + 1)).alias("due")
    )
    lengths = staged(lengths, "lengths")  # so small that Spark broadcasts it
    due = asking.withColumn("dim", F.size("v")).join(lengths, "dim").select("qid", "v", "due")
    while plan.m:
        got = nearest.groupBy("qid").agg(F.count("*").alias("got"))
        short = due.join(got, "qid", "left").filter(F.coalesce("got", F.lit(0)) < F.col("due"))
        short = staged(short.select("v", "qid"), "short")
        if short.isEmpty():
            break
        further = min(FURTHER * plan.probes, plan.most())
        plan = replace(plan, probes=further) if further > plan.probes else plan.exact()
        nearest = staged(
            nearest.join(short.select("qid"), "qid", "left_anti").unionByName(
                met(rows, short, plan, k + 1)
            ),
            "nearest",
        )
    members = everyone.filter("is_query").join(asking, "v").select(
        "qid", F.col("vec_id").alias("query_id")
    )
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        members.join(nearest, "qid")
        .filter(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
