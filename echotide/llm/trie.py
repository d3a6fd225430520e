"""The prefix trie of conversations, with totals of every subtree, by time-forward processing.

Every rebuilt conversation is a path of turns. A node of the trie is a distinct beginning of one or
more of them and goes by its depth and two rolling hashes of its turns; texts are hashed where they
stand and never move.

Subtree totals rise from the leaves. Nodes sorted by reverse level order meet every child before
its parent, so one sweep with a priority queue is enough: a node takes the messages that its
children sent to its place in the order, adds its own values, and sends the sum to its parent's
place. The sort is Spark's external one, and the queue spills sorted runs to disk.

A sweep runs in every shard. The shards are the largest subtrees of at most ``SHARD`` turns (of all
members, so copies count), and are dealt over tasks by their roots. Above them are only nodes with
more turns than that below. These fall into paths of one smallest member each, at most one for every
``SHARD`` turns of the table. A second sweep runs across the shard roots, over those paths, and sums
along a path by blocks give the totals of its nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK = 1024
SHARD = 20_000
MOST_QUEUED = 100_000
ENDS = 4_096
FAMILY = 100
MOST_TAKEN = 5
KEY = ["depth", "a", "b"]
UP = ["up_depth", "up_a", "up_b"]
LONG_KEY = "depth long, a long, b long"


def _along(
    rows: DataFrame, key: str, place: str, block: int, **running: tuple[Callable, str]
) -> DataFrame:
    """``rows`` with running aggregates over ``place`` within ``key``: inside blocks of ``block``
    places, and then over the blocks, so that no task needs a whole key."""
    rows = rows.withColumn("_block", F.floor(F.col(place) / block))
    inside = Window.partitionBy(key, "_block").orderBy(place)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(key, "_block").agg(*(f(c).alias(f"_{n}") for n, (f, c) in running.items()))
    zero = F.lit(0).cast("long")
    starts = sums.select(
        key,
        "_block",
        *(F.coalesce(f(f"_{n}").over(before), zero).alias(f"_{n}") for n, (f, _) in running.items()),
    )
    local = rows.withColumns({n: f(c).over(inside) for n, (f, c) in running.items()})
    joined = local.join(starts, [key, "_block"])
    for n, (f, _) in running.items():
        both = F.col(n).bitwiseXOR(F.col(f"_{n}")) if f is F.bit_xor else F.col(n) + F.col(f"_{n}")
        joined = joined.withColumn(n, both)
    return joined.drop("_block", *(f"_{n}" for n in running))


def _placed(turns: DataFrame, block: int) -> DataFrame:
    """``conv_id, place, x, y, chars``: turns in order, as hashes, with the length of the text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(text).alias("t"),
        F.xxhash64(F.lit(1), role, text).alias("x"),
        F.xxhash64(F.lit(2), role, text).alias("y"),
        F.char_length(text).cast("long").alias("chars"),
    )
    rows = rows.withColumn("_block", F.floor(F.coalesce("turn", F.lit(-1)) / block))
    order = Window.partitionBy("conv_id", "_block").orderBy(F.asc_nulls_first("turn"), "role", "t", "x")
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = rows.groupBy("conv_id", "_block").agg(F.count("*").alias("n"))
    starts = sizes.select(
        "conv_id", "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    rows = rows.withColumn("place", F.row_number().over(order).cast("long"))
    return rows.join(starts, ["conv_id", "_block"]).select(
        "conv_id", (F.col("place") + F.col("start")).alias("place"), "x", "y", "chars"
    )


def taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(conv_id.cast("string")) % (MOST_TAKEN + 1)


def rebuilt(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The turns ``conv_id, depth, x, y, chars, length`` of rebuilt conversations, and all of these
    with their ``length``, turnless ones included."""
    own = staged(_placed(turns, block), "turns")
    # Of a family's first conversation at most MOST_TAKEN turns.
    first = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") <= MOST_TAKEN))
    heads = first.groupBy(F.col("conv_id").alias("head")).agg(
        F.array_sort(F.collect_list(F.struct("place", "x", "y", "chars"))).alias("turns")
    )
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.withColumn("h", taken(F.col("conv_id"))).withColumn(
        "head", F.col("conv_id") - F.col("conv_id") % FAMILY
    )
    convs = convs.join(heads, "head", "left").withColumn(
        "turns", F.slice("turns", F.lit(1), F.col("h").cast("int"))
    )
    lead = F.when(F.col("turns").isNull(), 0).otherwise(F.size("turns")).cast("long")
    length = lead + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = staged(convs.withColumn("lead", lead).withColumn("length", length), "conversations")
    columns = ["conv_id", "depth", "x", "y", "chars", "length"]
    before = convs.select("conv_id", "length", F.explode("turns").alias("t")).select(
        "conv_id", F.col("t.place").alias("depth"), "t.x", "t.y", "t.chars", "length"
    )
    after = own.join(convs.select("conv_id", "h", "lead", "length"), "conv_id")
    after = after.filter(F.col("place") > F.col("h")).withColumn(
        "depth", F.col("place") - F.col("h") + F.col("lead")
    )
    return before.select(columns).unionByName(after.select(columns)), convs.select("conv_id", "length")


def paths(turns: DataFrame, block: int) -> DataFrame:
    """Every turn of a rebuilt conversation with the key of its node and of the one above."""
    for name, seed in (("own_a", 1), ("own_b", 2)):
        turns = turns.withColumn(name, F.xxhash64(F.lit(seed), "depth", "x", "y"))
    rolled = _along(turns, "conv_id", "depth", block, a=(F.bit_xor, "own_a"), b=(F.bit_xor, "own_b"))
    return rolled.select(
        "conv_id",
        "length",
        *KEY,
        (F.col("depth") - 1).alias("up_depth"),
        F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"),
        F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b"),
        "chars",
    )


class Queue:
    """Messages by the place they are sent to, in order. More than ``most`` of them go to disk as a
    sorted run; places only grow, so runs are read from the front."""

    RECORD = "<6q"

    def __init__(self, most: int):
        self.most, self.heap, self.heads = most, [], []

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.most:
            run = tempfile.TemporaryFile()  # of this task alone, gone when it ends
            for m in sorted(self.heap):
                run.write(struct.pack(self.RECORD, *m))
            run.seek(0)
            self.heap = []
            self._next(run, len(self.heads))

    def _next(self, run, number: int) -> None:
        record = run.read(struct.calcsize(self.RECORD))
        if record:
            heapq.heappush(self.heads, (struct.unpack(self.RECORD, record), number, id(run), run))

    def take(self, place: tuple[int, int, int]) -> Iterator[tuple[int, ...]]:
        """All messages for ``place``, the least one that is left."""
        while True:
            if self.heap and (not self.heads or self.heap[0] <= self.heads[0][0]):
                if self.heap[0][:3] != place:
                    return
                yield heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][:3] == place:
                message, number, _, run = heapq.heappop(self.heads)
                self._next(run, number)
                yield message
            else:
                return


def sweep(nodes: DataFrame, leaf: int, most: int = MOST_QUEUED) -> DataFrame:
    """``depth, a, b, children, leaves, saved``: totals of subtrees within each partition of
    ``nodes``, which hold ``KEY``, ``UP`` (null where the parent is elsewhere) and their own
    ``leaves`` and ``saved``. A node without children here counts ``leaf`` leaves more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Queue(most)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, *UP, "leaves", "saved")]
            out = []
            for depth, a, b, up_depth, up_a, up_b, leaves, saved in zip(*columns, strict=True):
                children = 0
                for message in queue.take((-depth, a, b)):
                    children += 1
                    leaves += message[4]
                    saved += message[5]
                leaves += 0 if children else leaf
                if up_depth is not None:
                    # The fourth value tells the children of a node apart.
                    queue.push((-up_depth, up_a, up_b, a ^ depth, leaves, saved))
                out.append((depth, a, b, children, leaves, saved))
            if out:
                arrays = [pa.array(np.array(x, np.int64)) for x in zip(*out, strict=True)]
                names = [*KEY, "children", "leaves", "saved"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    ordered = nodes.sortWithinPartitions(F.desc("depth"), "a", "b")
    ordered = ordered.select(*KEY, *UP, "leaves", "saved")
    return ordered.mapInArrow(run, f"{LONG_KEY}, children long, leaves long, saved long")


def digests(ends: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the conversations that end at a node. Ids are joined in
    ranges of ``ENDS``, and a node's ranges run through one digest one after the other."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    ranges = ends.groupBy(*KEY, F.floor(F.col("conv_id") / ENDS).alias("range"))
    joined = ranges.agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            out = []
            keys = zip(*(batch.column(c).to_pylist() for c in KEY), strict=True)
            for key, part in zip(keys, batch.column("ids").to_pylist(), strict=True):
                if key != at:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            if out:
                yield _digest_rows(out)
        if at is not None:
            yield _digest_rows([(*at, state.hexdigest())])

    ordered = joined.repartition(*KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids")
    return ordered.mapInArrow(digest, f"{LONG_KEY}, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in zip(*rows, strict=True)], [*KEY, "ends_sha256"]
    )


def _sums(df: DataFrame, *by: Column) -> DataFrame:
    """Number and totals of subtrees by the node above."""
    return df.groupBy(*by).agg(
        F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def _zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0).cast("long"))


def across(large: DataFrame, below: DataFrame, block: int, most: int) -> DataFrame:
    """Totals of the ``large`` nodes from those of the shards ``below``, by the node above them."""
    large = large.join(below, KEY, "left")
    inner = large.filter("depth > 0").groupBy(*(F.col(u).alias(k) for u, k in zip(UP, KEY))).agg(
        F.count("*").alias("inner")
    )
    large = large.join(inner, KEY, "left").select(
        *KEY, *UP, "conv_id",
        (_zero("children") + _zero("inner")).alias("children"),
        (_zero("leaves") + (_zero("children") + _zero("inner") == 0).cast("long")).alias("leaves"),
        (_zero("saved") + F.col("own")).alias("saved"),
    )
    large = staged(large, "large")
    # Paths of nodes with one smallest member, by their top node; the one above is on another path.
    part = large.groupBy("conv_id").agg(
        F.min(F.struct(*KEY, *UP)).alias("top"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
    )
    part = part.select("conv_id", *(f"top.{c}" for c in (*KEY, *UP)), "leaves", "saved")
    part = staged(part, "paths")
    owner = large.select(*(F.col(k).alias(u) for k, u in zip(KEY, UP)), F.col("conv_id").alias("over"))
    tops = part.select(F.col("conv_id").alias("over"), *(F.col(k).alias(f"over_{k}") for k in KEY))
    named = part.join(owner, UP, "left").join(tops, "over", "left")
    linked = named.select(
        *KEY, *(F.col(f"over_{k}").alias(u) for k, u in zip(KEY, UP)), "leaves", "saved"
    )
    # One row for every ``SHARD`` turns at most, in one partition; the queue and the sort spill.
    totals = sweep(linked.coalesce(1), 0, most).select(*KEY, "leaves", "saved")
    hanging = part.filter("depth > 0").select(*KEY, *UP).join(totals, KEY)
    hanging = _sums(hanging, *UP).select(
        *(F.col(u).alias(k) for u, k in zip(UP, KEY)),
        F.col("leaves").alias("more_leaves"),
        F.col("saved").alias("more_saved"),
    )
    whole = large.join(hanging, KEY, "left").select(
        *KEY, "conv_id", "children", (-F.col("depth")).alias("_up"),
        (F.col("leaves") + _zero("more_leaves")).alias("own_leaves"),
        (F.col("saved") + _zero("more_saved")).alias("own_saved"),
    )
    summed = _along(
        whole, "conv_id", "_up", block, leaves=(F.sum, "own_leaves"), saved=(F.sum, "own_saved")
    )
    return summed.select(*KEY, "children", "leaves", "saved")


def prefix_trie(
    turns: DataFrame, shard: int = SHARD, block: int = BLOCK, most: int = MOST_QUEUED
) -> DataFrame:
    """Every node's ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``.

    Turns are ordered by ``turn`` (null first), then role, then a hash of the text; repeated rows
    are turns of their own. A null role or text is empty; rows without ``conv_id`` belong to no
    conversation. Each conversation is rebuilt with the first turns of the first one of its family.
    Nodes are the distinct beginnings of rebuilt conversations, the root (depth 0, no turns) among
    them, which turnless ones are members of as well; a node goes by its smallest member.
    ``saved_tokens`` sums, over the subtree, the code points of each node's last text for every
    member but one. An empty table has no nodes. Long conversations are numbered, hashed and
    summed in blocks; other columns, whatever their names, are not read.
    """
    turned, convs = rebuilt(turns.select("conv_id", "turn", "role", "text"), block)
    rows = staged(paths(turned, block), "paths")
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *(F.max(c).alias(c) for c in UP),
        F.max("chars").alias("chars"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    none = F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root = root.filter("n_convs > 0").select(
        *(F.lit(0).cast("long").alias(k) for k in KEY), "conv_id", "n_convs",
        *(none.alias(c) for c in UP), F.lit(0).cast("long").alias("chars"),
        F.lit(1 << 62).cast("long").alias("weight"),
    )
    own = (F.col("n_convs") - 1) * F.col("chars")
    nodes = staged(nodes.unionByName(root).withColumn("own", own), "nodes")

    large = nodes.filter(F.col("weight") > shard)
    marked = rows.select("conv_id", *KEY).join(
        large.select(*KEY, F.lit(True).alias("large")), KEY, "left"
    )
    top = marked.filter("large is null").groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("top"))
    small = nodes.filter(F.col("weight") <= shard).join(top, "conv_id")
    is_top = F.col("top.depth") == F.col("depth")
    small = small.withColumn("shard", F.xxhash64("top")).repartition("shard").select(
        *KEY, *(F.when(~is_top, F.col(u)).alias(u) for u in UP),
        F.lit(0).cast("long").alias("leaves"), F.col("own").alias("saved"),
    )
    found = staged(sweep(small, 1, most), "subtrees")
    # The shard roots: small nodes below a large one.
    above = nodes.filter(F.col("weight") <= shard).select(*KEY, *UP).join(
        large.select(*(F.col(k).alias(u) for k, u in zip(KEY, UP))), UP, "left_semi"
    )
    below = _sums(found.join(above, KEY), *UP)
    below = below.withColumnsRenamed(dict(zip(UP, KEY, strict=True)))
    totals = found.unionByName(across(large, below, block, most))

    last = rows.filter(F.col("depth") == F.col("length")).select("conv_id", *KEY)
    turnless = convs.filter("length = 0").select(
        "conv_id", *(F.lit(0).cast("long").alias(k) for k in KEY)
    )
    ends = digests(last.unionByName(turnless))
    # The root is above very many nodes; its smallest member is one number.
    least = convs.agg(F.min("conv_id")).first()[0]
    parent = nodes.filter("depth > 0").select(
        *(F.col(k).alias(u) for k, u in zip(KEY, UP)), F.col("conv_id").alias("parent")
    )
    parent_id = F.when(F.col("depth") == 1, F.lit(least).cast("long")).otherwise(F.col("parent"))
    return (
        nodes.join(totals, KEY)
        .join(ends, KEY, "left")
        .join(parent, UP, "left")
        .select(
            "conv_id",
            "depth",
            parent_id.alias("parent_conv_id"),
            "n_convs",
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


SQL = f"""
with c as materialized (select conv_id,
    list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
      order by turn nulls first, role, text) w
  from conversations where conv_id is not null group by conv_id),
h as (select conv_id, w, conv_id - conv_id % {FAMILY} head,
    xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(1, length(conv_id::varchar) + 1),
        lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint)),
      lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
        lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % {MOST_TAKEN + 1} h from c),
b as materialized (select h.conv_id, list_concat(list_slice(coalesce(f.w, []), 1, h.h),
    list_slice(h.w, h.h + 1, len(h.w))) w
  from h left join c f on f.conv_id = h.head),
n as materialized (select depth, p, min(conv_id) conv_id, count(*) n_convs,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (len(w) = depth) ends
  from (select conv_id, w, depth, list_slice(w, 1, depth) p
    from (select conv_id, w, unnest(range(0, len(w) + 1)) depth from b)) group by depth, p),
k as (select depth - 1 depth, list_slice(p, 1, depth - 1) p, count(*) n_children
  from n where depth > 0 group by 1, 2),
v as (select n.*, coalesce(n_children, 0) n_children,
    case when depth > 0 then (n_convs - 1) * length(p[depth].x) else 0 end own
  from n left join k using (depth, p)),
s as (select depth, p, sum(leaf) n_leaves, sum(own) saved_tokens from (
    select d depth, list_slice(p, 1, d) p, leaf, own from (
      select p, own, (n_children = 0)::int leaf, unnest(range(0, depth + 1)) d from v))
  group by depth, p)
select v.conv_id, v.depth, u.conv_id parent_conv_id, v.n_convs, v.n_children,
  cast(n_leaves as bigint) n_leaves, cast(saved_tokens as bigint) saved_tokens,
  sha256(coalesce(v.ends, '')) ends_sha256
from v join s using (depth, p)
left join n u on u.depth = v.depth - 1 and u.p = list_slice(v.p, 1, v.depth - 1) and v.depth > 0
"""
