"""Line dedup: later copies of a line go, and lines a few edits from an earlier one.

Segment-partition join: a line cut into ``edits + 1`` segments keeps at least one of them whole
under ``edits`` changes. Segments of every line are indexed by line length, number and content. A
line probes the index of each length it could match, with the substrings that can be that segment:
those whose shift can be made up by edits on both sides (multi-match-aware selection). Lines that
meet, and whose lengths and numbers of symbols allow it, are verified by a banded edit distance,
one word of bits for a column of the band.

All of it are DataFrame functions. Texts stay where they are: hashes move, and the few lines that
met. Lines shorter than ``LEAST_CHARS`` are compared for equality only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import computed
from .common import numbered, staged

EDITS = 2
LEAST_CHARS = 20
#: Lines up to which a list of them (a few numbers each) is sent to all tasks.
MOST_SENT = 500_000
#: Occurrences from which on a line may be taken once instead of each time; no result depends on it.
LEAST_OFTEN = 100
#: Letters that are counted before a distance is; any choice gives the same result.
LETTERS = "etaoinsrhldcumfpgwybvk"
NEWLINE = "\n"
LINE = ["h1", "h2"]
PARITIES = ["chars", "low", "high"]


def segment_bounds(length: Column, edits: int, i: int) -> tuple[Column, Column]:
    """First character (from 1) and length of segment ``i`` (from 1) of a line; the last segments
    take what does not divide evenly."""
    parts = edits + 1
    base = F.floor(length / parts).cast("int")
    longer = (length % parts).cast("int")
    first_longer = F.lit(parts) - longer  # segments after this one are longer by one
    start = base * (i - 1) + F.greatest(F.lit(i - 1) - first_longer, F.lit(0)) + 1
    return start, base + (F.lit(i) > first_longer).cast("int")


def shifts(edits: int) -> list[tuple[int, int, int]]:
    """All probes of a line, as how much shorter the other line is, the segment of that line, and
    how far it lies from its own place: over what the edits before it and after it allow both."""
    out = []
    for shorter in range(edits + 1):
        for i in range(1, edits + 2):
            low = max(-(i - 1), shorter - (edits + 1 - i))
            high = min(i - 1, shorter + (edits + 1 - i))
            out += [(shorter, i, shift) for shift in range(low, high + 1)]
    return out


def keys(lines: DataFrame, edits: int) -> DataFrame:
    """``key, own, h1, h2``: index and probe keys of every line (``line`` of ``n`` characters),
    ``own`` where it is a segment of the line itself.

    The probes are rows of a fixed list, so that one short expression makes all keys. One expression
    for each of them took about four times as long, presumably as its method is too long for the
    JVM to compile."""
    fixed = [
        F.struct(F.lit(s).alias("shorter"), F.lit(i).alias("i"), F.lit(d).alias("shift"))
        for s, i, d in shifts(edits)
    ]
    n, i, shift = F.col("n"), F.col("probe.i"), F.col("probe.shift")
    length = n - F.col("probe.shorter")
    start, size = segment_bounds(length, edits, i)
    at = start + shift
    return (
        lines.select(*LINE, "line", "n", F.explode(F.array(*fixed)).alias("probe"))
        .filter((at >= 1) & (at + size - 1 <= n))
        .select(
            F.xxhash64(length, i, F.substring(F.col("line"), at, size)).alias("key"),
            ((F.col("probe.shorter") == 0) & (shift == 0)).alias("own"),
            *LINE,
        )
    )


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines lie within ``edits`` insertions, deletions or replacements.

    A column of the band holds ``2 edits + 1`` cells around the diagonal as bits of vertical
    differences; one step of bit operations moves it by one character. Once the lower edge of the
    band is too far to come back, steps do nothing. ``a`` and ``b`` are arrays of characters, the
    longer line first, neither empty.
    """
    width = 2 * edits + 2
    mask = (1 << width) - 1
    top = 1 << (width - 1)
    m, n = F.size(a), F.size(b)

    def step(state: Column, i: Column) -> Column:
        letter = F.get(b, i)
        equal = reduce(
            lambda x, y: x.bitwiseOR(y),
            (
                F.when(F.get(a, i + (edits - width + 1 + k)) == letter, F.lit(1 << k).cast("long"))
                .otherwise(F.lit(0).cast("long"))
                for k in range(width)
            ),
        )
        moved = F.transform(
            F.array(F.struct(state.alias("s"), equal.alias("x"))),
            lambda v: _column(v["s"], v["x"], i, m, edits, mask, top),
        )[0]
        return F.when(state["distance"] > 2 * edits + n - m, state).otherwise(moved)

    start = F.struct(
        F.lit(mask ^ ((1 << (width - edits - 1)) - 1)).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"),
        F.lit(edits).alias("distance"),
        F.lit(top >> 1).cast("long").alias("last"),
    )
    end = F.aggregate(F.sequence(F.lit(0), n - 1), start, step)
    return (m - n <= edits) & (end["distance"] <= edits)


def _column(s: Column, x: Column, i: Column, m: Column, edits: int, mask: int, top: int) -> Column:
    """The next column of the band from the state ``s`` and the equal cells ``x``."""

    def once(value: Column, use) -> Column:
        # Computed once, used several times.
        return F.transform(F.array(value), use)[0]

    def invert(c: Column) -> Column:
        return c.bitwiseXOR(F.lit(mask).cast("long"))

    vp, vn = s["vp"], s["vn"]
    d0 = (
        (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(
            F.lit(mask).cast("long")
        )
    )

    def rest(d: Column) -> Column:
        hp = vn.bitwiseOR(invert(d.bitwiseOR(vp)))
        hn = d.bitwiseAND(vp)
        down = F.shiftright(d, 1)
        diagonal = i < m - edits
        distance = s["distance"] + F.when(
            diagonal, (d.bitwiseAND(F.lit(top).cast("long")) == 0).cast("int")
        ).otherwise(
            (hp.bitwiseAND(s["last"]) != 0).cast("int") - (hn.bitwiseAND(s["last"]) != 0).cast("int")
        )
        return F.struct(
            hn.bitwiseOR(invert(down.bitwiseOR(hp))).alias("vp"),
            down.bitwiseAND(hp).alias("vn"),
            distance.alias("distance"),
            F.when(diagonal, s["last"]).otherwise(F.shiftright(s["last"], 1)).alias("last"),
        )

    return once(d0, rest)


def common_start(x: Column, y: Column) -> Column:
    """How many characters two lines begin with in common, by bisection."""
    most = F.least(F.char_length(x), F.char_length(y))

    def longer(known: Column, step: Column) -> Column:
        n = known + step
        same = (n <= most) & (F.substring(x, F.lit(1), n) == F.substring(y, F.lit(1), n))
        return F.when(same, n).otherwise(known)

    steps = F.array(*(F.lit(1 << k) for k in range(26, -1, -1)))
    return F.aggregate(steps, F.lit(0), longer)


def same_letters(x: Column, y: Column, edits: int) -> Column:
    """Whether counts of common letters allow ``edits`` edits: each changes two of them at most."""

    def count(c: Column, letter: str) -> Column:
        return F.char_length(c) - F.char_length(F.replace(c, F.lit(letter), F.lit("")))

    differ = (F.abs(count(x, letter) - count(y, letter)) for letter in LETTERS)
    return reduce(lambda a, b: a + b, differ) <= 2 * edits


def near_pairs(pairs: DataFrame, edits: int) -> DataFrame:
    """The rows of ``pairs`` whose ``x`` and ``y`` lie within ``edits`` edits. What they begin and
    end with in common has no part in the distance and is cut first, and of the rest only those go
    on to the distance whose letters agree."""

    # ``computed`` keeps each step from being repeated in the next one's expressions.
    def cut(df: DataFrame) -> DataFrame:
        df = computed(df, start=common_start(F.col("x"), F.col("y")) + 1)
        rest = {
            c: F.reverse(F.substring(f"_{c}", F.col("start"), F.char_length(f"_{c}"))) for c in "xy"
        }
        named = df.withColumnsRenamed({"x": "_x", "y": "_y"})
        return computed(named, **rest).drop("_x", "_y", "start")

    short = cut(cut(pairs))
    n_x, n_y = F.char_length("x"), F.char_length("y")
    possible = (F.abs(n_x - n_y) <= edits) & same_letters(F.col("x"), F.col("y"), edits)
    swap = n_x < n_y
    short = computed(
        short.filter(possible),
        _longer=F.split(F.when(swap, F.col("y")).otherwise(F.col("x")), ""),
        _shorter=F.split(F.when(swap, F.col("x")).otherwise(F.col("y")), ""),
    )
    near = F.when(F.least(n_x, n_y) == 0, F.greatest(n_x, n_y) <= edits).otherwise(
        within(F.col("_longer"), F.col("_shorter"), edits)
    )
    return short.filter(near).drop("_longer", "_shorter")


def numbered_lines(docs: DataFrame) -> DataFrame:
    """``row, doc_id, place, line`` of every line with something other than white space."""
    return docs.select(
        "row", "doc_id", F.posexplode(F.split("text", NEWLINE)).alias("place", "line")
    ).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _identity(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(6), line).alias("h2")]


def parities(line: Column) -> Column:
    """``chars, low, high``: bits for the characters of some code points, and for some pairs of
    neighbouring characters, each whether their number in the line is odd. An edit changes two bits
    of ``chars`` at most, and four of ``low`` and ``high``."""

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place % 64)

    def step(bits: Column, at: Column) -> Column:
        none = F.lit(0).cast("long")
        return F.struct(
            bits["chars"].bitwiseXOR(bit(at["one"])).alias("chars"),
            bits["low"].bitwiseXOR(F.when(at["two"] < 64, bit(at["two"])).otherwise(none)).alias("low"),
            bits["high"].bitwiseXOR(F.when(at["two"] < 64, none).otherwise(bit(at["two"]))).alias("high"),
        )

    def places(codes: Column) -> Column:
        # Any rule for the place of a pair gives the same result; the last character's is with none.
        after = lambda i: F.coalesce(F.get(codes, i + 1), F.lit(0))
        return F.transform(
            codes,
            lambda c, i: F.struct(c.alias("one"), ((c % 65536 * 37 + after(i)) % 128).alias("two")),
        )

    codes = F.transform(F.split(line, ""), F.ascii)
    start = F.struct(*(F.lit(0).cast("long").alias(c) for c in ("chars", "low", "high")))
    # The codes are computed once, each pair looks at two of them.
    return F.aggregate(F.transform(F.array(codes), places)[0], start, step)


def sharing(lines: DataFrame, firsts: DataFrame, edits: int) -> DataFrame:
    """``key, own, h1, h2`` of the keys that different lines share, one of them as its own segment.
    ``lines`` holds ``row, place, line``, ``firsts`` the first ``row`` and ``place`` of every line
    and its number ``n_lines``.

    Of lines that occur often only the first occurrence is taken, so that a common line is no hot
    key. Of N occurrences at most ``MOST_SENT`` lines make up more than N / ``MOST_SENT`` each, so
    the list of them is small enough for every task."""
    total = firsts.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).first()[0]
    often = firsts.filter(F.col("n_lines") > max(LEAST_OFTEN, total // MOST_SENT))
    often = often.select(*LINE, F.struct("row", "place").alias("first"))
    # Lengths and hashes are columns of their own, so that each is computed once in compiled code.
    sized = lines.select("row", "place", "line", F.char_length("line").alias("n"), *_identity("line"))
    once = (
        sized.filter(F.col("n") >= LEAST_CHARS)
        .join(F.broadcast(often), LINE, "left")
        .filter(F.col("first").isNull() | (F.struct("row", "place") == F.col("first")))
    )
    # A key that only one line has meets nothing; most are of that kind and go before any pairing.
    same = Window.partitionBy("key")
    return (
        keys(once, edits)
        .withColumn("owned", F.max("own").over(same))
        .withColumn("least", F.min("h1").over(same))
        .withColumn("most", F.max("h1").over(same))
        .filter("owned and least != most")
        .select("key", "own", *LINE)
        .distinct()
    )


def first_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``id, line`` of the lines at ``places`` (``row, place, h1, h2``)."""
    by_row = places.groupBy("row").agg(F.collect_list(F.struct("place", *LINE)).alias("wanted"))
    if places.count() <= MOST_SENT:  # of a few numbers each: else the texts are shuffled
        by_row = F.broadcast(by_row)
    return (
        docs.join(by_row, "row")
        .select(F.split("text", NEWLINE).alias("lines"), F.explode("wanted").alias("w"))
        .select(F.struct("w.h1", "w.h2").alias("id"), F.get("lines", F.col("w.place")).alias("line"))
    )


def met(shared: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Pairs of different lines (``a`` and ``b``, two hashes each, unverified) that share a key, and
    whose lengths (``n``) and parities (``odd``) in ``texts`` allow ``edits`` edits. Lines of one
    template that differ by words, or by letters at several places, rarely do, so few of those pairs
    become rows; the fewer characters a script has, the more."""
    known = shared.join(texts.select("id.*", "n", "odd.*"), LINE)
    own, other = (
        known.select("key", "own", *(F.col(c).alias(f"{side}_{c}") for c in ("n", *PARITIES)),
                     F.struct(*LINE).alias(side))
        for side in "ab"
    )

    def differ(c: str) -> Column:
        return F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}")))

    possible = (
        (F.col("a") != F.col("b"))
        & (F.abs(F.col("a_n") - F.col("b_n")) <= edits)
        & (differ("chars") <= 2 * edits)
        & (differ("low") + differ("high") <= 4 * edits)
    )
    own, other = own.filter("own").drop("own"), other.drop("own").withColumnRenamed("key", "probe")
    return (
        own.join(other, (F.col("key") == F.col("probe")) & possible)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def near_links(docs: DataFrame, firsts: DataFrame, edits: int = EDITS) -> DataFrame:
    """``a, b``: pairs of different lines within ``edits`` edits, as structs of two hashes.
    ``firsts`` holds the first ``row`` and ``place`` of every line (``h1``, ``h2``) and its number
    ``n_lines``."""
    shared = staged(sharing(numbered_lines(docs), firsts, edits), "segments")
    places = firsts.select("row", "place", *LINE).join(shared.select(*LINE).distinct(), LINE)
    texts = first_texts(docs, staged(places, "wanted"))
    texts = texts.withColumn("n", F.char_length("line")).withColumn("odd", parities(F.col("line")))
    texts = staged(texts, "lines")
    pairs = staged(met(shared, texts, edits), "pairs")
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
    return near_pairs(pairs.join(left, "a").join(right, "b"), edits).select("a", "b")


def dedup_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Every row of ``docs`` with all its columns, its ``text`` without the lines that go, and
    ``n_lines, n_copies, n_near``: lines with a word, those dropped as a copy of an earlier line,
    and those dropped for an earlier line within ``edits`` edits.

    Lines are parts between newlines; those of white space only always stay. Order is by
    ``doc_id`` (null first) and place. Of equal lines the first stays, unless a different line
    whose first place is earlier lies within ``edits`` edits, whether that one stays or not; then
    all go. A null text stays null, and a document none of whose lines stay has an empty one. Rows
    count one by one, also with null or repeated ids. Other columns, whatever their names, are
    carried along. An empty table gives an empty one.
    """
    carried = [c for c in docs.columns if c != "text"]
    own = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("own")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", own)
    rows = numbered(rows, "texts")
    texts = rows.select("row", "doc_id", "text")
    found = staged(
        numbered_lines(texts).select("row", "doc_id", "place", *_identity("line")), "places"
    )
    at = F.struct("doc_id", "row", "place")
    counted = found.groupBy(LINE).agg(F.min(at).alias("at"), F.count("*").alias("n_lines"))
    counted = staged(counted, "firsts")
    firsts = counted.select(*LINE, "at")
    links = near_links(texts, counted.select(*LINE, "at.row", "at.place", "n_lines"), edits)
    named = firsts.select(F.struct(*LINE).alias("id"), "at")
    later = (
        links.join(named.select(F.col("id").alias("a"), F.col("at").alias("at_a")), "a")
        .join(named.select(F.col("id").alias("b"), F.col("at").alias("at_b")), "b")
        .select(F.when(F.col("at_a") < F.col("at_b"), F.col("b")).otherwise(F.col("a")).alias("id"))
        .distinct()
        .select("id.h1", "id.h2", F.lit(True).alias("near"))
    )
    judged = (
        found.join(firsts, LINE)
        .join(staged(later, "near"), LINE, "left")
        .withColumn("near", F.coalesce("near", F.lit(False)))
        .withColumn("copy", at != F.col("at"))
    )
    counted = judged.groupBy("row").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("copy")).alias("n_copies"),
        F.count_if(F.col("near") & ~F.col("copy")).alias("n_near"),
        F.collect_list(F.when(F.col("copy") | F.col("near"), F.col("place"))).alias("gone"),
    )
    kept = F.filter(
        F.split("text", NEWLINE), lambda line, i: ~F.array_contains("gone", i)
    )
    text = F.when(F.size("gone") > 0, F.array_join(kept, NEWLINE)).otherwise(F.col("text"))
    zero = F.lit(0).cast("long")
    others = [F.col("own")[c].alias(c) for c in carried]
    return rows.join(counted, "row", "left").select(
        *others,
        text.alias("text"),
        *(F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_copies", "n_near")),
    )
