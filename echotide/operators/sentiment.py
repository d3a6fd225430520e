"""Lexicon sentiment: words looked up, their valences summed and normalised.

The lexicon is the caller's ``(word, valence)``, one row per word. Normalisation and thresholds
are those of the published VADER model (Hutto and Gilbert, 2014).

A text is scored where it stands: a lexicon whose measured size is within ``HELD_CHARACTERS`` goes
to the tasks whole, and each text is looked up in one pass, with no shuffle and no second reading of
the input. A larger one is joined with the words of the texts instead, which are known by their
hash, so ids may repeat or be missing. Both ways give the same scores.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACES, any_of
from ..schemas import computed
from .phrases import joined, slices

# Fixed values of the published model.
ALPHA = 15
POSITIVE, NEGATIVE = 0.05, -0.05
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Fixed values of the published model: how words around a word of the lexicon change its valence.
BOOST, DAMPEN = 0.293, -0.293
CAPITALS, NEGATION, NEVER_SO = 0.733, -0.74, 1.25
DISTANCE = (1.0, 0.95, 0.9)  # weight of a booster one, two and three words before
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

BOOSTERS = dict.fromkeys(
    """absolutely amazingly awfully completely considerable considerably decidedly deeply effing
    enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously
    flippin flipping frackin fracking frickin fricking friggin frigging fuckin fucking fuggin
    fugging fully greatly hella highly hugely incredible incredibly intensely major majorly more
    most particularly purely quite really remarkably so substantially thoroughly total totally
    tremendous tremendously uber unbelievably unusually utter utterly very""".split(),
    BOOST,
) | dict.fromkeys(
    """almost barely hardly kind-of kinda kindof less little marginal marginally occasional
    occasionally partly scarce scarcely slight slightly somewhat sort-of sorta sortof""".split(),
    DAMPEN,
)

NEGATIONS = tuple(
    """ain't aint aren't arent can't cannot cant couldn't couldnt daren't darent despite didn't
    didnt doesn't doesnt don't dont hadn't hadnt hasn't hasnt haven't havent isn't isnt mightn't
    mightnt mustn't mustnt needn't neednt neither never none nope nor not nothing nowhere oughtn't
    oughtnt rarely seldom shan't shant shouldn't shouldnt uh-uh uhuh wasn't wasnt weren't werent
    without won't wont wouldn't wouldnt""".split()
)

HELD_CHARACTERS = 4_000_000  # of a lexicon that goes to the tasks whole
UNIT = 1_000_000  # valences are summed as whole millionths: exact in any order of rows

Lexicon = Sequence[tuple[str, float]]


def bare_word(piece: Column) -> Column:
    """A word without the punctuation around it. What would leave two characters or fewer stays
    as it is, since it may be an emoticon."""
    bare = F.trim(piece, F.lit(PUNCTUATION))
    return F.when(F.char_length(bare) <= 2, piece).otherwise(bare)


def normalize_score(total: Column, alpha: int = ALPHA) -> Column:
    """A sum of valences in units squeezed into -1 to 1, to four places."""
    s = total / F.lit(float(UNIT))
    return F.coalesce(F.round(s / F.sqrt(s * s + F.lit(alpha)), 4), F.lit(0.0))


def unique_words(lexicon: Lexicon | DataFrame, df: DataFrame) -> DataFrame:
    """``word, valence``: one row per lower-cased word, valences in units. Of words that differ in
    case only, the first by spelling counts, and of equal ones the least valence."""
    if not isinstance(lexicon, DataFrame):
        lexicon = df.sparkSession.createDataFrame(list(lexicon), "word string, valence double")
    units = F.round(F.col("valence") * UNIT).cast("bigint")
    return (
        lexicon.filter("word != '' and valence is not null")
        .groupBy(F.lower("word").alias("low"))
        .agg(F.min(F.struct("word", units.alias("valence"))).alias("first"))
        .select(F.col("low").alias("word"), F.col("first.valence").alias("valence"))
    )


def _text_key(text: str) -> list[Column]:
    """What a text is known by in joins: two hashes. The score depends on the text alone, so it
    needs no id, and repeated texts share one."""
    return [F.xxhash64(text).alias("_a"), F.xxhash64(F.lit(1), text).alias("_b")]


def _held(known: DataFrame) -> dict[str, int] | None:
    """The lexicon as a mapping if it is within ``HELD_CHARACTERS``, measured by Spark first."""
    size = known.agg(F.sum(F.char_length("word") + F.lit(1))).first()[0] or 0
    if size > HELD_CHARACTERS:
        return None
    return {r["word"]: r["valence"] for r in known.collect()}


def _adder(shared):
    """The sum of the valences of a lower-cased text, in units; 0 for a null."""

    @F.arrow_udf("bigint")
    def total(texts: pa.Array) -> pa.Array:
        held = shared.value

        def of(piece: str) -> int:
            return held.get(_bare(piece), 0)

        # What ``split`` takes for space is what ``SPACES`` names.
        sums = (sum(map(of, t.split())) if t else 0 for part in slices(texts) for t in part)
        return pa.array(sums, pa.int64())

    return total


def lexicon_score(
    df: DataFrame, lexicon: Lexicon | DataFrame, text: str = "text", alpha: int = ALPHA
) -> DataFrame:
    """Add ``sentiment_score``; null texts and those without a known word score 0.

    ``lexicon`` is a list or a table of any size, see ``unique_words``. Ids play no part.
    """
    known = unique_words(lexicon, df)
    held = _held(known)
    if held is None:
        return _scored(df, _joined_sums(df, known, text), text, F.col("_total"), alpha)
    add = _adder(df.sparkSession.sparkContext.broadcast(held))
    score = normalize_score(add(F.lower(text)), alpha)
    return computed(df.drop("sentiment_score"), sentiment_score=score)


def _joined_sums(df: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """``_a, _b, _total`` of texts whose words sum to something, for lexicons of any size: each task
    sums its own words first, and one number per text is left."""
    pieces = df.filter(F.col(text).isNotNull()).select(
        *_text_key(text), F.posexplode(F.split(F.lower(text), SPACES)).alias("_at", "_piece")
    )
    words = computed(pieces, word=bare_word(F.col("_piece")))
    # A repeated text is summed as often as it occurs: its first pieces count how often.
    copies = F.count_if(F.col("_at") == 0)
    return (
        words.join(known, "word", "left")
        .groupBy("_a", "_b")
        .agg((F.coalesce(F.sum("valence"), F.lit(0)) / copies).alias("_total"))
        .filter("_total != 0")
    )


def _scored(
    df: DataFrame, totals: DataFrame, text: str, total: Column, alpha: int
) -> DataFrame:
    keyed = df.select("*", *_text_key(text)).join(totals, ["_a", "_b"], "left")
    score = normalize_score(F.coalesce(total, F.lit(0.0)), alpha)
    return keyed.withColumn("sentiment_score", score).drop("_a", "_b", *totals.columns[2:])


def _finder(shared):
    """Where the words of a text are in the lexicon: place, valence, and of the three words before,
    nearest first, whether the lexicon holds them and how much they boost. ``but`` is the position
    of the first "but", from 1, or 0."""

    around = [("known", pa.list_(pa.bool_())), ("boost", pa.list_(pa.int64()))]
    one = pa.struct([("at", pa.int32()), ("valence", pa.int64()), *around])
    kind = pa.struct([("but", pa.int32()), ("hits", pa.list_(one))])

    @F.arrow_udf(
        """but int, hits array<struct<at: int, valence: bigint, known: array<boolean>,
        boost: array<bigint>>>"""
    )
    def find(texts: pa.Array) -> pa.Array:
        held, boost = shared.value

        def hit(words: list[str], at: int) -> dict:
            before = [words[at - back] for back in (1, 2, 3) if at >= back]
            return {
                "at": at,
                "valence": held[words[at]],
                "known": [word in held for word in before],
                "boost": [boost.get(word) for word in before],
            }

        def of(text: str | None) -> dict:
            # What ``split`` takes for space is what ``SPACES`` names.
            words = [_bare(piece).lower() for piece in text.split()] if text else []
            hits = (at for at, w in enumerate(words) if w in held and w not in boost)
            return {
                "but": words.index("but") + 1 if "but" in words else 0,
                "hits": [hit(words, at) for at in hits],
            }

        return joined([pa.array([of(t) for t in part], kind) for part in slices(texts)], kind)

    return find


def _bare(piece: str) -> str:
    """``bare_word`` of one piece."""
    bare = piece.strip(PUNCTUATION)
    return piece if len(bare) <= 2 else bare


def rule_score(
    df: DataFrame,
    lexicon: Lexicon | DataFrame,
    text: str = "text",
    alpha: int = ALPHA,
    boosters: Mapping[str, float] = BOOSTERS,
    negations: Sequence[str] = NEGATIONS,
) -> DataFrame:
    """Add ``sentiment_score`` with the model's rules for context: boosters and negations up to
    three words before, capitals among other case, what follows a "but", and ``!`` and ``?``.

    Only words of the lexicon, of any size, look at the three before them. Idioms and the word
    "least", which the model also knows, are not looked at.
    """
    known = unique_words(lexicon, df)
    boost = unique_words(list(boosters.items()), df)
    held = _held(known)
    if held is None:
        totals = _joined_rule_sums(df, known, boost, text, negations)
        return _scored(df, totals, text, _marked(F.col("_total"), text), alpha)
    raised = {r["word"]: r["valence"] for r in boost.collect()}
    find = _finder(df.sparkSession.sparkContext.broadcast((held, raised)))
    found = computed(df.drop("sentiment_score"), _found=find(text))
    # The words themselves are looked at only where there is one of the lexicon.
    some = F.size("_found.hits") > 0
    found = computed(found, _words=F.when(some, _words_of(text)))
    found = computed(found, _mixed=_mixed_case(F.col("_words")))
    words, mixed = F.col("_words"), F.col("_mixed")

    def first(hit: Column) -> Column:
        value = hit["valence"] / F.lit(float(UNIT))
        v = value + _capitals_of(F.get(words, hit["at"]), mixed, value)
        return F.struct(
            hit["at"].alias("at"), hit["known"].alias("known"), hit["boost"].alias("boost"),
            v.alias("v"),
        )

    def under(back: int) -> Callable[[Column], Column]:
        def step(hit: Column) -> Column:
            def before(b: int) -> Column:
                return F.when(hit["at"] >= b, F.get(words, hit["at"] - b))

            place = F.lit(back - 1)
            held_too = F.coalesce(F.get(hit["known"], place), F.lit(False))
            return hit.withField(
                "v",
                _step(
                    hit["v"], back, before, held_too, F.get(hit["boost"], place), mixed, negations
                ),
            )

        return step

    hits = F.transform("_found.hits", first)
    for back in (1, 2, 3):
        hits = F.transform(hits, under(back))
    total = F.aggregate(
        hits,
        F.lit(0).cast("decimal(38,15)"),
        lambda sum_, hit: (sum_ + _exact(hit["v"] * _side(hit["at"], F.col("_found.but")))).cast(
            "decimal(38,15)"
        ),
    )
    summed = computed(found, _total=total.cast("double"))
    score = normalize_score(_marked(F.col("_total"), text), alpha)
    return computed(summed, sentiment_score=score).drop(
        "_found", "_words", "_mixed", "_total"
    )


def _words_of(text: str) -> Column:
    return F.transform(F.filter(F.split(F.col(text), SPACES), lambda w: w != ""), bare_word)


def _exact(value: Column) -> Column:
    """A value whose sums are the same in any order of rows."""
    return value.cast("decimal(28,15)")


def _side(at: Column, but: Column) -> Column:
    """The weight of a place before or after the "but" at position ``but`` (from 1, 0: none)."""
    return (
        F.when((but == 0) | (at + 1 == but), F.lit(1.0))
        .when(at + 1 < but, F.lit(BEFORE_BUT))
        .otherwise(F.lit(AFTER_BUT))
    )


def _marked(total: Column, text: str) -> Column:
    """A sum with the emphasis of its text, in units."""
    total = F.coalesce(total, F.lit(0.0))
    emphasis = F.coalesce(_emphasis(F.col(text)), F.lit(0.0))
    return (total + F.signum(total) * emphasis) * UNIT


def _joined_rule_sums(
    df: DataFrame, known: DataFrame, boost: DataFrame, text: str, negations: Sequence[str]
) -> DataFrame:
    """``_a, _b, _total`` of texts with a word of the lexicon, for lexicons of any size: each word
    carries the three before it, and only words of the lexicon go on to look at them."""
    boost = boost.withColumnRenamed("valence", "boost")
    texts = computed(
        df.filter(F.col(text).isNotNull()).select(*_text_key(text), F.col(text).alias("_text")),
        _words=_words_of("_text"),
    ).drop("_text")
    texts = computed(
        texts,
        _mixed=_mixed_case(F.col("_words")),
        _but=F.array_position(F.transform("_words", F.lower), "but"),
    )
    before = [
        F.when(F.col("_at") >= back, F.get("_words", F.col("_at") - back)).alias(f"w{back}")
        for back in (1, 2, 3)
    ]
    words = texts.select(
        "_a", "_b", "_mixed", "_but", "_words", F.posexplode("_words").alias("_at", "w0")
    ).select("_a", "_b", "_mixed", "_but", "_at", "w0", *before)
    rows = words.withColumn("word", F.lower("w0")).join(known, "word").join(
        boost.select("word"), "word", "left_anti"
    )
    for back in (1, 2, 3):
        own = F.lower(f"w{back}")
        rows = (
            rows.withColumn("word", own)
            .join(known.select("word", F.lit(True).alias(f"k{back}")), "word", "left")
            .join(boost.withColumnRenamed("boost", f"b{back}"), "word", "left")
        )
    value, mixed = F.col("valence") / F.lit(float(UNIT)), F.col("_mixed")
    rows = rows.withColumn("v", value + _capitals_of(F.col("w0"), mixed, value))
    for back in (1, 2, 3):
        rows = rows.withColumn(
            "v",
            _step(
                F.col("v"), back, lambda b: F.col(f"w{b}"), F.col(f"k{back}").isNotNull(),
                F.col(f"b{back}"), mixed, negations,
            ),
        )
    # A repeated text counts once per occurrence.
    sums = rows.groupBy("_a", "_b").agg(
        F.sum(_exact(F.col("v") * _side(F.col("_at"), F.col("_but")))).alias("_sum")
    )
    copies = df.filter(F.col(text).isNotNull()).groupBy(*_text_key(text)).agg(
        F.count("*").alias("_copies")
    )
    return sums.join(copies, ["_a", "_b"]).select(
        "_a", "_b", (F.col("_sum").cast("double") / F.col("_copies")).alias("_total")
    )


def _is_capitals(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _mixed_case(words: Column) -> Column:
    return F.exists(words, _is_capitals) & F.exists(words, lambda w: ~_is_capitals(w))


def _capitals_of(word: Column, mixed: Column, value: Column) -> Column:
    """What capitals among other case add to a value, in its direction."""
    amount = F.when(value > 0, F.lit(CAPITALS)).otherwise(F.lit(-CAPITALS))
    return F.when(mixed & _is_capitals(word), amount).otherwise(F.lit(0.0))


def _step(
    v: Column,
    back: int,
    before: Callable[[int], Column],
    held: Column,
    boost: Column,
    mixed: Column,
    negations: Sequence[str],
) -> Column:
    """The value ``v`` under the word ``back`` places before. A word of the lexicon (``held``), and
    the front of the text, change nothing."""
    word = before(back)
    low = F.lower(word)

    def nearer(*words: str) -> Column:
        return F.coalesce(
            any_of(F.lower(before(b)).isin(*words) for b in range(1, back)), F.lit(False)
        )

    base = boost / F.lit(float(UNIT))
    signed = F.when(v < 0, -base).otherwise(base) + _capitals_of(word, mixed, v)
    boosted = v + F.coalesce(signed * DISTANCE[back - 1], F.lit(0.0))
    turned = (
        F.when((low == "never") & nearer("so", "this"), F.lit(NEVER_SO))
        .when((low == "without") & nearer("doubt"), F.lit(1.0))
        .when(low.isin(*negations) | F.contains(low, F.lit("n't")), F.lit(NEGATION))
        .otherwise(F.lit(1.0))
    )
    return F.when(word.isNotNull() & ~held, boosted * turned).otherwise(v)


def _emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the size of a sum."""
    loud = F.least(F.regexp_count(text, F.lit("!")), F.lit(EXCLAMATIONS)) * F.lit(EXCLAMATION)
    asked = F.regexp_count(text, F.lit(r"\?"))
    doubt = (
        F.when(asked <= 1, F.lit(0.0))
        .when(asked <= QUESTIONS, asked * F.lit(QUESTION))
        .otherwise(F.lit(MANY_QUESTIONS))
    )
    return loud + doubt


def sentiment_label(score: Column, pos: float = POSITIVE, neg: float = NEGATIVE) -> Column:
    """Positive, Negative or Neutral."""
    return (
        F.when(score >= pos, "Positive").when(score <= neg, "Negative").otherwise("Neutral")
    )
