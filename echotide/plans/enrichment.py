"""Products, platforms, issues and sentiment on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..operators import enrich, measures
from ..operators.sentiment import lexicon_score, rule_score, sentiment_label
from . import fixtures as fx
from . import sources
from .registry import day, query, table

# A stand-in for the caller's lexicon: frequent words of the documents.
LEXICON = (
    ("the", 0.4), ("of", -0.7), ("and", 1.3), ("is", 0.9), ("was", -2.1), ("that", -0.3),
    ("under", -1.5), ("license", 1.9), ("une", 0.8), ("les", -1.1), ("der", 0.6), ("que", -0.9),
    ("with", 1.1), ("not", -1.2), ("free", 2.3), ("no", -1.2),
)

_PRODUCTS = (("license", "Licence"), ("the ", "Article"))


@query(
    """select doc_id, case when contains(t, 'license') then 'Licence'
              when contains(t, 'the ') then 'Article' else 'Other' end product,
              case when contains(t, 'blinkit') then 'Blinkit' when contains(t, 'district')
              then 'District' else 'Zomato' end default_product
       from (select doc_id, lower(text) || lower(source) t from documents)"""
)
def product_tag(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        enrich.product_tag(F.col("text"), F.col("source"), _PRODUCTS, "Other").alias("product"),
        enrich.product_tag(F.col("text"), F.col("source")).alias("default_product"),
    )


@query(
    f"""with {fx.SQL_CORE} select review_id, case platform when 'Google Play'
              then 'Google Play Store' else platform end platform from core"""
)
def platform_canon(spark, sf_dir):
    return fx.core(spark, sf_dir).select(
        "review_id", enrich.canonical_platform(F.col("platform")).alias("platform")
    )


@query(f"with {fx.SQL_TAGGED} select distinct review_id, l1, l2 from f")
def tag_rules(spark, sf_dir):
    rows = enrich.tag_issues(fx.core(spark, sf_dir).select("review_id", "text"), fx.RULES)
    return _pairs(rows)


def _pairs(rows):
    tagged = enrich.explode_tags(rows).filter(F.col("l2_specific_issue").isNotNull())
    return tagged.select(
        "review_id", F.col("l1_category").alias("l1"), F.col("l2_specific_issue").alias("l2")
    )


@query(
    f"""with {fx.SQL_CORE}, rules as (
          select 'Benchmark' l1, 'item ' || (item_id % 7) l2, text kw
          from benchmark)
        select distinct review_id, l1, l2 from core join rules
        on contains(lower(text), lower(kw))"""
)
def tag_rules_table(spark, sf_dir):
    rules = table(spark, sf_dir, "benchmark").select(
        F.lit("Benchmark").alias("l1"),
        F.concat(F.lit("item "), F.col("item_id") % 7).alias("l2"),
        F.col("text").alias("keyword"),
    )
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), "text"
    )
    return _pairs(enrich.tag_issues(rows, rules))


# Rows as they may arrive: ids repeated and missing.
_SQL_ODD = """odd as (
  select case when doc_id % 5 > 0 then doc_id // 3 end id, text from documents
  union all select doc_id // 3, text from documents where doc_id % 4 = 0)"""


def _odd(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    third = F.floor(F.col("doc_id") / 3)
    first = docs.select(F.when(F.col("doc_id") % 5 > 0, third).alias("id"), "text")
    return first.unionByName(
        docs.filter(F.col("doc_id") % 4 == 0).select(third.alias("id"), "text")
    )


@query(
    f"""with {_SQL_ODD}, {fx.SQL_RULES}
        select id, (select count(distinct (l1, l2)) from rules where contains(lower(text), kw)) n,
               (select string_agg(distinct l1 || '/' || l2, ',' order by l1 || '/' || l2)
                from rules where contains(lower(text), kw)) tags from odd"""
)
def tag_rules_dups(spark, sf_dir):
    rules = spark.createDataFrame([*fx.RULES, *fx.RULES], "l1 string, l2 string, keyword string")
    rows = enrich.tag_issues(_odd(spark, sf_dir), rules)
    names = F.transform("tags", lambda t: F.concat(t["l1"], F.lit("/"), t["l2"]))
    tags = F.array_join(F.array_sort(names), ",")
    return rows.select(
        "id", F.size("tags").cast("long").alias("n"), F.when(F.size("tags") > 0, tags).alias("tags")
    )


@query(
    f"""with {fx.SQL_TAGGED}
        select c.review_id, f.l1 l1_category, coalesce(f.l2, '{enrich.DEFAULT_ISSUE}')
               l2_specific_issue
        from core c left join f on c.review_id = f.review_id"""
)
def tag_default(spark, sf_dir):
    rows = enrich.tag_issues(fx.core(spark, sf_dir).select("review_id", "text"), fx.RULES)
    return enrich.explode_tags(enrich.with_default_issue(rows)).drop("text")


_WS = WHITESPACE
_PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
_SQL_SCORES = f"""lexicon(word, valence) as (values {", ".join(
    f"('{w}', {v}::decimal(18, 6))" for w, v in LEXICON)}),
words as (select doc_id, unnest(string_split_regex(text, '[{_WS}]+')) w from documents),
tokens as (select doc_id, lower(case when length(trim(w, '{_PUNCTUATION}')) <= 2 then w
                  else trim(w, '{_PUNCTUATION}') end) word from words where w <> ''),
sums as (select doc_id, cast(sum(valence) as double) s from tokens join lexicon using (word)
         group by doc_id),
scores as (select d.doc_id, coalesce(round(s / sqrt(s * s + 15), 4), 0.0) score
           from documents d left join sums using (doc_id))"""


@query(f"with {_SQL_SCORES} select doc_id, score from scores")
def sentiment_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexicon_score(docs, LEXICON).select(
        "doc_id", F.col("sentiment_score").alias("score")
    )


@query(f"with {_SQL_SCORES} select doc_id, score from scores")
def sentiment_score_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = spark.createDataFrame(list(LEXICON), "word string, valence double")
    return lexicon_score(docs, lexicon).select(
        "doc_id", F.col("sentiment_score").alias("score")
    )


@query(
    f"""with {_SQL_SCORES}
        select case when doc_id % 5 > 0 then doc_id // 3 end id, score from scores
        union all select doc_id // 3, score from scores where doc_id % 4 = 0"""
)
def sentiment_dups(spark, sf_dir):
    words = [(w, v) for w, v in LEXICON] + [("tHE", 9.0), ("the", 9.0), ("wAs", 3.0)]
    lexicon = spark.createDataFrame(words, "word string, valence double")
    # Of words that differ in case, the first by spelling counts: capitals come before letters.
    lexicon = lexicon.withColumn("word", F.when(F.col("valence") < 3, F.upper("word")).otherwise(
        F.col("word")
    ))
    return lexicon_score(_odd(spark, sf_dir), lexicon).select(
        "id", F.col("sentiment_score").alias("score")
    )


@query(
    f"""with {_SQL_SCORES} select doc_id, case when score >= 0.05 then 'Positive'
              when score <= -0.05 then 'Negative' else 'Neutral' end label from scores""",
    name="sentiment_label",
)
def sentiment_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lexicon_score(docs, LEXICON)
    return scored.select("doc_id", sentiment_label(F.col("sentiment_score")).alias("label"))


BOOST_WORDS = {"this": 0.293, "as": 0.293, "le": 0.293, "from": -0.293}
NEGATION_WORDS = ("not", "be", "on", "never", "without")


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _sql_step(back: int) -> str:
    """One step of the context rules over columns that hold the words before."""
    nearer = " or ".join(f"l{b} in ('so', 'this')" for b in range(1, back)) or "false"
    doubt = " or ".join(f"l{b} = 'doubt'" for b in range(1, back)) or "false"
    weight = (1.0, 0.95, 0.9)[back - 1]
    return f"""case when n > {back} and k{back} is null then
        (v + coalesce(((case when v < 0 then -b{back} else b{back} end)
                       + case when mixed and w{back} = upper(w{back}) and w{back} <> lower(w{back})
                              then case when v > 0 then 0.733 else -0.733 end else 0 end)
                      * {weight}::double, 0))
        * case when l{back} = 'never' and ({nearer}) then 1.25
               when l{back} = 'without' and ({doubt}) then 1.0
               when l{back} in ({_quoted(NEGATION_WORDS)}) or contains(l{back}, 'n''t')
               then -0.74 else 1.0 end::double
        else v end"""


_SQL_LAGS = ", ".join(
    f"lag({c}, {b}) over w {c[0]}{b}"
    for b in (1, 2, 3)
    for c in ("word", "low", "known", "boost")
)


@query(
    f"""with lexicon(word, valence) as (values {", ".join(
            f"('{w}', {v}::double)" for w, v in LEXICON)}),
        boosters(word, boost) as (values {", ".join(
            f"('{w}', {v}::double)" for w, v in BOOST_WORDS.items())}),
        pieces as (select doc_id, unnest(list_filter(string_split_regex(text, '[{_WS}]+'),
                          lambda x: x <> '')) p,
                          generate_subscripts(list_filter(string_split_regex(text, '[{_WS}]+'),
                          lambda x: x <> ''), 1) n from documents),
        words as (select doc_id, n, case when length(trim(p, '{_PUNCTUATION}')) <= 2 then p
                         else trim(p, '{_PUNCTUATION}') end word from pieces),
        looked as (select doc_id, n, w.word, lower(w.word) low, l.valence known, b.boost
                   from words w left join lexicon l on lower(w.word) = l.word
                        left join boosters b on lower(w.word) = b.word),
        texts as (select doc_id, count(*) size,
                         count_if(word = upper(word) and word <> lower(word)) capitals,
                         min(case when low = 'but' then n end) but_at from looked group by 1),
        ctx as (select looked.*, capitals > 0 and capitals < size mixed, but_at, {_SQL_LAGS}
                from looked join texts using (doc_id)
                window w as (partition by doc_id order by n)),
        s0 as (select *, known + case when mixed and word = upper(word) and word <> lower(word)
                      then case when known > 0 then 0.733 else -0.733 end else 0 end::double v
               from ctx where known is not null and boost is null),
        s1 as (select * replace ({_sql_step(1)} as v) from s0),
        s2 as (select * replace ({_sql_step(2)} as v) from s1),
        s3 as (select * replace ({_sql_step(3)} as v) from s2),
        sums as (select doc_id, sum(v * case when but_at is null or n = but_at then 1.0
                        when n < but_at then 0.5 else 1.5 end::double order by n) s
                 from s3 group by 1),
        marks as (select doc_id, length(text) - length(replace(text, '!', '')) e,
                         length(text) - length(replace(text, '?', '')) q from documents),
        total as (select doc_id, coalesce(s, 0) s, least(e, 4) * 0.292::double
                         + case when q <= 1 then 0 when q <= 3 then q * 0.18 else 0.96 end::double m
                  from marks left join sums using (doc_id)),
        final as (select doc_id, s + sign(s) * m s from total)
        select doc_id, round(s / sqrt(s * s + 15), 4) score from final"""
)
def sentiment_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = rule_score(docs, LEXICON, boosters=BOOST_WORDS, negations=NEGATION_WORDS)
    return scored.select("doc_id", F.col("sentiment_score").alias("score"))


def _sql_scores(texts: str) -> str:
    """The SQL of the scores over another table of ``doc_id`` and ``text``."""
    return _SQL_SCORES.replace("documents", texts)


@query(
    f"""with {sources.sql_base()},
        said as (select row_number() over () doc_id, * from base where review_date is not null),
        {_sql_scores("said")}
        select strftime(date_trunc('month', review_date), '%Y-%m-%d') as month,
               count_if(score <= -0.05)::bigint n_negative, count(*) n_reviews,
               round(count_if(score <= -0.05)::double / count(*), 9) negativity
        from said join scores using (doc_id) where review_date >= date '2025-12-01' group by 1"""
)
def negativity_from_payloads(spark, sf_dir):
    """Payloads of seven sources to one measure."""
    base = sources.base_all(spark, sf_dir).drop("sentiment", "sentiment_score")
    scored = lexicon_score(base, LEXICON)
    labelled = scored.withColumn("sentiment", sentiment_label(F.col("sentiment_score")))
    monthly = measures.negativity_pct(labelled, ["month"], "2025-12-01")
    return monthly.select(
        day("month").alias("month"), "n_negative", "n_reviews",
        F.round("negativity", 9).alias("negativity"),
    )
