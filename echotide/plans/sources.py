"""Normalisers over payloads that Spark builds from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from ..session import checkpoint_root
from ..sources import feeds, files, pages, variants
from .fixtures import sql_collapse, sql_trim
from .registry import ORACLES, day, query, table

APPS = (feeds.App("Alpha", "com.alpha", "One"), feeds.App("Beta", "com.beta", "Two"))


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text", "source")


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _escaped(text: str = "text") -> Column:
    """Text as it stands in HTML."""
    c = F.col(text)
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(name))
    return c


def _payload(df, schema: str, **fields: Column):
    """Build a payload as JSON text and read it under its schema, the way it would land."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.select("*", F.from_json(body, schema).alias("_p")).select("*", "_p.*").drop("_p")


def _which(n: int) -> Column:
    return F.col("doc_id") % n


_DAY = "date '2025-09-01' + to_days(cast(doc_id * 7 % 270 as int))"


def _date() -> Column:
    return F.date_add(F.lit("2025-09-01").cast("date"), (F.col("doc_id") * 7 % 270).cast("int"))


# Reviews and posts


@query(
    f"""select cast(doc_id as varchar) review_id, 'Google Play' platform,
               'Play Store — ' || app source, null::varchar country,
               case when doc_id % 11 = 0 then '' else strftime({_DAY}, '%d/%m/%Y') end date,
               false date_is_ingest, 'u' || (doc_id % 9) username,
               case when doc_id % 2 = 0 then '' else 'title ' || doc_id end title,
               case when doc_id % 5 = 0 then '' else text end as text,
               cast(doc_id % 6 as varchar) score_raw,
               case app when 'Alpha' then 'One' else 'Two' end product_tag,
               null::varchar keyword,
               'https://play.google.com/store/apps/details?id=' ||
               case app when 'Alpha' then 'com.alpha' else 'com.beta' end url
        from (select *, case doc_id % 3 when 0 then 'Alpha' when 1 then 'Beta' else 'Other' end app
              from documents)
        where app <> 'Other'"""
)
def norm_play_store(spark, sf_dir):
    return feeds.normalize_play_store(_play_store(spark, sf_dir), APPS)


def _play_store(spark, sf_dir):
    label = F.when(_which(3) == 0, "Alpha").when(_which(3) == 1, "Beta").otherwise("Other")
    return _payload(
        _documents(spark, sf_dir).drop("source"),
        schemas.PLAY_STORE_REVIEW,
        reviewId=F.col("doc_id").cast("string"),
        userName=F.concat(F.lit("u"), _which(9)),
        title=F.when(_which(2) == 1, F.concat(F.lit("title "), "doc_id")),
        content=F.when(_which(5) != 0, F.col("text")),
        score=_which(6).cast("int"),
        at=F.when(_which(11) != 0, _date().cast("timestamp")),
        app_label=label,
    )


def _labelled(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(c.alias("label")))


def _entry(id, title, content, summary=None, name=None, href=None) -> Column:
    none = F.lit(None).cast("string")
    text = lambda v: none if v is None else v
    return F.struct(
        _labelled(id).alias("id"),
        _labelled(title).alias("title"),
        _labelled(text(content)).alias("content"),
        _labelled(text(summary)).alias("summary"),
        _labelled(_which(6).cast("string")).alias("im:rating"),
        _labelled(text(name)).alias("im:name"),
        F.struct(_labelled(F.concat(F.lit("u"), _which(9))).alias("name")).alias("author"),
        _labelled(F.date_format(_date(), "yyyy-MM-dd'T02:00:00+05:30'")).alias("updated"),
        F.struct(F.struct(text(href).alias("href")).alias("attributes")).alias("link"),
    )


@query(
    f"""with app as (select *, cast(doc_id as varchar) id from documents where doc_id % 10 < 8),
        entries as (
          select doc_id, case doc_id % 3 when 0 then 1 else 0 end as position, id review_id,
                 'title ' || doc_id title, text, case when doc_id % 2 = 0 then 'https://r/' || id
                 else 'https://apps.apple.com/app/idcom.alpha' end url from app
          union all
          select doc_id, 1, 'app', 'App', '', 'https://apps.apple.com/app/idcom.alpha'
          from app where doc_id % 3 = 1
          union all
          select doc_id, case doc_id % 3 when 2 then 1 else 2 end, id || 'b', '', text,
                 'https://apps.apple.com/app/idcom.alpha' from app where doc_id % 2 = 1)
        select review_id, 'Apple App Store' platform, 'App Store — Alpha' source, 'in' country,
               strftime({_DAY}, '%d/%m/%Y') date, false date_is_ingest,
               'u' || (doc_id % 9) username, title, text, cast(doc_id % 6 as varchar) score_raw,
               'One' product_tag, null::varchar keyword, url, cast(position as int) as position
        from entries"""
)
def norm_app_store(spark, sf_dir):
    doc = F.col("doc_id").cast("string")
    first = _entry(
        doc,
        F.concat(F.lit("title "), "doc_id"),
        F.col("text"),
        href=F.when(_which(2) == 0, F.concat(F.lit("https://r/"), doc)),
    )
    # The second review has a summary instead of a content, or neither that nor a title.
    second = _entry(
        F.concat(doc, F.lit("b")),
        F.lit(""),
        F.lit(""),
        F.when(_which(2) == 1, F.col("text")).otherwise(""),
    )
    about = _entry(F.lit("app"), F.lit("App"), None, name=F.lit("The App"))
    entries = (
        F.when(_which(3) == 0, F.array(about, first, second))
        .when(_which(3) == 1, F.array(first, about, second))
        .otherwise(F.array(first, second))
    )
    landed = _payload(
        _documents(spark, sf_dir).drop("source"),
        schemas.APP_STORE_PAGE,
        feed=F.struct(entries.alias("entry")),
        country=F.lit("in"),
        page=F.lit(1),
        app_label=F.when(_which(10) < 8, "Alpha").otherwise("Other"),
    )
    return feeds.normalize_app_store(landed, APPS)


@query(
    """select case when doc_id % 2 = 0 then 'id' || doc_id else left(md5('Beta|' || text), 12) end
                review_id, 'Apple App Store' platform,
              'App Store — Beta' source, text, 'Two' product_tag, cast(0 as int) as position
       from documents"""
)
def norm_app_store_catalog(spark, sf_dir):
    id = F.when(_which(2) == 0, F.concat(F.lit("id"), "doc_id")).when(_which(3) == 0, "")
    body = F.struct(id.alias("id"), F.struct(F.col("text").alias("body")).alias("attributes"))
    landed = _payload(
        _documents(spark, sf_dir).drop("source"),
        schemas.APP_STORE_CATALOG_PAGE,
        data=F.array(body),
        app_label=F.lit("Beta"),
    )
    return feeds.normalize_app_store_catalog(landed, APPS).select(
        "review_id", "platform", "source", "text", "product_tag", "position"
    )


_SQL_POST = f"""
  select *, case when doc_id % 13 = 0 then '' else cast(doc_id as varchar) end id,
         case when doc_id % 4 = 0 then '' else 'Post ' || doc_id end title,
         case when doc_id % 5 in (0, 2) then '' else {sql_trim('text')} end body,
         case when doc_id % 17 = 0 then '' else strftime({_DAY}, '%d/%m/%Y') end date
  from documents"""


@query(
    f"""select id review_id, 'Reddit' platform, source, null::varchar country, date,
               false date_is_ingest, 'u' || (doc_id % 9) username, title,
               case when body = '' then title else body end as text,
               cast(case when doc_id % 3 = 0 then 0 else doc_id end as varchar) score_raw,
               null::varchar product_tag, 'kw' keyword,
               'https://www.reddit.com/r/' || source || '/comments/' || id || '/' url,
               cast(0 as int) as position
        from ({_SQL_POST}) where id <> '' and (body <> '' or title <> '')"""
)
def norm_reddit(spark, sf_dir):
    return feeds.normalize_reddit(_reddit(spark, sf_dir)).drop("created")


def _reddit(spark, sf_dir):
    seconds = F.unix_seconds(_date().cast("timestamp"))
    created = (
        F.when(_which(17) == 0, F.lit("soon"))
        .when(_which(2) == 0, seconds.cast("string"))
        .otherwise(F.date_format(_date(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    post = F.struct(
        F.when(_which(13) != 0, F.col("doc_id").cast("string")).alias("id"),
        F.when(_which(4) == 0, "").otherwise(F.concat(F.lit("  Post "), "doc_id")).alias("title"),
        F.when(_which(5) == 0, "[deleted] ")
        .when(_which(5) == 1, "")
        .when(_which(5) == 2, "[removed]")
        .otherwise(F.concat(F.lit(" \n"), "text"))
        .alias("selftext"),
        F.when(_which(5) == 1, F.col("text")).otherwise("unused").alias("body"),
        F.concat(F.lit("u"), _which(9)).alias("author"),
        F.when(_which(3) != 0, F.col("doc_id")).alias("score"),
        created.alias("created_utc"),
    )
    return _payload(
        _documents(spark, sf_dir),
        schemas.FORUM_PAGE,
        data=F.array(post),
        sub=F.col("source"),
        keyword=F.lit("kw"),
    )


@query(
    f"""select case when doc_id % 2 = 0 then 't' || doc_id else 'i' || doc_id end review_id,
               'Twitter' platform, 'Twitter (unofficial)' source,
               strftime({_DAY}, '%d/%m/%Y') date,
               case when doc_id % 3 = 0 then '' else 'u' || (doc_id % 9) end username,
               '' title, text, cast(case when doc_id % 3 = 0 then doc_id % 7 else doc_id * 1000 end
               as varchar) score_raw, 'q' keyword,
               case when doc_id % 2 = 0 then '' else 'https://t/' || doc_id end url
        from documents where doc_id % 10 <> 9"""
)
def norm_tweets(spark, sf_dir):
    return _tweets(spark, sf_dir).select(
        "review_id", "platform", "source", "date", "username", "title", "text", "score_raw",
        "keyword", "url",
    )


def _tweets(spark, sf_dir):
    nested = _which(3) != 0
    tweet = F.struct(
        F.when(_which(2) == 0, F.concat(F.lit("t"), "doc_id")).alias("tweet-id"),
        F.concat(F.lit("i"), "doc_id").alias("id"),
        F.when(_which(10) < 5, F.col("text")).otherwise("").alias("text"),
        F.when(_which(10) != 9, F.col("text")).alias("content"),
        F.when(_which(2) == 0, F.date_format(_date(), "MMM d, yyyy' · 3:45 PM UTC'"))
        .otherwise(F.date_format(_date(), "yyyy-MM-dd'T23:00:00-08:00'"))
        .alias("date"),
        # A key that is present but empty does not give way to the other one.
        F.when(_which(2) == 0, "").alias("link"),
        F.concat(F.lit("https://t/"), "doc_id").alias("url"),
        _which(7).cast("string").alias("likes"),
        F.when(nested, F.struct(F.concat(F.lit("u"), _which(9)).alias("username"))).alias("user"),
        F.when(
            nested, F.struct(F.format_number(F.col("doc_id") * 1000, 0).alias("likes"))
        ).alias("stats"),
    )
    landed = _payload(
        _documents(spark, sf_dir), schemas.TWEET_PAGE, tweets=F.array(tweet), query=F.lit("q")
    )
    return feeds.normalize_tweets(landed)


@query(
    f"""with t as (select *, 'c' || (doc_id // 2) id, {sql_collapse('text')} clean from documents)
        select id review_id, source, strftime({_DAY}, '%d/%m/%Y') date, clean as text,
               cast(doc_id as varchar) score_raw, 'https://n/' || lpad(doc_id::varchar, 9, '0') url
        from t where length(clean) >= 10
        qualify row_number() over (partition by id order by doc_id) = 1"""
)
def norm_thread_comments(spark, sf_dir):
    return _threads(spark, sf_dir).select(
        "review_id", "source", "date", "text", "score_raw", "url"
    )


def _threads(spark, sf_dir):
    post = F.struct(
        F.concat(F.lit("c"), F.expr("doc_id div 2")).alias("id"),
        F.concat(F.lit("<p> "), _escaped(), F.lit(" </p>")).alias("raw_message"),
        F.date_format(_date(), "yyyy-MM-dd'T10:00:00+00:00'").alias("createdAt"),
        F.col("doc_id").alias("likes"),
        F.struct(F.concat(F.lit("u"), _which(9)).alias("name")).alias("author"),
    )
    landed = _payload(
        _documents(spark, sf_dir),
        schemas.THREAD_PAGE,
        response=F.array(post),
        page_url=F.concat(F.lit("https://n/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")),
        site_name=F.col("source"),
        query=F.lit("q"),
    )
    return feeds.normalize_thread_comments(landed)


@query(
    f"""with t as (select *, {sql_trim('text')} body, 'https://s/' || conv_id || '/blinkit' url
                   from conversations)
        select left(md5(url), 12) review_id, 'LinkedIn' platform, left(text, 200) title,
               left(body, 2000) as text, 'Blinkit' product_tag, url, 'LinkedIn' keyword
        from t where length(body) >= 30
        qualify row_number() over (partition by url order by turn) = 1"""
)
def search_results(spark, sf_dir):
    return _results(spark, sf_dir).select(
        "review_id", "platform", "title", "text", "product_tag", "url", "keyword"
    )


def _results(spark, sf_dir):
    found = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("https://s/"), "conv_id", F.lit("/blinkit")).alias("url"),
        F.col("text").alias("title"),
        F.concat(F.lit("\t"), "text", F.lit("\n")).alias("text"),
        F.lit("").alias("author"),
        F.lit("").alias("date"),
        F.concat(F.lit("q"), F.col("conv_id") % 3).alias("query"),
        F.col("turn").alias("position"),
    )
    return feeds.normalize_search_results(found)


# Pages


_LIVE = (
    "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'),"
    " '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
)


@query(
    f"""with a as (select page_id, unnest(regexp_extract_all({_LIVE},
                          '(?i)<a [^>]*href="([^"]*)"', 1)) url,
                          generate_subscripts(regexp_extract_all({_LIVE},
                          '(?i)<a [^>]*href="([^"]*)"', 1), 1) n from pages),
        firsts as (select page_id, url, min(n) n from a
                   where url like '/%' and not contains(url, '/the') group by all)
        select page_id, cast(row_number() over (partition by page_id order by n) - 1 as int)
               as position, url
        from firsts qualify row_number() over (partition by page_id order by n) <= 4"""
)
def page_links(spark, sf_dir):
    return pages.extract_links(
        _pages(spark, sf_dir),
        domain=None,
        exclude="/the",
        cap=4,
        link_class=None,
        keep_prefixes=("/",),
        carry=["page_id"],
    )


@query(
    """select page_id, cast(0 as int) as position, url from pages where contains(url, '.com')
       union all
       select page_id, cast(case when contains(url, '.com') then 1 else 0 end as int),
              'http://direct.example.com/' || page_id from pages"""
)
def page_links_redirect(spark, sf_dir):
    html = F.concat(
        F.lit('<div><a rel="x" class="result__a" href="//s/l/?uddg='),
        F.url_encode("url"),
        F.lit('&amp;rut=1">one</a><a class="other" href="http://other.example.com/">no</a>'),
        F.lit('<a class="result__a big" href="http://direct.example.com/'),
        "page_id",
        F.lit('">two</a><a class="result__a" href="//s/l/?uddg='),
        F.url_encode("url"),
        F.lit('&amp;rut=2">again</a></div>'),
    )
    found = _pages(spark, sf_dir).select("page_id", "url", html.alias("html"))
    return pages.extract_links(
        found, ".com", pages.QUESTION_EXCLUDE, pages.NEWS_LINKS_PER_PAGE, carry=["page_id"]
    )


_SQL_H1 = "regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)"
_SQL_TITLE = sql_trim(f"replace(replace({_SQL_H1}, '&quot;', '\"'), '&amp;', '&')")


@query(
    f"""select page_id, layout, cast(0 as int) as position, url, {_SQL_TITLE} title,
               case layout when 'primary' then {_SQL_TITLE} else '' end as text
        from pages, (values ('primary'), ('fallback')) l(layout) where contains(url, 'example.com')
        """
)
def page_results(spark, sf_dir):
    heading = F.regexp_extract("html", "(?is)<h1>(.*?)</h1>", 1)
    source = _pages(spark, sf_dir)
    link = F.replace("url", F.lit("&"), F.lit("&amp;"))
    primary = F.concat(
        F.lit('<div class="results"><div class="result web"><a class="result__a" href="'),
        link, F.lit('"><b> '), heading, F.lit('</b></a><a class="result__snippet"> '), heading,
        F.lit('</a></div><div class="result"><p>no link</p></div></div>'),
    )
    fallback = F.concat(
        F.lit('<ol><li class="b_algo"><h2><a href="'), link, F.lit('">'), heading,
        F.lit('</a></h2><div class="b_caption"></div></li></ol>'),
    )
    both = [
        pages.extract_results(
            source.select("page_id", html.alias("html")), "example.com", layout, ["page_id"]
        ).withColumn("layout", F.lit(layout))
        for layout, html in (("primary", primary), ("fallback", fallback))
    ]
    return files.union_sources(*both).drop("author", "date")


_SQL_ENDS = (
    "(?is)</?(?:p|div|article|section|ul|ol|table|h[1-6]|footer|nav|header|main|aside|blockquote|"
    "form|pre|hr|body|html)\\b.*$"
)
_SQL_DECODED = (
    "replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'),"
    " '&amp;', '&')"
)
_SQL_PIECE_TEXT = sql_collapse(
    _SQL_DECODED.format("regexp_replace(piece, '<[^>]*>', ' ', 'g')")
)
_SQL_PIECE_SOLID = sql_trim(
    _SQL_DECODED.format("regexp_replace(piece, '\\s*<[^>]*>\\s*', '', 'g')")
)


@query(
    f"""with split as (select page_id, url, html, string_split({_LIVE}, '<p>') parts from pages),
        pieces as (select page_id, url, {_SQL_TITLE} title,
                          regexp_replace(unnest(parts[2:]), '{_SQL_ENDS}', '') piece,
                          generate_subscripts(parts[2:], 1) n from split),
        texts as (select page_id, url, title, n, {_SQL_PIECE_TEXT} as text from pieces
                  where length({_SQL_PIECE_SOLID}) > 80),
        capped as (select *, row_number() over (partition by page_id order by n) - 1 as position
                   from texts
                   qualify row_number() over (partition by page_id order by n) <= 5)
        select page_id, cast(position as int) as position,
               left(md5(url || '|' || left(text, 100)), 12) review_id,
               'Quora' platform, '01/06/2026' date, true date_is_ingest, title, text, url,
               'q' || (page_id % 7) keyword
        from capped where length(text) >= 40"""
)
def page_answers(spark, sf_dir):
    return _answers(spark, sf_dir).select(
        "page_id", "keyword", "position", "review_id", "platform", "date", "date_is_ingest",
        "title", "text", "url",
    )


def _answers(spark, sf_dir):
    return pages.extract_answers(
        _pages(spark, sf_dir).withColumn("query", F.concat(F.lit("q"), F.col("page_id") % 7)),
        as_of="2026-06-01",
        keyword="query",
        carry=["page_id"],
    )


@query(
    f"""with t as (select doc_id, {sql_collapse("text || ' tail'")} as text from documents)
        select doc_id, cast(0 as int) as position,
               left(md5('https://q/' || doc_id || '|' || left(text, 100)), 12) review_id,
               'Q' || doc_id title, text
        from t where length(text) >= 40"""
)
def page_answer_blocks(spark, sf_dir):
    html = F.concat(
        F.lit("<h1>Q"), "doc_id", F.lit('</h1><div class="x Spacing_Log"><div>'), _escaped(),
        F.lit('</div><span>tail</span></div><div class="qu-userSelect">short</div><p>'),
        _escaped(), F.lit("</p>"),
    )
    found = _documents(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("https://q/"), "doc_id").alias("url"), html.alias("html")
    )
    return pages.extract_answers(found, carry=["doc_id"]).select(
        "doc_id", "position", "review_id", "title", "text"
    )


@query(
    f"""with t as (select doc_id, source, {sql_collapse('text')} body, 'https://p/' || doc_id url
                   from documents),
        picked as (select *, case when length(body) >= 20 then body when doc_id % 3 = 0
                          then 'a second selector, long enough' end as text from t)
        select doc_id, cast(0 as int) as position,
               left(md5(url || '|' || left(text, 80)), 12) review_id, source,
               case when doc_id % 3 = 2 then '' else 'user ' || (doc_id % 50) end username,
               'News ' || doc_id title, text, url, 'k' || (doc_id % 6) keyword
        from picked where text is not null"""
)
def page_comments(spark, sf_dir):
    block = (
        F.when(
            _which(3) == 0,
            F.concat(
                F.lit('<div class="comment-body">'), _escaped(),
                F.lit('</div><p class="comment">a second selector, long enough</p>'),
            ),
        )
        .when(
            _which(3) == 1,
            F.concat(
                F.lit('<div class="comment-body">short</div><p class="big comment">'),
                _escaped(), F.lit("</p>"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('<ul><li class="comment">'), _escaped(), F.lit('<li class="comment">no</ul>')
            )
        )
    )
    html = F.concat(
        F.lit("<html><head><title>News "), "doc_id",
        F.lit('</title></head><body><div class="thread"><span class="author"> user '), _which(50),
        F.lit("</span>"), block, F.lit("</div></body></html>"),
    )
    found = _documents(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("https://p/"), "doc_id").alias("url"),
        F.col("source").alias("site_name"),
        html.alias("html"),
        F.concat(F.lit("k"), _which(6)).alias("query"),
    )
    return pages.extract_page_comments(found, keyword="query", carry=["doc_id"]).select(
        "doc_id", "position", "review_id", "source", "username", "title", "text", "url", "keyword"
    )


# Stacking and typing


@query(
    f"""select platform, count(*) n_rows, count(product_tag) n_products, count(keyword) n_keywords
        from (select 'Google Play' platform, 'x' product_tag, null keyword from documents
              where doc_id % 3 <> 2
              union all by name
              select 'Reddit' platform, 'kw' keyword, null product_tag from ({_SQL_POST})
              where id <> '' and (body <> '' or title <> ''))
        group by platform"""
)
def union_sources(spark, sf_dir):
    posts = feeds.normalize_reddit(_reddit(spark, sf_dir)).drop("product_tag")
    reviews = feeds.normalize_play_store(_play_store(spark, sf_dir), APPS).drop("keyword")
    return files.union_sources(reviews, posts).groupBy("platform").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("product_tag").alias("n_products"),
        F.count("keyword").alias("n_keywords"),
    )


@query(
    """with p as (select * from conversations where role = 'system')
       select conv_id, turn, role from p
       union all
       select conv_id, turn, role from conversations
       where role = 'user' and conv_id not in (select conv_id from p)"""
)
def source_fallback(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return files.fallback_union(
        rows.filter("role = 'system'"), rows.filter("role = 'user'"), "conv_id"
    )


@query(
    f"""select cast(doc_id as varchar) review_id, strftime({_DAY}, '%Y-%m-%d') review_date,
               case when doc_id % 3 = 0 then cast(doc_id % 6 as int) end star_rating,
               case when doc_id % 4 = 0 then null else cast(doc_id % 9 as double) / 4 end
               sentiment_score, text
        from documents"""
)
def typed_base(spark, sf_dir):
    raw = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("Review_ID"),
        F.when(_which(2) == 0, F.date_format(_date(), "dd/MM/yyyy"))
        .otherwise(F.date_format(_date(), "yyyy-MM-dd"))
        .alias("Date"),
        F.when(_which(3) == 0, F.concat(F.lit(" "), _which(6)))
        .when(_which(3) == 1, "good")
        .otherwise("")
        .alias("Score"),
        F.when(_which(4) == 0, "n/a")
        .otherwise((_which(9) / 4).cast("string"))
        .alias("Sentiment_Score"),
        F.col("text").alias("Text"),
    )
    return files.enforce_types(raw).withColumn("review_date", day("review_date"))


@query(
    f"""select cast(doc_id as varchar) review_id, 'Google Play Store' platform,
               case when doc_id % 11 <> 0 then strftime({_DAY}, '%Y-%m-%d') end review_date,
               case when doc_id % 6 > 0 then cast(doc_id % 6 as int) end star_rating
        from documents where doc_id % 3 <> 2"""
)
def typed_reviews(spark, sf_dir):
    rows = files.type_collected(feeds.normalize_play_store(_play_store(spark, sf_dir), APPS))
    return rows.select("review_id", "platform", day("review_date").alias("review_date"), "star_rating")


@query(
    f"""select case when doc_id % 6 = 0 then null else doc_id end id, count(*) n from documents
        group by 1"""
)
def corrupt_payloads(spark, sf_dir):
    """Payload lines written as text, every sixth broken off, read with the broken ones kept."""
    line = F.concat(F.lit('{"id": "'), "doc_id", F.lit('", "body": "x"}'))
    landed = _documents(spark, sf_dir).select(
        F.when(_which(6) == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")
    )
    path = f"{checkpoint_root(spark)}/payloads-{uuid.uuid4().hex}"
    landed.write.text(path)
    back = files.read_payloads(spark, path, "id string, body string")
    broken = F.col(files.CORRUPT).isNotNull()
    return back.groupBy(F.when(~broken, F.col("id")).cast("bigint").alias("id")).agg(
        F.count("*").alias("n")
    )


@query(
    f"""select cast(doc_id as varchar) review_id, strftime({_DAY}, '%Y-%m-%d') review_date,
               replace(text, chr(10), ' / ') || ', "quoted"' as text, cast(doc_id % 6 as int) star
        from documents"""
)
def csv_roundtrip(spark, sf_dir):
    """The flat table written as CSV and read back, one line per row."""
    rows = _documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("Review_ID"),
        F.lit("Reddit").alias("Platform"),
        F.lit("s").alias("Source"),
        F.date_format(_date(), "dd/MM/yyyy").alias("Date"),
        F.lit("u").alias("Username"),
        F.lit("t").alias("Title"),
        F.concat(F.replace("text", F.lit("\n"), F.lit(" / ")), F.lit(', "quoted"')).alias("Text"),
        _which(6).alias("Score"),
        *(F.lit("x").alias(c) for c in ("Product_Tag", "URL", "Sentiment")),
        F.lit("0.5").alias("Sentiment_Score"),
        F.lit("l1").alias("L1_Category"),
        F.lit("l2").alias("L2_Specific_Issue"),
    )
    path = f"{checkpoint_root(spark)}/flat-{uuid.uuid4().hex}"
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    back = files.read_reviews_csv(spark, path)
    return back.select(
        "review_id", day("review_date").alias("review_date"), "text",
        F.col("star_rating").alias("star"),
    )


# All sources in one base


def _sql_product(text: str, url: str) -> str:
    where = f"lower({text} || {url})"
    return (
        f"case when contains({where}, 'blinkit') then 'Blinkit'"
        f" when contains({where}, 'district') then 'District' else 'Zomato' end"
    )


def sql_base() -> str:
    """Seven sources stacked: the SQL of each normaliser, dates typed, products filled."""
    parts = {
        "norm_play_store": "platform, source, date, keyword, product_tag",
        "norm_app_store": "platform, source, date, keyword, product_tag",
        "norm_reddit": "platform, source, date, keyword, product_tag",
        "norm_tweets": "platform, source, date, keyword, null product_tag",
        "norm_thread_comments": "'News' platform, source, date, 'q' keyword, null product_tag",
        "search_results": "platform, 'LinkedIn' source, '' date, keyword, product_tag",
        "page_answers": "platform, 'quora.com' source, date, keyword, null product_tag",
    }
    rows = " union all ".join(
        f"select review_id, {columns}, text, url from ({ORACLES[name]})"
        for name, columns in parts.items()
    )
    day_ = "cast(try_strptime(nullif(date, ''), '%d/%m/%Y') as date)"
    return f"""base as (
      select review_id, case platform when 'Google Play' then 'Google Play Store' else platform end
             platform, source, {day_} review_date, keyword, text, url,
             coalesce(product_tag, {_sql_product("text", "url")}) product_tag
      from ({rows}))"""


_BASE_COLUMNS = ("review_id", "platform", "source", "keyword", "text", "url", "product_tag")


def base_all(spark, sf_dir):
    return files.reviews_base(
        norm_play_store(spark, sf_dir),
        norm_app_store(spark, sf_dir),
        norm_reddit(spark, sf_dir),
        _tweets(spark, sf_dir),
        _threads(spark, sf_dir),
        _results(spark, sf_dir),
        _answers(spark, sf_dir),
    )


@query(
    f"""with {sql_base()} select {", ".join(_BASE_COLUMNS)},
        strftime(review_date, '%Y-%m-%d') review_date from base"""
)
def reviews_base_all(spark, sf_dir):
    base = base_all(spark, sf_dir)
    return base.select(*_BASE_COLUMNS, day("review_date").alias("review_date"))


@query(
    f"""with threads as (select review_id, text, url from ({ORACLES["norm_thread_comments"]})
                         where cast(score_raw as int) % 3 > 0),
             page as (select 'p' || doc_id review_id, text,
                             'https://n/' || lpad(doc_id::varchar, 9, '0') url from documents)
        select * from threads union all
        select * from page where url not in (select url from threads)"""
)
def news_thread_first(spark, sf_dir):
    """Comments of a page only where its thread yields none."""
    threads = _threads(spark, sf_dir).filter(F.col("score_raw").cast("int") % 3 > 0)
    page = _documents(spark, sf_dir).select(
        F.concat(F.lit("p"), "doc_id").alias("review_id"),
        "text",
        F.concat(F.lit("https://n/"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("url"),
    )
    return files.thread_first(threads, page).select("review_id", "text", "url")


# Payloads whose fields change over time: a rating as a number, a text, an object or nonsense, an id
# as a number, a key that no schema knows, and lines that are cut off.
_CHANGED = "reviewId STRING, score INT, user STRUCT<name: STRING>, tags ARRAY<STRUCT<label: STRING>>"


@query(
    """select case when broken then null else cast(doc_id as varchar) end review_id,
              case when broken or kind >= 2 then null else (doc_id % 6)::int end score,
              case when broken or kind = 3 then null else text end username,
              case when broken or kind = 2 then null else 't' || doc_id end tag,
              case when broken then null when kind = 1 then 'thumbsUp' else '' end undeclared,
              case when not broken and kind = 1 then doc_id % 7 end thumbs, broken
       from (select doc_id, text, (doc_id % 4)::int kind, doc_id % 10 = 9 broken from documents)"""
)
def changed_payloads(spark, sf_dir):
    read = variants.open_payloads(_changed_lines(spark, sf_dir), "line", _CHANGED)
    payload = F.col(variants.PAYLOAD)
    return read.select(
        F.col("reviewId").alias("review_id"),
        "score",
        F.col("user.name").alias("username"),
        F.get("tags", F.lit(0))["label"].alias("tag"),
        F.array_join(variants.undeclared(payload, _CHANGED, spark), ",").alias("undeclared"),
        F.try_variant_get(payload, "$.thumbsUp", "bigint").alias("thumbs"),
        F.col(files.CORRUPT).isNotNull().alias("broken"),
    )


def _changed_lines(spark, sf_dir):
    """The payloads as JSON texts."""
    id, kind, rating = F.col("doc_id"), _which(4), _which(6)
    label = F.array(F.struct(F.concat(F.lit("t"), "doc_id").alias("label")))
    user = F.struct(F.col("text").alias("name"))

    def line(*fields):
        return F.to_json(F.struct(*fields))

    text = rating.cast("string").alias("score")
    whole = (
        F.when(kind == 0, line(id.alias("reviewId"), rating.alias("score"), user.alias("user"),
                               label.alias("tags")))
        .when(kind == 1, line(id.cast("string").alias("reviewId"), text, user.alias("user"),
                              label.alias("tags"), _which(7).alias("thumbsUp")))
        .when(kind == 2, line(id.alias("reviewId"), F.struct(rating.alias("stars")).alias("score"),
                              user.alias("user"), F.lit("none").alias("tags")))
        .otherwise(line(id.alias("reviewId"), F.lit("good").alias("score"),
                        F.col("text").alias("user"), label.alias("tags")))
    )
    cut = F.when(_which(10) == 9, F.substring(whole, 1, 12)).otherwise(whole)
    return table(spark, sf_dir, "documents").select(cut.alias("line"))
