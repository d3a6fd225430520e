"""Column functions on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from .fixtures import sql_clean, sql_collapse, sql_trim
from .registry import day, query, table

_PADDED = "chr(9) || ' ' || text || ' ' || chr(160) || chr(10)"


@query(
    f"select doc_id, {sql_trim(_PADDED)} trimmed, {sql_clean(_PADDED)} cleaned from documents"
)
def clean_text(spark, sf_dir):
    padded = F.concat(F.lit("\t "), "text", F.lit(" \xa0\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.trim_all(padded).alias("trimmed"), fn.clean_text(padded).alias("cleaned")
    )


@query(f"select doc_id, {sql_collapse(_PADDED)} collapsed from documents")
def collapse_ws(spark, sf_dir):
    padded = F.concat(F.lit("\t "), "text", F.lit(" \xa0\n"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.collapse_ws(padded).alias("collapsed")
    )


@query(
    """select conv_id, turn, contains(lower(text), 'the ') found, length(text) >= 200 is_long,
              left(text, 80) head
       from conversations"""
)
def contains_ci(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        fn.contains_ci(text, "THE ").alias("found"),
        fn.min_chars(text, 200).alias("is_long"),
        fn.truncate(text, 80).alias("head"),
    )


@query(
    """select conv_id, turn,
              coalesce(case when role <> 'user' then role end, left(text, 20)) nonempty,
              case when role = 'user' then '' else role end present,
              case when role = 'system' then '' else role end placed
       from conversations"""
)
def first_of_fields(spark, sf_dir):
    role = F.when(F.col("role") == "user", "").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        fn.first_nonempty(role, fn.truncate(F.col("text"), 20)).alias("nonempty"),
        fn.first_present(role, F.col("text")).alias("present"),
        fn.null_placeholders(F.col("role"), ["system"]).alias("placed"),
    )


@query(
    """select event_id,
              case event_id % 4 when 3 then null
                   else cast(floor(epoch(ts)) as bigint) - case event_id % 4 when 2 then 19800
                        else 0 end end as epoch
       from events"""
)
def parse_epoch(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    seconds = F.unix_seconds(ts).cast("string")
    written = (
        F.when(F.col("event_id") % 4 == 0, seconds)
        .when(F.col("event_id") % 4 == 1, F.concat(seconds, F.lit(".7")))
        .when(
            F.col("event_id") % 4 == 2,
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"),
        )
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(fn.parse_epoch_or_iso(written)).alias("epoch")
    )


_DATE_TEXT = """case event_id % 5 when 0 then strftime(ts, '%d/%m/%Y')
    when 1 then strftime(ts, '%Y-%m-%d') when 2 then strftime(ts, '%b %-d, %Y') || ' · 3:45 PM UTC'
    when 3 then strftime(ts, '%Y-%m-%dT%H:%M:%S+05:30') else event_type end"""


def _date_text():
    ts = F.col("ts").cast("timestamp")
    which = F.col("event_id") % 5
    return (
        F.when(which == 0, F.date_format(ts, "dd/MM/yyyy"))
        .when(which == 1, F.date_format(ts, "yyyy-MM-dd"))
        .when(which == 2, F.concat(F.date_format(ts, "MMM d, yyyy"), F.lit(" · 3:45 PM UTC")))
        .when(which == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+05:30'"))
        .otherwise(F.col("event_type"))
    )


@query(
    f"""with t as (select event_id, ts, {_DATE_TEXT} written from events)
        select event_id, written,
               case when event_id % 5 < 4 then strftime(ts, '%Y-%m-%d') end any_date,
               case when event_id % 5 < 2 then strftime(ts, '%Y-%m-%d') end strict_date
        from t"""
)
def parse_date(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", _date_text().alias("written"))
    return rows.select(
        "event_id",
        "written",
        day(fn.parse_date_any(F.col("written"))).alias("any_date"),
        day(fn.parse_dmy(F.col("written"))).alias("strict_date"),
    )


@query(
    """select event_id,
              case when event_id % 10 = 0 then '' else strftime(ts, '%d/%m/%Y') end dmy
       from events"""
)
def format_date(spark, sf_dir):
    ts = F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp")).otherwise(
        F.timestamp_seconds(F.lit(0))
    )
    return table(spark, sf_dir, "events").select("event_id", fn.format_dmy(ts).alias("dmy"))


@query(
    """select event_id,
              case when event_id % 10 = 0 then '' else strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end iso
       from events"""
)
def format_iso(spark, sf_dir):
    ts = F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", fn.format_iso_utc(ts).alias("iso"))


@query(
    """select event_id, strftime(ts, '%Y-%m-%d') wall_date, strftime(ts, '%d/%m/%Y') wall_dmy,
              strftime(date_trunc('month', ts), '%Y-%m-%d') in_month
       from events"""
)
def iso_wall_date(spark, sf_dir):
    written = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+05:30'")
    return table(spark, sf_dir, "events").select(
        "event_id",
        day(fn.iso_wall_date(written)).alias("wall_date"),
        fn.wall_dmy(written).alias("wall_dmy"),
        day(fn.month(fn.iso_wall_date(written))).alias("in_month"),
    )


@query(
    """select event_id, case when event_id % 3 = 0 then user_id * 1234567
              when event_id % 3 = 1 then user_id else 0 end n
       from events"""
)
def safe_int(spark, sf_dir):
    which = F.col("event_id") % 3
    written = (
        F.when(which == 0, F.format_number(F.col("user_id") * 1234567, 0))
        .when(which == 1, F.concat(F.lit(" "), "user_id", F.lit(" ")))
        .otherwise(F.concat("user_id", F.lit(".5")))
    )
    return table(spark, sf_dir, "events").select("event_id", fn.safe_int(written).alias("n"))


@query(
    """select doc_id, case when doc_id % 3 < 2 and doc_id % 8 between 1 and 5
              then cast(doc_id % 8 as int) end stars
       from documents"""
)
def star_rating(spark, sf_dir):
    score = (F.col("doc_id") % 8).cast("string")
    platform = (
        F.when(F.col("doc_id") % 3 == 0, "Google Play Store")
        .when(F.col("doc_id") % 3 == 1, "Apple App Store")
        .otherwise("Reddit")
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", fn.star_rating(score, platform).alias("stars")
    )


_SQL_TEXT = (
    "replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    "html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), "
    "'(?s)<!--.*?-->', '', 'g'), '(?s)</?[A-Za-z!][^>]*>', ' ', 'g'), "
    "'&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
)


@query(f"select page_id, {sql_collapse(_SQL_TEXT)} page_text from pages")
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", fn.collapse_ws(fn.html_to_text(F.col("html"))).alias("page_text")
    )


def _sql_element(name: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{name}>(.*?)</{name}>', 1)"
    decoded = f"replace(replace({inner}, '&quot;', '\"'), '&amp;', '&')"
    return sql_trim(decoded)


@query(
    f"""select page_id, case when page_id % 2 = 0 then {_sql_element('h1')}
               else {_sql_element('title')} end title, {_sql_element('h1')} question
        from pages"""
)
def page_title(spark, sf_dir):
    html = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(
        F.regexp_replace("html", "</?h1>", "")
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        fn.page_title(html).alias("title"),
        fn.question_title(F.col("html")).alias("question"),
    )


@query(
    """select doc_id, source forum, case when doc_id % 2 = 0 then 'doc-' || doc_id end thread
       from documents"""
)
def script_values(spark, sf_dir):
    thread = F.when(
        F.col("doc_id") % 2 == 0,
        F.concat(F.lit('<script>this.page.identifier = "doc-'), "doc_id", F.lit('";</script>')),
    ).otherwise(F.lit("<p>this.page.identifier = 'none'</p>"))
    html = F.concat(
        F.lit("<html><script>var disqus_shortname = '"), "source", F.lit("';</script><p>"),
        F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit("</p>"), thread,
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        fn.script_value(html, "disqus_shortname").alias("forum"),
        fn.script_value(html, "this.page.identifier").alias("thread"),
    )


@query("select page_id, url target, left(md5(url || '|x'), 12) id from pages")
def unwrap_redirect(spark, sf_dir):
    link = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(
        F.concat(F.lit("//search.example/l/?uddg="), F.url_encode("url"), F.lit("&rut=1"))
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        fn.unwrap_redirect(link).alias("target"),
        fn.short_id(F.col("url"), F.lit("x")).alias("id"),
    )


@query(
    """select event_id, json_extract_string(props, '$.k') k,
              coalesce(json_extract_string(props, '$.nested.z'), 'none') z
       from events"""
)
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.json_field(F.col("props"), "$.k").alias("k"),
        fn.json_field(F.col("props"), "$.nested.z", "none").alias("z"),
    )


@query(
    """with t as (select event_id, cast(user_id % 4 as double) n,
                         cast(event_id % 3 as double) d from events)
       select event_id, case when d <> 0 then n / d end blank,
              case when d = 0 then 0.0 else n / d end zero,
              case when d = 0 then 0.0 when n <> 0 then n / d end blank_counts
       from t"""
)
def safe_divide(spark, sf_dir):
    n, d = F.col("user_id") % 4, F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        "event_id",
        fn.safe_divide(n, d).alias("blank"),
        fn.safe_divide(n, d, 0.0).alias("zero"),
        fn.safe_divide(n, d, 0.0, blank_counts=True).alias("blank_counts"),
    )


@query(
    """select conv_id, turn, case when role = 'user' then sha256('pepper|u' || conv_id)
              else '' end masked
       from conversations"""
)
def mask_user(spark, sf_dir):
    name = F.when(F.col("role") == "user", F.concat(F.lit("u"), "conv_id")).otherwise("")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", fn.mask_user(name, "pepper").alias("masked")
    )
