"""Rows from landed HTML pages: links, search results, answers, comments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.html import (
    SEAM,
    decode_entities,
    html_to_text,
    page_title,
    question_title,
    seamed_text,
    strip_inert,
)
from ..functions.links import short_id, unwrap_redirect
from ..functions.text import any_of, collapse_ws, min_chars, truncate
from ..schemas import collected, computed
from .blocks import Selector, parse, select, text_of

# Where comments and their authors stand in article pages, in order of trial.
COMMENT_SELECTORS = (
    "div.comment-body",
    "div.comment-text",
    "div.comment-content",
    "p.comment",
    "li.comment",
    "div[class*='comment']",
    "div.user-comment",
    "span.comment",
    "div.post-comment",
    ".comments-list .comment",
    ".commentsWrapper p",
)
AUTHOR_SELECTORS = ("span.author", "span.name", "a.username", "div.author", ".comment-author")
MIN_PAGE_COMMENT, COMMENT_ID_CHARS, NEWS = 20, 80, "News"

# Answer blocks of a question page, and the limits on them.
ANSWER_CLASSES = ("q-text", "spacing_log", "answer_content", "qu-userSelect")
MIN_PARAGRAPH, MIN_ANSWER, ANSWER_ID_CHARS, ANSWERS_PER_PAGE = 80, 40, 100, 5
QUORA, QUORA_SOURCE = "Quora", "quora.com"

# The class of result links, and link caps per result page.
RESULT_LINK_CLASS = "result__a"
NEWS_LINKS_PER_PAGE, QUESTION_LINKS_PER_PAGE = 8, 30
QUESTION_SITES = ("https://quora.com", "https://www.quora.com")
QUESTION_EXCLUDE = "quora.com/q/"

PAGES_AT_ONCE = 64
_ALL = 2**31 - 2  # longer than any array
_BLOCK = (
    "p|div|article|section|ul|ol|table|h[1-6]|footer|nav|header|main|aside|blockquote|form|pre|"
    "hr|body|html"
)


def _class_attribute(name: str) -> str:
    """A pattern for a class attribute that holds ``name`` as one of its words."""
    return rf"""class\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["']"""


def _href(anchor: Column) -> Column:
    pattern = r"""(?is)^<a\b[^>]*?\bhref\s*=\s*["']([^"']*)"""
    return decode_entities(F.regexp_extract(anchor, pattern, 1))


# Links of a result page


def extract_links(
    pages: DataFrame,
    domain: str | None,
    exclude: str | None = None,
    cap: int | None = None,
    link_class: str | None = RESULT_LINK_CLASS,
    keep_prefixes: Iterable[str] = ("http",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Distinct link targets per page in order of first sight, as ``(position, url)``.

    Redirects are unwrapped; a target must hold ``domain`` and must not hold ``exclude``. All of
    a page's links stay in its row until the cap is applied, so nothing is shuffled.
    """
    opening = r"(?is)<a\b[^>]*>"
    anchors = F.regexp_extract_all(strip_inert(F.col("html")), F.lit(opening), 0)
    if link_class is not None:
        wanted = "(?is)" + _class_attribute(link_class)
        anchors = F.filter(anchors, lambda a: a.rlike(wanted))
    targets = F.transform(anchors, lambda a: unwrap_redirect(_href(a), keep_prefixes))

    def allowed(url: Column) -> Column:
        ok = url.isNotNull() & (url != "")
        if domain is not None:
            ok = ok & F.contains(url, F.lit(domain))
        if exclude is not None:
            ok = ok & ~F.contains(url, F.lit(exclude))
        return ok

    urls = F.array_distinct(F.filter(targets, allowed))
    if cap is not None:
        urls = F.slice(urls, 1, cap)
    return pages.select(*carry, F.posexplode(urls).alias("position", "url"))


class ResultLayout(NamedTuple):
    """Patterns for one search page: start of a result, its link, its snippet."""

    block: str
    link: str
    snippet: str


_END = r"</(?:a|div|span|td)\s*>"
RESULT_LAYOUTS = {
    "primary": ResultLayout(
        rf"<[a-z0-9]+\b[^>]*{_class_attribute('result')}[^>]*>",
        rf"(<a\b[^>]*{_class_attribute('result__a')}[^>]*>)(.*?)</a\s*>",
        rf"<[a-z0-9]+\b[^>]*{_class_attribute('result__snippet')}[^>]*>(.*?){_END}",
    ),
    "fallback": ResultLayout(
        rf"<li\b[^>]*{_class_attribute('b_algo')}[^>]*>",
        r"<h2\b[^>]*>.*?(<a\b[^>]*>)(.*?)</a\s*>",
        rf"<[a-z0-9]+\b[^>]*{_class_attribute('b_caption')}[^>]*>.*?<p\b[^>]*>(.*?)</(?:p|div)\s*>",
    ),
}


def extract_results(
    pages: DataFrame, domain: str, layout: str = "primary", carry: Sequence[str] = ()
) -> DataFrame:
    """Results of a search page as ``(position, url, title, text, author, date)``.

    Links are taken as they are, without a cap; a result without a snippet has an empty text.
    """
    block, link, snippet = RESULT_LAYOUTS[layout]
    # A mark in front of each result splits the page; the piece before the first is none.
    marked = F.regexp_replace(strip_inert(F.col("html")), rf"(?is)({block})", "\u0002$1")
    blocks = F.slice(F.split(marked, "\u0002"), 2, _ALL)
    rows = pages.select(*carry, F.posexplode(blocks).alias("position", "_block"))
    piece = F.col("_block")
    found = computed(
        rows.select(*carry, "position", "_block"),
        url=_href(F.regexp_extract(piece, f"(?is){link}", 1)),
        title=html_to_text(F.regexp_extract(piece, f"(?is){link}", 2), ""),
        text=html_to_text(F.regexp_extract(piece, f"(?is){snippet}", 1), ""),
        author=F.lit(""),
        date=F.lit(""),
    )
    return found.filter(F.contains("url", F.lit(domain))).drop("_block")


# Answers of a question page


def paragraphs(html: Column, longer_than: int, first: int) -> Column:
    """Texts of the ``first`` ``p`` elements that are long enough, in order. A paragraph ends at
    its end tag or at the next block, closed or not; its length is that of its pieces alone."""
    pieces = F.slice(F.split(strip_inert(html), r"(?i)<p\b[^>]*>"), 2, _ALL)
    ends = rf"(?is)</?(?:{_BLOCK})\b.*$"
    cut = F.transform(pieces, lambda piece: F.regexp_replace(piece, ends, ""))
    # No text is longer than its markup, so short pieces are dropped before they are decoded.
    raw = F.filter(cut, lambda piece: F.char_length(piece) > longer_than)
    seamed = F.transform(raw, seamed_text)
    long = F.filter(
        seamed, lambda t: F.char_length(F.replace(t, F.lit(SEAM), F.lit(""))) > longer_than
    )
    return F.transform(
        F.slice(long, 1, first), lambda t: collapse_ws(F.replace(t, F.lit(SEAM), F.lit(" ")))
    )


def extract_answers(
    pages: DataFrame,
    per_page: int = ANSWERS_PER_PAGE,
    as_of=None,
    classes: Sequence[str] = ANSWER_CLASSES,
    keyword: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Answers of question pages: blocks of an answer class, or else every paragraph longer than
    80 characters; the first ``per_page``, of which those of 40 characters and more are kept.

    Pages show no dates: ``as_of``, the day of collection, stands in for one. ``keyword`` names the
    column of the search term a page was found by.
    """
    named = "(?:%s)" % "|".join(classes)
    value = rf"""(?:"[^"]*{named}|'[^']*{named}|[^\s"'>]*{named})"""
    has_blocks = F.col("html").rlike(rf"(?is)<div\b[^>]*\sclass\s*=\s*{value}")
    term = F.lit(None).cast("string") if keyword is None else F.col(keyword)
    head = ["url", question_title(F.col("html")).alias("_title"), term.alias("_term"), *carry]
    # Nested blocks need the tree of the page; the paragraphs of other pages are read in the JVM.
    html, plain = F.col("html"), paragraphs(F.col("html"), MIN_PARAGRAPH, per_page)
    rows = _blocks_of(
        computed(pages, _nested=has_blocks).select(
            *head,
            F.when(F.col("_nested"), html).alias("html"),
            F.when(~F.col("_nested"), plain).alias("_plain"),
        ),
        [Selector("div", class_parts=tuple(c.lower() for c in classes), ignore_case=True)],
        per_page,
        first_only=False,
    )
    return collected(
        rows.filter(min_chars(F.col("_text"), MIN_ANSWER)),
        "position",
        *carry,
        review_id=short_id(F.col("url"), truncate(F.col("_text"), ANSWER_ID_CHARS)),
        platform=F.lit(QUORA),
        source=F.lit(QUORA_SOURCE),
        date=F.date_format(F.lit(as_of).cast("date"), "dd/MM/yyyy"),
        date_is_ingest=F.lit(True),
        username=F.lit(""),
        title=F.col("_title"),
        text=F.col("_text"),
        score_raw=F.lit(""),
        keyword=F.col("_term"),
        url=F.col("url"),
    )


# Comments of an article page


def extract_page_comments(
    pages: DataFrame,
    selectors: Sequence[str] = COMMENT_SELECTORS,
    per_page: int | None = None,
    as_of=None,
    source: str = "site_name",
    keyword: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Comments of article pages, by the first selector that yields any on the page; at most
    ``per_page`` blocks of it, if given. ``keyword`` names the column of the search term.

    Each page is read on its own, so the work needs no shuffle. The same page landed twice gives
    the same ids: keep the first with ``dedup_keep_first``.
    """
    title = page_title(F.col("html")).alias("_title")
    term = F.lit(None).cast("string") if keyword is None else F.col(keyword)
    head = ["url", title, F.col(source).alias("_source"), term.alias("_term"), *carry]
    rows = _blocks_of(
        pages.select(*head, "html"), [Selector.of(s) for s in selectors], per_page, first_only=True
    )
    return collected(
        rows,
        "position",
        *carry,
        review_id=short_id(F.col("url"), truncate(F.col("_text"), COMMENT_ID_CHARS)),
        platform=F.lit(NEWS),
        source=F.col("_source"),
        date=F.date_format(F.lit(as_of).cast("date"), "dd/MM/yyyy"),
        date_is_ingest=F.lit(True),
        username=F.col("_author"),
        title=F.col("_title"),
        text=F.col("_text"),
        score_raw=F.lit(""),
        keyword=F.col("_term"),
        url=F.col("url"),
    )


def _blocks_of(
    pages: DataFrame, selectors: Sequence[Selector], per_page: int | None, first_only: bool
) -> DataFrame:
    """Blocks of each page as ``(position, _text, _author)`` next to its other columns.

    With ``first_only`` a page stops at the first selector that yields a long enough text, equal
    texts counting once; otherwise all blocks of the one selector are returned, or long paragraphs
    where there is no block. Pages with an array ``_plain`` have been read already.
    """
    kept = [f for f in pages.schema.fields if f.name not in ("html", "_plain")]
    names = [f.name for f in kept]
    schema = StructType(
        [
            *kept,
            StructField("position", IntegerType()),
            StructField("_text", StringType()),
            StructField("_author", StringType()),
        ]
    )

    def found(html: str) -> list[tuple[str, str]]:
        tree = parse(html or "")
        rows: list[tuple[str, str]] = []
        authors: dict[int, str] = {}
        for selector in selectors:
            seen = set()
            for node in select(tree, selector)[:per_page]:
                text = " ".join(text_of(node, " ").split())
                if first_only and (len(text) < MIN_PAGE_COMMENT or text[:COMMENT_ID_CHARS] in seen):
                    continue
                seen.add(text[:COMMENT_ID_CHARS])
                rows.append((text, _author_near(node, authors) if first_only else ""))
            if rows:
                break
        if not rows and not first_only:  # the class stood in a comment or a script only
            long = [p for p in select(tree, _PARAGRAPH) if len(text_of(p, "")) > MIN_PARAGRAPH]
            rows = [(" ".join(text_of(p, " ").split()), "") for p in long[:per_page]]
        return rows

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time, so that long pages do not pile up as Python objects.
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                some = batch.slice(start, PAGES_AT_ONCE)
                plain = [None] * some.num_rows
                if "_plain" in some.schema.names:
                    plain = some.column("_plain").to_pylist()
                rows = [
                    (page, place, *block)
                    for page, html in enumerate(some.column("html").to_pylist())
                    for place, block in enumerate(
                        found(html) if plain[page] is None else [(t, "") for t in plain[page]]
                    )
                ]
                page, place, text, author = zip(*rows) if rows else ((), (), (), ())
                kept_rows = some.select(names).take(pa.array(page, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *kept_rows.columns,
                        pa.array(place, pa.int32()),
                        pa.array(text, pa.string()),
                        pa.array(author, pa.string()),
                    ],
                    names=schema.names,
                )

    return pages.mapInArrow(read, schema)


_PARAGRAPH = Selector("p")
_AUTHORS = [Selector.of(s) for s in AUTHOR_SELECTORS]


def _author_near(node, known: dict[int, str]) -> str:
    """The first author among the elements around a comment, looked for once per parent."""
    parent = node.parent
    if parent is None:
        return ""
    if id(parent) not in known:
        hits = (select(parent, selector) for selector in _AUTHORS)
        known[id(parent)] = next((text_of(h[0], "") for h in hits if h), "")
    return known[id(parent)]
