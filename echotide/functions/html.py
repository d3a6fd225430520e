"""HTML fragments as text, without a DOM: enough for titles, messages and paragraphs."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE, bind

# Stands where tags stood; removed from the text of a page beforehand.
SEAM = "\u0001"
_INERT = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->"
_TAG = r"(?s)</?[A-Za-z!][^>]*>"
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_HEADING = (r"<h1\b[^>]*>", "h1")
_COMMON = ("amp", "lt", "gt", "quot", "nbsp")


def strip_inert(html: Column) -> Column:
    """Remove scripts, style sheets and comments with all they hold."""
    return F.regexp_replace(html, _INERT, "")


def _entity_json() -> str:
    # A map literal is searched from the front, so the frequent names come first.
    characters = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}
    names = [*_COMMON, *sorted(characters.keys() - set(_COMMON))]
    return json.dumps({name: characters[name] for name in names})


_ENTITIES = _entity_json()


def _named_entities() -> Column:
    """Entity names with their characters. Spark evaluates this to one constant when it plans."""
    return F.from_json(F.lit(_ENTITIES), "map<string,string>")


def _numeric(name: Column) -> Column:
    """The character of ``#8364`` or ``#x20AC``; null for what is no character."""
    hexa = F.lower(F.substring(name, 1, 2)) == "#x"
    digits = F.when(hexa, F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(
        F.substr(name, F.lit(2))
    )

    def encoded(code: Column) -> Column:
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0")), "UTF-32")

    return bind(digits.try_cast("bigint"), encoded)


def decode_entities(c: Column) -> Column:
    """Decode named and numeric character references in one pass from the left."""
    named = _named_entities()

    def resolve(piece: Column) -> Column:
        def put(name: Column) -> Column:
            char = F.when(F.startswith(name, F.lit("#")), _numeric(name)).otherwise(
                F.try_element_at(named, name)
            )
            after = F.substr(piece, F.char_length(name) + F.lit(2))
            return F.coalesce(F.concat(char, after), F.concat(F.lit("&"), piece))

        return bind(F.regexp_extract(piece, _ENTITY, 1), put)

    def decode(text: Column) -> Column:
        decoded = F.transform(
            F.split(text, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(resolve(piece))
        )
        return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)

    return bind(c, decode)


def seamed_text(c: Column) -> Column:
    """Text of a fragment: every piece between tags stripped, empty ones dropped, and one
    ``SEAM`` between two pieces."""
    live = F.regexp_replace(F.replace(c, F.lit(SEAM), F.lit("")), _INERT, "")
    decoded = decode_entities(F.regexp_replace(live, _TAG, SEAM))
    joined = F.regexp_replace(decoded, r"(?U)[\s\x1c-\x1f]*\x01[\s\x01\x1c-\x1f]*", SEAM)
    return F.trim(joined, F.lit(WHITESPACE + SEAM))


def html_to_text(c: Column, sep: str = " ") -> Column:
    """Text of a fragment with ``sep`` between the pieces that tags divide."""
    return F.replace(seamed_text(c), F.lit(SEAM), F.lit(sep))


def _inner(live: Column, opening: str, name: str) -> Column:
    """What the first element that ``opening`` matches holds; null if there is none."""
    inner = F.regexp_extract(live, rf"(?is){opening}(.*?)(?:</{name}\s*>|$)", 1)
    return F.when(live.rlike(rf"(?is){opening}"), inner)


def _first_text(html: Column, *elements: tuple[str, str]) -> Column:
    """Text of the first of the elements that the page has, even if that is empty."""
    found = bind(
        strip_inert(html),
        lambda live: F.coalesce(*[_inner(live, *element) for element in elements], F.lit("")),
    )
    return html_to_text(found, "")


def page_title(html: Column) -> Column:
    """Text of the first ``h1``, else of ``title``, else empty. An empty ``h1`` still counts."""
    return _first_text(html, _HEADING, (r"<title\b[^>]*>", "title"))


def question_title(html: Column) -> Column:
    """Text of the first ``h1``, else of a question-text ``span``, else empty."""
    span = r"""<span\b[^>]*class\s*=\s*["'][^"']*(?:q_text|question_text)[^"']*["'][^>]*>"""
    return _first_text(html, _HEADING, (span, "span"))


def script_value(html: Column, name: str) -> Column:
    """The quoted value a page script assigns to ``name``; null if no script does."""
    scripts = F.array_join(
        F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script"), 1), "\n"
    )
    pattern = name.replace(".", r"\.") + r"\s*=\s*['\"]([^'\"]+)['\"]"
    return F.nullif(F.regexp_extract(scripts, pattern, 1), F.lit(""))
