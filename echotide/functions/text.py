"""Text: trimming, cleaning, folding, fallbacks, lengths, masking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode or Python counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A run of the same characters. Java reads the class faster than it reads the list.
SPACES = r"(?U)[\s\x1c-\x1f]+"

# What a removed post leaves behind.
DELETED_MARKERS = ("[deleted]", "[removed]")


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to ``c``, with ``c`` computed once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def trim_all(c: Column) -> Column:
    """Strip white space of any kind; plain ``trim`` strips spaces only."""
    return F.trim(c, F.lit(WHITESPACE))


def clean_ctrl(c: Column) -> Column:
    """Delete control characters, newlines included, putting nothing in their place."""
    return F.regexp_replace(c, r"[\x00-\x1F\x7F]", "")


def clean_text(c: Column) -> Column:
    """Trim, then clean, in that order: a blank before a trailing control character stays."""
    return clean_ctrl(trim_all(c))


def collapse_ws(c: Column) -> Column:
    """Turn every run of white space into one space and strip the ends."""
    return trim_all(F.regexp_replace(c, SPACES, " "))


def null_placeholders(c: Column, values: Iterable[str] = DELETED_MARKERS) -> Column:
    """Make a text that equals one of ``values`` empty."""
    return F.when(c.isin(*values), F.lit("")).otherwise(c)


def first_nonempty(*cs: Column) -> Column:
    """The first text that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def first_present(*cs: Column) -> Column:
    """The first text that is not null, even if empty, else the empty text."""
    return F.coalesce(*cs, F.lit(""))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def fold(c: Column) -> Column:
    """Case-folded text for matching."""
    return F.lower(c)


def min_chars(c: Column, n: int) -> Column:
    """True where the text has at least ``n`` characters."""
    return F.char_length(c) >= n


def is_blank(c: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(trim_all(c) == "", F.lit(True))


def contains_ci(c: Column, phrase: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(c), F.lit(phrase.lower()))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def lookup(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """The value a small fixed mapping gives a key, else ``default``."""
    known = [F.when(c == key, F.lit(value)) for key, value in mapping.items()]
    return F.coalesce(*known, F.lit(None) if default is None else default)


def json_field(c: Column, path: str, default: str | None = None) -> Column:
    """A nested field of a JSON text by path, or ``default`` where it is missing."""
    value = F.get_json_object(c, path)
    return value if default is None else F.coalesce(value, F.lit(default))


def mask_user(c: Column, salt: str) -> Column:
    """A stable keyed digest of a user name; empty and null names stay as they are."""
    return F.when(c != "", F.sha2(F.concat(F.lit(salt + "|"), c), 256)).otherwise(c)
