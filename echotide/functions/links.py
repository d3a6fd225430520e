"""Links and surrogate ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_of

# Fixed value: where a search result page hides the target of a redirect link.
REDIRECT_TARGET = r"uddg=(https?[^&]+)"


def url_from(template: str, *cs: Column) -> Column:
    """Fill the ``{}`` slots of ``template`` in order; a null value leaves its slot empty."""
    parts = template.split("{}")
    if len(parts) != len(cs) + 1:
        raise ValueError(f"{template!r} has {len(parts) - 1} slots, {len(cs)} columns given")
    pieces = [F.lit(parts[0])]
    for value, tail in zip(cs, parts[1:]):
        pieces += [F.coalesce(value.cast("string"), F.lit("")), F.lit(tail)]
    return F.concat(*pieces)


def unwrap_redirect(c: Column, keep_prefixes: Iterable[str] = ("http",)) -> Column:
    """The percent-decoded redirect target; else the link itself if it starts with one of
    ``keep_prefixes``; else null. A plus sign is kept, as it is no encoded blank in a path."""
    target = F.regexp_extract(c, REDIRECT_TARGET, 1)
    decoded = F.coalesce(F.try_url_decode(F.replace(target, F.lit("+"), F.lit("%2B"))), target)
    kept = any_of(F.startswith(c, F.lit(p)) for p in keep_prefixes)
    return F.when(target != "", decoded).when(kept, c)


def short_id(*cs: Column, n: int = 12) -> Column:
    """The first ``n`` hex digits of the md5 over the columns joined by a bar."""
    return F.substring(F.md5(F.concat_ws("|", *cs)), 1, n)
