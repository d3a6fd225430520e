"""Numbers: tolerant integers, star ratings, and division that never raises."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_all

# Platforms whose score is a rating in stars.
RATED_PLATFORMS = ("Google Play Store", "Apple App Store")


def safe_int(c: Column, default: int = 0) -> Column:
    """A whole number with or without thousands commas, else ``default``."""
    digits = trim_all(F.replace(c.cast("string"), F.lit(","), F.lit("")))
    return F.coalesce(digits.try_cast("bigint"), F.lit(default).cast("bigint"))


def star_rating(
    score: Column, platform: Column, rated_platforms: Iterable[str] = RATED_PLATFORMS
) -> Column:
    """1 to 5 where the platform rates in stars; upvotes and likes are no stars."""
    stars = score.try_cast("int")
    return F.when(platform.isin(*rated_platforms) & stars.between(1, 5), stars)


def safe_divide(
    n: Column, d: Column, alternate: float | None = None, blank_counts: bool = False
) -> Column:
    """``n / d``, or ``alternate`` (null by default) where ``d`` is zero or null.

    ``blank_counts`` reads a zero numerator as blank, the way a BI tool sees a count over no
    rows: the ratio is then null and not 0, unless the denominator is empty too.
    """
    ratio = F.try_divide(n.cast("double"), d.cast("double"))
    if blank_counts:
        ratio = F.when(n != 0, ratio)
    if alternate is None:
        return ratio
    empty = d.isNull() | (d == 0)
    return F.when(empty, F.lit(float(alternate))).otherwise(ratio)
