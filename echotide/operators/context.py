"""Measures over related tables under a filter context.

A ``Model`` holds the dimension, its facts, and filters. Filters of the dimension reach the facts, filters
of a fact reach nothing else. A fact whose review the dimension lacks belongs to the *unknown member*,
whose columns are all blank: it is visible as long as every filter of the dimension accepts a blank.

Reaching a fact takes one join on the key and never moves more than keys of the dimension: a semi-join
with the reviews that are accepted, or, while the unknown member is visible, an anti-join with
those that are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_divide
from ..functions.text import fold
from .measures import distinct_per, is_negative


@dataclass(frozen=True)
class Filter:
    """A condition on a column of a table, or on whole rows where ``column`` is null. ``blank`` says
    whether it accepts the unknown member."""

    table: str
    column: str | None
    condition: Callable[[], Column]
    blank: bool


def _among(column: str, values: Iterable) -> tuple[Callable[[], Column], bool]:
    """Whether a column is among values, case ignored; null stands for a blank."""
    values = list(values)
    blank = None in values
    texts = [v.lower() for v in values if isinstance(v, str)]
    others = [v for v in values if v is not None and not isinstance(v, str)]

    def condition() -> Column:
        c = F.col(column)
        tests = [c.isNull()] if blank else []
        tests += [fold(c).isin(texts)] if texts else []
        tests += [c.isin(others)] if others else []
        return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))

    return condition, blank


@dataclass(frozen=True)
class Model:
    """Tables by name, the dimension's name and the key that facts share with it."""

    tables: Mapping[str, DataFrame]
    dim: str = "dim_reviews_core"
    key: str = "review_id"
    filters: tuple[Filter, ...] = ()

    def _with(self, new: Filter, add: bool) -> Model:
        if new.table not in self.tables:
            raise ValueError(f"no table {new.table}")
        same = (lambda f: (f.table, f.column) == (new.table, new.column)) if not add else None
        old = (f for f in self.filters if same is None or new.column is None or not same(f))
        return replace(self, filters=(*old, new))

    def keep(self, table: str, column: str, values: Iterable, add: bool = False) -> Model:
        """Only rows whose ``column`` is among ``values``, case ignored, null for a blank. Replaces
        other filters of that column unless ``add``."""
        condition, blank = _among(column, values)
        return self._with(Filter(table, column, condition, blank), add)

    def drop(self, table: str, column: str, values: Iterable, add: bool = False) -> Model:
        """Only rows whose ``column`` is not among ``values``; a blank is not, unless null is."""
        condition, blank = _among(column, values)
        return self._with(Filter(table, column, lambda: ~condition(), not blank), add)

    def where(self, table: str, condition: Column, blank: bool = False) -> Model:
        """Only rows that meet a condition of any kind, besides all other filters; ``blank`` says
        whether the unknown member does. A condition that is null is not met."""
        met = F.coalesce(condition, F.lit(False))
        return self._with(Filter(table, None, lambda: met, blank), add=True)

    def clear(self, table: str, *columns: str) -> Model:
        """Without the filters of a table, or of some of its columns."""
        gone = (lambda f: not columns or f.column in columns)
        return replace(
            self, filters=tuple(f for f in self.filters if f.table != table or not gone(f))
        )

    def _own(self, table: str) -> Column | None:
        own = [f.condition() for f in self.filters if f.table == table]
        return reduce(lambda a, b: a & b, own) if own else None

    @property
    def unknown_visible(self) -> bool:
        """Whether facts of the unknown member are visible."""
        return all(f.blank for f in self.filters if f.table == self.dim)

    def visible(self, table: str) -> DataFrame:
        """The rows of a table that the filters let through."""
        own, rows = self._own(table), self.tables[table]
        rows = rows if own is None else rows.filter(own)
        through = self._own(self.dim)
        if table == self.dim or through is None:
            return rows
        dim = self.tables[self.dim]
        if self.unknown_visible:
            return rows.join(dim.filter(~through).select(self.key), self.key, "left_anti")
        return rows.join(dim.filter(through).select(self.key), self.key, "left_semi")

    def related(self, table: str, columns: Sequence[str]) -> DataFrame:
        """The visible rows of a fact with ``columns`` of their review; of the unknown member these
        are null."""
        rows = self.visible(table)
        more = [c for c in columns if c not in rows.columns]
        if table == self.dim or not more:
            return rows
        return rows.join(self.tables[self.dim].select(self.key, *more), self.key, "left")

    def distinct_reviews(
        self, table: str, by: Sequence[str] = (), **flags: Column
    ) -> DataFrame:
        """``total``, the distinct reviews by columns of the fact or of its review, and for each
        flag (one at least) the distinct reviews with a row that has it."""
        known = F.col(self.key).isNotNull()
        flags = {name: known & flag for name, flag in flags.items()}
        return distinct_per(self.related(table, by), by, self.key, flags)

    def negative_reviews(self, table: str, by: Sequence[str] = ()) -> DataFrame:
        """Distinct negative reviews by columns of the fact or of its review; groups without any
        are left out."""
        # The sentiment may be the fact's own or its review's.
        rows = self.related(table, [*by, "sentiment"]).filter(is_negative())
        return rows.groupBy(*by).agg(F.count_distinct(self.key).alias("negative_reviews"))

    def share(self, table: str, by: Sequence[str], cleared: Sequence[str]) -> DataFrame:
        """``n_rows, n_all, share``: rows of each group over those of the same context without the
        filters of the columns ``cleared`` of the table, per value of what else ``by`` names."""
        rows = self.related(table, by).groupBy(*by).agg(F.count("*").alias("n_rows"))
        rest = [c for c in by if c not in cleared]
        whole = self.clear(table, *cleared).related(table, rest)
        whole = whole.groupBy(*(F.col(c).alias(f"_{c}") for c in rest)).agg(
            F.count("*").alias("n_all")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in rest]
        # Without other columns the whole is one row.
        joined = rows.join(whole, same) if rest else rows.crossJoin(F.broadcast(whole))
        share = safe_divide(F.col("n_rows"), F.col("n_all"))
        return joined.withColumn("share", share).drop(*(f"_{c}" for c in rest))
