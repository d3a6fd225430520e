"""All queries by name."""

from __future__ import annotations

from . import (  # noqa: F401
    enrichment,
    measures,
    model,
    relations,
    scalars,
    selection,
    sources,
    streams,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
