"""Collects the registered queries of the engine's own operators."""

from __future__ import annotations

from tidewheel.plans import additions, jobs, lookups, more, rest, series, skies
from tidewheel.plans.tables import Query

BOOKS = (lookups.book, series.book, skies.book, more.book, rest.book, additions.book, jobs.book)


def queries() -> dict[str, Query]:
    return {k: f for b in BOOKS for k, f in b.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for b in BOOKS for k, s in b.oracle.items()}
