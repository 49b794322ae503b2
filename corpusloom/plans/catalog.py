"""Every query of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from . import cleaning, corpus, dedup, domains, files, lm, transcripts  # noqa: F401  each registers its queries
from .registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
