"""Pieces of Arrow batches, which have a fixed number of rows however long these are."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd

CHARACTERS = 1 << 20


def pieces(texts: pd.Series, rows: int | None = None, characters: int = CHARACTERS) -> Iterator[pd.Series]:
    """texts in order, in pieces that end where they have `characters` or `rows`; an iterator function may give one after another."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text) if isinstance(text, str) else 0
        if size >= characters or at + 1 - begin == rows:
            yield texts.iloc[begin : at + 1]
            begin, size = at + 1, 0
    if begin < len(texts):
        yield texts.iloc[begin:]
