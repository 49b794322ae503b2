"""Paged listings: links and the next page of each page, followed round after round over a table of fetched pages."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tables import stored
from .readers import anchors_of


def next_page(html: Column, class_name: str = "paging__link--next", label: str = "Next") -> Column:
    """Href of the first anchor of a class whose text holds the label, else null."""
    found = F.regexp_extract_all(html, F.lit(rf'(?s)<a\b[^>]*class="[^"]*\b{class_name}(?![\w-])[^"]*"[^>]*>[^<]*{label}[^<]*</a>'), F.lit(0))
    href = F.regexp_extract(F.get(found, F.lit(0)), 'href="([^"]*)"', 1)
    return F.when(F.size(found) > 0, href)


def follow(seeds: DataFrame, pages: DataFrame, class_name: str = "article__link", max_rounds: int = 1000) -> DataFrame:
    """(*seeds' columns, round, link) of every link of a listing's pages, from its first page (`url`) to the last.

    pages: url, html, what a fetcher stored. A round is a join with the next pages; a page without a next one, or one
    that wasn't fetched, ends its listing.
    """
    keys = [c for c in seeds.columns if c != "url"]
    frontier, out = seeds, None
    for n in range(max_rounds):
        seen = stored(frontier.join(pages.select("url", "html"), "url"), "listing")
        links = seen.select(*keys, F.lit(n).alias("round"), F.explode(anchors_of(F.col("html"), class_name)).alias("link"))
        out = links if out is None else out.unionByName(links)
        frontier = seen.select(*keys, next_page(F.col("html")).alias("url")).where("url IS NOT NULL")
        if not frontier.limit(1).count():
            return out
    raise RuntimeError("listings did not end")


def patiently(fetch: Callable[[str], str], wait: float = 10.0, factor: float = 1.5, tries: int = 10, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """fetch that tries again after a lost connection, waiting longer each time; the last failure is raised."""

    def run(url: str) -> str:
        pause = wait
        for left in range(tries, 0, -1):
            try:
                return fetch(url)
            except ConnectionError:
                if left == 1:
                    raise
                sleep(pause)
                pause *= factor
        raise ValueError("no tries")

    return run
