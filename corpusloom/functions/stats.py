"""Counts, ratios and predicates of texts as Column functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import listed

# What counts as a letter, digit, capital and token character.
LETTERS, DIGITS, CAPITALS = "[äÄöÖåÅa-zA-Z]", "[0-9]", "[ÄÖÅA-Z]"
TOKEN_BREAK = "[^A-Za-z_0-9]"
STRIP = r"(?U)^\s+|\s+$"


def occurrences(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def members(c: Column, characters: str, common: bool = False) -> Column:
    """Number of characters of a class like [a-z]; runs are taken out at once, the others' where the class is common."""
    inside = listed(characters[1:-1])
    if common:
        return F.length(F.regexp_replace(c, f"[^{inside}]+", "")).cast("long")
    return (F.length(c) - F.length(F.regexp_replace(c, f"[{inside}]+", ""))).cast("long")


def words(c: Column) -> Column:
    """Number of blank-separated words of a text whose blanks are single; none in an empty text."""
    return F.when(c == "", F.lit(0)).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("long")


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def text_stats(c: Column) -> dict[str, Column]:
    total = F.length(c).cast("long")
    out = {"alphabet_len": members(c, LETTERS, common=True), "number_len": members(c, DIGITS), "upper_len": members(c, CAPITALS), "total_len": total}
    return out | {f"{k}_ratio": ratio(out[f"{k}_len"], total) for k in ("alphabet", "number", "upper")}


@dataclass(frozen=True)
class Gate:
    """All bounds are strict."""

    min_words: int = 20
    alphabet_above: float = 0.75
    upper_below: float = 0.10
    number_below: float = 0.05
    language: str | None = None
    confidence_above: float = 0.65

    def reason(self) -> Column:
        """The first predicate a row fails, in order, or 'kept'. Columns: clean_words and the ratios."""
        out = F.when(F.col("clean_words") < self.min_words, "short")
        out = out.when(~F.coalesce(F.col("alphabet_ratio") > self.alphabet_above, F.lit(False)), "alphabet")
        out = out.when(~(F.col("upper_ratio") < self.upper_below), "upper").when(~(F.col("number_ratio") < self.number_below), "number")
        if self.language is not None:
            out = out.when(~((F.col("lang") == self.language) & (F.col("lang_confidence") > self.confidence_above)), "language")
        return out.otherwise("kept")


def content_hash(c: Column) -> Column:
    """MD5 of the text without blanks at its ends."""
    return F.md5(F.regexp_replace(c, STRIP, ""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, f"[^{listed(TOKEN_BREAK[2:-1])}]"), lambda x: F.length(x) > 0)


def _token_runs(c: Column) -> Column:
    """tokens() with an empty one more where the text begins or ends with other characters."""
    return F.split(c, f"[^{listed(TOKEN_BREAK[2:-1])}]+")


def token_set(c: Column) -> Column:
    return F.array_remove(F.array_distinct(_token_runs(c)), "")


def token_count(c: Column) -> Column:
    """size(tokens(c)), by the same split as token_set()."""
    runs = _token_runs(c)
    empty = [F.when(F.element_at(runs, 1) == "", 1).otherwise(0), F.when((F.size(runs) > 1) & (F.element_at(runs, -1) == ""), 1).otherwise(0)]
    return F.size(runs) - empty[0] - empty[1]


def not_missing(c: Column, kind: str = "double") -> Column:
    """Neither null nor, for numbers, NaN."""
    return c.isNotNull() & ~F.isnan(c) if kind in ("double", "float") else c.isNotNull()


def netloc(url: Column) -> Column:
    """Authority of a URL with user, port and case; empty where there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def valid_url(url: Column) -> Column:
    return url.rlike(r"^https?://[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}(?::[0-9]{2,5})?(?:[/?#]\S*)?$")


def sentence_count(c: Column) -> Column:
    return occurrences(c, r"[.!?]+(?:\s|$)")


def article_id(url: Column) -> Column:
    """The number after /read/year/month/day/ of a URL; the URL itself where there is none."""
    return F.regexp_replace(url, r".+/read/\d+/\d+/\d+/(\d+).+", "$1")


def timestamp(ms: Column, mark: str = ",", hours: bool = True) -> Column:
    ms = ms.cast("long")
    h = F.format_string("%02d:", F.floor(ms / 3600000))
    rest = F.format_string(f"%02d:%02d{mark}%03d", F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)
    return F.concat(h, rest) if hours else F.when(ms >= 3600000, F.concat(h, rest)).otherwise(rest)
