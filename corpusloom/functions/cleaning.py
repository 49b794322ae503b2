"""Web-text normalisation as Column functions; each step maps a text column to a text column.

`strict` keeps the semantics of the corpora built so far, including that line breaks become full stops and that a text
with a user handle is spaced out letter by letter; `intended` does what these steps were meant to do.
"""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .batches import pieces
from .patterns import listed

# Replacements of markup remnants, in order.
MARKUP = (
    ("#39;", "'"),
    ("amp;", "&"),
    ("#146;", "'"),
    ("nbsp;", " "),
    ("#36;", "$"),
    ("\\n", "\n"),
    ("quot;", "'"),
    ("<br />", "\n"),
    ('\\"', '"'),
    ("<unk>", " "),
    (" @.@ ", "."),
    (" @-@ ", "-"),
    ("...", " …"),
)
# Punctuation that is unified, and the characters that stay.
PUNCTUATION_FROM, PUNCTUATION_TO = "‘’´“”–-", "'''\"\"--"
KEPT = "a-zA-Z0-9ÖÄÅöäå .,'%&€$=*@+;<>/()!?%:-"
# Patterns of tags, anchors, addresses, user handles and repetitions.
NEWS_TAGS = "(?:<[A-Z].+?>)|(?:</[A-Z].+?>)"
ANCHORS = "(?:<a.+?>)|(?:</a>)|(?:<ref.+?>)"
URL_CHARACTERS = r"a-zA-Z0-9./?:@\-_=#"
URL_TAIL = r"a-zA-Z0-9.&/?:@\-_=#"
URL = rf"(?:https?://)?[{URL_CHARACTERS}]+\.[a-zA-Z]{{2,6}}[{URL_TAIL}]*"
HANDLE = r"(?U)(^|[^@\w])@(\w{1,15})\b"
REPEATED_WORD = r"(?U)\b(\w+)( \1\b)+"
REPEATED_PUNCTUATION = r"([!-/:-@\[-\x60{-~])\1+"

# A run of URL characters holds a match only if one starts at its first character, and a match ends where no such
# character follows; trying no other place keeps an unbroken run linear.
URL_AT_RUN = rf"(?<![{listed(URL_CHARACTERS)}])(?:https?://)?[{listed(URL_CHARACTERS)}]+\.[{listed('a-zA-Z')}]{{2,6}}[{listed(URL_TAIL)}]*"


@F.pandas_udf(StringType())
def _unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in (part for texts in batches for part in pieces(texts)):
        yield part.map(lambda t: None if t is None else html.unescape(t))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def where_contains(c: Column, needle: str, body: Callable[[Column], Column]) -> Column:
    """body of the texts that hold the needle; the others stay as they are."""
    return let(c, lambda t: F.when(t.contains(needle), body(t)).otherwise(t))


def replace_up_to_last(c: Column, closing: str, pattern: str) -> Column:
    """c without matches of a pattern that ends with `closing`; what is after the last one isn't searched in vain."""

    def body(t: Column) -> Column:
        rest = F.substring_index(t, closing, -1)
        head = F.left(t, F.length(t) - F.length(rest))
        return F.concat(F.regexp_replace(head, pattern, ""), rest)

    return where_contains(c, closing, body)


def fix_markup(c: Column) -> Column:
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), MARKUP, c)


def unescape(c: Column) -> Column:
    """HTML entities; Python runs only for texts with an ampersand."""
    return F.when(c.contains("&"), _unescape(F.when(c.contains("&"), c))).otherwise(c)


def control_to_stop(c: Column, by: str = ".") -> Column:
    return F.regexp_replace(c, "[\r\n\t]+", by)


def drop_control(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{C}", "")


def drop_symbols(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{So}", "")


def unify_punctuation(c: Column, kept: str = KEPT) -> Column:
    unified = reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), (r for r in zip(PUNCTUATION_FROM, PUNCTUATION_TO, strict=True) if r[0] != r[1]), c)
    return F.regexp_replace(unified, f"[^{listed(kept)}]", " ")


def drop_news_tags(c: Column) -> Column:
    return replace_up_to_last(c, ">", NEWS_TAGS)


def drop_urls(c: Column) -> Column:
    return F.regexp_replace(replace_up_to_last(c, ">", ANCHORS), URL_AT_RUN, "")


def drop_handles(c: Column, spaced_out: bool = True) -> Column:
    """Texts with an at sign lose user handles (and the character before one); strictly, they are then spaced out."""

    def bare(t: Column) -> Column:
        out = F.regexp_replace(F.replace(t, F.lit("@<user>"), F.lit("")), HANDLE, "" if spaced_out else "$1")
        return F.trim(F.regexp_replace(F.regexp_replace(out, r"\s+", ""), "(.)", "$1 ")) if spaced_out else out

    return let(c, lambda t: F.when(t.contains("@"), bare(t)).otherwise(t))


def collapse_words(c: Column) -> Column:
    return F.regexp_replace(c, REPEATED_WORD, "$1")


def collapse_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, REPEATED_PUNCTUATION, "$1")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


STRICT = (fix_markup, unescape, control_to_stop, drop_control, unify_punctuation, drop_news_tags, drop_urls, drop_handles, collapse_words, collapse_punctuation, collapse_spaces)
INTENDED = (
    fix_markup,
    unescape,
    lambda c: control_to_stop(c, " "),
    drop_control,
    drop_symbols,
    unify_punctuation,
    drop_news_tags,
    drop_urls,
    lambda c: drop_handles(c, spaced_out=False),
    collapse_words,
    collapse_punctuation,
    collapse_spaces,
)
NATIVE = tuple(f for f in STRICT if f not in (unescape, collapse_words))


def compose(steps, c: Column) -> Column:
    return reduce(lambda x, f: f(x), steps, c)


def clean(c: Column, mode: str = "strict") -> Column:
    return compose({"strict": STRICT, "intended": INTENDED, "native": NATIVE}[mode], c)
