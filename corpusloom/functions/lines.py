"""Line-based document cleaning: keep sentences, drop menus, listings and unwanted documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LineRules:
    """A line stays if it ends in terminal punctuation (an ellipsis is none) and has enough words; a document stays if
    enough sentences remain and it holds no bad word."""

    min_words: int = 5
    min_sentences: int = 5
    bad_words: tuple[str, ...] = ("scum", "moron")

    @property
    def bad(self) -> str:
        return r"(?i)\b(?:" + "|".join(self.bad_words) + r")\b"

    def sql(self, table: str, key: str, text: str) -> str:
        kept = rf"list_filter(string_split({text}, chr(10)), lambda l: regexp_matches(trim(l), '[.!?]$') AND NOT regexp_matches(trim(l), '(?:\.\.\.|…)$') AND len(regexp_extract_all(l, '[^ ]+')) >= {self.min_words})"
        return rf"""SELECT {key}, reason, CASE WHEN reason = 'kept' THEN body END AS clean_text FROM (SELECT {key}, body, CASE WHEN regexp_matches({text}, '{self.bad}') THEN 'bad_word'
          WHEN len(regexp_extract_all(body, '[.!?]+(?:\s|$)')) < {self.min_sentences} THEN 'few_sentences' ELSE 'kept' END AS reason
          FROM (SELECT {key}, {text}, array_to_string({kept}, chr(10)) AS body FROM {table}))"""


def clean_lines(text: Column, rules: LineRules) -> tuple[Column, Column]:
    """(reason, clean_text): 'kept' and the kept lines, or why the document is dropped and null."""

    def keep(line: Column) -> Column:
        t = F.trim(line)
        return t.rlike("[.!?]$") & ~t.rlike(r"(?:\.\.\.|…)$") & (F.regexp_count(line, F.lit("[^ ]+")) >= rules.min_words)

    body = F.array_join(F.filter(F.split(text, "\n"), keep), "\n")
    reason = F.when(text.rlike(rules.bad), "bad_word").when(F.regexp_count(body, F.lit(r"[.!?]+(?:\s|$)")) < rules.min_sentences, "few_sentences").otherwise("kept")
    return reason.alias("reason"), F.when(reason == "kept", body).alias("clean_text")
