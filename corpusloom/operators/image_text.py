"""Union of image-text sources in one schema, from a registry of source builders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, CalendarIntervalType, DateType, DayTimeIntervalType, TimestampNTZType, TimestampType

IMAGE = "struct<path:string,bytes:binary>"
COLUMNS = ("image_url", "image", "text", "source", "meta")


def json_value(df: DataFrame, name: str) -> Column:
    """A column as JSON takes it: times as text, what JSON has no form for is refused."""
    kind = df.schema[name].dataType
    if isinstance(kind, BinaryType | CalendarIntervalType | DayTimeIntervalType):
        raise TypeError(f"column {name} of type {kind.simpleString()} is no JSON value")
    return F.col(name).cast("string").alias(name) if isinstance(kind, TimestampType | TimestampNTZType | DateType) else F.col(name)


def record(df: DataFrame, source: str, text: str | Column, image_url: str | Column | None = None, image: Column | None = None, meta: tuple[str, ...] = ()) -> DataFrame:
    """df in the five columns; the `meta` columns become one JSON text."""

    def c(x: str | Column | None, kind: str) -> Column:
        return F.lit(None).cast(kind) if x is None else F.col(x) if isinstance(x, str) else x

    rest = F.to_json(F.struct(*(json_value(df, m) for m in meta))) if meta else F.lit(None).cast("string")
    return df.select(c(image_url, "string").alias("image_url"), c(image, IMAGE).cast(IMAGE).alias("image"), c(text, "string").alias("text"), F.lit(source).alias("source"), rest.alias("meta"))


@dataclass(frozen=True)
class SourceSpec:
    name: str
    build: Callable[[str], DataFrame]  # split -> rows
    splits: tuple[str, ...] = ("train", "validation")
    configs: tuple[str, ...] = ("all",)
    flag: str | None = None  # takes part only where this flag is set, whatever the config


@dataclass
class UnionConfig:
    """Which sources take part: all those of the config, for the splits that they have."""

    name: str = "all"
    sources: list[SourceSpec] = field(default_factory=list)
    flags: frozenset[str] = frozenset()

    def table(self, split: str) -> DataFrame:
        if split not in ("train", "validation"):
            raise ValueError(f"no split {split}")
        chosen = [s for s in self.sources if (self.name in s.configs or self.name == s.name) and split in s.splits and (s.flag is None or s.flag in self.flags)]
        if not chosen:
            raise ValueError(f"no source for {self.name}, {split}")
        return reduce(DataFrame.unionByName, (s.build(split) for s in chosen))


def url_column(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that df has."""
    return F.coalesce(*(F.col(n) for n in names if n in df.columns))


def padded_id(c: Column, width: int = 12) -> Column:
    """Zero-padded; longer ids stay whole and a sign stays in front."""
    sign = F.when(c.rlike("^[+-]"), F.substring(c, 1, 1)).otherwise("")
    bare = F.regexp_replace(c, "^[+-]", "")
    return F.when(F.length(c) >= width, c).otherwise(F.concat(sign, F.lpad(bare, F.lit(width) - F.length(sign), F.lit("0"))))
