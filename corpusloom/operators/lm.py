"""Language-model data preparation: splits by position, token rows, concatenation and chunks, masks, model batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.batches import pieces
from .tables import stored, with_row_index


def split_by_position(df: DataFrame, key: str, percent: int) -> DataFrame:
    """df with split: the first `percent` of rows by key are for validation, the rest for training."""
    indexed = with_row_index(df, key)
    total = df.agg(F.count("*").alias("__n"))  # one row
    border = F.round(F.col("__n") * percent / 100)
    rows = indexed.join(F.broadcast(total))
    return rows.withColumn("split", F.when(F.col("row_index") < border, "validation").otherwise("train")).drop("__n")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def truncated_padded(tokens: Column, length: int, pad: str = "[PAD]") -> Column:
    """The first `length` tokens, filled up to `length`."""
    kept = F.slice(tokens, 1, length)
    return F.concat(kept, F.array_repeat(F.lit(pad), F.lit(length) - F.size(kept)))


def with_specials(tokens: Column, length: int | None = None, begin: str = "[CLS]", end: str = "[SEP]", pad: str = "[PAD]", fill: bool = True) -> Column:
    """struct<tokens, special>: tokens between two marks, cut to `length` with them and filled up; special is 1 for marks and filling."""
    kept = tokens if length is None else F.slice(tokens, 1, max(0, length - 2))

    def framed(t: Column) -> Column:
        n = F.size(t)
        rest = F.lit(0) if length is None or not fill else F.greatest(F.lit(0), F.lit(length) - n - 2)
        words = F.concat(F.array(F.lit(begin)), t, F.array(F.lit(end)), F.array_repeat(F.lit(pad), rest))
        mask = F.concat(F.array(F.lit(1)), F.array_repeat(F.lit(0), n), F.array_repeat(F.lit(1), rest + 1))
        return F.struct(words.alias("tokens"), mask.alias("special"))

    return F.element_at(F.transform(F.array(kept), framed), 1)


def tokeniser(load_model: Callable[[], Callable[[list[str]], list[list[str]]]]):
    """A column function text -> tokens of any tokeniser, loaded once per Python worker; nulls have no tokens."""

    @F.pandas_udf("array<string>")
    def tokenise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for part in (part for texts in batches for part in pieces(texts)):
            yield pd.Series(model(part.fillna("").tolist()))

    return tokenise


def chunked(df: DataFrame, key: str, tokens: str | Column, length: int, batch_rows: int = 1000, separator: str | None = None) -> DataFrame:
    """(batch, chunk, tokens): the tokens of each batch of rows put together and cut to `length`.

    The rest of a batch is dropped, unless the batch has fewer than `length` tokens: then it is one short chunk.
    `tokens` may be an expression over df's columns, so that these move instead of arrays; with a `separator` that no
    token holds, pieces move as text.
    """
    # only keys and counts are put in order; tokens move once to meet their place and once, in pieces, to their chunk
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = with_row_index(df.select(key, F.size(tokens).cast("long").alias("n")), key)
    rows = rows.withColumn("batch", F.floor(F.col("row_index") / batch_rows))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("batch").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy("batch"))
    rows = stored(rows.withColumns({"before": before, "total": total}).where("n > 0").select(key, "batch", "n", "before", "total"), "places")
    last = F.floor((F.col("before") + F.col("n") - 1) / length)
    kept_chunks = F.when(F.col("total") < length, 1).otherwise(F.floor(F.col("total") / length))
    whole = df.join(rows, key).select("batch", "before", "n", tokens.alias("tokens"), kept_chunks.alias("chunks"), F.sequence(F.floor(F.col("before") / length), last).alias("own"))
    pieces = whole.select("batch", "before", "n", "tokens", "chunks", F.explode("own").alias("chunk"))  # apart, so that tokens are made once
    begin = F.greatest(F.col("chunk") * length - F.col("before"), F.lit(0))
    end = F.least((F.col("chunk") + 1) * length - F.col("before"), F.col("n"))
    piece = F.slice("tokens", (begin + 1).cast("int"), (end - begin).cast("int"))
    piece = piece if separator is None else F.array_join(piece, separator)
    pieces = pieces.where("chunk < chunks").select("batch", "chunk", "before", piece.alias("piece"))
    joined = F.transform(F.array_sort(F.collect_list(F.struct("before", "piece"))), lambda x: x["piece"])
    joined = F.flatten(joined) if separator is None else F.split(F.array_join(joined, separator), separator if separator.isspace() or separator.isalnum() else f"\\Q{separator}\\E")
    return pieces.groupBy("batch", "chunk").agg(joined.alias("tokens"))


def masked(tokens: Column, key: Column, rate: int = 15, mask: str = "[MASK]") -> Column:
    """tokens with about `rate` per cent masked; the choice is by a hash of key and place."""

    def each(token: Column, i: Column) -> Column:
        place = F.conv(F.substring(F.md5(F.concat_ws("|", key.cast("string"), i.cast("string"))), 1, 7), 16, 10).cast("long")
        return F.when(place % 100 < rate, mask).otherwise(token)

    return F.transform(tokens, each)


def translator(load_model: Callable[[], Callable[[list[str]], list[str]]], batch: int = 1024, filler: str = "tidak"):
    """A column function text -> text. Each batch has a fixed size for the model: the last is filled up and cut again.

    The model is loaded once per Python worker; a failing batch fails the task instead of vanishing.
    """

    @F.pandas_udf(StringType())
    def translate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            yield from _translated(model, texts, batch, filler)

    return translate


def row_translator(load_model: Callable[[], Callable[[list[str]], list[str]]], names: list[str], batch: int = 1024, filler: str = "tidak"):
    """translator() over several columns at once: texts -> struct of `names`, by one Python worker with one model instead of one for each column."""

    @F.pandas_udf(", ".join(f"{name} string" for name in names))
    def translate(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for columns in batches:
            for parts in zip(*(_translated(model, texts, batch, filler) for texts in columns), strict=True):
                yield pd.DataFrame(dict(zip(names, parts, strict=True)))

    return translate


def _translated(model: Callable[[list[str]], list[str]], texts: pd.Series, batch: int, filler: str) -> Iterator[pd.Series]:
    for a in range(0, len(texts), batch):
        part = texts.iloc[a : a + batch].fillna("").tolist()
        yield pd.Series(model(part + [filler] * (batch - len(part)))[: len(part)])
