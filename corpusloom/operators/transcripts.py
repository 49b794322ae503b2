"""Speaker-aligned transcripts. Streams are partitions; a stream (one recording) is worked through in order.

words: stream, seq, start_ms, end_ms, word. turns: stream, turn, start_ms, end_ms, speaker, with ends that don't decrease.
Both should be stored tables, as they are counted: a task gets streams of about as many words however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import timestamp
from .tables import bounded

SENTENCE_END = ".?!"


def anchor(option: str = "start") -> Column:
    times = {"start": F.col("start_ms"), "mid": (F.col("start_ms") + F.col("end_ms")) / 2, "end": F.col("end_ms")}
    return times[option].cast("double")


def map_speakers(words: DataFrame, turns: DataFrame, option: str = "start") -> DataFrame:
    """words with the speaker of the first turn that ends at or after the word's anchor; after all turns, of the last.

    An as-of join by union: words and turn ends in one order of time, from the last to the first, and each word takes the
    turn end met last. (A frame that looks forward would be computed anew for every row.)
    """
    w = words.select("stream", "seq", "start_ms", "end_ms", "word", anchor(option).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("speaker"))
    t = turns.select("stream", F.lit(None).cast("long").alias("seq"), F.lit(None).cast("long").alias("start_ms"), F.lit(None).cast("long").alias("end_ms"), F.lit(None).cast("string").alias("word"), F.col("end_ms").cast("double").alias("at"), F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "speaker")
    ahead = Window.partitionBy("stream").orderBy(F.desc("at"), F.desc("kind"), F.desc("turn")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max_by("speaker", "turn").over(Window.partitionBy("stream"))
    found = F.coalesce(F.last("speaker", ignorenulls=True).over(ahead), last)
    both = bounded(w.unionByName(t), words.count(), "stream").withColumn("speaker", found)
    return both.where("kind = 0").select("stream", "seq", "start_ms", "end_ms", "word", "speaker")


def segments(mapped: DataFrame, turns: DataFrame) -> DataFrame:
    """(stream, segment, speaker, start_ms, end_ms, text): runs of one speaker.

    The first segment belongs to the first turn's speaker and starts with that turn; it is empty if the first word is
    another's. Words are followed by a blank each.
    """
    first = turns.groupBy("stream").agg(F.min_by(F.struct("start_ms", "end_ms", "speaker"), "turn").alias("t0"))
    n = mapped.count()
    rows = bounded(mapped, n, "stream").join(bounded(first, n, "stream"), "stream")
    order = Window.partitionBy("stream").orderBy("seq")
    before = F.coalesce(F.lag("speaker").over(order), F.col("t0.speaker"))
    rows = rows.withColumn("change", (F.col("speaker") != before).cast("long"))
    rows = rows.withColumn("segment", F.sum("change").over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "word"))), lambda x: F.concat(x["word"], F.lit(" "))), "")
    full = rows.groupBy("stream", "segment").agg(F.first("speaker").alias("speaker"), F.min_by("start_ms", "seq").alias("start_ms"), F.max_by("end_ms", "seq").alias("end_ms"), text.alias("text"), F.first("t0.start_ms").alias("s0"))
    full = full.withColumn("start_ms", F.when(F.col("segment") == 0, F.col("s0")).otherwise(F.col("start_ms"))).drop("s0")
    opened = first.join(full.where("segment = 0"), "stream", "left_anti")
    empty = opened.select("stream", F.lit(0).cast("long").alias("segment"), F.col("t0.speaker").alias("speaker"), F.col("t0.start_ms").alias("start_ms"), F.col("t0.end_ms").alias("end_ms"), F.lit("").alias("text"))
    return full.unionByName(empty).withColumn("speaker", F.concat(F.lit("Speaker "), "speaker"))


def srt(parts: DataFrame) -> DataFrame:
    """(stream, segment, lines): numbered subtitle blocks."""
    text = F.replace(F.trim("text"), F.lit("-->"), F.lit("->"))
    lines = F.concat((F.col("segment") + 1).cast("string"), F.lit("\n"), timestamp(F.col("start_ms")), F.lit(" --> "), timestamp(F.col("end_ms")), F.lit("\n"), "speaker", F.lit(": "), text, F.lit("\n"))
    return parts.select("stream", "segment", lines.alias("lines"))


def realign(mapped: DataFrame, max_words: int = 50) -> DataFrame:
    """mapped with sentences that several speakers share given to the one with most of their words.

    A sentence runs to the next word that ends in terminal punctuation, and may have max_words words; what is left after
    the last such word counts only at just that length. The largest share must be half or more, rounded down; ties go to
    the smaller label. Sentences don't touch each other's labels, so a stream is no group of its own.
    """
    before = Window.partitionBy("stream").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.right("word", F.lit(1)).isin(*SENTENCE_END).cast("long")
    rows = mapped.select("stream", "seq", "start_ms", "end_ms", "word", "speaker", ended.alias("ended"))
    rows = rows.withColumn("sentence", F.coalesce(F.sum("ended").over(before), F.lit(0)))
    whole = Window.partitionBy("stream", "sentence")
    share = F.count("*").over(Window.partitionBy("stream", "sentence", "speaker"))
    rows = rows.withColumn("share", share).withColumns({"size": F.count("*").over(whole), "closed": F.max("ended").over(whole), "top": F.min(F.struct((-F.col("share")).alias("less"), "speaker")).over(whole)})
    shared = F.col("top.less") > -F.col("size")
    fits = F.when(F.col("closed") == 1, F.col("size") <= max_words).otherwise(F.col("size") == max_words)
    most = -F.col("top.less") >= F.floor(F.col("size") / 2)
    speaker = F.when(shared & fits & most, F.col("top.speaker")).otherwise(F.col("speaker"))
    return rows.select("stream", "seq", "start_ms", "end_ms", "word", speaker.alias("speaker"))
