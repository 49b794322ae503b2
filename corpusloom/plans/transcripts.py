"""Transcript queries; conversations stand in for recordings, 300 ms a word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import transcripts as t
from ..operators.tables import bounded, load, shared_path, stored
from ..sources import readers, sinks
from .registry import query


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    talks = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stream"), "turn", "text")
    n = talks.agg(F.sum(F.size(spoken))).first()[0] or 0
    rows = bounded(talks, n, "stream").select("stream", "turn", F.posexplode(spoken).alias("at", "word"))
    seq = F.row_number().over(Window.partitionBy("stream").orderBy("turn", "at")) - 1
    rows = rows.withColumn("seq", seq.cast("long"))
    return rows.select("stream", "turn", "seq", (F.col("seq") * 300).alias("start_ms"), (F.col("seq") * 300 + 250).alias("end_ms"), "word")


def recordings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(words, turns). Words are numbered once and stored, as turns and mapping both read them.

    A turn ends 400 ms after its last word, so the next speaker's first word still falls into it.
    """
    spoken = stored(words(spark, sf_dir), "words")
    ends = spoken.groupBy("stream", "turn").agg(F.min("start_ms").alias("start_ms"), (F.max("end_ms") + 400).alias("end_ms"))
    roles = load(spark, sf_dir, "conversations").select(F.col("conv_id").alias("stream"), "turn", F.col("role").alias("speaker"))
    return spoken, stored(ends.join(roles, ["stream", "turn"]), "turns")


_AT = {"start": "wd.start_ms", "mid": "(wd.start_ms + wd.end_ms) / 2", "end": "wd.end_ms"}


def _base(option: str = "start") -> str:
    return BASE.replace("ts.end_ms >= wd.start_ms", f"ts.end_ms >= {_AT[option]}")


BASE = """w0 AS (SELECT conv_id AS stream, turn, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word, generate_subscripts(string_split(replace(text, chr(10), ' '), ' '), 1) AS i FROM conversations),
w AS (SELECT stream, turn, word, row_number() OVER (PARTITION BY stream ORDER BY turn, i) - 1 AS seq FROM w0),
wd AS (SELECT *, seq * 300 AS start_ms, seq * 300 + 250 AS end_ms FROM w),
tn AS (SELECT stream, turn, min(start_ms) AS start_ms, max(end_ms) + 400 AS end_ms FROM wd GROUP BY stream, turn),
ts AS (SELECT tn.*, role AS speaker FROM tn JOIN conversations c ON c.conv_id = stream AND c.turn = tn.turn),
mp AS (SELECT wd.stream, wd.seq, any_value(wd.start_ms) AS start_ms, any_value(wd.end_ms) AS end_ms, any_value(word) AS word,
  coalesce(arg_min(speaker, ts.turn) FILTER (ts.end_ms >= wd.start_ms), arg_max(speaker, ts.turn)) AS speaker FROM wd JOIN ts ON ts.stream = wd.stream GROUP BY wd.stream, wd.seq),
f AS (SELECT stream, arg_min(speaker, turn) AS sp0, arg_min(start_ms, turn) AS s0, arg_min(end_ms, turn) AS e0 FROM ts GROUP BY stream),
ch AS (SELECT mp.*, sp0, s0, e0, CASE WHEN speaker <> coalesce(lag(speaker) OVER (PARTITION BY stream ORDER BY seq), sp0) THEN 1 ELSE 0 END AS c FROM mp JOIN f USING (stream)),
gr AS (SELECT *, sum(c) OVER (PARTITION BY stream ORDER BY seq) AS segment FROM ch),
sg AS (SELECT stream, CAST(segment AS BIGINT) AS segment, 'Speaker ' || any_value(speaker) AS speaker, CASE WHEN segment = 0 THEN any_value(s0) ELSE min(start_ms) END AS start_ms, max(end_ms) AS end_ms, string_agg(word || ' ', '' ORDER BY seq) AS text FROM gr GROUP BY stream, segment
  UNION ALL SELECT stream, 0, 'Speaker ' || sp0, s0, e0, '' FROM f WHERE stream NOT IN (SELECT stream FROM gr WHERE segment = 0))"""


def mapped(spark: SparkSession, sf_dir: str, option: str = "start") -> DataFrame:
    return t.map_speakers(*recordings(spark, sf_dir), option)


@query("word_speaker_map", f"WITH {BASE} SELECT stream, seq, start_ms, end_ms, word, speaker FROM mp")
def word_speaker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir)


@query("word_speaker_map_mid", f"WITH {_base('mid')} SELECT stream, seq, start_ms, end_ms, word, speaker FROM mp")
def word_speaker_map_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by the middle of their time."""
    return mapped(spark, sf_dir, "mid")


@query("word_speaker_map_end", f"WITH {_base('end')} SELECT stream, seq, start_ms, end_ms, word, speaker FROM mp")
def word_speaker_map_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by the end of their time."""
    return mapped(spark, sf_dir, "end")


@query("speaker_segments", f"WITH {BASE} SELECT * FROM sg")
def speaker_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken, turns = recordings(spark, sf_dir)
    return t.segments(stored(t.map_speakers(spoken, turns), "mapped"), turns)


def _clock(x: str) -> str:
    return f"lpad(CAST({x} // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST({x} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({x} // 1000 % 60 AS VARCHAR), 2, '0') || ',' || lpad(CAST({x} % 1000 AS VARCHAR), 3, '0')"


@query(
    "srt_lines",
    f"WITH {BASE} SELECT stream, segment, (segment + 1) || chr(10) || {_clock('start_ms')} || ' --> ' || {_clock('end_ms')} || chr(10) || speaker || ': ' || replace(trim(text), '-->', '->') || chr(10) AS lines FROM sg",
)
def srt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.srt(speaker_segments(spark, sf_dir))


@query("transcript_text", f"WITH {BASE} SELECT stream, string_agg(chr(10) || chr(10) || speaker || ': ' || text, '' ORDER BY segment) AS transcript FROM sg GROUP BY stream")
def transcript_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = speaker_segments(spark, sf_dir).withColumn("line", F.concat(F.lit("\n\n"), "speaker", F.lit(": "), "text"))
    lines = F.array_sort(F.collect_list(F.struct("segment", "line")))
    return parts.groupBy("stream").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("transcript"))


@query(
    "realign_speakers",
    f"""WITH {BASE}, sn AS (SELECT *, coalesce(sum(e) OVER (PARTITION BY stream ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence
      FROM (SELECT *, CASE WHEN right(word, 1) IN ('.', '?', '!') THEN 1 ELSE 0 END AS e FROM mp)),
    sc AS (SELECT stream, sentence, speaker, count(*) AS n FROM sn GROUP BY ALL), sl AS (SELECT stream, sentence, count(*) AS l, max(e) AS e, count(DISTINCT speaker) AS d FROM sn GROUP BY ALL),
    tp AS (SELECT stream, sentence, speaker AS top, n FROM (SELECT *, row_number() OVER (PARTITION BY stream, sentence ORDER BY n DESC, speaker) AS rn FROM sc) WHERE rn = 1)
    SELECT stream, seq, start_ms, end_ms, word, CASE WHEN d > 1 AND (sl.e = 1 AND l <= 50 OR sl.e = 0 AND l = 50) AND n >= l // 2 THEN top ELSE speaker END AS speaker
    FROM sn JOIN sl USING (stream, sentence) JOIN tp USING (stream, sentence)""",
)
def realign_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.realign(mapped(spark, sf_dir))


@query(
    "srt_file",
    f"WITH {BASE}, ln AS (SELECT unnest(string_split((segment + 1) || chr(10) || {_clock('start_ms')} || ' --> ' || {_clock('end_ms')} || chr(10) || speaker || ': ' || replace(trim(text), '-->', '->') || chr(10), chr(10))) AS line FROM sg) SELECT count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM ln",
)
def srt_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtitles of all recordings written as text in order, and what the files hold."""
    sinks.write_text(srt_lines(spark, sf_dir), path := shared_path(spark, "srt"), "lines", "stream", "segment")
    return readers.read_lines(spark, path).agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query(
    "speaker_changes",
    f"WITH {BASE}, n AS (SELECT *, lag(speaker) OVER (PARTITION BY stream ORDER BY seq) AS before, lead(speaker) OVER (PARTITION BY stream ORDER BY seq) AS after FROM mp) SELECT stream, seq, before, speaker, after FROM n WHERE speaker <> after AND right(word, 1) NOT IN ('.', '?', '!')",
)
def speaker_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of speaker inside a sentence, with the speakers around."""
    order = Window.partitionBy("stream").orderBy("seq")
    rows = mapped(spark, sf_dir).withColumns({"before": F.lag("speaker").over(order), "after": F.lead("speaker").over(order)})
    return rows.where((F.col("speaker") != F.col("after")) & ~F.right("word", F.lit(1)).isin(*t.SENTENCE_END)).select("stream", "seq", "before", "speaker", "after")


@query(
    "majority_speaker",
    f"WITH {BASE}, n AS (SELECT stream, seq // 50 AS span, speaker, count(*) AS n FROM mp GROUP BY 1, 2, 3) SELECT stream, span, speaker, n FROM (SELECT *, row_number() OVER (PARTITION BY stream, span ORDER BY n DESC, speaker) AS rn FROM n) WHERE rn = 1",
)
def majority_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label with most words in each span of 50, ties to the smaller label."""
    n = mapped(spark, sf_dir).groupBy("stream", F.floor(F.col("seq") / 50).alias("span"), "speaker").agg(F.count("*").alias("n"))
    best = n.groupBy("stream", "span").agg(F.min(F.struct((-F.col("n")).alias("less"), "speaker", "n")).alias("x"))
    return best.select("stream", "span", "x.speaker", "x.n")
