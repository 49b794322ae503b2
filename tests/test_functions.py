"""Cleaning, statistics and line rules against hand-made rows and a plain restatement."""

import random
import re
import time

import pytest
from brute import restated
from corpusloom.functions import cleaning, lines, stats
from corpusloom.operators.image_text import padded_id
from pyspark.sql import functions as F

TEXTS = [
    "",
    "plain words here",
    "kata satu.\nKata dua. akhir",
    "Visit http://a.example.com/x?y=1 or sub.domain.org/path now, ok",
    "hi @bob how are you",
    "mail me at x@y.org please @<user> and @@z",
    "nbsp;a quot;b&quot; &amp; amp;c #39;d <br />e ... <unk> f",
    'say \\"hi\\" “quoted” ‘it’s’ – dash',
    "ö ö the the the cat cat. Ö",
    "wow!!! really??? --- ,,, ((x))",
    "café naïve ünïcode ​­ zero",
    "<a href='x'>link</a> <ref name=1> <B>bold</B> <News tag>",
    "tabs\tand\r\nbreaks\n\n\nend",
    "emoji 😀 stays? no",
    "&lt;tag&gt; &copy 2020 &notanentity; &#233;",
    "a  b   c",
]


def column(spark, texts, *columns):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", *columns).orderBy("id").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


def test_strict_chain(spark):
    assert column(spark, TEXTS, cleaning.clean(F.col("text"), "strict")) == [restated(t) for t in TEXTS]


def test_strict_chain_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in docs.select("text", cleaning.clean(F.col("text"), "strict").alias("clean")).collect():
        assert r.clean == restated(r.text)


@pytest.mark.parametrize("seed", range(4))
def test_urls_and_tags_go_as_the_plain_patterns_say(spark, seed):
    rng = random.Random(seed)
    bits = ["a", "B", "http://", "https://", ".", ".com", "/", "&", "@", " ", "<", ">", "<a", "</a>", "<ref", "<N", "</N", "é", "-", "=x", "..", "abcdefgh"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(400)]
    got = column(spark, texts, cleaning.drop_urls(cleaning.drop_news_tags(F.col("text"))))
    assert got == [re.sub(cleaning.URL, "", re.sub(cleaning.ANCHORS, "", re.sub(cleaning.NEWS_TAGS, "", t))) for t in texts]


@pytest.mark.parametrize("text", ["Ab9" * 350000, "<A" * 500000, "<a " * 300000 + ">", "a." * 500000, "@" * 1000000])
def test_unbroken_megabytes_are_quick(spark, text):
    column(spark, ["warm"], cleaning.clean(F.col("text"), "native"))
    began = time.perf_counter()
    column(spark, [text], cleaning.clean(F.col("text"), "native"))
    assert time.perf_counter() - began < 5


def test_modes_differ_as_described(spark):
    strict, intended = (column(spark, ["kata satu.\nKata dua. akhir", "hi @bob ok", "a ☃ b"], cleaning.clean(F.col("text"), m)) for m in ("strict", "intended"))
    assert strict == ["kata dua. akhir", "h i o k", "a b"] and intended == ["kata satu. Kata dua. akhir", "hi ok", "a b"]


def test_nulls_stay(spark):
    assert column(spark, [None], cleaning.clean(F.col("text"), "strict")) == [None]


def test_statistics(spark):
    s = stats.text_stats(F.col("text"))
    got = column(spark, ["Ab1 Öx", "", "😀"], *s.values())
    assert got[0] == (4, 1, 2, 6, 4 / 6, 1 / 6, 2 / 6) and got[1] == (0, 0, 0, 0, None, None, None) and got[2][3] == 1


def test_words_and_hash(spark):
    got = column(spark, ["", "a", "a b"], stats.words(F.col("text")))
    assert got == [0, 1, 2]
    a, b = column(spark, ["  x\n", "x"], stats.content_hash(F.col("text")))
    assert a == b


def test_gate_reasons(spark):
    rows = [(5, 0.9, 0.0, 0.0), (30, 0.75, 0.0, 0.0), (30, 0.9, 0.1, 0.0), (30, 0.9, 0.0, 0.05), (30, 0.9, 0.0, 0.0), (30, None, None, None)]
    df = spark.createDataFrame(rows, "clean_words long, alphabet_ratio double, upper_ratio double, number_ratio double")
    got = [r[0] for r in df.select(stats.Gate().reason()).collect()]
    assert got == ["short", "alphabet", "upper", "number", "kept", "alphabet"]


@pytest.mark.parametrize(
    ("url", "want"),
    [("http://u:p@Ex.org:80/a?b#c", "u:p@Ex.org:80"), ("//host/x", "host"), ("mailto:a@b.c", ""), ("no url", ""), ("https://a.b?q", "a.b")],
)
def test_netloc(spark, url, want):
    assert column(spark, [url], stats.netloc(F.col("text"))) == [want]


def test_timestamps(spark):
    df = spark.createDataFrame([(0,), (61001,), (3723004,)], "ms long")
    assert [r[0] for r in df.select(stats.timestamp(F.col("ms"))).collect()] == ["00:00:00,000", "00:01:01,001", "01:02:03,004"]
    assert [r[0] for r in df.select(stats.timestamp(F.col("ms"), ".", hours=False)).collect()] == ["00:00.000", "01:01.001", "01:02:03.004"]


def test_padded_ids(spark):
    assert column(spark, ["7", "-7", "1234567890123", ""], padded_id(F.col("text"))) == ["000000000007", "-00000000007", "1234567890123", "000000000000"]


def test_article_id(spark):
    got = column(spark, ["https://x.example/read/2024/01/02/345/some", "https://x.example/other"], stats.article_id(F.col("text")))
    assert got == ["345", "https://x.example/other"]


LINES = [f"Zin nummer {n} heeft hier genoeg woorden staan." for n in range(6)]


def test_line_cleaner(spark):
    rules = lines.LineRules(bad_words=("vloek",))
    menu = "Home\nMenu | Contact\n" + "\n".join(LINES) + "\nDeze regel eindigt met drie punten erin...\nKort."
    got = column(spark, [menu, "\n".join(LINES[:2]), menu + "\nEen vloek.", None, "trefwoord, trefwoord, trefwoord"], *lines.clean_lines(F.col("text"), rules))
    assert got[0] == ("kept", "\n".join(LINES)) and got[1] == ("few_sentences", None) and got[2] == ("bad_word", None)
    assert got[4] == ("few_sentences", None)


@pytest.mark.parametrize(
    ("text", "reason", "kept"),
    [
        ("\n".join(LINES[:3]), "few_sentences", None),
        ("\n".join(LINES + LINES[:3]), "kept", LINES + LINES[:3]),
        ("Aanbiedingen > Tuin > Stoelen\nHome / Winkel / Contact\n" + "\n".join(LINES), "kept", LINES),
        ("\n".join(f"Aanbieding nummer {n} met een lange omschrijving van de inhoud..." for n in range(12)), "few_sentences", None),
        ("\n".join([*LINES, "Deze zin breekt aan het eind af met een teken…", "Deze zin houdt aan het eind gewoon op met een punt."]), "kept", [*LINES, "Deze zin houdt aan het eind gewoon op met een punt."]),
        ("fietsen tweedehands goedkoop fietsen kopen " * 30, "few_sentences", None),
        ("\n".join([*LINES, "Hier staat een vloek midden in een zin."]), "bad_word", None),
        ("\n".join([*LINES, "Vloekwoorden zoals dit woord tellen niet als het hele woord."]), "kept", [*LINES, "Vloekwoorden zoals dit woord tellen niet als het hele woord."]),
        ("\n".join(f"  {x}  " for x in LINES), "kept", [f"  {x}  " for x in LINES]),
        ("", "few_sentences", None),
    ],
)
def test_line_rules_by_shape(spark, text, reason, kept):
    """Titles, listings, cut lines, keywords and unwanted words, and how many sentences must be left."""
    got = column(spark, [text], *lines.clean_lines(F.col("text"), lines.LineRules(bad_words=("vloek",))))
    assert got == [(reason, kept and "\n".join(kept))]


def test_language_is_told_only_of_texts_that_pass(spark, tmp_path):
    """Rows that fail the gate before have no language to tell, and the reasons stay the same."""
    from corpusloom.plans import cleaning as plans

    good = "the house of the man that was in the town and the road is long for all of them with a view to the sea"
    rows = [(1, good), (2, "kurz"), (3, "1 2 3 " * 30), (4, "der mann und das haus ist nicht von hier und die frau mit dem kind ist zu hause und der weg ist ein langer"), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.lang for r in plans._identified(spark, str(tmp_path)).collect()}
    assert got == {1: "en", 2: None, 3: None, 4: "de", 5: got[5]}
    reasons = {r.reason: r.n for r in plans.language_reject_reasons(spark, str(tmp_path)).collect()}
    assert reasons["kept"] == 1 and reasons["language"] == 1
