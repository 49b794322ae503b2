"""Queries keep whole inputs: fixtures with texts, pages and domains that a cut or a wrong list would lose."""

from corpusloom.operators import lm
from corpusloom.plans import catalog
from pyspark.sql import functions as F


def write(spark, folder, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")


def test_translate_whole_texts(spark, folder):
    texts = ["A" * 64 + "B" * 200, "Short", "C" * 65]
    write(spark, folder, "conversations", [(i, 0, "User", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: (r["translated"], r["original"]) for r in catalog.queries()["translate_stub"](spark, folder).collect()}
    assert got == {i: (t.lower(), f"user: {t.lower()}") for i, t in enumerate(texts)}


def write_union(spark, folder, pages=()):
    write(spark, folder, "documents", [(i, f"text {i}", "en", "web") for i in range(20)], "doc_id long, text string, lang string, source string")
    write(spark, folder, "pages", list(pages), "page_id long, url string, html string")
    write(spark, folder, "conversations", [(i, 0, "user", f"turn {i}") for i in range(20)], "conv_id long, turn int, role string, text string")


def test_union_keeps_whole_pages(spark, folder):
    html = "<p>" + "words " * 100 + "</p>"
    write_union(spark, folder, [(1, "http://a.example/", html)])
    assert [r["text"] for r in catalog.queries()["pmd_union"](spark, folder).where("source = 'pages'").collect()] == [html]


def test_tokens_truncated_and_padded(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c", "d", "e"]), (2, ["a"]), (3, [])], "id long, k array<string>")
    got = {r["id"]: r["t"] for r in df.select("id", lm.truncated_padded(F.col("k"), 3).alias("t")).collect()}
    assert got == {1: ["a", "b", "c"], 2: ["a", "[PAD]", "[PAD]"], 3: ["[PAD]"] * 3}


def test_lines_keep_the_production_length(spark, folder):
    words = [f"w{i}" for i in range(1100)]
    write(spark, folder, "documents", [(1, " ".join(words[:300]) + "\n\n" + " ".join(words))], "doc_id long, text string")
    got = {r["line_no"]: (r["tokens"].split(" "), r["n_tokens"]) for r in catalog.queries()["tokenise_truncate_pad"](spark, folder).collect()}
    assert got == {0: (words[:300] + ["[PAD]"] * 724, 300), 2: (words[:1024], 1024)}


def test_denylist_is_the_reference_list(spark, folder):
    hosts = ["agenjudi45.com", "viagra.example", "m.obatkuat.example", "pornox.example", "slot.example", "health.example", "heart.example", "text.example"]
    write(spark, folder, "pages", [(i, f"https://{h}/a", "") for i, h in enumerate(hosts)], "page_id long, url string, html string")
    assert {r["domain"]: r["n"] for r in catalog.queries()["domain_denylist"](spark, folder).collect()} == dict.fromkeys(hosts[:5], 1)


def test_union_has_both_splits(spark, folder):
    write_union(spark, folder, [(10, "http://a.example/", "<p>")])
    split = {i: "train" if i % 10 else "validation" for i in range(20)}
    got = {(r["text"], r["split"]) for r in catalog.queries()["pmd_union"](spark, folder).collect()}
    assert got == {(f"{kind} {i}", s) for kind in ("text", "turn") for i, s in split.items()} | {("<p>", "train")}
    assert {r["doc_id"]: r["split"] for r in catalog.queries()["pmd_meta_json"](spark, folder).collect()} == split


def test_native_chain_covers_pages(spark, folder):
    write(spark, folder, "documents", [(1, "a  text")], "doc_id long, text string")
    write(spark, folder, "pages", [(1, "http://a.example/", "a  page")], "page_id long, url string, html string")
    got = {(r["kind"], r["id"], r["text"]) for r in catalog.queries()["clean_no_backref"](spark, folder).collect()}
    assert got == {("document", 1, "a text"), ("page", 1, "a page")}
