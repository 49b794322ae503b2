"""The pipeline's stages one by one on a small corpus with planted cases."""

import random

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("bcdfgklmnprstvaeiou", k=rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus") / "sf")
    item = prose(7000, 30)
    texts = {i: prose(i, 60) + (" vilezork slimegor" if i % 10 == 0 else "") for i in range(300)}
    texts |= {300: texts[1], 301: texts[3] + " end", 302: prose(302, 50) + " " + item, 303: prose(303, 40) + ' token = "abcdef0123456"', 304: None, 305: ""}
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 4}", 0, 1) for i, t in texts.items()], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, corpus)
        if name != "mixing":
            assert new.columns == docs.columns
        seen.append((name, {r.doc_id: r for r in new.collect()}))
        docs = spark.createDataFrame(new.collect(), new.schema)
    ids = {name: set(r) for name, r in seen}
    assert not any(i % 10 == 0 for i in ids["toxicity"] if i < 300) and {1, 2, 3, 301, 304, 305} <= ids["toxicity"]
    assert ids["toxicity"] - ids["near_duplicates"] == {300, 301}
    assert ids["near_duplicates"] - ids["decontamination"] == {302}
    assert ids["decontamination"] == ids["secrets"] == ids["mixing"]
    assert "[SECRET]" in dict(seen)["secrets"][303].text
    last = dict(seen)["mixing"][303]
    assert last.size == 1 and last.taken == last.copies * last.mix_size


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() == 300 - 30 + 3
    assert corpus_pipeline.ORACLE_SQL is None


def test_repeated_ids_ties_and_very_long_texts(spark, corpus):
    """Each stage on rows that repeat an id, rows without one, blank, tied and very long texts, and clashing columns."""
    item = spark.read.parquet(f"{corpus}/benchmark.parquet").first().text
    long = prose(900, 40000)
    data = [(1, prose(1, 40)), (1, prose(1, 40)), (1, prose(2, 40)), (2, long), (3, long + " end"), (4, " \n"), (5, None), (None, prose(3, 40)), (None, None), (6, prose(4, 40000) + f" {item} token = abcdef123456 " + prose(5, 10))]
    columns = "doc_id long, text string, lang string, source string, n_chars long, size int, rate string, blob string, component_id int, score double"
    docs = spark.createDataFrame([(i, t, None, None if i == 1 else "s", None, 7, "r", "b", 3, 0.1) for i, t in data], columns)
    ids = {name: sorted(str(r.doc_id) for r in stage(spark, docs, corpus).collect()) for name, stage in corpus_pipeline.STAGES}
    every = sorted(str(i) for i, _ in data)
    assert ids["toxicity"] == ids["secrets"] == ids["mixing"] == every
    assert ids["near_duplicates"] == ["1", "2", "4", "5", "6", "None", "None"]
    assert ids["decontamination"] == [i for i in every if i != "6"]
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, corpus).columns == docs.columns, name
    mixed = corpus_pipeline.mix_sources(spark, docs, corpus)
    assert mixed.columns == [*docs.columns, "mix_size", "source_size", "target", "mix_rate", "copies", "taken"]
    assert all(r.mix_size == len((r.text or "").split()) and r.taken == r.copies * r.mix_size for r in mixed.collect())
    assert "token = " not in next(r.text for r in corpus_pipeline.redact_secrets(spark, docs, corpus).collect() if r.doc_id == 6)


def test_empty(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
