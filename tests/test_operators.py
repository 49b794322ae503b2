"""Clusters, transcripts, language-model rows, positions, files and streams."""

import gzip
import io
import json
import lzma
import random
import re
import tarfile
from collections import Counter, defaultdict
from datetime import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
import zstandard
from brute import brute_pairs, sequential
from corpusloom.functions import batches, cleaning
from corpusloom.operators import lm, lsh, tables, transcripts
from corpusloom.operators.image_text import SourceSpec, UnionConfig, record
from corpusloom.operators.tables import with_row_index, with_running_sum
from corpusloom.plans import catalog
from corpusloom.sources import crawl, readers, sinks
from corpusloom.streaming import ingest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


def test_row_index(spark):
    df = spark.range(1000).withColumn("k", F.md5(F.col("id").cast("string")))
    got = [(r.k, r.row_index) for r in with_row_index(df, "k").collect()]
    assert sorted(got) == [(k, i) for i, k in enumerate(sorted(k for k, _ in got))]


def varied_copies(seed):
    """Texts with copies, and edits in which candidates are partly similar, in mixed order."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = rng.sample(vocabulary, 30)
        for _ in range(14):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += ["a b c", "a b c", "", None] + [" ".join(rng.sample(vocabulary, 20)) for _ in range(5)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("source", "config"), [("sf0.01", lsh.LshConfig()), (1, lsh.LshConfig(threshold=0.85, bands=13, rows=19)), (2, lsh.LshConfig(bands=40, rows=4))])
def test_clusters_follow_insertion_order(spark, source, config):
    if source == "sf0.01":
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    else:
        docs = spark.createDataFrame(varied_copies(source), "doc_id long, text string")
    df = lsh.tokenised(docs).cache()
    rows = df.collect()
    tokens = {r.id: set(r.tokens or ()) for r in rows}
    pairs = brute_pairs(tokens, {r.id: r.n_tokens or 0 for r in rows}, config)
    index = lsh.build_index(df, config)
    rep = {r.id: r.rep for r in index.members.collect()}
    assert {(r.a, r.b) for r in lsh.candidate_pairs(index).collect()} == {(a, b) for a, b in pairs if rep[a] == a and rep[b] == b}
    assert {(r.a, r.b) for r in lsh.copies(index).collect()} == {(rep[i], i) for i in rep if rep[i] != i}
    got = [tuple(r) for r in lsh.clusters(df, config).collect()]
    assert len(got) == len(set(got)) and set(got) == sequential(tokens, pairs, config.threshold) and got
    kept = {r.doc_id for r in lsh.near_dedup(df, docs, config).collect()}
    clustered, extremes = {g[1] for g in got}, {g[1] for g in got if g[2]}
    assert kept == set(tokens) - (clustered - extremes)


@pytest.mark.parametrize("seed", range(20))
def test_assignment_is_the_sequential_one(seed):
    """Classes with copies and random buckets: base of every document as when inserted one by one."""
    rng = random.Random(seed)
    ids = list(range(60))
    rng.shuffle(ids)
    members = defaultdict(list)
    for i in ids:
        members[rng.randrange(25)].append(i)
    classes = [(sorted(m), sorted({rng.randrange(18) for _ in range(rng.randrange(4))})) for m in members.values()]
    buckets = {i: set(b) or {("own", m[0])} for m, b in classes for i in m}
    made, want = set(), {}
    for i in sorted(buckets):
        near = [j for j in range(i) if j in buckets and buckets[j] & buckets[i]]
        base = next((j for j in near if j in made), near[0] if near else None)
        if base is not None:
            made.add(base)
            want[i] = base
    got = {}
    out = lsh.assign([(m[0], len(m), m[1] if len(m) > 1 else None, b) for m, b in classes])
    for (m, _), (_, own, second, steps) in zip(classes, out, strict=True):
        got |= dict(zip(m, [own, second, *([b for t, b in steps if t < i][-1] for i in m[2:])], strict=False))
    assert {i: b for i, b in got.items() if b is not None} == want


def test_a_page_of_very_many_copies(spark):
    """Buckets hold representatives only, so 5,000 copies of a text are one entry in each."""
    page = " ".join(f"w{i}" for i in range(40))
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 > 0, page).otherwise(F.concat(F.lit(page), F.lit(" x"), F.col("id"))).alias("text"))
    df = lsh.tokenised(docs)
    index = lsh.build_index(df, lsh.LshConfig())
    assert index.members.count() == 5000 and index.buckets.agg(F.max("id"), F.count("*")).first()[1] <= 21 * 1001
    got = lsh.clusters(df, lsh.LshConfig()).where("is_extreme").collect()
    assert [(r.base, r.id, r.copies) for r in got] == [(0, 0, 5000)]
    assert lsh.near_dedup(df, docs, lsh.LshConfig()).count() == 1


def test_short_documents_are_no_candidates(spark):
    df = lsh.tokenised(spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, ""), (4, None)], "doc_id long, text string"))
    index = lsh.build_index(df, lsh.LshConfig())
    assert lsh.candidate_pairs(index).count() == lsh.copies(index).count() == lsh.clusters(df, lsh.LshConfig()).count() == 0


def test_tokens_come_of_one_split(spark):
    """Token sets, their sizes and digests, without a function called for each token."""
    texts = ["", " ", "a", "a b a", " a--b\n", "b a", "x_1 y!", "é", "é a é", "..", "a.", ".a", "A a", None]
    df = lsh.tokenised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    rows = {texts[r.id]: r for r in df.collect()}
    for text in texts[:-1]:
        words = re.findall("[A-Za-z_0-9]+", text)
        assert (rows[text].tokens, rows[text].n_tokens) == (list(dict.fromkeys(words)), len(words))
    assert rows[None].tokens is None and (rows[None].n_tokens or 0) <= 0
    assert rows["a b a"].digest == rows["b a"].digest == rows[" a--b\n"].digest != rows["a"].digest


@pytest.mark.parametrize(("tokens", "texts"), [(1 << 20, 1 << 10), (200, 1 << 10), (1 << 20, 3)])
def test_pairs_are_compared_in_blocks(spark, monkeypatch, tokens, texts):
    """The same pairs once, however many blocks a component has; empty blocks too."""
    monkeypatch.setattr(lsh, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(lsh, "BLOCK_TEXTS", texts)
    config = lsh.LshConfig(bands=40, rows=4)
    df = lsh.tokenised(spark.createDataFrame(varied_copies(3), "doc_id long, text string")).cache()
    sets, index = {r.id: set(r.tokens or ()) for r in df.collect()}, lsh.build_index(df, config)
    alike = {(r.a, r.b): len(sets[r.a] & sets[r.b]) / len(sets[r.a] | sets[r.b]) for r in lsh.candidate_pairs(index).collect()}
    got = [tuple(r) for r in lsh.similar_pairs(index, df, 0.75).collect()]
    assert sorted(got) == sorted((a, b, x) for (a, b), x in alike.items() if x >= 0.75) and len(got) > 50


def test_pairs_without_candidates(spark):
    df = lsh.tokenised(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    assert lsh.similar_pairs(lsh.build_index(df, lsh.LshConfig()), df, 0.75).count() == 0


def test_hashes_are_permuted_modulo_the_prime():
    h = np.array([0, 1, 5, 6, 2**28 - 1, *random.Random(1).sample(range(2**28), 300)])
    a, b = (np.array([*edge, *(lsh.permutation(i)[j] for i in range(252))]) for j, edge in enumerate(([1, lsh.PRIME - 1, 1], [lsh.PRIME - 5, 5, lsh.PRIME - 1])))
    assert (lsh.permuted(h, a, b) == (h[:, None] * a + b) % lsh.PRIME).all()


WORD = "stream long, seq long, start_ms long, end_ms long, word string"
TURN = "stream long, turn long, start_ms long, end_ms long, speaker string"


def test_speakers_and_segments(spark):
    words = spark.createDataFrame([(1, i, 100 * i, 100 * i + 90, w) for i, w in enumerate("Hi there. Yes I do. Bye".split())], WORD)
    turns = spark.createDataFrame([(1, 0, 0, 150, "A"), (1, 1, 180, 400, "B"), (1, 2, 450, 460, "A")], TURN)
    mapped = transcripts.map_speakers(words, turns)
    assert [r.speaker for r in mapped.orderBy("seq").collect()] == ["A", "A", "B", "B", "B", "A"]
    got = [(r.segment, r.speaker, r.start_ms, r.end_ms, r.text) for r in transcripts.segments(mapped, turns).orderBy("segment").collect()]
    assert got == [(0, "Speaker A", 0, 190, "Hi there. "), (1, "Speaker B", 200, 490, "Yes I do. "), (2, "Speaker A", 500, 590, "Bye ")]
    late = transcripts.map_speakers(words, turns, "end")
    assert [r.speaker for r in late.orderBy("seq").collect()] == ["A", "B", "B", "B", "A", "A"]


def test_first_word_of_another_speaker(spark):
    words = spark.createDataFrame([(1, 0, 500, 590, "Hi")], WORD)
    turns = spark.createDataFrame([(1, 0, 0, 100, "A"), (1, 1, 200, 600, "B")], TURN)
    got = [(r.segment, r.speaker, r.start_ms, r.end_ms, r.text) for r in transcripts.segments(transcripts.map_speakers(words, turns), turns).orderBy("segment").collect()]
    assert got == [(0, "Speaker A", 0, 100, ""), (1, "Speaker B", 500, 590, "Hi ")]
    line = transcripts.srt(transcripts.segments(transcripts.map_speakers(words, turns), turns)).where("segment = 1").collect()[0].lines
    assert line == "2\n00:00:00,500 --> 00:00:00,590\nSpeaker B: Hi\n"


@pytest.mark.parametrize(
    ("text", "before", "after", "limit"),
    [
        ("we go home. now", "AABB", "AAAB", 50),  # a sentence split near its end goes to the majority
        ("no end at all", "AABB", "AABB", 50),  # what has no end is left, but for just the limit's length
        ("no end at all", "AABB", "AAAA", 4),
        ("I am here. You are there.", "ABBBBB", "BBBBBB", 50),
        ("a b c. d", "AABA", "AAAA", 50),
        ("one two. three four.", "AABB", "AABB", 50),  # a change at a sentence end stays
        ("a b c d.", "AABB", "AABB", 3),  # longer than the limit
        ("a b c d e.", "ABCDE", "ABCDE", 50),  # the largest share is below half
    ],
)
def test_realignment(spark, text, before, after, limit):
    words = text.split()
    df = spark.createDataFrame([(s, i, i, i, w, before[i]) for s in (1, 2) for i, w in enumerate(words)], f"{WORD}, speaker string")
    got = transcripts.realign(df, limit).orderBy("stream", "seq").collect()
    assert "".join(r.speaker for r in got) == after * 2


@pytest.mark.parametrize("seed", range(3))
def test_realignment_by_sentences(spark, seed):
    rng = random.Random(seed)
    rows = [(s, i, i, i, rng.choice(["a", "b", "c.", "d", "e!", ""]), rng.choice("AAB")) for s in range(30) for i in range(rng.randint(0, 25))]
    want = []
    for s in range(30):
        sentence = []
        mine = [r for r in rows if r[0] == s]
        for r in mine:
            sentence.append(r)
            closed = r[4][-1:] in (".", "!")
            if closed or r is mine[-1]:
                tally = Counter(x[5] for x in sentence)
                top, n = min(tally.items(), key=lambda t: (-t[1], t[0]))
                moved = len(tally) > 1 and n >= len(sentence) // 2 and (len(sentence) <= 6 if closed else len(sentence) == 6)
                want += [top if moved else x[5] for x in sentence]
                sentence = []
    got = transcripts.realign(spark.createDataFrame(rows, f"{WORD}, speaker string"), 6).orderBy("stream", "seq").collect()
    assert [r.speaker for r in got] == want


def test_anchor_options(spark):
    words = spark.createDataFrame([(1, 0, 0, 100, "a"), (1, 1, 100, 300, "b"), (1, 2, 300, 340, "c")], WORD)
    turns = spark.createDataFrame([(1, 0, 0, 150, "A"), (1, 1, 150, 320, "B"), (1, 2, 320, 330, "C")], TURN)
    got = {o: "".join(r.speaker for r in transcripts.map_speakers(words, turns, o).orderBy("seq").collect()) for o in ("start", "mid", "end")}
    assert got == {"start": "AAB", "mid": "ABB", "end": "ABC"}


def test_running_sum(spark):
    df = spark.range(500).select("id", ((F.col("id") * 7919) % 13).alias("v"), F.md5(F.col("id").cast("string")).alias("k"))
    got = {r.id: r.before for r in with_running_sum(df, "v", "k", name="before").collect()}
    total, want = 0, {}
    for r in sorted(df.collect(), key=lambda r: r.k):
        want[r.id] = total
        total += r.v
    assert got == want


def test_flags_and_json_values(spark):
    df = spark.createDataFrame([(1, "x", datetime(2024, 1, 2, 3, 4, 5), bytearray(b"b"))], "id long, text string, at timestamp, raw binary")
    flagged = UnionConfig("f", [SourceSpec("f", lambda s: record(df, "f", "text", meta=("id", "at")), configs=(), flag="on")], frozenset({"on"}))
    assert json.loads(flagged.table("train").collect()[0].meta) == {"id": 1, "at": "2024-01-02 03:04:05"}
    with pytest.raises(ValueError):
        UnionConfig("f", flagged.sources).table("train")
    with pytest.raises(TypeError):
        record(df, "f", "text", meta=("raw",))


def test_input_config(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    config = readers.InputConfig(train=str(tmp_path / "a.txt"))
    assert sorted(r.text for r in config.read(spark, "train", "text string").collect()) == ["one", "two"] and readers.text_column(spark.range(1)) == "id"
    for wrong in ({}, {"train": "x.parquet"}, {"validation": "x"}):
        with pytest.raises(ValueError):
            readers.InputConfig(**wrong)
    with pytest.raises(ValueError):
        config.read(spark, "validation", "text string")


def test_patience():
    waits, answers = [], [ConnectionError(), ConnectionError(), "page"]

    def fetch(url):
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    assert crawl.patiently(fetch, sleep=waits.append)("u") == "page" and waits == [10.0, 15.0]
    answers[:] = [ConnectionError()] * 3
    with pytest.raises(ConnectionError):
        crawl.patiently(fetch, tries=3, sleep=waits.append)("u")


def test_next_page(spark):
    html = ['<a class="paging__link paging__link--next" href="/2">Next</a>', '<a href="/3" class="paging__link--next">Next page</a>', '<a class="paging__link--next" href="/4">Last</a>', "", None]
    df = spark.createDataFrame(list(enumerate(html)), "id long, h string")
    assert [r.n for r in df.orderBy("id").select(crawl.next_page(F.col("h")).alias("n")).collect()] == ["/2", "/3", None, None, None]


def test_chunks(spark):
    df = spark.createDataFrame([(0, list("abc")), (1, []), (2, list("defgh")), (3, list("xy"))], "id long, t array<string>")
    for separator in (None, ".", "| "):
        got = {(r.batch, r.chunk): "".join(r.tokens) for r in lm.chunked(df, "id", F.col("t"), 4, batch_rows=3, separator=separator).collect()}
        assert got == {(0, 0): "abcd", (0, 1): "efgh", (1, 0): "xy"}


def test_model_batches_are_filled_up(spark):
    def model():
        def run(texts):
            assert len(texts) == 8
            return [t[::-1] for t in texts]

        return run

    rows = spark.createDataFrame([(i, f"t{i}") for i in range(21)], "id long, t string")
    got = {r.id: r.o for r in rows.select("id", lm.translator(model, batch=8)(F.col("t")).alias("o")).collect()}
    assert got == {i: f"t{i}"[::-1] for i in range(21)}


def test_union_config(spark):
    df = spark.createDataFrame([(1, "x", "u")], "id long, text string, url string")
    specs = [SourceSpec("a", lambda s: record(df, "a", "text", "url", meta=("id",))), SourceSpec("b", lambda s: record(df, "b", "text"), splits=("train",)), SourceSpec("c", lambda s: record(df, "c", "text"), configs=())]
    assert sorted(r.source for r in UnionConfig("all", specs).table("train").collect()) == ["a", "b"]
    row = UnionConfig("all", specs).table("validation").collect()[0]
    assert row.image_url == "u" and json.loads(row.meta) == {"id": 1} and row.image is None
    assert [r.source for r in UnionConfig("c", specs).table("train").collect()] == ["c"]
    with pytest.raises(ValueError):
        UnionConfig("all", specs).table("test")


def test_conllu(spark, tmp_path):
    text = "# sent_id = 1\n# text = Halo dunia = ya\n1\tHalo\t_\n\n# text = Dua\n1\tDua\n"
    (tmp_path / "a.conllu.xz").write_bytes(lzma.compress(text.encode()))
    got = [(r.sentence, r.metadata) for r in readers.read_conllu(spark, str(tmp_path / "*.xz")).orderBy("sentence").collect()]
    assert got == [(0, {"sent_id": "1", "text": "Halo dunia = ya"}), (1, {"text": "Dua"})]


def test_packed_json_lines(spark, tmp_path):
    raw = b'{"text": "a", "x": "1"}\n\n{"x": "2"}\n'
    (tmp_path / "a.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(raw))
    got = readers.read_packed_jsonl(spark, str(tmp_path / "*.zst"), ("text", "x")).collect()
    assert sorted(map(tuple, got), key=str) == [("a", "1"), (None, "2")]


def test_gzip_json_lines(spark, tmp_path):
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'{"text": "a"}\n\n{"text": "b"}\n'))
    assert sorted(r.text for r in readers.read_jsonl(spark, str(tmp_path / "*.json.gz"), "text string", 2).collect()) == ["a", "b"]


def test_tar(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as archive:
        for name, content in (("d/one.jpg", b"1"), ("two.txt", b"2")):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    got = readers.read_tar(spark, str(tmp_path / "*.tar")).collect()
    assert [(r.path, r.stem, bytes(r.bytes)) for r in got] == [("d/one.jpg", "one", b"1")]


def test_literals_and_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("{'a': 1, 'b': \"it's\"}\n\n{'a': 2}\n")
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    got = readers.parse_literals(readers.read_lines(spark, str(tmp_path / "x.txt")), schema).collect()
    assert sorted(map(tuple, got)) == [(1, "it's"), (2, None)]
    assert [r.length for r in readers.list_files(spark, str(tmp_path), "*.txt").collect()] == [(tmp_path / "x.txt").stat().st_size]


def test_shards_are_contiguous(spark, folder):
    sinks.write_shards(spark.range(25), folder, "id", 10)
    rows = spark.read.schema("id long, shard string").json(folder).select("id", F.col("shard")).collect()
    assert {r.id: int(r.shard) for r in rows} == {i: i // 10 + 1 for i in range(25)}


def test_anchor_classes(spark):
    html = '<h3><a class="article__link big" href="/1">x</a></h3><a href="/2">y</a><a href="/3" class="article__link">z</a>'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(readers.anchors_of(F.col("h"), "article__link")).collect()[0][0] == ["/1", "/3"]


def test_incremental_files(spark, folder):
    df = spark.createDataFrame([(i, f"t{i % 5}") for i in range(20)], "id long, t string")
    ingest.arrivals(df.where("id < 10"), 2, "id", f"{folder}/in")
    run = lambda: ingest.process_new(ingest.incoming(spark, f"{folder}/in", "id long, t string"), lambda b: b, f"{folder}/out", f"{folder}/state")
    run()
    assert spark.read.parquet(f"{folder}/out").select("part").distinct().count() == 2
    ingest.arrivals(df.where("id >= 10"), 1, "id", f"{folder}/in")
    run()
    run()
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r.id for r in rows) == list(range(20)) and {r.part for r in rows} == {9, 10, 11}


def test_done_files_are_archived(spark, folder):
    """Files of batches that are done move to the archive; what is there to process stays."""
    df = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "id long, t string")
    run = lambda: ingest.process_new(ingest.incoming(spark, f"{folder}/in", "id long, t string", clean_source="archive", archive=f"{folder}/archive"), lambda b: b, f"{folder}/out", f"{folder}/state")
    for part in range(3):
        ingest.arrivals(df.where(F.col("id") % 3 == part), 1, "id", f"{folder}/in")
        run()
    spark.read.parquet(f"{folder}/out").count()
    archived = list(Path(f"{folder}/archive").rglob("*.parquet"))
    waiting = list(Path(f"{folder}/in").glob("*.parquet"))
    assert len(archived) + len(waiting) == 3 and len(archived) >= 1
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == list(range(12))


def test_streaming_first_seen(spark, folder):
    df = spark.createDataFrame([(i, f"t{i % 5}") for i in range(20)], "id long, t string")
    ingest.arrivals(df, 4, "id", f"{folder}/in")
    fresh = ingest.first_seen(ingest.incoming(spark, f"{folder}/in", "id long, t string"), F.md5("t"))
    ingest.append_to(fresh, f"{folder}/out", f"{folder}/state")
    assert sorted(r.t for r in spark.read.parquet(f"{folder}/out").collect()) == [f"t{i}" for i in range(5)]


ODD = [None, "", " ", " a ", "\ta\n", "a\r\nb", "a\rb", "\r", "\n", '"', 'a"b', '"a"', "\\", '\\"', "a,b", "\x00", "a\x00", "\x01a", "#x", "\\N", "null"]


def odd_documents(spark, folder):
    """Texts that a format may lose, and ids that are null or below 0; the folder with them as documents."""
    rows = [(i if i else None, x, "en", "s", 1) for i, x in enumerate(ODD, -3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return [r[:3] for r in rows]


def test_csv_keeps_odd_texts(spark, folder):
    rows = odd_documents(spark, folder)
    got = [(r.doc_id, r.text, r.lang) for r in catalog.queries()["csv_roundtrip"](spark, folder).collect()]
    assert Counter(got) == Counter(rows)


@pytest.mark.parametrize("name", ["tsv_roundtrip", "jsonl_roundtrip"])
def test_appended_batches_keep_odd_rows(spark, folder, name):
    rows = odd_documents(spark, folder)
    flat = [(i, x.replace("\n", " ").replace("\t", " ") if x and name == "tsv_roundtrip" else x, lang) for i, x, lang in rows]
    got = [(r.doc_id, r.text, r.lang) for r in catalog.queries()[name](spark, folder).collect()]
    assert Counter(got) == Counter(flat)


def test_tsv_column_keeps_odd_values(spark, folder):
    odd_documents(spark, folder)
    odd = spark.read.parquet(f"{folder}/documents.parquet").withColumn("source", F.col("text"))
    odd.write.parquet(f"{folder}-b/documents.parquet")
    got = Counter({r.value: r.n for r in catalog.queries()["tsv_gz_column"](spark, f"{folder}-b").collect()})
    assert got == Counter(ODD)


def test_arrivals_in_many_files(spark, folder):
    """Batches of several files, so that no task writes or reads a batch; rows of odd ids arrive too."""
    df = spark.createDataFrame([(i if i else None, f"t{i}") for i in range(-8, 56)], "id long, t string").repartition(4)
    ingest.arrivals(df, 2, "id", f"{folder}/in", files=None)
    assert len(list(Path(f"{folder}/in").glob("*.parquet"))) == 8
    stream = ingest.incoming(spark, f"{folder}/in", "id long, t string", files_per_batch=3)
    ingest.process_new(stream, lambda b: b, f"{folder}/out", f"{folder}/state")
    got = spark.read.parquet(f"{folder}/out").collect()
    assert sorted(r.t for r in got) == sorted(f"t{i}" for i in range(-8, 56)) and len({r.part for r in got}) == 3


def test_stream_queries_write_no_single_files(spark, folder):
    """Documents of eight files arrive in more than one file for each of three batches."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(8).write.option("parquet.block.size", 1 << 16).parquet(f"{folder}/documents.parquet")
    rows = catalog.queries()["stream_ingest_dedup"](spark, folder)
    arrived = Path(rows.inputFiles()[0].removeprefix("file:")).parent.parent / "in"
    assert len(list(arrived.glob("*.parquet"))) > 3
    assert rows.count() == docs.select(F.md5(F.trim("text"))).distinct().count() == rows.distinct().count()


def test_streams_are_dealt_by_their_words(spark, monkeypatch):
    """More words are more tasks, not larger ones; adaptive execution would join small parts again."""
    words = spark.range(2000).select((F.col("id") % 40).alias("stream"), F.floor(F.col("id") / 40).alias("seq"))
    words = words.withColumns({"start_ms": F.col("seq") * 300, "end_ms": F.col("seq") * 300 + 250, "word": F.lit("w")})
    turns = words.where("seq % 10 = 9").select("stream", (F.col("seq") / 10).cast("long").alias("turn"), "start_ms", "end_ms", F.lit("a").alias("speaker"))
    monkeypatch.setattr(transcripts, "bounded", lambda df, rows, *keys: tables.bounded(df, rows, *keys, each=100))
    mapped = transcripts.map_speakers(words, turns)
    assert mapped.rdd.getNumPartitions() == 20 and mapped.where("speaker = 'a'").count() == 2000
    assert transcripts.realign(mapped).rdd.getNumPartitions() == 20
    found = transcripts.segments(mapped, turns)
    assert found.count() == 40 and found.rdd.getNumPartitions() >= 20


def test_text_in_order_is_cut_by_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(sinks, "PART", 1000)
    sinks.write_text(spark.range(1000).select("id", F.format_string("%06d", "id").alias("line")), folder, "line", "id")
    files = sorted(Path(folder).glob("part-*"))
    assert len(files) > 4 and "".join(f.read_text() for f in files).split() == [f"{i:06d}" for i in range(1000)]


def test_models_get_pieces_not_batches(spark):
    """What a Python worker makes of a batch is bounded by characters and the model's rows, however long the batch."""
    texts = pd.Series(["x" * 400, None, "y" * 700, "", "z" * 5000, "a"])
    assert [len(p) for p in batches.pieces(texts, characters=1000)] == [3, 2, 1]
    assert [len(p) for p in batches.pieces(texts, rows=4)] == [4, 2] and not list(batches.pieces(texts[:0]))
    made = lm._translated(lambda rows: [f"{len(rows)}{t}" for t in rows], pd.Series(["a", None, "c"]), 2, "f")
    assert [p.tolist() for p in made] == [["2a", "2"], ["2c"]]
    long = spark.createDataFrame([(i, None if i == 2 else f"&amp; {i} " * 60000) for i in range(7)], "id long, text string").coalesce(1)
    tokens = lm.tokeniser(lambda: lambda rows: [t.split() for t in rows])(F.col("text"))
    got = {r.id: (r.n, r.t) for r in long.select("id", F.size(tokens).alias("n"), F.left(cleaning.unescape(F.col("text")), F.lit(4)).alias("t")).collect()}
    assert got == {i: (0, None) if i == 2 else (120000, f"& {i} ") for i in range(7)}
    both = lm.row_translator(lambda: lambda rows: [t.upper() for t in rows], ["a", "b"], batch=2)
    pairs = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(5)], "x string, y string").coalesce(1)
    assert [tuple(r.t) for r in pairs.select(both("x", "y").alias("t")).collect()] == [(f"A{i}", f"B{i}") for i in range(5)]


def test_translate_stub_is_one_python_step(spark):
    text = catalog.queries()["translate_stub"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1
