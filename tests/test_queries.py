"""Every query gives the rows that its SQL gives, or where SQL can't, those of plain Python."""

import html
import math
import re
from pathlib import Path

import duckdb
import pytest
from brute import brute_pairs, restated, sequential
from corpusloom.plans import catalog, dedup

DATA = Path("/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted([tuple(value(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_same_rows_as_sql(spark, db, name):
    got = catalog.queries()[name](spark, str(DATA))
    want = db.execute(catalog.oracles()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, want.fetchall())


def documents(db):
    return dict(db.execute("SELECT doc_id, text FROM documents").fetchall())


def pages(db):
    return dict(db.execute("SELECT page_id, html FROM pages").fetchall())


def by_kind(db, function):
    return {("document", i): function(t) for i, t in documents(db).items()} | {("page", i): function(t) for i, t in pages(db).items()}


def clusters(db, config):
    found = {i: re.findall("[A-Za-z_0-9]+", t or "") for i, t in documents(db).items()}
    tokens = {i: set(w) for i, w in found.items()}
    return sequential(tokens, brute_pairs(tokens, {i: len(w) for i, w in found.items()}, config), config.threshold)


def kept(db, config):
    got = clusters(db, config)
    return set(documents(db)) - ({i for _, i, _, _ in got} - {i for _, i, extreme, _ in got if extreme})


#: Queries that SQL can't express: their rows as a comparable value, and the same by plain Python.
RESTATED = {
    "clean_html_unescape": (lambda r: {x.page_id: x.html for x in r}, lambda db: {i: html.unescape(t) for i, t in pages(db).items()}),
    "clean_duplicate_words": (lambda r: {x.doc_id: x.text for x in r}, lambda db: {i: t and re.sub(r"\b(\w+)( \1\b)+", r"\1", t) for i, t in documents(db).items()}),
    "clean_full_strict": (lambda r: {(x.kind, x.id): x.text for x in r}, lambda db: by_kind(db, lambda t: t and restated(t))),
    "clean_full_intended": (lambda r: {(x.kind, x.id): x.text for x in r}, lambda db: by_kind(db, lambda t: t and restated(t, intended=True))),
    "dup_clusters": (lambda r: {tuple(x) for x in r}, lambda db: clusters(db, dedup.LOW)),
    "dup_clusters_nested": (lambda r: {(x.base, m.base_index, m.is_extreme, m.copies) for x in r for m in x.members}, lambda db: clusters(db, dedup.LOW)),
    "near_dedup_075": (lambda r: {x.doc_id for x in r}, lambda db: kept(db, dedup.LOW)),
    "near_dedup_085": (lambda r: {x.doc_id for x in r}, lambda db: kept(db, dedup.HIGH)),
}


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracles())))
def test_same_rows_as_plain_python(spark, db, name):
    value, plain = RESTATED[name]
    got = catalog.queries()[name](spark, str(DATA)).collect()
    want = plain(db)
    assert value(got) == want and len(got) == (len({x[0] for x in want}) if name == "dup_clusters_nested" else len(want))


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
