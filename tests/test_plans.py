"""What the physical plans must show: pruned columns, pushed filters, no needless Python, shuffles or products."""

import re

import pytest
from corpusloom.functions.language import detector
from corpusloom.operators.tables import spread
from corpusloom.plans import catalog, cleaning
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_is_one_narrow_stage(spark, monkeypatch):
    """Where the input has splits enough; a small one is dealt over the cores first, once."""
    assert plan(catalog.queries()["quality_gate"](spark, DATA)).count("Exchange") == 1
    monkeypatch.setattr(cleaning, "spread", lambda df, key: spread(df, key, split_bytes=0))
    text = plan(catalog.queries()["quality_gate"](spark, DATA))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("regexp_replace") < 40  # the chain is there once, not once for each statistic
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert "source" not in columns and "lang" not in columns


def test_filters_reach_the_scan(spark):
    text = plan(catalog.queries()["lang_filter"](spark, DATA))
    assert re.search(r"PushedFilters: \[.*EqualTo\(lang,de\)", text)


@pytest.mark.parametrize("name", ["exact_dedup", "dup_rows", "domain_counts", "domain_semi", "domain_anti", "anti_invalid_ids", "explode_captions", "normalise_union", "perplexity"])
def test_no_products_or_python(spark, name):
    text = plan(catalog.queries()[name](spark, DATA))
    assert not re.search("CartesianProduct|BroadcastNestedLoop|Python|Pandas|MapInArrow", text)


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(catalog.queries()["domain_topk"](spark, DATA))


def test_detector_plugs_in(spark):
    def model():
        return lambda texts: [("id" if "yang" in t else "en", 0.9) for t in texts]

    df = spark.createDataFrame([("yang ini",), ("this",), (None,)], "text string")
    got = [tuple(r[0]) for r in df.select(detector(model)(F.col("text")).alias("p")).collect()]
    assert got == [("id", 0.9), ("en", 0.9), ("en", 0.9)]
