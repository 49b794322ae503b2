"""Toxicity, near-duplicates, benchmark leaks, secrets and mixing, one after another over documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
All but the last return the columns of documents. Rows with null texts pass the filters; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from corpusloom.llm import common, decontaminate, mixing, secrets, setsketch, toxicity
from corpusloom.session import ship_package


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labels of all documents but the held-out fold.

    Null and empty texts score as the bias says and stay; very long texts are read whole; rows that repeat an id are
    judged each; a score of just 0.5 goes; without labels nothing is rejected; an empty table stays empty.
    """
    labels = common.table(spark, sf_dir, "labels").where(common.remainder("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of five-word shingle similarity 0.8 or more.

    Null, empty and blank texts are in no group and stay; a similarity of just 0.8 counts; of rows that repeat an id one
    stays; rows without an id stay; an empty table stays empty.
    """
    return setsketch.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to 80 % of its five-word shingles.

    Null and empty texts and rows without an id stay; just 80 % goes; rows that repeat an id go together; an empty table
    or benchmark removes nothing.
    """
    found = decontaminate.contaminated(docs, common.table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every finding replaced by a mark; findings that overlap are one mark.

    Null and empty texts stay as they are; rows that repeat an id are redacted each; an empty table stays empty.
    """
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """documents' columns with size, source_size, target, rate, copies and taken: a copy count for every row.

    A name that documents has already gets mix_ before it. Null and empty texts have size 0 and no copies; rows that
    repeat an id and rows without one are counted and given copies each; an empty table stays empty.
    """
    return mixing.attach(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The toxicity model is learned numerically and the sketch search is iterative; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
