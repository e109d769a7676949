"""Corpus pipeline: toxic documents go, near-duplicates go, leaks of the benchmark go, sources are mixed, tokens are written.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last give the
columns of documents; the last gives each document's place, count and checksum in the token files it wrote.

Defined results: null, empty and blank texts are near copies of each other, so one of them stays, until the mix, which
takes no document without words; of repeated rows one stays; documents with a null doc_id are judged like any other;
further columns, of any name, are passed on; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import read, stash, unstash
from tessera.llm.decontam import drop_leaks
from tessera.llm.mixing import mix_documents
from tessera.llm.simhash import drop_near_duplicates
from tessera.llm.tokens import token_files
from tessera.llm.toxicity import drop_toxic

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"), edited=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files(docs)[0]


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES, 1):
        found = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            found = found if "stash_path" in vars(found) else stash(found, name)
            if k > 1:  # what the stage before wrote is not read again
                unstash(docs)
        docs = found
    return docs
