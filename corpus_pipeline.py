"""The training-data pipeline: five operators of ``supplylake.llm`` in a row.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet below the shared checkpoint folder and read again as the next one's
``docs``.  All but the last return the columns of ``documents``; the last returns
what was read back from the written token files.

1. toxicity: documents predicted toxic go.
2. near_duplicates: one document of each group of near copies stays.
3. decontamination: documents that hold a benchmark passage go.
4. mixing: documents repeat or go so that sources come near their target words.
5. tokens: token files are written, read back and summed up by document.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns
are handled as each operator's docstring says; a document that is kept keeps its
row as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from supplylake.llm.common import saved, table
from supplylake.llm.decontamination import without_leaks
from supplylake.llm.mixing import repeated_by_mix
from supplylake.llm.ngram_join import keep_one_of_each
from supplylake.llm.queries import tokenizer_path
from supplylake.llm.token_files import read_token_files, write_token_files
from supplylake.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), step=1)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeated_by_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, shards = write_token_files(docs, tokenizer_path(), added=True)
    return read_token_files(shards)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Nearest neighbours, iterative grouping and a tokenizer's merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
