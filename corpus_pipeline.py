"""Corpus pipeline: STAGES over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all rows that the one before it
kept; all but the last return the columns of ``documents``.

1. language ID: documents whose language isn't found go;
2. line dedup: lines found in ten documents or more go from every text;
3. SimHash near-dedup: of each group the document with the smallest id stays;
4. mixing: documents are repeated or dropped to bring sources to target weights;
5. packing: documents become pieces in sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilspark.llm.common import read, written
from veilspark.llm.langid import keep_identified
from veilspark.llm.lines import dedup_lines_stage
from veilspark.llm.mixing import mix_stage
from veilspark.llm.packing import pack, tokenizer_spec
from veilspark.llm.simhash import keep_one


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines_stage(docs, min_docs=10)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, k=4, d=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_stage(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_spec())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Hashes, trained models and tokenizers: no SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
