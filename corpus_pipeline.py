"""The training-data pipeline over documents: quality rules, line dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and returns the columns of documents, but for the last, which
returns the packed pieces. An empty table passes through every stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castellan.llm.mixing import mixed_documents
from castellan.llm.packing import pack
from castellan.llm.quality import keep_quality
from castellan.llm.simhash import one_of_each
from castellan.llm.templates import drop_recurring_lines
from castellan.workspace import keep

#: SQL can express neither the estimates of the first stage nor the tree of the second.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p = pack(docs, tokenizer_path=public_tokenizers.path("word_bpe_49k.json"))
    return p.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup), ("mixing sources to target weights", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
