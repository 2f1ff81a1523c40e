"""Documents to training tokens: quality, exact and near copies, source mix, token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom.llm.byte_bpe import tokenize
from newsloom.llm.exact_dedup import keep_first
from newsloom.llm.jaccard_join import keep_one
from newsloom.llm.mixing import keep_sample
from newsloom.llm.quality_classifier import keep_good
from newsloom.llm.texts import table
from newsloom.session import file_system, scratch, staging

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return keep_one(docs).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens lean less to the largest sources, languages and topics."""
    return keep_sample(docs, fraction=None).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return tokenize(docs, path, decoded_col="decoded").select(
        "doc_id", "lang", "source", "ids", same.alias("decodes_to_text"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
    ("source mix", source_mix), ("byte-level BPE", token_ids),
]
ORACLE_SQL = None  # the classifier, the raking and the tokenizer are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again.

    When a stage is written, its own scratch tables and what the stage before wrote are deleted.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, step in STAGES:
        path = scratch(spark)
        with staging(spark):
            made = step(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            fs, folder = file_system(spark, before)
            fs.delete(folder, True)
        before = path
    return docs
