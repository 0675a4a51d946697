"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

``run`` applies the stages to the documents of ``sf_dir``; each stage's rows are written as
Parquet to the shared folder and read again by the next. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopsignal.llm import exact_dedup, mixing, packing, quality, simhash
from shopsignal.llm.common import ship_package, table, written
from shopsignal.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the row with the smallest doc_id stays."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, spread over domains, languages and sources by their target weights."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The classifier, fingerprints and tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep (the columns of ``packing.pack``).

    Null texts count as empty in every stage; empty and very long texts, ties, repeated rows and null
    ids are handled as each operator's docstring says; columns of ``documents`` beyond its own, with
    any names, travel along up to the last stage; an empty table gives no rows. The tables between
    stages stay in the shared folder, as the result reads them lazily.
    """
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, rows, sf_dir)
