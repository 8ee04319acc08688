"""The corpus pipeline: language ID, line dedup, near duplicates, decontamination, packing.

Each stage takes the documents that its predecessor kept and returns documents again; the last
returns the placed pieces of the packed training sequences. Empty tables pass all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomcorpus.llm import decontaminate, jaccard, language, lines, packing
from loomcorpus.llm.common import delete, scratch, stored


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop null texts, texts without a letter, and those that two learned languages explain alike.
    Repeated rows stay or go together, rows with a null id like others; very long texts are scored whole."""
    return language.keep_identified(docs)


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated runs of lines, and documents of which nothing is left. The copy
    in the least id stays; texts that are null or blank to begin with, and rows with a null id, stay as they are."""
    return lines.keep_new_lines(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of each group of linked documents. Null and wordless texts are linked with
    nothing and stay, as do rows with a null id; rows that repeat the least id all stay."""
    return jaccard.keep_one_per_group(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by the benchmark. Null texts, null ids and, for an empty benchmark,
    all rows stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences: every row, null and empty texts as an end id alone."""
    return packing.pack(docs)


STAGES = [
    ("language", _language),
    ("line_dedup", _line_dedup),
    ("near_duplicates", _near_duplicates),
    ("decontaminate", _decontaminate),
    ("pack", _pack),
]

#: The language model and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again. What a stage wrote, and what its
    operators stored on the way, is deleted when the next stage is written; only the result stays."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, scope=2)
        if before is not None:
            delete(spark, before)
        files = docs.inputFiles()
        before = files[0].rsplit("/", 1)[0] if files else None
    return docs
