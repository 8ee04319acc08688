"""The registered queries of the training-data operators, and their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcorpus.llm import decontaminate, jaccard, language, lines, materialise, middle, packing, quality, repeats, sharding, urls, warc, whitening
from loomcorpus.llm.common import scratch, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), 40)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark):
        return stored(lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text")), "line_dedup", scope=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def quality_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op6_quality_rules`` that need no model, so that SQL can check them."""
    return quality.measure(_table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"), urls.rules_table(spark, urls.RULES))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.materialise(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.middle_digests(_table(spark, sf_dir, "documents"))


def op13_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "quality_measures": quality_measures,
    "op7_url_filters": op7_url_filters,
    "op8_warc": op8_warc,
    "op9_training_order": op9_training_order,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_repeated_strings": op13_repeated_strings,
}

ORACLES: dict[str, str] = {
    "op2_sharding": sharding.SQL,
    "op3_line_dedup": lines.SQL,
    "op4_decontamination": decontaminate.SQL,
    "op5_jaccard_join": jaccard.SQL,
    "quality_measures": quality.MEASURES_SQL,
    "op7_url_filters": urls.SQL,
    "op8_warc": warc.SQL,
    "op12_fill_in_middle": middle.SQL,
    "op13_repeated_strings": repeats.SQL,
}
