"""The registered queries of the dealt operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from portflow.llm import context_mixing, decontamination, html_region, line_dedup, merkle, neighbours, packing, pii, prefix_trie, quality_rules, simhash, suffix_dedup, toxicity
from portflow.llm.common import table


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score_texts(table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op6_max_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.extract_main_text(table(spark, sf_dir, "pages"))


def op7_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, n_lines="n_lines", n_dropped="n_dropped").drop("source")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents")))


def op11_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_octopus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_peeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digest(prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_fertility, op2_differencing, op3_context_mixing, op4_neighbours, op5_weak_supervision, op6_max_subsequence, op7_wu_manber, op8_site_lines, op9_simhash, op10_suffixes, op11_block_max, op12_octopus, op13_peeling)}
ORACLE: dict[str, str] = {"op7_wu_manber": decontamination.oracle(), "op8_site_lines": line_dedup.oracle(), "op12_octopus": merkle.oracle(),
                          "op13_peeling": prefix_trie.oracle()}
