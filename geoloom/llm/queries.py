"""The registered queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import decontaminate, divergence, htmltext, interaction, katz, langid, licenses, packing, pii, quality, simhash, suffixes, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"), kept=False)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.report(table(spark, sf_dir, "documents"), ~katz.held_out())
    return scored.select("doc_id", katz.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op13_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontaminate": op2_decontaminate,
    "op3_langid": op3_langid,
    "op4_suffixes": op4_suffixes,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_katz": op7_katz,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_html": op10_html,
    "op11_divergence": op11_divergence,
    "op12_urls": op12_urls,
    "op13_interaction": op13_interaction,
}
ORACLES: dict[str, str] = {"op2_decontaminate": decontaminate.oracle(), "op6_licenses": licenses.oracle(), "op11_divergence": divergence.oracle(), "op13_interaction": interaction.oracle()}
