"""The operators as queries over the tables of a folder, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewarden.llm import (
    decontaminate,
    line_runs,
    packing,
    periodic_runs,
    pii,
    quality_model,
    quality_rules,
    simhash,
    speculative_bpe,
    substring_dedup,
    token_alignment,
    toxicity,
    unit_dedup,
)
from tablewarden.llm.common import read_table

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality_model.quality_scores(docs, labels)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.passage_report(docs, benchmark)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_report(read_table(spark, sf_dir, "documents"))


def repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.unit_report(read_table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.toxicity_scores(docs, labels)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.line_report(read_table(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read_table(spark, sf_dir, "documents"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules_report(read_table(spark, sf_dir, "documents"))


def repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(read_table(spark, sf_dir, "documents"))


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    paths = (public_tokenizers.path(name) for name in (VOCABULARY, PIECES))
    return token_alignment.alignment_report(docs, *paths)


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(read_table(spark, sf_dir, "documents"))


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return speculative_bpe.round_trip_report(docs, public_tokenizers.path(VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality,
    "op2_decontamination": decontamination,
    "op3_simhash_dedup": near_duplicates,
    "op4_substring_dedup": repeated_units,
    "op5_toxicity": toxic,
    "op6_best_fit_packing": packed,
    "op7_line_dedup": repeated_lines,
    "op8_pii": personal_data,
    "op9_quality_rules": rules,
    "op10_suffix_dedup": repeated_substrings,
    "op11_token_alignment": aligned_tokens,
    "op12_periodic_runs": periodic,
    "op13_bpe_round_trip": round_trip,
}

ORACLES: dict[str, str] = {"op7_line_dedup": line_runs.ORACLE, "op9_quality_rules": quality_rules.ORACLE}
