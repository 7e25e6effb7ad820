"""The subpackage's registered queries and their DuckDB statements."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain.llm import decontamination, divergence, exact_dedup, html_text, line_dedup, merkle, near_dedup, packing, paragraph_dedup, quality, substring_dedup, warc, weak_rules
from pitchgrain.llm.shared import read_table
from pitchgrain.session import checkpoint_root

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.quality_scores(docs, labels)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_root(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write(read_table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.drop_boilerplate(docs, counts=True).drop("source")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = decontamination.scan(docs, items)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("ids")


def op7_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return paragraph_dedup.drop_repeats(docs, report=True).drop("removed", "kept_in")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.strip_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(read_table(spark, sf_dir, "documents"))


def op12_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_rules.judge(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_html_text": op2_html_text,
    "op3_warc": op3_warc,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_paragraph_dedup": op7_paragraph_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_near_dedup": op10_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_weak_quality": op12_weak_quality,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op3_warc": warc.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_decontamination": decontamination.ORACLE,
    "op7_paragraph_dedup": paragraph_dedup.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op10_near_dedup": near_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_weak_quality": weak_rules.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
