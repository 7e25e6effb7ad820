"""A training corpus from raw documents: five stages, each written before the next reads it.

Every stage takes all that its predecessor kept and returns the columns of ``documents``; the last
returns the pieces that packing makes. Rows that a stage changes get their ``n_chars`` anew.

Cases: null and empty texts are scored like others; where the model accepts them they stay, as they have neither
lines to lose nor shingles to share, and packing makes them one end token each. Of a group of equal or
near-equal rows one stays: the smallest ``doc_id``, nulls last, then the least digest of the text; ids may
repeat. A null source is a site of its own. Without labels all scores are a half, and all rows are
accepted; an empty benchmark rejects none; an empty ``documents`` gives an empty result. Further columns go
through all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain.llm import decontamination, line_dedup, near_dedup, packing, quality
from pitchgrain.llm.shared import fresh_name, materialise, read_table, told_apart


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model accepts, whatever their ids."""
    row = fresh_name(docs, "row")
    keyed = told_apart(docs, row)
    scores = quality.quality_scores(keyed, read_table(spark, sf_dir, "labels"), row=row)
    good = scores.where("predicted = 1").select(F.col("row").alias("good_row"))
    return keyed.join(good, keyed[row] == good["good_row"], "left_semi").select(*(keyed[c] for c in docs.columns))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; exact and near copies count as one page."""
    return line_dedup.drop_boilerplate(docs, copies_once=True).withColumn("n_chars", F.length("text").cast("long"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.deduplicate(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of powers of two."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", keep_one),
    ("benchmark decontamination", keep_clean),
    ("packing", pack),
]

#: Neither a trained model nor a tokenizer can be put into SQL; the stages' own tests check them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of ``sf_dir``/documents.parquet."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
