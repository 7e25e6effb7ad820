"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its own content says so: after the first sentence end that follows at least
``MIN_CHUNK`` characters, at ``MAX_CHUNK`` characters at the latest. Equal texts have equal cuts.
A document becomes its recipe, the ordered list of 64-bit chunk identifiers. Identifiers are
verified by the chunks' SHA-256: where two different chunks share an identifier, the documents
that hold it carry the digests as well, so recipes are equal only if all chunks are. Texts are read
once and never move; what is shuffled is a recipe and 40 bytes for each chunk.

Cases: a null text counts as empty, and all empty texts are equal. A null ``doc_id`` stands behind
all others of its group. Rows that repeat a ``doc_id`` with an equal text are all in the group and
all carry its smallest id; with different texts they are separate documents. An empty table gives
an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.shared import materialise, text_or_empty

MIN_CHUNK = 512
MAX_CHUNK = 4096
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: str = "text") -> Column:
    """Each run of blanks as one space."""
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text in pieces that join to it again; none for an empty text."""
    cut = rf"(?s).{{{least},{most - 1}}}?[.!?|;。] |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def recipes(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """doc_id, text_sha256, and of the chunks in order ``ids`` (64 bits) and ``digests`` (SHA-256)."""
    texts = docs.select("doc_id", normalised().alias("norm"))
    cut = texts.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), chunks(F.col("norm"), least, most).alias("parts"))
    return cut.select(
        "doc_id",
        "text_sha256",
        F.transform("parts", lambda part: F.xxhash64(part)).alias("ids"),
        F.transform("parts", lambda part: F.unhex(F.sha2(part, 256))).alias("digests"),
    )


def clashing(recipe_table: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk content."""
    pairs = recipe_table.select(F.explode(F.arrays_zip("ids", "digests")).alias("c")).select("c.ids", "c.digests")
    return pairs.distinct().groupBy("ids").count().where("count > 1").select(F.col("ids").alias("clash"))


def verified(recipe_table: DataFrame) -> DataFrame:
    """Adds ``exact``: the digests of documents that hold a clashing identifier, else an empty list."""
    held = (
        recipe_table.select("row", F.explode(F.array_distinct("ids")).alias("id"))
        .join(clashing(recipe_table), F.col("id") == F.col("clash"))
        .select("row")
        .distinct()
        .withColumn("held", F.lit(True))
    )
    none = F.array().cast("array<binary>")
    return recipe_table.join(held, "row", "left").select("doc_id", "text_sha256", "ids", F.when(F.col("held"), F.col("digests")).otherwise(none).alias("exact"))


def exact_duplicates(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``."""
    cut = materialise(recipes(docs, least, most).withColumn("row", F.monotonically_increasing_id()), "recipes")
    exact = materialise(verified(cut), "verified")
    groups = exact.groupBy("ids", "exact").agg(F.count(F.lit(1)).alias("group_size"), F.min("doc_id").alias("keep_id"))
    # Documents of their own need no look-up, and a table written once lets the join split hot groups.
    shared = materialise(groups.where("group_size > 1"), "copies").withColumnsRenamed({"ids": "g_ids", "exact": "g_exact"})
    joined = exact.join(shared, (F.col("ids") == F.col("g_ids")) & (F.col("exact") == F.col("g_exact")), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_id") == F.col("doc_id"), F.col("group_size").isNull() | F.col("keep_id").isNull()).alias("kept"),
        "text_sha256",
    )


#: In DuckDB's SQL.
ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, min(doc_id) AS keep_id FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
