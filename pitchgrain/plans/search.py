"""Embedding documents and searching them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchgrain.functions.encoder import (
    QUERY_PREFIX,
    Encoder,
    encode_column,
    encode_query,
    token_hash_encoder,
    unit_rows,
)
from pitchgrain.operators.topk import HITS, SCORE_DIGITS, UNDEFINED, best, cosine_topk
from pitchgrain.session import materialise

CODE_TABLES = 64
CODE_BITS = 14  # per table; more make a code rarer
FREE_BITS = 6  # of a query's code in a table, tried both ways
OVERFULL = 65_536
SALTS = 64


def evened(scan: DataFrame) -> DataFrame:
    """Spread a scan of fewer partitions than cores before per-row Python work.

    A table of many files is returned as it is; only a small one is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def embed_pending(
    docs: DataFrame, make_encoder: Callable[[], Encoder] = token_hash_encoder
) -> DataFrame:
    """``docs`` with every missing embedding filled in; rows that have one are not encoded."""
    pending = docs.filter(F.col("embedding").isNull())
    done = docs.filter(F.col("embedding").isNotNull())
    filled = pending.withColumn("embedding", encode_column(F.col("content"), make_encoder))
    return done.unionByName(filled.select(*docs.columns))


def embed_queries(
    queries: DataFrame,
    make_encoder: Callable[[], Encoder] = token_hash_encoder,
    prefix: str = QUERY_PREFIX,
) -> DataFrame:
    """Search texts (query_id, text, doc_type, k) as vectors, with the instruction in front."""
    return queries.select(
        "query_id",
        encode_query(F.col("text"), make_encoder, prefix).alias("embedding"),
        "doc_type",
        "k",
    )


def search(docs: DataFrame, queries: DataFrame) -> DataFrame:
    """Documents nearest to each embedded query, with their content, best first."""
    hits = cosine_topk(docs, queries)
    shown = docs.select("doc_id", "doc_type", "ref_id", "content", "metadata")
    return hits.join(shown, "doc_id").orderBy("query_id", "rank").select(
        "query_id", "rank", "doc_id", "doc_type", "ref_id", "content", "metadata", "score"
    )


def search_text(
    docs: DataFrame,
    text: str,
    k: int = 5,
    doc_type: str | None = None,
    make_encoder: Callable[[], Encoder] = token_hash_encoder,
) -> DataFrame:
    """One search text given as a value."""
    one = docs.sparkSession.createDataFrame(
        [(0, text, doc_type, k)], "query_id bigint, text string, doc_type string, k int"
    )
    return search(docs, embed_queries(one, make_encoder))


# ---------------------------------------------------------------- approximate search


def sign_matrix(width: int, columns: int) -> np.ndarray:
    """Signs of the projections, a column for each bit; from a digest, so that SQL can do the same."""
    return np.array(
        [
            [1 if hashlib.md5(f"{j}:{b}".encode()).hexdigest()[0] >= "8" else -1 for b in range(columns)]
            for j in range(1, width + 1)
        ],
        dtype=np.int8,
    )


def with_codes(df: DataFrame, tables: int = CODE_TABLES, bits: int = CODE_BITS, free: int = 0) -> DataFrame:
    """Rows that have an ``embedding``, with ``codes``: for each table the signs of ``bits`` projections.

    With ``free``, a table's codes are all those that differ from it in its ``free`` least certain
    signs, the projections nearest to zero. Without, the single code of each table.
    """
    present = df.filter(F.col("embedding").isNotNull())
    schema = T.StructType(present.schema.fields + [T.StructField("codes", T.ArrayType(T.ArrayType(T.IntegerType())))])
    spread = np.array([[(i >> k) & 1 for k in range(free)] for i in range(1 << free)], dtype=np.int64)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = vectors.reshape(batch.num_rows, -1)
            if signs is None:
                signs = sign_matrix(vectors.shape[1], tables * bits)
            ahead = (vectors @ signs).reshape(-1, tables, bits)
            places = 1 << np.arange(bits)
            order = np.argsort(np.abs(ahead), axis=2, kind="stable")[:, :, :free]
            loose = places[order]
            base = ((ahead > 0) * places).sum(axis=2) & ~loose.sum(axis=2)
            every = (base[:, :, None] + loose @ spread.T).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, every.size + 1, 1 << free, dtype=np.int32)), pa.array(every.ravel()))
            codes = pa.ListArray.from_arrays(pa.array(np.arange(0, batch.num_rows * tables + 1, tables, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=[*batch.schema.names, "codes"])

    return present.mapInArrow(coded, schema)


def code_index(docs: DataFrame, tables: int = CODE_TABLES, bits: int = CODE_BITS) -> DataFrame:
    """The inverted table: a row (table, code, doc_id, doc_type) for each document and table.

    Written once, it answers any number of searches without a look at the documents.
    """
    coded = with_codes(docs.select("doc_id", "doc_type", "embedding"), tables, bits)
    placed = coded.select("doc_id", F.col("doc_type").cast("string"), F.posexplode("codes").alias("table", "c"))
    return placed.select("table", F.col("c")[0].alias("code"), "doc_id", "doc_type")


def candidates(index: DataFrame, queries: DataFrame, tables: int = CODE_TABLES, bits: int = CODE_BITS, free: int = FREE_BITS) -> DataFrame:
    """query_id, doc_id: documents that share a code with a query, by equality of table and code.

    A code that more than ``OVERFULL`` documents have is split into ``SALTS`` parts, each asked by itself.
    """
    full = index.groupBy("table", "code").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > OVERFULL)
    full = materialise(full.select("table", "code", F.lit(SALTS).alias("parts")), "overfull")
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1))).alias("part")
    dealt = index.join(full, ["table", "code"], "left").select("table", "code", part, "doc_id", "doc_type")
    coded = with_codes(queries.select("query_id", "doc_type", "embedding"), tables, bits, free)
    placed = coded.select("query_id", F.col("doc_type").cast("string").alias("wanted"), F.posexplode("codes").alias("table", "c"))
    asked = placed.select("query_id", "wanted", "table", F.explode("c").alias("code")).join(full, ["table", "code"], "left")
    asked = asked.select("query_id", "wanted", "table", "code", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)).alias("part"))
    met = asked.join(dealt, ["table", "code", "part"])
    return met.filter(F.col("wanted").isNull() | (F.col("wanted") == F.col("doc_type"))).select("query_id", "doc_id").distinct()


def rescored(found: DataFrame, docs: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, doc_id, score, k: the exact cosine of each pair (query_id, doc_id)."""
    vectors = docs.filter(F.col("embedding").isNotNull()).select("doc_id", F.col("embedding").alias("of_doc"))
    asked = queries.select("query_id", F.col("embedding").alias("of_query"), F.col("k").cast("bigint").alias("k"))
    pairs = found.join(vectors, "doc_id").join(asked, "query_id").select("query_id", "doc_id", "of_doc", "of_query", "k")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    unit_rows(batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1))
                    for c in ("of_doc", "of_query")
                )
                score = np.round(np.einsum("ij,ij->i", left, right), SCORE_DIGITS)
                score[~left.any(axis=1) | ~right.any(axis=1)] = UNDEFINED
                own = [batch.column(c) for c in ("query_id", "doc_id")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(score), batch.column("k")], names=["query_id", "doc_id", "score", "k"])

    return pairs.mapInArrow(scored, HITS)


def approximate_topk(
    docs: DataFrame,
    queries: DataFrame,
    index: DataFrame | None = None,
    tables: int = CODE_TABLES,
    bits: int = CODE_BITS,
    free: int = FREE_BITS,
) -> DataFrame:
    """Top-k among documents that share a code with the query, scored exactly: query_id, doc_id, score, rank.

    ``index`` is a stored ``code_index`` of the same ``tables`` and ``bits``; without one it is made here.
    Only candidates' vectors are compared; no candidate is cut off.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    queries = queries.withColumn("query_id", F.col("query_id").cast("bigint")).filter(F.col("k") > 0)
    if index is None:
        index = materialise(code_index(docs, tables, bits), "codes")
    return best(rescored(candidates(index, queries, tables, bits, free), docs, queries))
