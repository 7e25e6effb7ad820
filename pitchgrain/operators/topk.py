"""Exact and candidate-filtered cosine top-k of many queries against many documents.

No pair of query and document becomes a row. Documents stay in their partitions; each task
scores Arrow batches against the query matrix and keeps a running top-k, so a task emits at most
k rows per query, and one small window merges the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchgrain.functions.encoder import unit_rows

MAX_SHIPPED_QUERIES = 4096  # x 384 doubles = 12 MB per task
QUERY_BLOCK = 2048
DOC_BLOCK = 20_000
SCORE_ROWS = 2048
SCORE_DIGITS = 12  # ranking ignores noise below this, so equal vectors tie and order by id
MERGE_PARTS = 64  # first step of the merge
UNDEFINED = -2.0  # below any cosine: a zero vector has none

HITS = "query_id bigint, doc_id bigint, score double, k bigint"


@dataclass
class QueryBlock:
    """Queries as arrays, grouped so that one type filter is applied once per group."""

    ids: np.ndarray
    unit: np.ndarray
    types: np.ndarray
    k: np.ndarray
    codes: np.ndarray | None = None

    @classmethod
    def of(cls, rows: pd.DataFrame) -> QueryBlock:
        codes = None
        if "codes" in rows.columns:
            codes = np.array([np.asarray(c) for c in rows["codes"]])
        types = np.array([None if pd.isna(t) else str(t) for t in rows["doc_type"]], dtype=object)
        return cls(
            rows["query_id"].to_numpy(np.int64),
            unit_rows(np.array([np.asarray(v, dtype=np.float64) for v in rows["embedding"]])),
            types,
            rows["k"].to_numpy(np.int64),
            codes,
        )


class Running:
    """The best hits seen so far, as flat arrays (query position, score, document id)."""

    def __init__(self, k: np.ndarray):
        self.k = k
        self.q = np.empty(0, dtype=np.int64)
        self.s = np.empty(0)
        self.d = np.empty(0, dtype=np.int64)

    def add(self, q: np.ndarray, s: np.ndarray, d: np.ndarray) -> None:
        q = np.concatenate([self.q, q])
        s = np.concatenate([self.s, s])
        d = np.concatenate([self.d, d])
        order = np.lexsort((d, -s, q))
        q, s, d = q[order], s[order], d[order]
        starts = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - starts < self.k[q]
        self.q, self.s, self.d = q[keep], s[keep], d[keep]

    def frame(self, block: QueryBlock) -> pd.DataFrame:
        return pd.DataFrame(
            {"query_id": block.ids[self.q], "doc_id": self.d, "score": self.s, "k": block.k[self.q]}
        )


def _candidates(
    unit: np.ndarray, zero: np.ndarray, codes: np.ndarray | None, block: QueryBlock, cols: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, query position, score) of everything that can be among a query's best here."""
    wanted = block.unit[cols]
    if codes is None:
        scores = unit @ wanted.T
        scores = np.round(scores, SCORE_DIGITS)
        scores[zero, :] = UNDEFINED
        scores[:, ~wanted.any(axis=1)] = UNDEFINED
        depth = int(min(block.k[cols].max(), len(unit)))
        bound = np.partition(scores, len(unit) - depth, axis=0)[len(unit) - depth]
        row, col = np.nonzero(scores >= bound)
        return row, cols[col], scores[row, col]
    match = np.zeros((len(unit), len(cols)), dtype=bool)
    for table in range(codes.shape[1]):
        match |= codes[:, table][:, None] == block.codes[cols, table][None, :]
    row, col = np.nonzero(match)
    scores = np.round(np.einsum("ij,ij->i", unit[row], wanted[col]), SCORE_DIGITS)
    scores[zero[row] | ~wanted.any(axis=1)[col]] = UNDEFINED
    return row, cols[col], scores


def _score(running: Running, block: QueryBlock, ids, types, vectors, codes) -> None:
    for start in range(0, len(ids), SCORE_ROWS):
        part = slice(start, start + SCORE_ROWS)
        unit = unit_rows(vectors[part])
        zero = ~unit.any(axis=1)
        for kind in set(block.types):
            cols = np.nonzero(block.types == kind)[0] if kind is not None else np.array(
                [i for i, t in enumerate(block.types) if t is None]
            )
            rows = slice(None) if kind is None else types[part] == kind
            some, nil = unit[rows], zero[rows]
            if not len(some):
                continue
            here = None if codes is None else codes[part][rows]
            row, q, s = _candidates(some, nil, here, block, cols)
            running.add(q, s, ids[part][rows][row])


def _matrix(column: pa.Array) -> np.ndarray:
    """list<float> without NULLs as a 2-d array; a width that varies is an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _shipped(docs: DataFrame, block: QueryBlock) -> DataFrame:
    """Documents scanned in place, queries sent along with the task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = Running(block.k)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.schema.names
            codes = _matrix(batch.column("codes")) if "codes" in names else None
            _score(
                running,
                block,
                batch.column("doc_id").to_numpy(zero_copy_only=False),
                np.array(batch.column("doc_type").to_pylist(), dtype=object),
                _matrix(batch.column("embedding")),
                codes,
            )
        yield pa.RecordBatch.from_pandas(running.frame(block), preserve_index=False)

    return docs.mapInArrow(scan, HITS)


def _blocked(docs: DataFrame, queries: DataFrame, n_queries: int) -> DataFrame:
    """Both sides cut into bounded blocks; every (document block, query block) is one group.

    For query sets too large to ship. Documents are shuffled once per query block.
    """
    doc_blocks = max(1, -(-docs.count() // DOC_BLOCK))
    query_blocks = -(-n_queries // QUERY_BLOCK)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    d = docs.select(
        F.lit(False).alias("is_query"),
        F.col("doc_id").alias("query_id"),
        *[c for c in queries.columns if c not in ("query_id", "k")],
        F.lit(None).cast("int").alias("k"),
        F.pmod(F.xxhash64("doc_id"), F.lit(doc_blocks)).cast("int").alias("_d"),
        every(query_blocks).alias("_q"),
    )
    q = queries.select(
        F.lit(True).alias("is_query"),
        "*",
        F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("_q"),
        every(doc_blocks).alias("_d"),
    )

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["is_query"].to_numpy(bool)
        left, right = rows[~asked], rows[asked]
        block = QueryBlock.of(right)
        running = Running(block.k)
        if len(left) and len(right):
            codes = None
            if "codes" in rows.columns:
                codes = np.array([np.asarray(c) for c in left["codes"]])
            _score(
                running,
                block,
                left["query_id"].to_numpy(np.int64),
                left["doc_type"].astype(object).to_numpy(),
                np.array([np.asarray(v, dtype=np.float64) for v in left["embedding"]]),
                codes,
            )
        return running.frame(block)

    return d.unionByName(q).groupBy("_d", "_q").applyInPandas(score, HITS)


def cosine_topk(
    docs: DataFrame, queries: DataFrame, max_shipped: int = MAX_SHIPPED_QUERIES
) -> DataFrame:
    """The k documents nearest to each query: query_id, doc_id, score, rank.

    docs: doc_id, doc_type, embedding and optionally codes; rows without embedding are skipped.
    queries: query_id (unique), embedding, doc_type (NULL searches all types), k and optionally
    codes. With codes on both sides only documents sharing a code in any table are scored.
    Ties go to the smaller doc_id. A zero vector has no cosine and comes last, with score NaN.
    """
    coded = "codes" in docs.columns and "codes" in queries.columns
    extra = ["codes"] if coded else []
    d = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("doc_type").cast("string").alias("doc_type"),
        "embedding",
        *extra,
    ).filter(F.col("embedding").isNotNull())
    q = queries.select(
        F.col("query_id").cast("bigint").alias("query_id"),
        "embedding",
        F.col("doc_type").cast("string").alias("doc_type"),
        F.col("k").cast("int").alias("k"),
        *extra,
    )
    # a query for nothing finds nothing
    q = q.filter(F.when(F.col("k") < 0, F.raise_error("k must not be negative")).otherwise(F.col("k") > 0))
    # at most max_shipped + 1 rows ever reach the driver
    head = q.limit(max_shipped + 1).toPandas()
    if len(head) == 0:
        hits = d.sparkSession.createDataFrame([], HITS)
    elif len(head) <= max_shipped:
        hits = _shipped(d, QueryBlock.of(head))
    else:
        hits = _blocked(d, q, q.count())
    return best(hits)


def best(hits: DataFrame) -> DataFrame:
    """query_id, doc_id, score, rank: of ``hits`` (query_id, doc_id, score, k) the k best of each query."""
    # Merged in two steps: with many tasks, a query's hits of all of them would meet in one.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS))
    near = Window.partitionBy("query_id", part).orderBy(F.desc("score"), "doc_id")
    hits = hits.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= F.col("k"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = hits.withColumn("rank", F.row_number().over(best))
    score = F.when(F.col("score") != UNDEFINED, F.col("score")).otherwise(F.lit(float("nan")))
    ranked = ranked.withColumn("score", score)
    return ranked.filter(F.col("rank") <= F.col("k")).drop("k")
