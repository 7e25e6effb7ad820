import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchgrain.operators.topk import cosine_topk
from pitchgrain.plans import search as V

DOCS = "doc_id bigint, doc_type string, embedding array<float>"
QUERIES = "query_id bigint, embedding array<float>, doc_type string, k int"


def brute(docs, queries):
    out = set()
    for qid, q, kind, k in queries:
        scored = []
        for did, dtype, v in docs:
            if v is None or (kind is not None and dtype != kind):
                continue
            a, b = np.asarray(q, float), np.asarray(v, float)
            n = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-round(float(a @ b / n), 9) if n else 2.0, did))
        out |= {(qid, did, rank + 1) for rank, (_, did) in enumerate(sorted(scored)[:k])}
    return out


def made(seed, n=300, width=8):
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((n, width)).astype(np.float32)
    vectors[5] = vectors[6] = vectors[7]  # ties
    docs = [(i, "ab"[i % 2], vectors[i].tolist()) for i in range(n)]
    docs[3] = (3, "a", None)
    docs[4] = (4, "b", [0.0] * width)
    queries = [(q, rng.standard_normal(width).tolist(), [None, "a", "b", "none"][q % 4], q % 7) for q in range(40)]
    queries.append((99, vectors[6].tolist(), None, 2))
    return docs, queries


@pytest.mark.parametrize("shipped", [4096, 5])
def test_topk_equals_brute_force(spark, shipped):
    docs, queries = made(1)
    d = spark.createDataFrame(docs, DOCS).repartition(5)
    q = spark.createDataFrame(queries, QUERIES)
    got = {(r.query_id, r.doc_id, r.rank) for r in cosine_topk(d, q, shipped).collect()}
    assert got == brute(docs, queries)


def test_k_beyond_the_corpus_and_zero_vectors(spark):
    d = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.0, 0.0]), (3, "a", [-1.0, 0.0])], DOCS)
    q = spark.createDataFrame([(0, [2.0, 0.0], None, 10)], QUERIES)
    got = [(r.doc_id, r.score) for r in cosine_topk(d, q).orderBy("rank").collect()]
    assert [g[0] for g in got] == [1, 3, 2]
    assert got[0][1] == 1.0 and got[1][1] == -1.0 and math.isnan(got[2][1])


def test_no_queries(spark):
    d = spark.createDataFrame([(1, "a", [1.0])], DOCS)
    assert cosine_topk(d, spark.createDataFrame([], QUERIES)).count() == 0


def test_equal_documents_rank_by_id_whatever_the_layout(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal(384).astype(np.float32).tolist()
    d = spark.createDataFrame([(i, "a", v) for i in range(3000)], DOCS)
    q = spark.createDataFrame([(0, v, None, 5)], QUERIES)
    for parts in (1, 7):
        got = [r.doc_id for r in cosine_topk(d.repartition(parts), q).orderBy("rank").collect()]
        assert got == [0, 1, 2, 3, 4]


def test_embed_pending_leaves_done_rows(spark):
    kinds = "doc_id bigint, doc_type string, ref_id bigint, content string, embedding array<float>, metadata string"
    df = spark.createDataFrame([(1, "a", 1, "x y", None, None), (2, "a", 2, "z", [9.0], None)], kinds)
    out = {r.doc_id: r.embedding for r in V.embed_pending(df).collect()}
    assert out[2] == [9.0] and len(out[1]) == 384
    assert np.linalg.norm(out[1]) == pytest.approx(1, abs=1e-6)


def test_search_text(spark):
    kinds = "doc_id bigint, doc_type string, ref_id bigint, content string, embedding array<float>, metadata string"
    df = spark.createDataFrame(
        [(1, "a", 1, "pressing high", None, None), (2, "b", 2, "pressing low", None, None), (3, "a", 3, "corner kick", None, None)],
        kinds,
    )
    done = V.embed_pending(df)
    assert [r.ref_id for r in V.search_text(done, "pressing high", 1).collect()] == [1]
    assert [r.ref_id for r in V.search_text(done, "pressing high", 5, "b").collect()] == [2]


def test_lsh_finds_near_neighbours(spark):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((40, 64))
    points = np.repeat(centres, 25, axis=0) + 0.25 * rng.standard_normal((1000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    d = spark.createDataFrame([(i, "a", points[i].astype(np.float32).tolist()) for i in range(1000)], DOCS)
    q = d.filter("doc_id % 20 = 0").select(
        F.col("doc_id").alias("query_id"), "embedding", F.lit(None).cast("string").alias("doc_type"), F.lit(10).alias("k")
    )
    exact = {(r.query_id, r.doc_id) for r in cosine_topk(d, q).collect()}
    close = {(r.query_id, r.doc_id): r.score for r in V.approximate_topk(d, q).collect()}
    assert len(exact & set(close)) / len(exact) >= 0.95
    # what it returns is scored exactly
    scores = {(r.query_id, r.doc_id): r.score for r in cosine_topk(d, q).collect()}
    assert all(abs(scores[p] - s) < 1e-9 for p, s in close.items() if p in scores)


def test_codes_prune(spark):
    """Candidates come from the index alone, and few of them; a hot code is split without loss."""
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((50, 64))
    points = np.repeat(centres, 40, axis=0) + 0.25 * rng.standard_normal((2000, 64))
    rows = [(i, "a" if i % 2 else "b", points[i].astype(np.float32).tolist()) for i in range(2000)]
    rows += [(2000 + i, "a", rows[0][2]) for i in range(300)] + [(9000, "a", None), (9001, "b", [0.0] * 64)]
    d = spark.createDataFrame(rows, DOCS)
    q = d.filter("doc_id % 100 = 0 and doc_id < 2000").select(
        F.col("doc_id").alias("query_id"), "embedding", F.when(F.col("doc_id") % 200 == 0, F.col("doc_type")).alias("doc_type"), F.lit(5).alias("k")
    )
    index = V.materialise(V.code_index(d), "index")
    pairs = {tuple(r) for r in V.candidates(index, q).collect()}
    assert len(pairs) < 0.3 * 20 * len(rows)
    V.OVERFULL, kept = 50, V.OVERFULL
    try:
        assert {tuple(r) for r in V.candidates(index, q).collect()} == pairs
    finally:
        V.OVERFULL = kept
    exact = {(r.query_id, r.doc_id) for r in cosine_topk(d, q).collect()}
    close = {(r.query_id, r.doc_id) for r in V.approximate_topk(d, q, index).collect()}
    assert len(exact & close) / len(exact) >= 0.95
    assert V.approximate_topk(d.limit(0), q).count() == 0 and V.approximate_topk(d, q.limit(0)).count() == 0
