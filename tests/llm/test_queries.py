"""The registered text queries on the smallest tables, and the pipeline against its plain version."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import brute
import corpus_pipeline
from compare import compare, connect
from conftest import SF
from pitchgrain.llm import line_dedup, quality
from pitchgrain.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name]) is None


def test_registered():
    assert {"pipeline", *QUERIES} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_packing_query(spark):
    got = QUERIES["op6_packing"](spark, SF).collect()
    assert sum(p["length"] for p in got) == sum({p["doc_id"]: p["doc_tokens"] for p in got}.values())


def test_substring_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w[:3] for r, w in zip(docs, brute.without_repeated_strings([r["text"] for r in docs], 200), strict=True)}
    got = QUERIES["op9_suffix_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got} == want


def test_html_query(spark):
    got = QUERIES["op2_html_text"](spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {r["page_id"] for r in got} == set(pages)
    assert all(r["text"] and r["n_chars"] == len(r["text"]) and "track(" not in r["text"] and "\n\n" not in r["text"] for r in got)


def test_pipeline(spark):
    """All stages but the trained one done again in plain Python, the model's verdicts given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r[0] for r in quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").select("doc_id").collect()}
    rows = [r for r in docs.select("doc_id", "text", "source").orderBy("doc_id").collect() if r["doc_id"] in good]
    texts = brute.without_boilerplate([(r["source"], r["text"]) for r in rows], line_dedup.RATIO, line_dedup.LEAST)
    sets = [brute.shingle_set(t) for t in texts]
    first = brute.components(sets, 85)
    kept = [(r["doc_id"], t) for i, (r, t) in enumerate(zip(rows, texts, strict=True)) if first[i] == i or not sets[i]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [(d, t) for d, t in kept if not brute.contamination(t, items)[3]]
    tokenizer = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    want = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in clean}
    got = {}
    for p in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda p: p["start"]):
        got.setdefault(p["doc_id"], []).extend(p["ids"])
    assert got == want and 0 < len(want) < len(rows) < docs.count()


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes
    assert np.all([len(s) == 2 for s in corpus_pipeline.STAGES])
