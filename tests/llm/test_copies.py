"""Copies and repeated ids in the pipeline's stages."""

import random

import corpus_pipeline
from conftest import SF
from pitchgrain.llm import line_dedup, near_dedup

SHARED = "Read our terms before you go on."


def written(rng, lines):
    return "\n".join(" ".join(f"w{rng.randrange(9000)}" for _ in range(12)) for _ in range(lines))


def edited(rng, text):
    words = text.split(" ")
    words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_copies_do_not_make_boilerplate(spark):
    """A third of a source are exact copies of one page, another near copies of one; a line of other pages still goes."""
    rng = random.Random(3)
    one, two = written(rng, 8), written(rng, 8)
    texts = [one] * 40 + [edited(rng, two) for _ in range(40)] + [f"{SHARED}\n{written(rng, 8)}" for _ in range(20)] + [written(rng, 8) for _ in range(20)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, docs, SF).collect()}
    assert got == {i: t.removeprefix(f"{SHARED}\n") for i, t in enumerate(texts)}
    kept = corpus_pipeline.keep_one(spark, corpus_pipeline.drop_lines(spark, docs, SF), SF).collect()
    assert {r["doc_id"] for r in kept} == {0, 40, *range(80, 120)} and all(r["text"] for r in kept)


def test_a_third_of_exact_copies_keeps_its_text(spark):
    rng = random.Random(8)
    one = written(rng, 6)
    rows = [("s", one)] * 40 + [("s", f"{SHARED}\n{written(rng, 5)}") for _ in range(20)] + [("s", written(rng, 5)) for _ in range(60)]
    got = [r["text"] for r in line_dedup.drop_boilerplate(spark.createDataFrame(rows, "source string, text string")).collect()]
    assert sorted(got) == sorted(t.removeprefix(f"{SHARED}\n") for _, t in rows)


def test_awkward_pages(spark):
    rows = [("a", None), ("a", None), ("a", ""), (None, "x\ny"), (None, "x\ny"), (None, "x\ny"), ("b", " "), ("b", "word")]
    docs = spark.createDataFrame(rows, "source string, text string")
    got = line_dedup.drop_boilerplate(docs, copies_once=True).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_one_row_of_each_component(spark):
    """Equal rows of an id, a near copy whose id has another text as well, and groups without ids."""
    rng = random.Random(5)
    a, b, c, d = (written(rng, 12) for _ in range(4))
    rows = [(1, a), (1, a), (2, b), (3, edited(rng, b)), (3, c), (None, d), (None, d), (None, edited(rng, d)), (None, a), (9, None), (9, " "), (None, "")]
    got = near_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    first = [x["text"] for x in got if x["doc_id"] is None and x["text"]]
    assert len(first) == 1 and first[0] in {d, rows[7][1]}
    named = sorted((tuple(x) for x in got if x["doc_id"] is not None), key=repr)
    assert named == sorted([(1, a), (2, b), (3, c), (9, None), (9, " ")], key=repr) and (None, "") in {tuple(x) for x in got} and len(got) == 7


def test_rejected_rows_of_an_accepted_id_go(spark):
    """Real documents once with their own ids and once with ids that all are the same or null: the same texts stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id >= 0")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {(x["row"]): x["predicted"] for x in corpus_pipeline.quality.quality_scores(docs.selectExpr("doc_id", "text", "doc_id as r"), labels, row="r").collect()}
    repeated = docs.withColumn("doc_id", corpus_pipeline.F.expr("if(doc_id % 2 = 0, 1, null)").cast("long"))
    kept = corpus_pipeline.keep_good(spark, repeated, SF)
    again = corpus_pipeline.quality.quality_scores(repeated, labels)
    assert kept.dtypes == docs.dtypes and kept.count() == again.where("predicted = 1").count() < docs.count()
    assert len(scores) == docs.count() and set(scores.values()) == {0, 1}


def test_stages_on_awkward_tables(spark, tmp_path):
    """Null texts, ids and sources, names that operators use inside, and tables without rows."""
    rng = random.Random(9)
    texts = [None, "", " \n", written(rng, 3), written(rng, 3), written(rng, 40), written(rng, 400)]
    rows = [(i % 4 or None, t, "en", None if i % 3 else "s", 1, *["x"] * 9) for i, t in enumerate(texts + texts)]
    names = "kept_row string, row string, key string, marks string, of string, good_row string, node string, label string, spans string"
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(str(tmp_path / f"full/{table}.parquet"))
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"none/{table}.parquet"))
    for folder, table in (("full", docs), ("none", docs), ("full", docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path / folder))
            assert out.dtypes == docs.dtypes, name
            table = line_dedup.materialise(out, "stage")
        packed = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path / folder))
        assert packed.count() >= table.count()
        if folder == "none":
            kept = [r["text"] for r in table.collect()]
            assert sorted(map(repr, kept)) == sorted(map(repr, [*texts[:3], *texts]))
