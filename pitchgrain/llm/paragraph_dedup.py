"""Near-duplicate paragraphs: leading shingles, exact Jaccard, one paragraph of each component stays.

A paragraph is a sentence of at least ``LEAST`` words, or a run of so many times the same word. Where it ends
depends on its own words alone, not on lines or on what stands before, so a passage that is copied into other
text brings its paragraphs along; shorter sentences are left alone, as they come again by chance.
Equal shingle sets count as one. Paragraphs that share one of their leading shingles, in the order of their
hashes, are compared by full sets; ``shingles.leading`` takes so many that no pair at the threshold is overlooked (see
``components.linked`` for how large buckets are handled; those left in several components are replaced by
buckets of rare shingles, which miss nothing either), components are formed, and in each the paragraph first by
``doc_id`` and place stays.

Shingles and sets never travel with texts; texts are sent once to be compared and once to be rewritten.

Cases: null texts stay null, empty ones empty. Rows that repeat a ``doc_id`` and text share one identity:
their paragraphs count once there, and all such rows are rewritten alike. A null ``doc_id`` comes last.
All columns of the input stay, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm import shingles
from pitchgrain.llm.components import linked
from pitchgrain.llm.packing import slices
from pitchgrain.llm.rare_shingles import confirmed, rarest
from pitchgrain.llm.shared import discard, fresh_name, materialise, text_or_empty

PERCENT = 80
#: Words of a paragraph.
LEAST = 15

BLANK = r"[\x20\x09-\x0D]"
#: A word with the blanks before it, and the blanks behind the last one.
TOKEN = BLANK + "*" + r"[^\x20\x09-\x0D]+"
TAIL = BLANK + r"*\z"

SIGNED = "doc_id long, text_key long, place int, words int, size long, set_key binary, leading array<long>"


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words' hashes, where each text begins among them, and of each paragraph its text's row, its first word and the one behind its last."""
    words, index, begin = shingles.words_of(texts)
    n = len(index)
    stops = np.fromiter((w[-1:] in (".", "!", "?") for w in words), bool, len(words))[index]
    first = np.zeros(n + 1, bool)
    first[begin] = True
    fresh = first[:-1].copy()
    fresh[1:] |= index[1:] != index[:-1]
    run = np.cumsum(fresh) - 1
    monotone = (np.bincount(run) >= LEAST)[run] if n else np.empty(0, bool)
    # A sentence begins with the text, behind a sentence's end, and where a run of one word begins or ends.
    starts = first.copy()
    if n:
        starts[1:-1] |= (stops & ~monotone)[:-1] | (fresh[1:] & (monotone[1:] | monotone[:-1]))
    starts[n] = True
    at = np.flatnonzero(starts)
    long_ = np.diff(at) >= LEAST
    b, e = at[:-1][long_], at[1:][long_]
    return shingles.hashed(words)[index], begin, np.searchsorted(begin, b, side="right") - 1, b, e


def sign(texts: DataFrame, percent: int) -> DataFrame:
    """Of each paragraph its document, first word's place, words, set size, set key and leading shingles."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                words, begin, row, b, e = paragraphs(batch.column("text")[lo:hi])
                sets = list(shingles.sets_between(words, b, e))
                ends, leading = shingles.leading(sets, percent)
                of = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(of),
                        batch.column("text_key").take(of),
                        pa.array((b - begin[row]).astype(np.int32)),
                        pa.array((e - b).astype(np.int32)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([shingles.set_key(s) for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(leading)),
                    ],
                    names=["doc_id", "text_key", "place", "words", "size", "set_key", "leading"],
                )

    return texts.mapInArrow(signed, SIGNED)


def fetched(nodes: DataFrame, wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """node, part: the wanted nodes' paragraphs, cut from their texts."""
    placed = nodes.join(wanted, "node").select("node", F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "place", "words")
    lists = placed.groupBy("of_id", "of_key").agg(F.collect_list(F.struct("node", "place", "words")).alias("cuts"))
    met = texts.join(lists, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))).dropDuplicates(["of_id", "of_key"])

    # A variable of ``transform``, so that the words are found once and not for each paragraph.
    def cut(words: Column) -> Column:
        return F.transform("cuts", lambda c: F.struct(c["node"].alias("node"), F.array_join(F.slice(words, c["place"] + 1, c["words"]), " ").alias("part")))

    words = F.filter(F.split("text", BLANK + "+", -1), lambda w: w != "")
    return met.select(F.explode(F.transform(F.array(words), cut)[0]).alias("x")).select("x.node", "x.part")


def repeated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, place and words of each paragraph that goes, and of the one that stays for it kept_in (a doc_id) and kept_place."""
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed = materialise(sign(texts, percent), "signed").withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "place"))
    first = F.min("order").alias("first")
    sets = materialise(signed.groupBy("set_key").agg(first).withColumn("node", F.monotonically_increasing_id()), "sets")
    # The set's first paragraph lends it its leading shingles.
    lent = sets.select("node", F.col("set_key").alias("k"), F.col("first.doc_id").alias("i"), F.col("first.text_key").alias("t"), F.col("first.place").alias("p"))
    meets = (F.col("set_key") == F.col("k")) & (F.col("text_key") == F.col("t")) & (F.col("place") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("i"))
    nodes = materialise(signed.join(lent, meets).select("node", "doc_id", "text_key", "place", "words", "size", "leading").dropDuplicates(["node"]), "nodes")
    members = nodes.select(F.posexplode("leading").alias("at", "key"), "node", "size").withColumn("at", F.col("at").cast("long"))
    met = materialise(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "met")
    members = materialise(members.join(met, "key"), "members")
    discard(met)
    parts = materialise(fetched(nodes, members.select("node").distinct(), texts), "parts")
    discard(nodes)
    labels = linked(
        members,
        lambda pairs: confirmed(pairs, parts, percent),
        percent,
        lambda crowded: rarest(parts.join(crowded, "node"), percent),
    )

    placed = materialise(sets.join(labels, "node", "left").select("set_key", "first", F.coalesce("label", "node").alias("label")), "placed-sets")
    stays = materialise(placed.groupBy("label").agg(F.min("first").alias("stays")), "stays")
    named = materialise(placed.join(stays, "label").select("set_key", "stays"), "named-sets")
    gone = signed.join(named, "set_key").where("order <> stays")
    return gone.select("doc_id", "text_key", "place", "words", F.col("stays.doc_id").alias("kept_in"), F.col("stays.place").alias("kept_place"))


def without(tokens: Column, gone: Column) -> Column:
    """The tokens joined, but for the stretches ``gone`` (place, words), which are in order."""
    bounds = F.concat(F.array(F.lit(0)), F.flatten(F.transform(gone, lambda g: F.array(g["place"], g["place"] + g["words"]))), F.array(F.size(tokens)))

    def kept(ends: Column) -> Column:
        stretch = lambda k: F.slice(tokens, F.get(ends, 2 * k) + 1, F.get(ends, 2 * k + 1) - F.get(ends, 2 * k))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda k: F.array_join(stretch(k), "")), "")

    return F.transform(F.array(bounds), kept)[0]


def drop_repeats(docs: DataFrame, percent: int = PERCENT, report: bool = False) -> DataFrame:
    """``docs`` without repeated paragraphs, each going with the blanks before it; with ``report`` also n_removed,
    n_removed_words, removed (places of first words) and kept_in (doc ids)."""
    gone = repeated(docs, percent).distinct()
    lists = gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("place", "words", "kept_in"))).alias("gone"))
    of_id, of_key, lost = (fresh_name(docs, n) for n in ("of_id", "of_key", "lost"))
    lists = lists.toDF(of_id, of_key, lost)
    met = docs.join(lists, F.col("doc_id").cast("long").eqNullSafe(F.col(of_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(of_key)), "left")
    tokens = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    kept = F.concat(F.transform(F.array(tokens), lambda t: without(t, F.col(lost)))[0], F.regexp_extract("text", TAIL, 0))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(kept)
    if not report:
        return met.withColumn("text", text).select(docs.columns)
    none = F.expr("cast(array() as array<struct<place: int, words: int, kept_in: bigint>>)")
    lists = F.coalesce(F.col(lost), none)
    return met.select(
        *(F.col(c) for c in docs.columns if c != "text"),
        F.size(lists).cast("long").alias("n_removed"),
        F.aggregate(lists, F.lit(0).cast("long"), lambda n, g: n + g["words"]).alias("n_removed_words"),
        F.transform(lists, lambda g: g["place"]).alias("removed"),
        F.transform(lists, lambda g: g["kept_in"]).alias("kept_in"),
        text.alias("text"),
    )


#: In DuckDB's SQL: shingles of the different sets joined with each other, components by recursion.
ORACLE = rf"""
WITH RECURSIVE x AS (SELECT doc_id, text, regexp_extract_all(text, '{TOKEN}') AS toks FROM documents),
t AS (SELECT doc_id, u.i - 1 AS i, u.t AS tok,
    translate(regexp_replace(u.t, '^{BLANK}+', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM x, unnest(toks) WITH ORDINALITY AS u(t, i)),
a AS (SELECT *, coalesce(w <> lag(w) OVER (PARTITION BY doc_id ORDER BY i), true) AS fresh FROM t),
b AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM a),
o AS (SELECT *, count(*) OVER (PARTITION BY doc_id, r) >= {LEAST} AS same FROM b),
q AS (SELECT *, coalesce(lag(regexp_matches(w, '[.!?]$') AND NOT same) OVER d OR (fresh AND (same OR lag(same) OVER d)), true) AS starts
  FROM o WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
z AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY i) AS piece FROM q),
p AS (SELECT doc_id, min(i) AS place, count(*) AS n_words, list(w ORDER BY i) AS w FROM z GROUP BY doc_id, piece HAVING count(*) >= {LEAST}),
s AS (SELECT DISTINCT doc_id, place, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM p),
k AS (SELECT doc_id, place, md5(array_to_string(list_sort(list(g)), chr(10))) AS k, count(*) AS n FROM s GROUP BY 1, 2),
f AS (SELECT k, min({{'d': doc_id, 'p': place}}) AS f, any_value(n) AS n FROM k GROUP BY 1),
v AS (SELECT k, n, g FROM f JOIN s ON s.doc_id = f.f.d AND s.place = f.f.p),
c AS (SELECT x.k AS a, y.k AS b, count(*) AS m, any_value(x.n) AS na, any_value(y.n) AS nb FROM v x JOIN v y ON x.g = y.g AND x.k < y.k GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * m >= 80 * (na + nb - m)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(k, o) AS (SELECT k, k FROM f UNION SELECT r.k, e.b FROM r JOIN e ON r.o = e.a),
h AS (SELECT r.k, min(f.f) AS stays FROM r JOIN f ON f.k = r.o GROUP BY 1),
gone AS (SELECT doc_id, place, n_words FROM k JOIN h USING (k) JOIN p USING (doc_id, place) WHERE {{'d': doc_id, 'p': place}} <> stays),
y AS (SELECT doc_id, string_agg(tok, '' ORDER BY i) AS kept FROM t WHERE NOT EXISTS (FROM gone g WHERE g.doc_id = t.doc_id AND t.i >= g.place AND t.i < g.place + g.n_words) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_removed, sum(n_words)::BIGINT AS n_removed_words FROM gone GROUP BY 1)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(n_removed_words, 0) AS n_removed_words,
  CASE WHEN n_removed IS NULL THEN text ELSE coalesce(kept, '') || regexp_extract(text, '{TAIL}') END AS text
FROM x LEFT JOIN m USING (doc_id) LEFT JOIN y USING (doc_id)
"""
