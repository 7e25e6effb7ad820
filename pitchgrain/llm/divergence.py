"""How sources of a language differ in their words: segment trees that share equal subtrees.

1. Tasks count terms by language and source; counts and numbers of documents are added up. A language
   keeps the terms of ``LEAST`` documents at least. A term's share in a source is its smoothed count in
   ``UNIT`` parts, rounded down, in whole numbers throughout.
2. The kept terms of a language are dealt into segments of about ``SEGMENT`` by a hash of the term and
   numbered in each. For a segment, each source's counts are the leaves of a binary tree over the
   numbers. Equal subtrees, of one source or several, are one node, found level by level through the
   pair of children; what a source lacks altogether is one node a level.
3. Two sources' trees are gone through together from the roots. Of each level only different pairs of
   nodes go on, with the number of times they occur, so an equal pair is priced once; leaves give the
   difference of shares. Segments' sums add up to the distance of two sources.
4. Sources come in blocks of ``BLOCK``; a task has a segment and two blocks, so its memory is bounded by
   ``BLOCK`` x ``SEGMENT`` whatever the number of sources and terms.

Cases: null text, language and source count as empty. Texts without terms make their source occur
all the same. Equal values rank by the item's UTF-8 bytes. Repeated rows count each. Columns beside text,
lang and source are not read. An empty table gives an empty result. Shares are exact while a source has
fewer than 9e15 occurrences.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm.packing import slices
from pitchgrain.llm.shared import materialise

LEAST = 30
UNIT = 1_000_000_000
ADDED = 5
TOP = 50
SEGMENT = 1024
BLOCK = 32
#: Different terms of a task that are held before they are passed on.
HELD = 200_000

#: Bytes of a term stay (A-Z as small letters), all others part terms.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences, and rows with the term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
        size = 0

        def passed() -> pa.RecordBatch:
            flat = [(lang, source, term, n, docs) for (lang, source), terms in held.items() for term, (n, docs) in terms.items()]
            columns = list(zip(*flat, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            arrays[2] = arrays[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                rows = zip(*(part.column(c).to_pylist() for c in ("lang", "source")), part.column("text").cast(pa.binary()).to_pylist(), strict=True)
                for lang, source, text in rows:
                    own = held[lang, source]
                    size -= len(own)
                    for term, n in Counter(text.translate(TERM_BYTES).split()).items():
                        if (entry := own.get(term)) is None:
                            own[term] = [n, 1]
                        else:
                            entry[0] += n
                            entry[1] += 1
                    size += len(own)
                if size > HELD:
                    yield passed()
                    held.clear()
                    size = 0
        yield passed()

    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = texts.mapInArrow(counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    part = F.lit(UNIT).cast("decimal(20,0)") * (n + ADDED)
    return F.call_function("div", part, (total + ADDED * terms).cast("decimal(20,0)")) + 1


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (n + ADDED) / whole), in three steps of long division."""
    out, rest = np.zeros(len(n), np.int64), n + ADDED
    out, rest = np.divmod(rest, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def trees(leaves: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Each row's root, and from the leaves up the children of each level's different nodes. The rows' width is a power of two."""
    children, nodes = [], leaves
    while nodes.shape[1] > 1:
        many = int(nodes.max()) + 1
        pairs, found = np.unique(nodes[:, 0::2] * many + nodes[:, 1::2], return_inverse=True)
        children.append((pairs // many, pairs % many))
        nodes = found.reshape(len(nodes), -1)
    return nodes[:, 0], children


def merged(pair: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different (pair, a, b) with the sums of their times."""
    many = int(max(a.max(), b.max())) + 1
    keys, found = np.unique((pair * many + a) * many + b, return_inverse=True)
    total = np.bincount(found, times, len(keys)).astype(np.int64)
    return keys // (many * many), keys // many % many, keys % many, total


def distances(leaves: np.ndarray, counts: np.ndarray, whole: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each pair of rows (``first``, ``second``) the sum of differences of shares. ``leaves`` holds places in
    ``counts``, of which the last stands for no term; ``whole`` is what each row's shares divide by."""
    roots, children = trees(leaves)
    pair, times = np.arange(len(first)), np.ones(len(first), np.int64)
    a, b = roots[first], roots[second]
    for left, right in reversed(children):
        both = (np.tile(pair, 2), np.concatenate((left[a], right[a])), np.concatenate((left[b], right[b])), np.tile(times, 2))
        pair, a, b, times = merged(*both)
    real = a < len(counts) - 1
    pair, a, b, times = pair[real], a[real], b[real], times[real]
    apart = np.abs(shares(counts[a], whole[first[pair]]) - shares(counts[b], whole[second[pair]]))
    out = np.zeros(len(first), np.int64)
    np.add.at(out, pair, apart * times)
    return out


def priced(cells: pd.DataFrame) -> pd.DataFrame:
    """lang, a, b, value: the part that a segment adds to the distances of the sources of two blocks."""
    known = cells[cells["id"] < 0]
    names = known["source"].to_numpy()
    order = np.argsort(names, kind="stable")
    known, names = known.iloc[order], names[order]
    block, width, apart = known["block"].to_numpy(), int(known["width"].iloc[0]), known["low"].iloc[0] != known["high"].iloc[0]
    whole = known["total"].to_numpy() + ADDED * known["terms"].to_numpy()
    first, second = np.triu_indices(len(names), 1)
    if apart:  # pairs within a block are worked where it meets itself
        across = block[first] != block[second]
        first, second = first[across], second[across]
    value = np.zeros(len(first), np.int64)
    if width and len(first):
        filled = cells[cells["id"] >= 0]
        counts = np.unique(np.append(filled["n"].to_numpy(), 0))
        leaves = np.full((len(names), 1 << (width - 1).bit_length()), len(counts), np.int64)
        leaves[:, :width] = 0
        row = pd.Index(names).get_indexer(filled["source"])
        leaves[row, filled["id"].to_numpy()] = np.searchsorted(counts, filled["n"].to_numpy())
        value = distances(leaves, np.append(counts, 0), whole, first, second)
    return pd.DataFrame({"lang": known["lang"].iloc[0], "a": names[first], "b": names[second], "value": value})


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: of each source its distance to each other of its language
    (part ``pair``), and the ``top`` terms it uses more than the language does (part ``term``)."""
    counts = materialise(term_counts(docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= least)
    kept = materialise(kept.select("lang", "term", "all_n"), "kept")
    langs = materialise(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("all_total")), "langs")
    dealt = kept.join(langs, "lang").withColumn("segment", F.expr(f"cast(pmod(xxhash64(term), ceil(terms / {segment})) as int)"))
    dealt = materialise(dealt.withColumn("id", F.expr("row_number() over (partition by lang, segment order by term) - 1")), "dealt")
    segments = materialise(dealt.groupBy("lang", "segment").agg(F.count(F.lit(1)).alias("width")), "segments")
    cells = materialise(counts.join(dealt, ["lang", "term"]).select("lang", "source", "term", "segment", "id", "n", "all_n"), "cells")

    occurring = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    totals = materialise(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), "totals")
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "terms", "all_total"])
    groups = materialise(groups, "groups")
    blocks = materialise(groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "blocks")
    groups = groups.join(blocks, "lang").withColumn("block", F.expr("cast(pmod(xxhash64(source), blocks) as int)"))
    groups = materialise(groups, "blocked")

    ids = ["lang", "source", "block", "blocks", "total", "terms", "segment", "id", "n", "width"]
    zero, none = F.lit(0).cast("long"), F.lit(-1)
    marks = groups.join(segments, "lang", "left").fillna(0, ["segment", "width"]).withColumns({"id": none, "n": zero}).select(*ids)
    filled = cells.join(groups, ["lang", "source"]).withColumn("width", zero).select(*ids)
    # A block's rows go to each task in which it meets another one, or itself.
    met = marks.union(filled).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    parts = met.groupBy("lang", "segment", "low", "high").applyInPandas(priced, "lang string, a string, b string, value long")
    pairs = materialise(parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    both = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    own, whole = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("all_n"), F.col("all_total"), F.col("terms"))
    used = cells.join(groups, ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (own - whole).alias("value"))
    rank = F.expr("row_number() over (partition by lang, source order by value desc, item)")
    used = used.where("value > 0").withColumn("rank", rank).where(F.col("rank") <= top)
    return both.withColumn("rank", rank).union(used)


#: In DuckDB's SQL: every kept term of every group, joined with itself.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= {LEAST}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
s AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + {ADDED}) // (s.n + {ADDED} * v.v)) AS p,
    1 + ({UNIT}::HUGEINT * (k.n + {ADDED}) // (v.n + {ADDED} * v.v)) AS q
  FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
