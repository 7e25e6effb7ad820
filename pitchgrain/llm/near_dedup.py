"""Near duplicates: MinHash bands, sequential Bayesian pruning, exact confirmation.

1. One pass over the texts gives each document's set size, a 128-bit key of its shingle set, band
   keys, and a signature of 16 bits for each hash. Documents with equal sets count as one from here.
2. Band keys propose pairs (see ``components.linked``: no pair of a bucket is lost, nor are all listed).
   Buckets of many texts that are not alike, such as those around a common passage, are replaced by
   buckets of rare shingles, which miss nothing.
3. Signatures are compared in batches. After each, with m of n values equal, a pair is dropped if the
   probability that its similarity reaches the threshold is below ``MISS``, under a uniform prior.
4. The survivors' texts meet, and full sets decide. Components follow, with the smallest ``doc_id``.

Bands are tuned so that a pair exactly at the threshold is overlooked with probability ``MISS_BAND``
at most. Memory of a task is bounded by a batch of texts.

Cases: null and blank texts have no set, are linked with nothing and kept. Rows with equal sets are
in one component also if they repeat a ``doc_id``. A null ``doc_id`` is nobody's component id unless
the whole component has none; such a row is kept if so. Other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm import shingles
from pitchgrain.llm.components import linked
from pitchgrain.llm.packing import slices
from pitchgrain.llm.rare_shingles import confirmed, rarest
from pitchgrain.llm.shared import discard, fresh_name, materialise, text_or_empty, told_apart

PERCENT = 85
ROWS = 6
MISS_BAND = 1e-5
MISS = 1e-7
BATCH = 30


def thresholds(steps: list[int], percent: int, miss: float) -> list[int]:
    """For each number of compared values, the fewest equal ones with which a pair lives on.

    With a uniform prior, P(similarity >= t | m of n equal) is the probability that of n + 1 throws
    with chance t at most m succeed.
    """
    least = []
    for n in steps:
        t, m, chance, total = percent / 100, 0, (1 - percent / 100) ** (n + 1), 0.0
        while m <= n:
            total += chance
            if total >= miss:
                break
            chance *= (n + 1 - m) / (m + 1) * t / (1 - t)
            m += 1
        least.append(m)
    return least


def sign(docs: DataFrame, percent: int, rows: int, miss: float) -> DataFrame:
    """doc_id, n_shingles, set_key, bands and signature of each row; the last three null without shingles."""
    count = rows * shingles.bands_for(percent / 100, rows, miss)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                sets = list(shingles.shingle_sets(batch.column("text")[lo:hi]))
                real = [i for i, s in enumerate(sets) if len(s)]
                keys, bands, signatures = ([None] * len(sets) for _ in range(3))
                values = shingles.minhashes([sets[i] for i in real], count)
                band = shingles.band_keys(values, rows)
                short = (values & np.uint64(0xFFFF)).astype("<u2")
                for k, i in enumerate(real):
                    keys[i], bands[i], signatures[i] = shingles.set_key(sets[i]), band[k], short[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[lo:hi],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(signatures, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "bands", "signature"],
                )

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(signed, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>, signature binary")


def texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, part: the text of each of ``nodes`` (node, doc_id, set_key)."""
    texts = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("part"))
    met = texts.join(nodes.select("node", "doc_id", "set_key"), F.col("id").eqNullSafe(F.col("doc_id")))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Where ids repeat, texts of other rows come along; the set key tells them.
            keys = [shingles.set_key(s) for s in shingles.shingle_sets(batch.column("part"))]
            good = [i for i, (key, want) in enumerate(zip(keys, batch.column("set_key").to_pylist(), strict=True)) if key == want]
            yield batch.select(["node", "part"]).take(pa.array(good, pa.int64()))

    return met.select("node", "part", "set_key").mapInArrow(own, "node long, part string").dropDuplicates(["node"])


def likely(pairs: DataFrame, percent: int, count: int, miss: float) -> DataFrame:
    """Pairs that no batch of signature values rules out, of pairs with signature_a and signature_b."""
    steps = list(range(BATCH, count, BATCH)) + [count]
    least = thresholds(steps, percent, miss)
    kept = [f.name for f in pairs.schema if not f.name.startswith("signature")]
    schema = pairs.select(*kept).schema

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, count) for c in ("signature_a", "signature_b"))
            alive, equal, begin = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for end, fewest in zip(steps, least, strict=True):
                equal = equal + (a[alive, begin:end] == b[alive, begin:end]).sum(axis=1)
                ok = equal >= fewest
                alive, equal, begin = alive[ok], equal[ok], end
            yield batch.select(kept).take(pa.array(alive))

    return pairs.mapInArrow(compared, schema)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, rows: int = ROWS, miss_band: float = MISS_BAND, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``. Ids may be of any type that has an order."""
    count = rows * shingles.bands_for(percent / 100, rows, miss_band)
    signed = materialise(sign(docs, percent, rows, miss_band).withColumn("row", F.monotonically_increasing_id()), "signed")
    sets = signed.where("set_key is not null").groupBy("set_key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    sets = materialise(sets, "sets")
    first = sets.select(F.col("node").alias("row"))
    nodes = materialise(signed.join(first, "row").withColumnRenamed("row", "node"), "nodes")
    members = nodes.select(F.explode("bands").alias("key"), "node", F.col("n_shingles").alias("size"))
    met = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = materialise(members.join(materialise(met, "met"), "key"), "members")
    parts = materialise(texts_of(nodes.join(members.select("node").distinct(), "node"), docs), "parts")

    def verify(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("signature").alias(f"signature_{side}")), side)
        return confirmed(materialise(likely(pairs, percent, count, miss), "likely"), parts, percent)

    def refine(crowded: DataFrame) -> DataFrame:
        return rarest(parts.join(crowded, "node"), percent)

    labels = linked(members, verify, percent, refine)
    discard(members, parts, nodes)
    placed = materialise(sets.join(labels, "node", "left").select("set_key", "least", F.coalesce("label", "node").alias("label")), "placed-sets")
    smallest = materialise(placed.groupBy("label").agg(F.min("least").alias("component_id")), "smallest")
    named = materialise(placed.join(smallest, "label").select("set_key", "component_id"), "named-sets")
    out = signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` of each component: the smallest ``doc_id``, nulls last, then the least digest of the text.

    Ids may repeat or be null, as rows are told apart by a key of their own. Rows without shingles all stay.
    """
    row = fresh_name(docs, "row")
    keyed = told_apart(docs, row)
    found = near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), percent)
    groups = found.where("n_shingles > 0").select(F.col("doc_id").alias("of"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), F.col(row).alias("row"))
    ranks = keyed.select(F.col(row).alias("row"), order.alias("rank")).join(groups, F.col("row") == F.col("of"))
    first = ranks.groupBy("component_id").agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias("row"))
    kept_row = fresh_name(keyed, "kept_row")
    kept = first.union(found.where("n_shingles = 0").select("doc_id")).toDF(kept_row)
    return keyed.join(kept, keyed[row] == kept[kept_row], "left_semi").select(*(keyed[c] for c in docs.columns))


#: In DuckDB's SQL: shingles joined with each other, components by recursion.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, o) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.o = e.a),
m AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
