"""Buckets of rare shingles, in which every pair above a similarity meets, and the test of such pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.llm import shingles
from pitchgrain.llm.packing import slices
from pitchgrain.llm.shared import discard, materialise


def rarest(parts: DataFrame, percent: int) -> DataFrame:
    """key, node, size, at: the rarest shingles of each node's text as buckets, of ``parts`` (node, part).

    Of two sets of n and m shingles whose similarity reaches t, the first n - ceil(t n) + 1 and
    m - ceil(t m) + 1 in any common order share one, so no linked pair is missed. The order is by the
    number of nodes with the shingle, the rarest first, and ``at`` is the shingle's place in it, from 0.
    Shingles of a single node come before all others and are only counted.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("part")):
                sets = list(shingles.shingle_sets(batch.column("part")[lo:hi]))
                sizes = np.array([len(s) for s in sets], np.int64)
                row = np.repeat(np.arange(len(sets)), sizes)
                keys = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                node = batch.column("node")[lo:hi].take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), node, pa.array(sizes[row])], names=["key", "node", "size"])

    each = materialise(parts.select("node", "part").mapInArrow(listed, "key long, node long, size long"), "shingles")
    often = materialise(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "frequencies")
    met = each.join(often, "key").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("met"))
    prefix = F.slice("met", F.lit(1), F.greatest(F.size("met") - F.ceil(F.col("size") * percent / 100).cast("int") + 1, F.lit(0)))
    first = met.select("node", "size", (F.col("size") - F.size("met")).alias("own"), F.posexplode(prefix).alias("place", "x"))
    out = materialise(first.select("x.key", "node", "size", (F.col("own") + F.col("place")).alias("at")), "rarest")
    discard(each, often)
    return out


def confirmed(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose full sets reach the threshold; ``parts`` (node, part) has their texts."""
    both = pairs.join(parts.toDF("b", "part_b"), "b").join(parts.toDF("a", "part_a"), "a")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for lo, hi in slices(batch.column("part_a")):
                sets = zip(*(shingles.shingle_sets(batch.column(c)[lo:hi]) for c in ("part_a", "part_b")), strict=True)
                for i, (a, b) in enumerate(sets, lo):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= percent * (len(a) + len(b) - common):
                        good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return both.select("a", "b", "part_a", "part_b").mapInArrow(exact, "a long, b long")
