"""Upsert by key and scoped replacement as plain DataFrame merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_latest(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: str | None = None,
) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing`` with the same key; others stay.

    If ``incoming`` repeats a key, the row with the greatest ``order`` wins.
    """
    if order is not None:
        ranked = incoming.withColumn("_rank", F.struct(F.lit(1), F.col(order).cast("bigint")))
    else:
        ranked = incoming.withColumn("_rank", F.struct(F.lit(1), F.lit(0).cast("bigint")))
    ranked = ranked.select(*existing.columns, "_rank")
    old = existing.withColumn("_rank", F.struct(F.lit(0), F.lit(0).cast("bigint")))
    both = old.unionByName(ranked)
    rest = [c for c in existing.columns if c not in keys]
    if not rest:
        return both.select(*keys).distinct()
    row = F.struct(*rest)
    best = both.groupBy(*keys).agg(F.max_by(row, "_rank").alias("_row"))
    return best.select(*[F.col(k) if k in keys else F.col(f"_row.{k}") for k in existing.columns])


def replace_scope(
    existing: DataFrame, replacement: DataFrame, scope: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Delete every row whose key is in ``scope``, then add ``replacement``.

    A scoped key without replacement rows disappears, which a dynamic partition overwrite would
    leave behind. ``scope`` is one row per key.
    """
    kept = existing.join(scope.select(*keys), list(keys), "left_anti")
    return kept.unionByName(replacement.select(*existing.columns))
