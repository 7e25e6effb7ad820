"""Keep one row per key, membership tests, and counts by group."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_INLINE_VALUES = 1000


def nulls_last(col: Column) -> list[Column]:
    """Ascending sort key with NULLs after all values, for use inside a struct."""
    return [col.isNull(), col]


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The row with the smallest (or ``last``) ``order`` per key.

    An aggregate, not a window: each task first reduces its own rows to one per key, so a key
    that holds most of the input never travels to a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*keys).agg((F.max_by if last else F.min_by)(row, F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest]).select(*df.columns)


def where_in(df: DataFrame, column: str, values: Iterable | None) -> DataFrame:
    """Filter on a caller's list: a pushed-down IN when short, a semi join when long."""
    if values is None:
        return df
    values = sorted(set(values))
    if len(values) <= MAX_INLINE_VALUES:
        return df.filter(F.col(column).isin(values))
    kind = df.schema[column].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} {kind}")
    return df.join(listed, column, "left_semi")


def share_of_total(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """How often each value occurs and its percentage of all rows, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.select(
        column, "n", (F.col("n").cast("double") / total.cast("double") * 100).alias("pct")
    ).orderBy(F.desc("n"), F.asc_nulls_last(column))
    return shares.limit(top) if top else shares
