"""Half-open minute intervals: lengths, lookups and the state timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchgrain.operators.neighbour import with_neighbour


def interval_minutes(start: Column, end: Column, horizon: Column) -> Column:
    """Length of [start, end); an open end runs to ``horizon``, an unknown start counts 0."""
    until = F.coalesce(end, horizon)
    length = F.greatest(until.cast("int") - start.cast("int"), F.lit(0))
    return F.when(start.isNull(), F.lit(0)).otherwise(length)


def state_timeline(
    changes: DataFrame,
    keys: Sequence[str],
    order: str,
    minute: str,
    state: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Reports of a state, in ``order``, turned into intervals of unchanged state.

    1. drop a report equal to the one before it (the first one stays);
    2. of several changes in a minute keep the latest;
    3. an interval ends where the next one starts, the last stays open.

    The comparison comes before the per-minute choice, so two neighbouring intervals can carry the
    same state. After step 2 a group has at most one row per minute value, which bounds the
    window of step 3 whatever the input size.
    """
    compared = with_neighbour(changes, keys, order, {"_before": state})
    changed = compared.filter(~F.col("_before").eqNullSafe(F.col(state)))
    carried = F.struct(order, state, *extra)
    per_minute = changed.groupBy(*keys, minute).agg(F.max_by(carried, order).alias("_c"))
    flat = per_minute.select(*keys, minute, "_c.*")
    following = F.lead(minute).over(Window.partitionBy(*keys).orderBy(order))
    return flat.select(
        *keys,
        F.col(minute).alias("from_minute"),
        following.alias("to_minute"),
        state,
        *extra,
    )


def interval_lookup(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    minute: str,
    state: str,
) -> DataFrame:
    """Which state held at a minute: left lookup of ``points`` in ``intervals``.

    Each interval is written out as its minutes, an open one up to the last minute its key is
    asked about. The lookup is then a join by equality on keys and minute: no point is compared
    with an interval it does not lie in, and the minutes of a hot key spread over partitions.
    """
    last_asked = points.groupBy(*keys).agg(F.max(minute).cast("int").alias("_asked"))
    ends = F.least(F.coalesce(F.col("to_minute").cast("int") - 1, F.col("_asked")), F.col("_asked"))
    minutes = F.explode(F.sequence(F.col("from_minute").cast("int"), F.col("_end")))
    states = (
        intervals.select(*keys, "from_minute", "to_minute", state)
        .join(last_asked, list(keys))
        .withColumn("_end", ends)
        # an interval that is empty, or that starts after everything asked
        .filter(F.col("from_minute") <= F.col("_end"))
        .select(*keys, minutes.alias(minute), state)
    )
    return points.join(states, [*keys, minute], "left")
