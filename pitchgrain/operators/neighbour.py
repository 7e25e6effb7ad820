"""Previous / next value within a group, without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN_BITS = 16


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: dict[str, str],
    ahead: bool = False,
    span_bits: int = SPAN_BITS,
    levels: int = 1,
) -> DataFrame:
    """Add ``values`` (new column -> source column) from the row before or after by ``order``.

    A plain lag over ``keys`` sends each group to one task however large it is. Here the integer
    ``order`` is cut into stretches of 2**span_bits values. Only the outermost row of a stretch has its
    neighbour in another one, so each stretch is first reduced to that row, before anything moves;
    these edges, one a stretch, are put in order by themselves and handed on to the next stretch. All
    rows then move once, to a window per (keys, stretch), where the edge handed on stands in for
    the missing neighbour.

    With ``order`` unique in a group a stretch holds at most 2**span_bits rows. A group whose order
    is so sparse that its edges are many takes ``levels`` above 1: edges are then handed on like
    rows, by stretches of stretches. Missing order values come first.
    """
    packed = F.struct(*[F.col(src).alias(dst) for dst, src in values.items()])
    pick = F.lead if ahead else F.lag
    outermost = F.min_by if ahead else F.max_by

    stretch, far = f"_stretch{levels}", f"_far{levels}"
    lanes = df.withColumn(stretch, F.shiftright(F.col(order).cast("bigint"), span_bits))
    edges = lanes.groupBy(*keys, stretch).agg(outermost(packed, F.struct(order)).alias("_edge"))
    if levels > 1:
        edges = with_neighbour(edges, keys, stretch, {far: "_edge"}, ahead, span_bits, levels - 1)
    else:
        edges = edges.withColumn(far, pick("_edge").over(Window.partitionBy(*keys).orderBy(stretch)))
    handed = edges.select(*[F.col(k).alias(f"_of_{k}") for k in (*keys, stretch)], far)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in (*keys, stretch)]
    met = lanes.join(handed, same, "left")
    near = pick(packed).over(Window.partitionBy(*keys, stretch).orderBy(order))
    found = met.select(*df.columns, F.coalesce(near, far).alias("_found"))
    return found.select(*df.columns, *[F.col("_found").getField(dst).alias(dst) for dst in values])
