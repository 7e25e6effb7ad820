"""Joining a large relation to one row per key when single keys may dominate it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def spread_join(
    large: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``large`` to ``lookup`` (unique on ``on``), cutting each key into ``salts`` parts.

    Rows of a hot key spread over ``salts`` partitions by a hash of ``spread_by``; the lookup row
    is repeated once per salt. No side is marked for broadcast: AQE still makes it one when the
    measured size of the lookup allows.
    """
    salted = large.withColumn("_salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
