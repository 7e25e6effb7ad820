"""Which matches a run or a query covers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.operators.choose import where_in


@dataclass(frozen=True)
class Scope:
    """One season of one competition. A season id alone is not unique."""

    competition_id: int = 43
    season_id: int = 106

    def filter(self, df: DataFrame) -> DataFrame:
        return df.filter(
            (F.col("competition_id") == self.competition_id) & (F.col("season_id") == self.season_id)
        )


def missing_ids(matches: DataFrame, match_ids: Iterable[int]) -> list[int]:
    """Requested ids that ``matches`` lacks. Never longer than the caller's own list."""
    wanted = sorted(set(match_ids))
    if not wanted:
        return []
    found = where_in(matches.select("match_id"), "match_id", wanted).distinct()
    asked = matches.sparkSession.createDataFrame([(i,) for i in wanted], "match_id bigint")
    gaps = asked.join(found, "match_id", "left_anti")
    return sorted(row.match_id for row in gaps.collect())


def resolve_matches(
    matches: DataFrame, scope: Scope, match_ids: Iterable[int] | None = None
) -> DataFrame:
    """Matches of the scope, or the requested ones among them; an unknown id is an error."""
    season = scope.filter(matches)
    if match_ids is None:
        return season
    wanted = list(match_ids)
    gaps = missing_ids(season, wanted)
    if gaps:
        raise ValueError(f"match_ids not found for competition/season: {gaps}")
    return where_in(season, "match_id", wanted)


def in_scope(df: DataFrame, matches: DataFrame, scope: Scope) -> DataFrame:
    """Rows of a match-keyed table that belong to the scope.

    Tables written by this package carry the season as partition columns: pruning folders is all
    it takes. Otherwise a semi join with the season's matches decides.
    """
    if {"competition_id", "season_id"} <= set(df.columns):
        return scope.filter(df)
    return df.join(scope.filter(matches).select("match_id"), "match_id", "left_semi")
