"""The set of tables the plans below read."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from pitchgrain.operators.choose import where_in
from pitchgrain.operators.scope import Scope
from pitchgrain.session import materialise

STAGED = (
    "competitions", "seasons", "teams", "players", "matches", "events", "lineups", "positions",
)


class MatchTables:
    """Staging tables and the two derived ones, each given as a DataFrame or as a way to make it.

    A table is only built when a plan asks for it. ``facts`` and ``timeline`` default to their
    plans over the staging tables. ``persistent`` says that all of them are read from storage.
    """

    def __init__(self, persistent: bool = False, **given: DataFrame | Callable[[], DataFrame]):
        unknown = set(given) - {*STAGED, "facts", "timeline"}
        if unknown:
            raise TypeError(f"unknown tables: {sorted(unknown)}")
        self._given = given
        self.persistent = persistent
        self._derived: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        value = self._given[name]
        if not isinstance(value, DataFrame):
            value = self._given[name] = value()
        return value

    @property
    def competitions(self) -> DataFrame:
        return self._table("competitions")

    @property
    def seasons(self) -> DataFrame:
        return self._table("seasons")

    @property
    def teams(self) -> DataFrame:
        return self._table("teams")

    @property
    def players(self) -> DataFrame:
        return self._table("players")

    @property
    def matches(self) -> DataFrame:
        return self._table("matches")

    @property
    def events(self) -> DataFrame:
        return self._table("events")

    @property
    def lineups(self) -> DataFrame:
        return self._table("lineups")

    @property
    def positions(self) -> DataFrame:
        return self._table("positions")

    @property
    def facts(self) -> DataFrame:
        if "facts" in self._given:
            return self._table("facts")
        from pitchgrain.plans.facts import player_match_stats

        if "facts" not in self._derived:
            self._derived["facts"] = player_match_stats(self.events, self.lineups, self.positions)
        return self._derived["facts"]

    @property
    def timeline(self) -> DataFrame:
        if "timeline" in self._given:
            return self._table("timeline")
        from pitchgrain.plans.facts import team_formation

        if "timeline" not in self._derived:
            self._derived["timeline"] = team_formation(self.events)
        return self._derived["timeline"]

    def having(self, **tables: DataFrame | Callable[[], DataFrame]) -> MatchTables:
        """The same set with some tables exchanged."""
        return MatchTables(self.persistent, **{**self._given, **tables})

    def stored(self, *names: str) -> MatchTables:
        """For plans that read tables several times: write the named ones once to the shared
        folder and read them from there. Tables that come from storage are used as they are."""
        if self.persistent:
            return self
        return self.having(**{n: materialise(getattr(self, n), n) for n in names})

    def named(self) -> dict[str, DataFrame]:
        return {
            "competitions": self.competitions,
            "seasons": self.seasons,
            "teams": self.teams,
            "players": self.players,
            "matches": self.matches,
            "events": self.events,
            "match_lineups": self.lineups,
            "match_lineup_positions": self.positions,
            "fact_player_match_stats": self.facts,
            "team_match_formation": self.timeline,
        }


def season_part(
    df: DataFrame, scope: Scope | None, match_ids: Iterable[int] | None = None
) -> DataFrame:
    """Cheap narrowing before an aggregation: directory pruning and a pushed-down id list.

    It never joins; rows outside the scope that remain are removed by ``in_scope`` after the
    aggregation has made the relation small.
    """
    if scope is not None and {"competition_id", "season_id"} <= set(df.columns):
        df = scope.filter(df)
    return where_in(df, "match_id", match_ids)
