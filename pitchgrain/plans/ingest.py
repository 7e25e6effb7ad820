"""Loading landed files into the staging tables, and the derived tables after them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.operators.scope import Scope, resolve_matches
from pitchgrain.plans import normalise as N
from pitchgrain.plans.facts import player_match_stats, team_formation
from pitchgrain.plans.tables import season_part
from pitchgrain.sources.landing import Landing
from pitchgrain.sources.warehouse import Warehouse

STEPS = ("competitions", "seasons", "teams", "players", "matches", "events", "lineups")
DERIVED = ("formation", "fact")


def _count(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1)).alias("n")).first().n


def _stored(warehouse: Warehouse, table: str, scope: Scope, match_ids: list[int] | None) -> int:
    return _count(season_part(warehouse.read(table), scope, match_ids))


def invalidate_analytics(warehouse: Warehouse, scope: Scope, match_ids: list[int] | None) -> None:
    """Facts and formations of matches about to be replaced are removed first."""
    for table in ("fact_player_match_stats", "team_match_formation"):
        warehouse.replace_matches(table, None, scope, match_ids)


def _load_lineups(landing, warehouse, scope, raw_matches, match_ids) -> int:
    raw = landing.of_matches("lineups", scope, raw_matches, match_ids)
    strays = N.unplaced_lineups(raw, raw_matches)
    some = strays.limit(5).collect()
    if some:
        named = ", ".join(f"team {r.team_name!r} in match {r.match_id}" for r in some)
        raise ValueError(f"{_count(strays)} line-ups of teams that are not in their match, such as {named}")
    warehouse.replace_matches("match_lineups", N.lineups(raw, raw_matches), scope, match_ids)
    warehouse.replace_matches(
        "match_lineup_positions", N.positions(raw, raw_matches), scope, match_ids
    )
    return _stored(warehouse, "match_lineups", scope, match_ids)


def _load_matches(warehouse, scope, raw_matches, match_ids, alone: bool) -> int:
    """Replacing matches removes what hangs on them, unless events and line-ups are replaced after."""
    for child in ("match_lineup_positions", "match_lineups", "events") if alone else ():
        warehouse.replace_matches(child, None, scope, match_ids)
    warehouse.replace_matches("matches", N.matches(raw_matches), scope, match_ids)
    return _stored(warehouse, "matches", scope, match_ids)


def run(
    landing: Landing,
    warehouse: Warehouse,
    scope: Scope,
    table: str = "all",
    match_ids: Iterable[int] | None = None,
) -> dict[str, int]:
    """Load one staging table or all in reference order; rows per step. All of it is published, or nothing."""
    if table != "all" and table not in STEPS:
        raise ValueError(f"unknown table step: {table}")
    ids = None if match_ids is None else sorted(set(match_ids))
    raw_matches = landing.matches(scope, ids)

    def dimension(name: str, df: DataFrame) -> int:
        warehouse.upsert(name, df)
        return _count(df)

    loaders = {
        "competitions": lambda: dimension(
            "competitions", N.competitions(landing.competition_row(scope))
        ),
        "seasons": lambda: dimension("seasons", N.seasons(landing.competition_row(scope))),
        "teams": lambda: dimension("teams", N.teams(raw_matches)),
        "players": lambda: dimension(
            "players",
            N.players(landing.of_matches("lineups", scope, raw_matches, ids), raw_matches),
        ),
        "matches": lambda: _load_matches(warehouse, scope, raw_matches, ids, table != "all"),
        "events": lambda: _load_events(landing, warehouse, scope, raw_matches, ids),
        "lineups": lambda: _load_lineups(landing, warehouse, scope, raw_matches, ids),
    }
    with warehouse.publishing():
        if table in ("all", "matches"):
            invalidate_analytics(warehouse, scope, ids)
        return {step: loaders[step]() for step in STEPS if table in ("all", step)}


def _load_events(landing, warehouse, scope, raw_matches, match_ids) -> int:
    raw = landing.of_matches("events", scope, raw_matches, match_ids)
    warehouse.replace_matches("events", N.events(raw), scope, match_ids)
    return _stored(warehouse, "events", scope, match_ids)


def aggregate(
    warehouse: Warehouse,
    scope: Scope,
    table: str = "all",
    match_ids: Iterable[int] | None = None,
) -> dict[str, int]:
    """Rebuild the derived tables of the scope; rows per table."""
    if table != "all" and table not in DERIVED:
        raise ValueError(f"unknown table: {table}")
    ids = None if match_ids is None else sorted(set(match_ids))
    known = resolve_matches(warehouse.read("matches"), scope, ids).select("match_id")

    def part(name: str) -> DataFrame:
        return season_part(warehouse.read(name), scope, ids)

    done: dict[str, int] = {}
    with warehouse.publishing():
        if table in ("all", "formation"):
            made = team_formation(part("events")).join(known, "match_id", "left_semi")
            warehouse.replace_matches("team_match_formation", made, scope, ids)
            done["formation"] = _stored(warehouse, "team_match_formation", scope, ids)
        if table in ("all", "fact"):
            facts = player_match_stats(
                part("events"), part("match_lineups"), part("match_lineup_positions")
            ).join(known, "match_id", "left_semi")
            warehouse.replace_matches("fact_player_match_stats", facts, scope, ids)
            done["fact"] = _stored(warehouse, "fact_player_match_stats", scope, ids)
    return done
