"""Looking into matches: goals, event mix, shots, samples and starting line-ups.

``match_ids=None`` covers every match.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.functions.text import clock, fixed, jersey_label, short_name
from pitchgrain.operators.choose import share_of_total, where_in
from pitchgrain.plans.tables import MatchTables

# Fixed values
SAMPLED_TYPES = ["Goal", "Shot", "Substitution", "Foul Committed", "Pass"]
TOP_TYPES = 12
SHOOTOUT_PERIOD = 5
NAME_WIDTH = 12

TACTICS = (
    "tactics STRUCT<formation: STRING, lineup: ARRAY<STRUCT<player: STRUCT<id: INT, name: STRING, "
    "jersey_number: INT>, position: STRUCT<name: STRING>, jersey_number: INT>>>"
)


def _padded(text: Column, width: int) -> Column:
    """At least ``width`` characters; longer text is kept whole."""
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def goal_timeline(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Goals in order, regular and extra time apart from the shoot-out."""
    goals = where_in(t.events, "match_id", match_ids).filter(
        (F.col("type") == "Shot") & (F.col("outcome") == "Goal")
        & (F.col("period") <= SHOOTOUT_PERIOD)
    )
    named = (
        goals.join(t.teams.select("team_id", "team_name"), "team_id", "left")
        .join(t.players.select("player_id", "player_name", "player_nickname"), "player_id", "left")
        .withColumn("shot_type", F.get_json_object("payload", "$.shot_type"))
    )
    team = F.coalesce("team_name", F.lit(""))
    player = F.coalesce(short_name(F.col("player_nickname"), F.col("player_name")), F.lit("?"))
    kind = F.coalesce(F.concat(F.lit(" ["), F.nullif("shot_type", F.lit("")), F.lit("]")), F.lit(""))
    xg = fixed(F.col("shot_statsbomb_xg"), 2)
    xg_text = F.coalesce(F.concat(F.lit(" (xG "), xg, F.lit(")")), F.lit(""))
    when = clock(F.col("minute"), F.col("second"))
    line = F.concat(F.lit("  "), when, F.lit("  "), _padded(team, NAME_WIDTH), F.lit(" "), player, kind, xg_text)
    phase = F.when(F.col("period") == SHOOTOUT_PERIOD, "shootout").otherwise("regular")
    return named.orderBy("match_id", "index").select(
        "match_id", "index", phase.alias("phase"), "minute", "second",
        F.col("team_name").alias("team"), player.alias("player"), line.alias("line"),
    )


def event_type_share(
    t: MatchTables, match_ids: Iterable[int] | None = None, top: int = TOP_TYPES
) -> DataFrame:
    """The most frequent event types with their share of all events."""
    shares = share_of_total(where_in(t.events, "match_id", match_ids), "type", top)
    return shares.select("type", "n", "pct", F.concat(fixed(F.col("pct"), 1), F.lit("%")).alias("share"))


def shot_summary(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Shots, goals and expected goals per match and team."""
    shots = (
        where_in(t.events, "match_id", match_ids)
        .filter(F.col("type") == "Shot")
        .groupBy("match_id", "team_id")
        .agg(
            F.count(F.lit(1)).alias("shots"),
            F.count_if(F.col("outcome") == "Goal").alias("goals"),
            F.coalesce(F.sum("shot_statsbomb_xg"), F.lit(0).cast(S.XG)).alias("xg"),
        )
    )
    return (
        shots.join(t.teams.select("team_id", "team_name"), "team_id")
        .orderBy("match_id", "team_name")
        .select("match_id", "team_id", "team_name", "shots", "goals", "xg")
    )


def event_sample(t: MatchTables, match_ids: Iterable[int] | None = None, n: int = 8) -> DataFrame:
    """The first ``n`` events of the interesting types."""
    first = (
        where_in(t.events, "match_id", match_ids)
        .filter(F.col("type").isin(SAMPLED_TYPES))
        .orderBy("match_id", "index")
        .limit(n)
        .select(
            "match_id", "index", "period", "minute", "second", "team_id", "player_id", "type",
            "outcome",
        )
    )
    return (
        first.join(t.teams.select("team_id", F.col("team_name").alias("team")), "team_id", "left")
        .join(t.players.select("player_id", F.col("player_name").alias("player")), "player_id", "left")
        .orderBy("match_id", "index")
        .select(
            "match_id", "index", "period", "minute", "second", "team", "player", "type", "outcome"
        )
    )


def _announced(t: MatchTables, match_ids: Iterable[int] | None) -> DataFrame:
    """One row per line-up slot of a Starting XI event."""
    parsed = F.from_json("payload", TACTICS)
    slots = (
        where_in(t.events, "match_id", match_ids)
        .filter(F.col("type") == S.STARTING_XI)
        .select("match_id", "team_id", "index", parsed.alias("p"))
        .select(
            "match_id", "team_id", "index",
            F.coalesce("p.tactics.formation", F.lit("?")).alias("formation"),
            F.posexplode("p.tactics.lineup").alias("slot_no", "slot"),
        )
    )
    return slots.select(
        "match_id", "team_id", "index", "formation", "slot_no",
        F.col("slot.player.id").alias("player_id"),
        F.col("slot.player.name").alias("slot_name"),
        # the number is found on the slot or on the player
        F.coalesce("slot.jersey_number", "slot.player.jersey_number").alias("slot_jersey"),
        F.coalesce("slot.position.name", F.lit("?")).alias("position"),
    )


def _squad_names(t: MatchTables) -> DataFrame:
    return t.lineups.select("match_id", "team_id", "player_id", "jersey_number").join(
        t.players.select("player_id", "player_name", "player_nickname"), "player_id"
    )


def starting_xi(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Announced starters with formation, label and position.

    A player missing from the squad lists is labelled from the announcement itself.
    """
    known = _squad_names(where_lineups(t, match_ids)).drop("team_id")
    joined = _announced(t, match_ids).join(known, ["match_id", "player_id"], "left")
    own = jersey_label(F.col("jersey_number"), F.col("player_nickname"), F.col("player_name"))
    announced = F.concat(
        F.lit("#"), F.coalesce(F.col("slot_jersey").cast("string"), F.lit("?")), F.lit(" "),
        F.coalesce("slot_name", F.lit("?")),
    )
    label = F.when(F.col("player_name").isNotNull(), own).otherwise(announced)
    return (
        joined.join(t.teams.select("team_id", "team_name"), "team_id", "left")
        .orderBy("match_id", "index", "slot_no")
        .select(
            "match_id", "index", "slot_no", "team_id", "team_name", "formation", "player_id",
            label.alias("label"), "position",
        )
    )


def where_lineups(t: MatchTables, match_ids: Iterable[int] | None) -> MatchTables:
    return t.having(lineups=where_in(t.lineups, "match_id", match_ids))


def bench_players(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Squad members that were not announced as starters, by jersey number."""
    squads = _squad_names(where_lineups(t, match_ids))
    started = _announced(t, match_ids).select("match_id", "team_id", "player_id").distinct()
    label = jersey_label(F.col("jersey_number"), F.col("player_nickname"), F.col("player_name"))
    return (
        squads.join(started, ["match_id", "team_id", "player_id"], "left_anti")
        .orderBy("match_id", "team_id", F.asc_nulls_last("jersey_number"), "player_id")
        .select("match_id", "team_id", "player_id", "jersey_number", label.alias("label"))
    )
