"""The two derived tables: player-match facts and the formation timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.functions.numeric import exact_ratio
from pitchgrain.operators.intervals import interval_minutes, state_timeline

# Which payload attribute matters for which event type.
DETAIL_KEYS = {
    "Pass": "pass_goal_assist",
    "Duel": "duel_type",
    "Foul Committed": "foul_committed_card",
    "Bad Behaviour": "bad_behaviour_card",
}
CARD_EVENTS = ["Foul Committed", "Bad Behaviour"]

# What each count of the fact table counts. ``detail`` is the attribute above.
COUNTED = {
    "passes_attempted": "type = 'Pass'",
    "passes_completed": "type = 'Pass' AND outcome IS NULL",
    "shots": "type = 'Shot'",
    "shots_on_target": "type = 'Shot' AND outcome IN ('Saved', 'Goal')",
    # shoot-out goals count as goals: there is no period condition
    "goals": "type = 'Shot' AND outcome = 'Goal'",
    # the attribute being there is enough, also with the value false
    "assists": "type = 'Pass' AND detail IS NOT NULL",
    "tackles": "type = 'Duel' AND detail = 'Tackle'",
    "interceptions": "type = 'Interception'",
    "pressures": "type = 'Pressure'",
    "blocks": "type = 'Block'",
    "dribbles_attempted": "type = 'Dribble'",
    # outcome is only ever filled for passes and shots, so this equals the attempts
    "dribbles_completed": "type = 'Dribble' AND outcome IS NULL",
    "carries": "type = 'Carry'",
    "yellow_cards": "type IN ('Foul Committed', 'Bad Behaviour') AND detail = 'Yellow Card'",
    "red_cards": (
        "type IN ('Foul Committed', 'Bad Behaviour') AND detail IN ('Red Card', 'Second Yellow')"
    ),
}


def _detail(events: DataFrame) -> Column:
    """The one payload attribute its event type needs: as stored, or parsed once per row."""
    if "detail" in events.columns:
        return F.col("detail")
    cases = [
        f"WHEN type = '{kind}' THEN get_json_object(payload, '$.{key}')"
        for kind, key in DETAIL_KEYS.items()
    ]
    return F.expr(f"CASE {' '.join(cases)} END")


def _formation(events: DataFrame) -> Column:
    if "formation_code" in events.columns:
        return F.col("formation_code")
    reported = F.col("type").isin(S.STARTING_XI, S.TACTICAL_SHIFT)
    return F.when(reported, F.get_json_object("payload", "$.tactics.formation"))


def with_promoted(events: DataFrame) -> DataFrame:
    """Events with the attributes of ``schemas.EVENTS_PROMOTED`` taken out of the payload."""
    return events.withColumns(
        {"detail": _detail(events), "formation_code": _formation(events)}
    )


def _metrics() -> list[Column]:
    counts = [F.expr(f"count_if({condition})").alias(name) for name, condition in COUNTED.items()]
    xg = F.expr("coalesce(sum(if(type = 'Shot', shot_statsbomb_xg, NULL)), 0)")
    return [F.max("team_id").alias("event_team_id"), *counts, xg.cast(S.XG).alias("xg")]


def player_event_totals(events: DataFrame) -> DataFrame:
    """All event metrics per (match, player), and ``max_minute``, the match's last minute, in one scan.

    Every buffer is a fixed-width number, so the partial aggregate hashes in place and what is
    shuffled is one row per key and task, however large a single match is. Events without a player
    make a row of their own in each match: they count for its last minute, which the window takes
    from the totals, a row for each player, and then they go.
    """
    read = events.select(
        "match_id", "player_id", "team_id", "type", "outcome", "shot_statsbomb_xg", "minute",
        _detail(events).alias("detail"),
    )
    totals = read.groupBy("match_id", "player_id").agg(*_metrics(), F.max("minute").alias("last"))
    length = F.max("last").over(Window.partitionBy("match_id"))
    return totals.withColumn("max_minute", length).drop("last").filter(F.col("player_id").isNotNull())


def player_stints(positions: DataFrame) -> DataFrame:
    """The different position intervals of each (match, team, player) as a list, with how often each occurs."""
    stint = ["from_period", "from_minute", "to_minute", "position_name"]
    once = positions.groupBy("match_id", "team_id", "player_id", *stint).agg(
        F.count(F.lit(1)).alias("times"), F.min("ordinal").alias("ordinal")
    )
    return once.groupBy("match_id", "team_id", "player_id").agg(
        F.collect_list(F.struct(*stint, "times", "ordinal")).alias("stints")
    )


def squad_info(lineups: DataFrame, positions: DataFrame) -> DataFrame:
    """One row per (match, player) of the line-ups: team, starter flag and position intervals."""
    listed = lineups.select("match_id", "team_id", "player_id", "is_starter")
    return listed.join(player_stints(positions), ["match_id", "team_id", "player_id"], "left").select(
        "match_id", "player_id", F.col("team_id").alias("lineup_team_id"), "is_starter", "stints"
    )


def _held(x: Column) -> Column:
    return interval_minutes(x["from_minute"], x["to_minute"], F.col("max_minute"))


def _minutes() -> Column:
    return F.aggregate("stints", F.lit(0).cast("bigint"), lambda total, x: total + x["times"] * _held(x))


def _longest_position() -> Column:
    """Of the interval held longest, then the earliest; an unknown start counts as latest."""
    ranked = F.transform(
        "stints",
        lambda x: F.struct(
            (-_held(x)).alias("held"),
            x["from_period"].isNull().alias("no_period"),
            x["from_period"].alias("from_period"),
            x["from_minute"].isNull().alias("no_minute"),
            x["from_minute"].alias("from_minute"),
            x["ordinal"].alias("ordinal"),
            x["position_name"].alias("position_name"),
        ),
    )
    return F.array_min(ranked)["position_name"]


def player_match_stats(
    events: DataFrame, lineups: DataFrame, positions: DataFrame
) -> DataFrame:
    """The fact table: one row per (match, player) that has events and a known team."""
    totals = player_event_totals(events)
    joined = totals.join(squad_info(lineups, positions), ["match_id", "player_id"], "left")
    team = F.coalesce("lineup_team_id", "event_team_id")
    attempted, completed = F.col("passes_attempted"), F.col("passes_completed")
    values = {
        "team_id": team,
        "minutes_played": F.coalesce(_minutes(), F.lit(0)).cast(S.MINUTES),
        "position_played": _longest_position(),
        "is_starter": F.coalesce("is_starter", F.lit(False)),
        "pass_completion_rate": F.round(exact_ratio(completed, attempted), 4).cast(S.RATE),
        "progressive_passes": F.lit(None).cast("bigint"),
        "xa": F.lit(0).cast(S.XG),
        "aggregated_at": F.current_timestamp(),
    }
    names = S.columns(S.FACTS)
    return joined.filter(team.isNotNull()).select(
        *[values[n].alias(n) if n in values else F.col(n) for n in names]
    )


def formation_reports(events: DataFrame) -> DataFrame:
    """Events that state a formation, with a missing minute read as kick-off."""
    return (
        events.filter(F.col("type").isin(S.STARTING_XI, S.TACTICAL_SHIFT))
        .filter(F.col("team_id").isNotNull())
        .select(
            "match_id",
            "team_id",
            "index",
            F.coalesce(F.col("minute"), F.lit(0)).cast("smallint").alias("minute"),
            _formation(events).alias("formation_code"),
            F.col("type").alias("source_event_type"),
        )
        .filter(F.col("formation_code").isNotNull())
    )


def team_formation(events: DataFrame) -> DataFrame:
    """Formation timeline per (match, team)."""
    timeline = state_timeline(
        formation_reports(events),
        keys=["match_id", "team_id"],
        order="index",
        minute="minute",
        state="formation_code",
        extra=["source_event_type"],
    )
    return timeline.select(*S.columns(S.TIMELINE))
