"""The analysis questions over matches, events and player-match facts.

Shape shared by all of them: reduce the facts to the grain the question needs first (partial
aggregation runs before the shuffle), then join the much smaller result to matches and names.
Dimensions are never marked for broadcast; Catalyst and AQE decide on their measured size.

``team_id=None`` answers a question for every team, a value only for that team.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.functions.numeric import exact_avg, exact_ratio, is_true, sum_where
from pitchgrain.operators.choose import where_in
from pitchgrain.operators.scope import Scope, in_scope
from pitchgrain.operators.sides import unpivot_sides
from pitchgrain.plans.tables import MatchTables, season_part

SUMMED = [
    "goals", "shots", "assists", "xg", "passes_attempted", "passes_completed",
    "tackles", "interceptions", "pressures", "blocks",
]


def defensive_actions() -> Column:
    """Per row, so that a NULL in one term drops that row and not the whole sum."""
    return F.col("tackles") + F.col("interceptions") + F.col("pressures") + F.col("blocks")


def stage_rank(stage: Column) -> Column:
    """Position of a stage in the tournament; NULL for a stage not in the list."""
    known = F.create_map(*[F.lit(x) for pair in S.STAGE_RANKS.items() for x in pair])
    return F.try_element_at(known, stage)


def team_match_totals(facts: DataFrame) -> DataFrame:
    """Facts summed per (match, team)."""
    return facts.groupBy("match_id", "team_id").agg(
        *[F.sum(c).alias(c) for c in SUMMED], F.sum(defensive_actions()).alias("def_actions")
    )


def score_text(home: Column, away: Column) -> Column:
    return F.concat(home.cast("string"), F.lit("-"), away.cast("string"))


# ---------------------------------------------------------------- season questions


def validation_counts(t: MatchTables, scope: Scope) -> DataFrame:
    """Row counts: matches of the season, and the other tables as a whole."""

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")

    return (
        counted("matches", scope.filter(t.matches))
        .unionByName(counted("events", t.events))
        .unionByName(counted("fact", t.facts))
        .unionByName(counted("formation", t.timeline))
    )


def goals_by_stage(t: MatchTables, scope: Scope) -> DataFrame:
    goals = F.col("home_score") + F.col("away_score")
    return (
        scope.filter(t.matches)
        .withColumn("stage_rank", stage_rank(F.col("competition_stage")))
        .filter(F.col("stage_rank").isNotNull())
        .groupBy("competition_stage", "stage_rank")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.round(exact_avg(goals), 2).alias("avg_total_goals"),
            F.sum(goals).alias("total_goals"),
        )
        .orderBy("stage_rank")
        .select("competition_stage", "matches", "avg_total_goals", "total_goals")
    )


def _player_season(t: MatchTables, scope: Scope, aggregates: list[Column]) -> DataFrame:
    """Season facts per player and team name, with names attached after the first reduction.

    Aggregates must be sums; two teams sharing a name fall into one group.
    """
    facts = in_scope(season_part(t.facts, scope), t.matches, scope)
    per_team = facts.groupBy("player_id", "team_id").agg(*aggregates)
    named = per_team.join(t.players.select("player_id", "player_name"), "player_id").join(
        t.teams.select("team_id", "team_name"), "team_id"
    )
    names = [c for c in per_team.columns if c not in ("player_id", "team_id")]
    return named.groupBy("player_id", "player_name", "team_name").agg(
        *[F.sum(c).alias(c) for c in names]
    )


def top_xg(t: MatchTables, scope: Scope, limit: int = 10) -> DataFrame:
    """Players with the most expected goals.

    A player has one fact row per match, so counting rows counts distinct matches without the
    second shuffle of a distinct count.
    """
    sums = _player_season(
        t,
        scope,
        [
            F.sum("xg").alias("xg"),
            F.sum("shots").alias("shots"),
            F.sum("goals").alias("goals"),
            F.sum("minutes_played").alias("minutes"),
            F.count(F.lit(1)).alias("matches"),
        ],
    )
    minutes = F.col("minutes").cast("decimal(28,2)") / F.nullif(
        F.col("matches").cast("decimal(9,0)"), F.lit(0)
    )
    return (
        sums.filter(F.col("xg") > 0)
        .select(
            "player_id",
            "player_name",
            "team_name",
            F.col("xg").cast("decimal(28,3)").alias("total_xg"),
            "shots",
            "goals",
            F.round(minutes, 1).alias("avg_mins_per_match"),
        )
        .orderBy(F.desc("total_xg"), "player_id", "team_name")
        .limit(limit)
        .drop("player_id")
    )


def finishing_efficiency(
    t: MatchTables, scope: Scope, min_shots: int = 3, limit: int = 8
) -> DataFrame:
    """Goals minus expected goals of players with enough shots."""
    sums = _player_season(
        t,
        scope,
        [F.sum("goals").alias("goals"), F.sum("xg").alias("xg"), F.sum("shots").alias("shots")],
    )
    return (
        sums.filter(F.col("shots") >= min_shots)
        .select(
            "player_id",
            "player_name",
            "team_name",
            "goals",
            F.round("xg", 3).alias("total_xg"),
            F.round(F.col("goals") - F.col("xg"), 3).alias("goals_minus_xg"),
            "shots",
        )
        .orderBy(F.desc("goals_minus_xg"), "player_id", "team_name")
        .limit(limit)
        .drop("player_id")
    )


def pass_accuracy_vs_result(t: MatchTables, scope: Scope) -> DataFrame:
    """Average team pass rate by result; a match without a score counts as a loss."""
    totals = team_match_totals(season_part(t.facts, scope)).select(
        "match_id", "team_id", "passes_attempted", "passes_completed"
    )
    sides = unpivot_sides(scope.filter(t.matches)).select(
        "match_id",
        "team_id",
        F.when(F.col("team_score") > F.col("opponent_score"), "win")
        .when(F.col("team_score") == F.col("opponent_score"), "draw")
        .otherwise("loss")
        .alias("result"),
    )
    played = (
        totals.join(sides, ["match_id", "team_id"])
        .join(t.teams.select("team_id"), "team_id", "left_semi")
        .filter(F.col("passes_attempted") > 0)
    )
    rate = exact_ratio(F.col("passes_completed"), F.col("passes_attempted"))
    rank = F.when(F.col("result") == "win", 1).when(F.col("result") == "draw", 2).otherwise(3)
    return (
        played.groupBy("result")
        .agg(
            F.count(F.lit(1)).alias("team_matches"),
            F.round(F.avg(rate), 4).alias("avg_pass_completion_rate"),
            F.round(exact_avg(F.col("passes_attempted")), 1).alias("avg_passes_attempted"),
        )
        .orderBy(rank)
    )


def defence_by_stage(t: MatchTables, scope: Scope) -> DataFrame:
    """Defensive actions per match, averaged over each stage."""
    per_match = season_part(t.facts, scope).groupBy("match_id").agg(
        F.sum(defensive_actions()).alias("def_actions")
    )
    staged = scope.filter(t.matches).select(
        "match_id", "competition_stage", stage_rank(F.col("competition_stage")).alias("stage_rank")
    )
    return (
        per_match.join(staged.filter(F.col("stage_rank").isNotNull()), "match_id")
        .groupBy("competition_stage", "stage_rank")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.round(exact_avg(F.col("def_actions")), 0).alias("avg_def_actions_per_match"),
        )
        .orderBy("stage_rank")
        .select("competition_stage", "matches", "avg_def_actions_per_match")
    )


# ---------------------------------------------------------------- passing under pressure


def pass_under_pressure(t: MatchTables) -> DataFrame:
    """Pass completion with and without an opponent's pressure, over all seasons.

    This is the flag on the pass, not the event type of the same name.
    """
    state = F.when(is_true(F.col("under_pressure")), "under_pressure").otherwise("no_pressure")
    done = F.count_if(F.col("outcome").isNull())
    return (
        t.events.filter(F.col("type") == "Pass")
        .groupBy(state.alias("pressure_state"))
        .agg(
            F.count(F.lit(1)).alias("pass_attempts"),
            done.alias("passes_completed"),
            F.round(exact_ratio(done, F.count(F.lit(1))), 4).alias("completion_rate"),
        )
        .orderBy("pressure_state")
    )


def pass_pressure_drop(t: MatchTables) -> DataFrame:
    """Percentage points lost under pressure, rounded after the subtraction."""
    pressed = is_true(F.col("under_pressure"))
    done = F.col("outcome").isNull()
    free_rate = exact_ratio(F.count_if(done & ~pressed), F.count_if(~pressed))
    hard_rate = exact_ratio(F.count_if(done & pressed), F.count_if(pressed))
    return (
        t.events.filter(F.col("type") == "Pass")
        .agg(free_rate.alias("free"), hard_rate.alias("hard"))
        .select(
            F.round("free", 4).alias("rate_no_pressure"),
            F.round("hard", 4).alias("rate_under_pressure"),
            F.round((F.col("free") - F.col("hard")) * 100, 2).alias("drop_pp"),
        )
    )


# ---------------------------------------------------------------- one team against its opponents


def _fixtures(t: MatchTables, scope: Scope, team_id: int | None) -> DataFrame:
    """Season matches seen from the team(s), with the opponent's name."""
    opponents = t.teams.select(
        F.col("team_id").alias("opponent_id"), F.col("team_name").alias("opponent_name")
    )
    return unpivot_sides(scope.filter(t.matches), team_id).join(opponents, "opponent_id")


def opponent_defense(t: MatchTables, scope: Scope, team_id: int | None = None) -> DataFrame:
    """Defensive actions of the opponent in each match of a team."""
    totals = team_match_totals(season_part(t.facts, scope)).select(
        "match_id",
        F.col("team_id").alias("opponent_id"),
        F.col("tackles").alias("opp_tackles"),
        F.col("interceptions").alias("opp_interceptions"),
        F.col("pressures").alias("opp_pressures"),
        F.col("blocks").alias("opp_blocks"),
        F.col("def_actions").alias("opp_def_actions"),
    )
    return (
        _fixtures(t, scope, team_id)
        .join(totals, ["match_id", "opponent_id"])
        .orderBy("match_date", "match_id", "team_id")
        .select(
            "match_id", "team_id", "match_date", "competition_stage", "opponent_name",
            score_text(F.col("home_score"), F.col("away_score")).alias("score"),
            "side", "opp_tackles", "opp_interceptions", "opp_pressures", "opp_blocks",
            "opp_def_actions",
        )
    )


def _own_and_other(t: MatchTables, scope: Scope, team_id: int | None) -> DataFrame:
    """Fixtures with xg and defensive actions of the team itself and of everyone else in the match.

    NULL, not 0, where a side has no facts; fixtures without any facts are left out.
    """
    totals = team_match_totals(season_part(t.facts, scope)).select(
        "match_id", F.col("team_id").alias("fact_team_id"), "xg", "def_actions"
    )
    fixtures = _fixtures(t, scope, team_id)
    own = F.col("fact_team_id") == F.col("team_id")
    other = F.col("fact_team_id") != F.col("team_id")
    measured = (
        fixtures.select("match_id", "team_id")
        .join(totals, "match_id")
        .groupBy("match_id", "team_id")
        .agg(
            sum_where(own, F.col("xg")).alias("team_xg"),
            sum_where(other, F.col("xg")).alias("opp_xg"),
            sum_where(own, F.col("def_actions")).alias("team_def_actions"),
            sum_where(other, F.col("def_actions")).alias("opp_def_actions"),
        )
    )
    return fixtures.join(measured, ["match_id", "team_id"])


def xg_balance(t: MatchTables, scope: Scope, team_id: int | None = None) -> DataFrame:
    """Expected goals for and against; the difference is rounded after subtracting."""
    return (
        _own_and_other(t, scope, team_id)
        .orderBy("match_date", "match_id", "team_id")
        .select(
            "match_id", "team_id", "match_date", "competition_stage",
            F.col("opponent_name").alias("opponent"),
            score_text(F.col("home_score"), F.col("away_score")).alias("score"),
            F.round("team_xg", 2).alias("team_xg"),
            F.round("opp_xg", 2).alias("opp_xg"),
            F.round(F.col("team_xg") - F.col("opp_xg"), 2).alias("xg_diff"),
        )
    )


def focus_matches(t: MatchTables, scope: Scope, team_id: int | None = None) -> DataFrame:
    """Matches of a team with scores, expected goals and defensive actions of both sides."""
    return (
        _own_and_other(t, scope, team_id)
        .orderBy("match_date", "match_id", "team_id")
        .select(
            "match_id", "team_id", "match_date", "competition_stage", "opponent_id",
            "opponent_name", "team_score", F.col("opponent_score").alias("opp_score"),
            F.round("team_xg", 2).alias("team_xg"),
            F.round("opp_xg", 2).alias("opp_xg"),
            "team_def_actions", "opp_def_actions",
        )
    )


# ---------------------------------------------------------------- team and player profiles


def team_aggregates(
    t: MatchTables, scope: Scope, team_ids: Iterable[int] | None = None
) -> DataFrame:
    """Season totals per team. The first level is per match, so matches are counted, not collected."""
    facts = where_in(season_part(t.facts, scope), "team_id", team_ids)
    season = in_scope(team_match_totals(facts), t.matches, scope)
    totals = season.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("matches"),
        F.sum("goals").alias("goals"),
        F.round(F.sum("xg"), 2).alias("xg"),
        *[
            F.sum(c).alias(c)
            for c in (
                "passes_attempted", "passes_completed", "tackles", "interceptions", "pressures",
                "blocks",
            )
        ],
    )
    named = totals.join(t.teams.select("team_id", "team_name"), "team_id")
    return named.select(
        "team_id", "team_name", *[c for c in totals.columns if c != "team_id"]
    ).orderBy("team_id")


def team_formations(
    t: MatchTables, scope: Scope, team_ids: Iterable[int] | None = None
) -> DataFrame:
    """Formations of each team in the order they were first used (by match id, then minute).

    Reduced to one row per (team, formation) first; the list built per team is as long as the
    number of different formations.
    """
    shown = where_in(season_part(t.timeline, scope), "team_id", team_ids)
    first = (
        in_scope(shown, t.matches, scope)
        .groupBy("team_id", "formation_code")
        .agg(F.min(F.struct("match_id", "from_minute")).alias("first_use"))
    )
    listed = F.array_sort(F.collect_list(F.struct("first_use", "formation_code")))
    return (
        first.groupBy("team_id")
        .agg(F.transform(listed, lambda x: x.getField("formation_code")).alias("formations"))
        .orderBy("team_id")
    )


def favourite_position(facts: DataFrame) -> DataFrame:
    """Position a player held longest, over every season in ``facts``; ties by name."""
    held = (
        facts.filter(F.col("position_played").isNotNull())
        .groupBy("player_id", "position_played")
        .agg(F.sum("minutes_played").alias("minutes"))
    )
    rank = F.struct(F.col("minutes").isNull(), -F.col("minutes"), F.col("position_played"))
    return held.groupBy("player_id").agg(F.min_by("position_played", rank).alias("position"))


def player_profiles(
    t: MatchTables, scope: Scope, team_ids: Iterable[int] | None = None
) -> DataFrame:
    """Season totals per player and team, for players with minutes; one fact row is one match."""
    facts = where_in(season_part(t.facts, scope), "team_id", team_ids)
    totals = (
        in_scope(facts, t.matches, scope)
        .groupBy("player_id", "team_id")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.sum("minutes_played").alias("minutes"),
            F.sum("passes_attempted").alias("passes_attempted"),
            F.sum("passes_completed").alias("passes_completed"),
            F.sum("goals").alias("goals"),
            F.sum("assists").alias("assists"),
            F.sum("shots").alias("shots"),
            F.round(F.sum("xg"), 2).alias("xg"),
            *[F.sum(c).alias(c) for c in ("tackles", "interceptions", "pressures", "blocks")],
        )
        .filter(F.col("minutes") > 0)
        .withColumn("minutes", F.round("minutes", 0).cast("decimal(28,0)"))
    )
    positions = favourite_position(t.facts)
    return (
        totals.join(t.players.select("player_id", "player_name"), "player_id")
        .join(t.teams.select("team_id", "team_name"), "team_id")
        .join(positions, "player_id", "left")
        .orderBy("team_id", F.desc("minutes"), "player_id")
        .select(
            "player_id", "player_name", "team_id", "team_name", "matches", "minutes", "position",
            "passes_attempted", "passes_completed", "goals", "assists", "shots", "xg",
            "tackles", "interceptions", "pressures", "blocks",
        )
    )


# ---------------------------------------------------------------- head to head


def match_headers(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Date, stage, both team names and the score of matches."""

    def side(role: str) -> DataFrame:
        return t.teams.select(
            F.col("team_id").alias(f"{role}_team_id"), F.col("team_name").alias(role)
        )

    return (
        where_in(t.matches, "match_id", match_ids)
        .join(side("home"), "home_team_id")
        .join(side("away"), "away_team_id")
        .select(
            "match_id", "match_date", "competition_stage", "home", "away", "home_score",
            "away_score", "home_team_id", "away_team_id",
        )
    )


def match_formations(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """Formation intervals of matches, with team names."""
    return (
        where_in(t.timeline, "match_id", match_ids)
        .join(t.teams.select("team_id", "team_name"), "team_id")
        .orderBy("match_id", "team_id", "from_minute")
        .select("match_id", "team_id", "team_name", "from_minute", "to_minute", "formation_code")
    )


def match_players(
    t: MatchTables, match_ids: Iterable[int] | None = None, team_id: int | None = None
) -> DataFrame:
    """Player lines of matches, starters first, then by minutes."""
    facts = where_in(t.facts, "match_id", match_ids)
    if team_id is not None:
        facts = facts.filter(F.col("team_id") == team_id)
    return (
        facts.join(t.players.select("player_id", "player_name"), "player_id")
        .orderBy(
            "match_id", "team_id", F.desc("is_starter"), F.desc("minutes_played"), "player_id"
        )
        .select(
            "match_id", "team_id", "player_id", "player_name", "position_played",
            "minutes_played", "is_starter", "passes_completed", "passes_attempted", "tackles",
            "interceptions", "pressures", "goals", "assists",
        )
    )


def formation_timeline(t: MatchTables, match_ids: Iterable[int] | None = None) -> DataFrame:
    """The timeline table of matches in reading order."""
    return where_in(t.timeline, "match_id", match_ids).orderBy(
        "match_id", "team_id", "from_minute"
    ).select(*S.columns(S.TIMELINE))


def formation_at_minute(t: MatchTables) -> DataFrame:
    """Events per (match, team, minute) with the formation the team had then."""
    from pitchgrain.operators.intervals import interval_lookup

    asked = (
        t.events.filter(F.col("team_id").isNotNull())
        .groupBy("match_id", "team_id", "minute")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return interval_lookup(asked, t.timeline, ["match_id", "team_id"], "minute", "formation_code")
