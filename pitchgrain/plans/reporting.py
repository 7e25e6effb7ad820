"""Row counts of the layers and the compression from events to facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain.functions.text import fixed
from pitchgrain.operators.scope import Scope
from pitchgrain.plans.tables import MatchTables, season_part


def _total(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("item"), "n")


def _season_rows(df: DataFrame, matches: DataFrame, scope: Scope) -> DataFrame:
    """Rows per match of the season. Counted per match first: the join sees one row per match."""
    per_match = season_part(df, scope).groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    return per_match.join(scope.filter(matches).select("match_id"), "match_id", "left_semi")


def _season_total(name: str, df: DataFrame, matches: DataFrame, scope: Scope) -> DataFrame:
    rows = _season_rows(df, matches, scope)
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(name).alias("item"), "n")


def staging_counts(t: MatchTables, scope: Scope) -> DataFrame:
    parts = [
        _total("competitions", t.competitions),
        _total("seasons", t.seasons),
        _total("teams", t.teams),
        _total("players", t.players),
        _total("matches", scope.filter(t.matches)),
        _season_total("events (season)", t.events, t.matches, scope),
        _season_total("match_lineups (season)", t.lineups, t.matches, scope),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def analytics_counts(t: MatchTables, scope: Scope, team_id: int) -> DataFrame:
    """Facts of the season, of all seasons and of one team, and formation intervals.

    The three fact counts come from one pass.
    """
    per_match = t.facts.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("team_id") == team_id).alias("of_team")
    )
    season = scope.filter(t.matches).select("match_id", F.lit(True).alias("in_season"))
    marked = per_match.join(season, "match_id", "left")
    none = F.lit(0).cast("bigint")
    sums = marked.agg(
        F.coalesce(F.sum(F.when(F.col("in_season"), F.col("n"))), none).alias("season"),
        F.coalesce(F.sum("n"), none).alias("all"),
        F.coalesce(F.sum(F.when(F.col("in_season"), F.col("of_team"))), none).alias("team"),
    )
    names = {
        "season": "fact (season)",
        "all": "fact (all seasons)",
        "team": "fact (team, season)",
    }
    rows = F.explode(
        F.array(*[F.struct(F.lit(v).alias("item"), F.col(k).alias("n")) for k, v in names.items()])
    )
    facts = sums.select(rows.alias("r")).select("r.item", "r.n")
    return facts.unionByName(_season_total("formation (season)", t.timeline, t.matches, scope))


def compression(t: MatchTables, scope: Scope) -> DataFrame:
    """Events per fact row in the season; 0 without facts."""
    events = _season_rows(t.events, t.matches, scope).select(
        F.col("n").alias("events"), F.lit(0).cast("bigint").alias("facts")
    )
    facts = _season_rows(t.facts, t.matches, scope).select(
        F.lit(0).cast("bigint").alias("events"), F.col("n").alias("facts")
    )
    sums = events.unionByName(facts).agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        F.coalesce(F.sum("facts"), F.lit(0)).alias("facts"),
    )
    ratio = F.coalesce(
        F.try_divide(F.col("events").cast("double"), F.col("facts").cast("double")), F.lit(0.0)
    )
    return sums.select(
        "events", "facts", ratio.alias("ratio"),
        F.concat(F.lit("~"), fixed(ratio, 0), F.lit("x")).alias("reduction"),
    )


def rows_per_match(events: DataFrame) -> DataFrame:
    """Loaded events per match, what a progress report prints line by line."""
    return events.groupBy("match_id").agg(F.count(F.lit(1)).alias("rows")).orderBy("match_id")
