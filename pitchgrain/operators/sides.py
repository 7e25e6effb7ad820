"""Two rows per match: each team once as the side looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_sides(matches: DataFrame, team_id: int | None = None) -> DataFrame:
    """Every match seen from both teams, or only from ``team_id``.

    Adds side, team_id, opponent_id, team_score and opponent_score.
    """
    home = F.struct(
        F.lit("home").alias("side"),
        F.col("home_team_id").alias("team_id"),
        F.col("away_team_id").alias("opponent_id"),
        F.col("home_score").alias("team_score"),
        F.col("away_score").alias("opponent_score"),
    )
    away = F.struct(
        F.lit("away").alias("side"),
        F.col("away_team_id").alias("team_id"),
        F.col("home_team_id").alias("opponent_id"),
        F.col("away_score").alias("team_score"),
        F.col("home_score").alias("opponent_score"),
    )
    both = matches.select("*", F.explode(F.array(home, away)).alias("_side"))
    both = both.select(*matches.columns, "_side.*")
    if team_id is not None:
        both = both.filter(F.col("team_id") == team_id)
    return both
