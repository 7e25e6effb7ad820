"""Table layouts: raw landing files, the staging layer and the analytics layer.

Counts and sums are BIGINT and decimals carry extra integer digits, so a key that
holds a large part of a huge input does not overflow; the scales are fixed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The defaults the tables are published with.
DATA_SOURCE = "statsbomb_open"
STARTING_XI = "Starting XI"
TACTICAL_SHIFT = "Tactical Shift"
STAGE_RANKS = {
    "Group Stage": 1,
    "Round of 16": 2,
    "Quarter-finals": 3,
    "Semi-finals": 4,
    "3rd Place Final": 5,
    "Final": 6,
}

EMBEDDING_WIDTH = 384

XG = T.DecimalType(18, 4)
MINUTES = T.DecimalType(18, 2)
COORD = T.DecimalType(6, 2)
EVENT_XG = T.DecimalType(6, 4)
DURATION = T.DecimalType(8, 3)
RATE = T.DecimalType(5, 4)


def struct(ddl: str) -> T.StructType:
    """The layouts below are DDL text, so importing them needs no session; this parses one."""
    return T.StructType.fromDDL(ddl)


def columns(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


# ---------------------------------------------------------------- raw landing files

RAW_COMPETITIONS = (
    "competition_id INT, season_id INT, competition_name STRING, season_name STRING, "
    "country_name STRING, competition_gender STRING"
)

RAW_MATCHES = (
    "match_id INT, competition_id INT, season_id INT, match_date STRING, kick_off STRING, "
    "home_team_id INT, away_team_id INT, home_team STRING, away_team STRING, "
    "home_team_gender STRING, away_team_gender STRING, "
    "home_team_country_name STRING, away_team_country_name STRING, "
    "home_score INT, away_score INT, match_status STRING, competition_stage STRING, "
    "match_week INT, stadium STRING, referee STRING, row_order BIGINT"
)

RAW_EVENTS_CORE = (
    "id STRING, match_id INT, index BIGINT, period INT, timestamp STRING, minute INT, second INT, "
    "type STRING, team_id INT, player_id INT, location ARRAY<DOUBLE>, duration DOUBLE, "
    "under_pressure BOOLEAN, pass_outcome STRING, shot_outcome STRING, shot_statsbomb_xg DOUBLE"
)

# The sparse attributes any query below reads. A feed with more of them passes its own
# schema to the reader; every column outside the core goes into the payload.
RAW_EVENTS_SPARSE = (
    "pass_goal_assist BOOLEAN, duel_type STRING, foul_committed_card STRING, "
    "bad_behaviour_card STRING, shot_type STRING, "
    "tactics STRUCT<formation: INT, lineup: ARRAY<STRUCT<player: STRUCT<id: INT, name: STRING, "
    "jersey_number: INT>, position: STRUCT<id: INT, name: STRING>, jersey_number: INT>>>"
)

RAW_EVENTS = RAW_EVENTS_CORE + ", " + RAW_EVENTS_SPARSE

RAW_LINEUPS = (
    "match_id INT, team_name STRING, player_id INT, player_name STRING, player_nickname STRING, "
    "country STRING, jersey_number INT, positions ARRAY<STRUCT<position: STRING, position_id: INT, "
    "`from`: STRING, `to`: STRING, from_period: INT, to_period: INT, start_reason: STRING, "
    "end_reason: STRING>>, row_order BIGINT"
)

LANDING = {
    "competitions": RAW_COMPETITIONS,
    "matches": RAW_MATCHES,
    "events": RAW_EVENTS,
    "lineups": RAW_LINEUPS,
}

# ---------------------------------------------------------------- staging layer

COMPETITIONS = (
    "competition_id INT, competition_name STRING, country_name STRING, competition_gender STRING, "
    "data_source STRING, ingested_at TIMESTAMP"
)
SEASONS = "competition_id INT, season_id INT, season_name STRING"
TEAMS = (
    "team_id INT, team_name STRING, team_gender STRING, country_name STRING, "
    "data_source STRING, ingested_at TIMESTAMP"
)
PLAYERS = (
    "player_id INT, player_name STRING, player_nickname STRING, country_name STRING, "
    "data_source STRING, ingested_at TIMESTAMP"
)
MATCHES = (
    "match_id INT, competition_id INT, season_id INT, match_date DATE, kick_off STRING, "
    "home_team_id INT, away_team_id INT, home_score INT, away_score INT, match_status STRING, "
    "competition_stage STRING, match_week INT, stadium_name STRING, referee_name STRING, "
    "data_source STRING, ingested_at TIMESTAMP"
)
EVENTS = (
    "event_id STRING, match_id INT, index BIGINT, period SMALLINT, timestamp STRING, "
    "minute SMALLINT, second SMALLINT, type STRING, team_id INT, player_id INT, "
    "location_x DECIMAL(6,2), location_y DECIMAL(6,2), duration DECIMAL(8,3), "
    "under_pressure BOOLEAN, outcome STRING, shot_statsbomb_xg DECIMAL(6,4), payload STRING, "
    "ingested_at TIMESTAMP"
)
# Stored next to the events: the payload attributes the derived tables need. Almost always NULL,
# so they cost nothing, and building facts or timelines does not read the payload at all.
EVENTS_PROMOTED = "detail STRING, formation_code STRING"
LINEUPS = (
    "match_id INT, team_id INT, player_id INT, jersey_number SMALLINT, is_starter BOOLEAN"
)
POSITIONS = (
    "match_id INT, team_id INT, player_id INT, ordinal BIGINT, position_name STRING, "
    "statsbomb_position_id INT, from_period SMALLINT, from_minute SMALLINT, "
    "to_period SMALLINT, to_minute SMALLINT, start_reason STRING, end_reason STRING"
)
RUNS = (
    "run_id STRING, source STRING, competition_id INT, season_id INT, started_at TIMESTAMP, "
    "finished_at TIMESTAMP, status STRING, matches_processed BIGINT, events_processed BIGINT, "
    "error_message STRING, logged_at TIMESTAMP"
)

# ---------------------------------------------------------------- analytics layer

FACTS = (
    "match_id INT, player_id INT, team_id INT, minutes_played DECIMAL(18,2), is_starter BOOLEAN, "
    "position_played STRING, passes_attempted BIGINT, passes_completed BIGINT, "
    "pass_completion_rate DECIMAL(5,4), progressive_passes BIGINT, shots BIGINT, "
    "shots_on_target BIGINT, goals BIGINT, assists BIGINT, xg DECIMAL(18,4), xa DECIMAL(18,4), "
    "tackles BIGINT, interceptions BIGINT, pressures BIGINT, blocks BIGINT, "
    "dribbles_attempted BIGINT, dribbles_completed BIGINT, carries BIGINT, yellow_cards BIGINT, "
    "red_cards BIGINT, aggregated_at TIMESTAMP"
)
TIMELINE = (
    "match_id INT, team_id INT, from_minute SMALLINT, to_minute SMALLINT, formation_code STRING, "
    "source_event_type STRING"
)
DOCUMENTS = (
    "doc_id BIGINT, doc_type STRING, ref_id BIGINT, content STRING, embedding ARRAY<FLOAT>, "
    "metadata STRING, created_at TIMESTAMP"
)

STAGING = {
    "competitions": COMPETITIONS,
    "seasons": SEASONS,
    "teams": TEAMS,
    "players": PLAYERS,
    "matches": MATCHES,
    "events": EVENTS,
    "match_lineups": LINEUPS,
    "match_lineup_positions": POSITIONS,
    "ingestion_runs": RUNS,
}
ANALYTICS = {
    "fact_player_match_stats": FACTS,
    "team_match_formation": TIMELINE,
    "embedding_documents": DOCUMENTS,
}
TABLES = {**STAGING, **ANALYTICS}

# Tables laid out by (competition_id, season_id); the rest are unpartitioned dimensions and logs.
SEASON_PARTITIONED = (
    "matches",
    "events",
    "match_lineups",
    "match_lineup_positions",
    "fact_player_match_stats",
    "team_match_formation",
)
SEASON_KEYS = ["competition_id", "season_id"]

# ---------------------------------------------------------------- keys and references

PRIMARY_KEYS = {
    "competitions": ["competition_id"],
    "seasons": ["competition_id", "season_id"],
    "teams": ["team_id"],
    "players": ["player_id"],
    "matches": ["match_id"],
    "events": ["event_id"],
    "match_lineups": ["match_id", "team_id", "player_id"],
    "match_lineup_positions": ["match_id", "team_id", "player_id", "ordinal"],
    "fact_player_match_stats": ["match_id", "player_id"],
    "team_match_formation": ["match_id", "team_id", "from_minute"],
}

NOT_NULL = {
    "competitions": ["competition_name"],
    "seasons": ["season_name"],
    "teams": ["team_name"],
    "players": ["player_name"],
    "matches": [
        "competition_id", "season_id", "match_date", "home_team_id", "away_team_id",
        "competition_stage",
    ],
    "events": ["match_id", "index", "period", "type", "payload"],
    "match_lineups": ["is_starter"],
    "match_lineup_positions": ["position_name"],
    "fact_player_match_stats": ["team_id", "minutes_played", "is_starter", "passes_attempted"],
    "team_match_formation": ["formation_code", "source_event_type"],
}

# (child table, child columns, parent table, parent columns)
FOREIGN_KEYS = [
    ("seasons", ["competition_id"], "competitions", ["competition_id"]),
    ("matches", ["competition_id"], "competitions", ["competition_id"]),
    ("matches", ["competition_id", "season_id"], "seasons", ["competition_id", "season_id"]),
    ("matches", ["home_team_id"], "teams", ["team_id"]),
    ("matches", ["away_team_id"], "teams", ["team_id"]),
    ("events", ["match_id"], "matches", ["match_id"]),
    ("events", ["team_id"], "teams", ["team_id"]),
    ("events", ["player_id"], "players", ["player_id"]),
    ("match_lineups", ["match_id"], "matches", ["match_id"]),
    ("match_lineups", ["team_id"], "teams", ["team_id"]),
    ("match_lineups", ["player_id"], "players", ["player_id"]),
    (
        "match_lineup_positions", ["match_id", "team_id", "player_id"],
        "match_lineups", ["match_id", "team_id", "player_id"],
    ),
    ("fact_player_match_stats", ["match_id"], "matches", ["match_id"]),
    ("fact_player_match_stats", ["player_id"], "players", ["player_id"]),
    ("fact_player_match_stats", ["team_id"], "teams", ["team_id"]),
    ("team_match_formation", ["match_id"], "matches", ["match_id"]),
    ("team_match_formation", ["team_id"], "teams", ["team_id"]),
]
