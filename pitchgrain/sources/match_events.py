"""Match tables derived from a generic event stream.

The stream has event_id, ts, user_id, event_type, value and props (a JSON object with an
integer k). Teams, matches, event types and payloads follow from these by column arithmetic, so
the whole pipeline can run on any such stream and be checked against another SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.operators.neighbour import with_neighbour
from pitchgrain.plans.tables import MatchTables

COMPETITION = 43
MAIN_SEASON = 106
OTHER_SEASON = 3
OTHER_SEASON_DAYS = (10, 20)

STREAM = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


STAGE = """
    CASE WHEN day < 18 THEN 'Group Stage' WHEN day < 24 THEN 'Round of 16'
         WHEN day < 27 THEN 'Quarter-finals' WHEN day < 28 THEN 'Semi-finals'
         WHEN day < 29 THEN '3rd Place Final' ELSE 'Final' END"""
SEASON = f"CASE WHEN day IN {OTHER_SEASON_DAYS} THEN {OTHER_SEASON} ELSE {MAIN_SEASON} END"
KIND = f"""
    CASE raw_type
      WHEN 'click' THEN 'Pass'
      WHEN 'purchase' THEN 'Shot'
      WHEN 'view' THEN if(k < 50, 'Pressure', 'Duel')
      WHEN 'error' THEN CASE WHEN k < 20 THEN 'Foul Committed' WHEN k < 40 THEN 'Bad Behaviour'
                             WHEN k < 60 THEN 'Interception' WHEN k < 80 THEN 'Block'
                             ELSE 'Dribble' END
      ELSE CASE WHEN k < 15 THEN '{S.STARTING_XI}' WHEN k < 45 THEN '{S.TACTICAL_SHIFT}'
                ELSE 'Carry' END END"""
OUTCOME = """
    CASE type WHEN 'Pass' THEN if(k % 4 = 0, 'Incomplete', NULL)
              WHEN 'Shot' THEN CASE k % 5 WHEN 0 THEN 'Goal' WHEN 1 THEN 'Saved' ELSE 'Off T' END
              END"""
SHAPED = f"type IN ('{S.STARTING_XI}', '{S.TACTICAL_SHIFT}') AND k % 13 <> 12"
CODE = "element_at(array(442, 433, 4231, 352), k % 4 + 1)"
PAYLOAD = f"""
    coalesce(CASE
      WHEN type = 'Pass' AND k % 10 = 1 THEN '{{"pass_goal_assist":true}}'
      WHEN type = 'Duel' THEN if(k % 2 = 0, '{{"duel_type":"Tackle"}}', '{{"duel_type":"Aerial"}}')
      WHEN type = 'Foul Committed' THEN
        CASE k % 3 WHEN 0 THEN '{{"foul_committed_card":"Yellow Card"}}'
                   WHEN 1 THEN '{{"foul_committed_card":"Red Card"}}' END
      WHEN type = 'Bad Behaviour' THEN
        CASE k % 3 WHEN 0 THEN '{{"bad_behaviour_card":"Yellow Card"}}'
                   WHEN 1 THEN '{{"bad_behaviour_card":"Second Yellow"}}' END
      WHEN {SHAPED} THEN concat('{{"tactics":{{"formation":', {CODE}, '}}}}') END, '{{}}')"""
PLAYER = "if(k % 33 <> 32, user_id, NULL)"
PRESSURE = "CASE WHEN k % 8 = 0 THEN true WHEN k % 8 <> 1 THEN false END"


def base_stream(spark: SparkSession, path: str) -> DataFrame:
    """The stream with the numbers everything else is computed from."""
    numbers = spark.read.schema(STREAM).parquet(path).selectExpr(
        "event_id",
        "CAST(user_id AS INT) AS user_id",
        "event_type AS raw_type",
        "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "datediff(to_date(ts), DATE'2024-01-01') AS day",
        "CAST((hour(ts) * 60 + minute(ts)) DIV 15 AS SMALLINT) AS minute",
        "CAST(second(ts) AS SMALLINT) AS second",
        "CAST(pmod(user_id, 6) AS INT) AS team_id",
    )
    slot = "if(team_id < 3, team_id, pmod(team_id - 3 + day, 3))"
    return numbers.selectExpr(
        "*",
        f"{slot} AS slot",
        f"day * 10 + {slot} AS match_id",
        "CAST(CASE WHEN k % 50 = 49 THEN 5 WHEN minute < 48 THEN 1 ELSE 2 END AS SMALLINT) AS period",
        f"{KIND} AS type",
    )


def event_rows(base: DataFrame) -> DataFrame:
    return base.selectExpr(
        "event_id",
        "match_id",
        "event_id AS index",
        "period",
        "CAST(NULL AS STRING) AS timestamp",
        "minute",
        "second",
        "type",
        "team_id",
        f"{PLAYER} AS player_id",
        "if(k % 20 <> 19, CAST(k * 1.2BD AS DECIMAL(6,2)), NULL) AS location_x",
        "if(k % 20 <> 19, CAST(k * 0.8BD AS DECIMAL(6,2)), NULL) AS location_y",
        "CAST(NULL AS DECIMAL(8,3)) AS duration",
        f"{PRESSURE} AS under_pressure",
        f"{OUTCOME} AS outcome",
        "if(type = 'Shot', CAST(least(value / 500, 0.99D) AS DECIMAL(6,4)), NULL) AS shot_statsbomb_xg",
        f"{PAYLOAD} AS payload",
        "current_timestamp() AS ingested_at",
    )


def match_rows(base: DataFrame) -> DataFrame:
    goal = "type = 'Shot' AND k % 5 = 0"
    played = base.groupBy("day", "slot").agg(
        F.expr(f"CAST(count_if({goal} AND team_id < 3) AS INT) AS home_score"),
        F.expr(f"CAST(count_if({goal} AND team_id >= 3) AS INT) AS away_score"),
    )
    return played.selectExpr(
        "day * 10 + slot AS match_id",
        f"{COMPETITION} AS competition_id",
        f"{SEASON} AS season_id",
        "date_add(DATE'2024-01-01', day) AS match_date",
        "CAST(NULL AS STRING) AS kick_off",
        "slot AS home_team_id",
        "3 + pmod(slot - day, 3) AS away_team_id",
        "home_score",
        "away_score",
        "CAST(NULL AS STRING) AS match_status",
        f"{STAGE} AS competition_stage",
        "CAST(NULL AS INT) AS match_week",
        "CAST(NULL AS STRING) AS stadium_name",
        "CAST(NULL AS STRING) AS referee_name",
        f"'{S.DATA_SOURCE}' AS data_source",
        "current_timestamp() AS ingested_at",
    )


def _lineup_events(base: DataFrame) -> DataFrame:
    return base.filter("k % 33 <> 32 AND k % 7 <> 6").selectExpr(
        "match_id", "team_id", "user_id AS player_id", "event_id AS ordinal", "minute", "k"
    )


def position_rows(base: DataFrame) -> DataFrame:
    ended = with_neighbour(
        _lineup_events(base), ["match_id", "player_id"], "ordinal", {"to_minute": "minute"}, ahead=True
    )
    return ended.selectExpr(
        "match_id",
        "team_id",
        "player_id",
        "ordinal",
        "concat('P', k % 5) AS position_name",
        "CAST(NULL AS INT) AS statsbomb_position_id",
        "CAST(if(minute < 48, 1, 2) AS SMALLINT) AS from_period",
        "if(k % 25 <> 24, minute, NULL) AS from_minute",
        "CAST(NULL AS SMALLINT) AS to_period",
        "to_minute",
        f"if(k % 3 = 0, '{S.STARTING_XI}', 'Substitution') AS start_reason",
        "CAST(NULL AS STRING) AS end_reason",
    )


def lineup_rows(base: DataFrame) -> DataFrame:
    starters = F.expr("bool_or(k % 3 = 0) AS is_starter")
    listed = _lineup_events(base).groupBy("match_id", "team_id", "player_id").agg(starters)
    return listed.selectExpr(
        "match_id", "team_id", "player_id", "CAST(NULL AS SMALLINT) AS jersey_number", "is_starter"
    )


def _dimension(ids: DataFrame, key: str, label: str, extra: dict[str, Column]) -> DataFrame:
    prefix = key.removesuffix("_id")
    return ids.select(
        key,
        F.concat(F.lit(f"{label} "), F.col(key).cast("string")).alias(f"{prefix}_name"),
        *[c.alias(n) for n, c in extra.items()],
        F.lit(S.DATA_SOURCE).alias("data_source"),
        F.current_timestamp().alias("ingested_at"),
    )


def _season_ids(base: DataFrame) -> DataFrame:
    return base.select(
        F.lit(COMPETITION).alias("competition_id"), F.expr(SEASON).alias("season_id")
    ).distinct()


def _seasons(base: DataFrame) -> DataFrame:
    name = F.concat(F.lit("Season "), F.col("season_id").cast("string"))
    return _season_ids(base).select("*", name.alias("season_name"))


def _competitions(base: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    ids = _season_ids(base).select("competition_id").distinct()
    return ids.select(
        "competition_id",
        F.lit("Competition 43").alias("competition_name"),
        none.alias("country_name"),
        none.alias("competition_gender"),
        F.lit(S.DATA_SOURCE).alias("data_source"),
        F.current_timestamp().alias("ingested_at"),
    )


def _teams(base: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    ids = base.select("team_id").distinct()
    return _dimension(ids, "team_id", "Team", {"team_gender": none, "country_name": none})


def _players(base: DataFrame) -> DataFrame:
    odd = F.col("player_id") % 2 == 1
    nickname = F.when(odd, F.concat(F.lit("Nick "), F.col("player_id").cast("string")))
    ids = base.select(F.col("user_id").alias("player_id")).distinct()
    return _dimension(
        ids, "player_id", "Player",
        {"player_nickname": nickname, "country_name": F.lit(None).cast("string")},
    )


def read_tables(spark: SparkSession, sf_dir: str) -> MatchTables:
    """All staging tables over ``sf_dir``/events.parquet."""
    base = base_stream(spark, f"{sf_dir}/events.parquet")
    return MatchTables(
        competitions=lambda: _competitions(base),
        seasons=lambda: _seasons(base),
        teams=lambda: _teams(base),
        players=lambda: _players(base),
        matches=lambda: match_rows(base),
        events=lambda: event_rows(base),
        lineups=lambda: lineup_rows(base),
        positions=lambda: position_rows(base),
    )


# ---------------------------------------------------------------- the same stream as landing files


def raw_competitions(base: DataFrame) -> DataFrame:
    """One row per season, the competition's attributes repeated, one of them blank."""
    return _season_ids(base).select(
        "competition_id",
        "season_id",
        F.lit("Competition 43").alias("competition_name"),
        F.concat(F.lit("Season "), F.col("season_id").cast("string")).alias("season_name"),
        F.lit(" ").alias("country_name"),
        F.lit("male").alias("competition_gender"),
    )


def raw_matches(base: DataFrame) -> DataFrame:
    """The matches as they would land: text dates, fractional kick-off, names on each side."""
    m = match_rows(base)
    clock = F.format_string("%02d:30:00.000", F.pmod(F.col("match_id"), F.lit(24)))

    def name(col: str) -> Column:
        return F.concat(F.lit("Team "), F.col(col).cast("string"))

    blank_or = F.when(F.col("match_id") % 2 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit("Ground "), F.col("home_team_id").cast("string"))
    )
    return m.select(
        "match_id", "competition_id", "season_id",
        F.date_format("match_date", "yyyy-MM-dd").alias("match_date"),
        F.when(F.col("match_id") % 3 != 0, clock).alias("kick_off"),
        "home_team_id", "away_team_id",
        name("home_team_id").alias("home_team"), name("away_team_id").alias("away_team"),
        F.lit("male").alias("home_team_gender"), F.lit("male").alias("away_team_gender"),
        name("home_team_id").alias("home_team_country_name"),
        # differs from match to match, so that "first occurrence wins" shows
        F.concat(F.lit("Country "), F.col("match_id").cast("string")).alias("away_team_country_name"),
        "home_score", "away_score",
        F.lit("available").alias("match_status"),
        "competition_stage",
        F.floor(F.col("match_id") / 70).cast("int").alias("match_week"),
        blank_or.alias("stadium"),
        F.lit("").alias("referee"),
        F.col("match_id").cast("bigint").alias("row_order"),
    )


def _slot(player: Column, k: Column, number_on_player: bool) -> Column:
    name = F.concat(F.lit("Announced "), player.cast("string"))
    number = (player % 40).cast("int")
    none = F.lit(None).cast("int")
    who = F.struct(
        player.alias("id"), name.alias("name"),
        (number if number_on_player else none).alias("jersey_number"),
    )
    where = F.struct((k % 5).alias("id"), F.concat(F.lit("P"), (k % 5).cast("string")).alias("name"))
    return F.struct(
        who.alias("player"), where.alias("position"),
        (none if number_on_player else number).alias("jersey_number"),
    )


def raw_events(base: DataFrame) -> DataFrame:
    """The events as they would land: one wide sparse row per event."""
    k, kind = F.col("k"), F.col("type")
    outcome = F.expr(OUTCOME)
    card = F.when(k % 3 == 0, "Yellow Card")
    tactics = F.struct(
        F.expr(CODE).alias("formation"),
        # the acting player, and a team-mate who need not be in the squad of the match
        F.array(_slot(F.col("user_id"), k, False), _slot(F.col("user_id") + 6, k, True)).alias("lineup"),
    )
    place = F.when(k % 20 != 19, F.array(k * F.lit(1.25), k * F.lit(0.75))).when(
        k % 40 == 19, F.array(k * F.lit(1.25))
    )
    xg = F.when(kind == "Shot", F.least(F.col("value") / 500, F.lit(0.99)))
    return base.select(
        F.col("event_id").cast("string").alias("id"),
        "match_id",
        F.col("event_id").alias("index"),
        F.col("period").cast("int").alias("period"),
        F.when(k % 9 != 0, F.lit("00:01:02.500")).otherwise(" ").alias("timestamp"),
        F.col("minute").cast("int").alias("minute"),
        F.col("second").cast("int").alias("second"),
        "type",
        "team_id",
        F.expr(PLAYER).alias("player_id"),
        place.alias("location"),
        F.when(k % 6 == 0, F.lit(float("nan"))).otherwise(k / F.lit(8.0)).alias("duration"),
        F.expr(PRESSURE).alias("under_pressure"),
        F.when(kind == "Pass", F.coalesce(outcome, F.lit(""))).alias("pass_outcome"),
        F.when(kind == "Shot", outcome).alias("shot_outcome"),
        F.coalesce(xg, F.lit(float("nan"))).alias("shot_statsbomb_xg"),
        F.when((kind == "Pass") & (k % 10 == 1), True).alias("pass_goal_assist"),
        F.when(kind == "Duel", F.when(k % 2 == 0, "Tackle").otherwise(" ")).alias("duel_type"),
        F.when(kind == "Foul Committed", card).alias("foul_committed_card"),
        F.when(kind == "Bad Behaviour", card).alias("bad_behaviour_card"),
        F.when(F.expr(SHAPED), tactics).alias("tactics"),
    )


def raw_lineups(base: DataFrame) -> DataFrame:
    """The line-ups as they would land, one record per stint, clocks as text."""
    p = position_rows(base)

    def stamp(col: str) -> Column:
        return F.concat(F.col(col).cast("string"), F.lit(":07"))

    stint = F.struct(
        F.col("position_name").alias("position"),
        F.lit(None).cast("int").alias("position_id"),
        stamp("from_minute").alias("from"),
        stamp("to_minute").alias("to"),
        F.col("from_period").cast("int").alias("from_period"),
        F.lit(None).cast("int").alias("to_period"),
        "start_reason",
        F.lit(" ").alias("end_reason"),
    )
    pid = F.col("player_id").cast("string")
    return p.select(
        "match_id",
        F.concat(F.lit("Team "), F.col("team_id").cast("string")).alias("team_name"),
        "player_id",
        F.concat(F.lit("Player "), pid).alias("player_name"),
        # a different nickname in every match, so that "last match wins" shows
        F.concat(F.lit("Nick "), F.col("match_id").cast("string"), F.lit("-"), F.col("ordinal").cast("string")).alias("player_nickname"),
        F.lit("").alias("country"),
        (F.col("player_id") % 30).alias("jersey_number"),
        F.array(stint).alias("positions"),
        F.col("ordinal").alias("row_order"),
    )


__all__ = ["base_stream", "raw_competitions", "read_tables", "raw_events", "raw_lineups", "raw_matches"]
