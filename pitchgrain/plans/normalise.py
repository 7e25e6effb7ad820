"""Raw landing rows to staging rows, as column expressions.

Which raw match or line-up came first is said by ``row_order`` where it is filled, then by
``feed_order``, the place in the files, and at last by the row's own keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.functions import clean as C
from pitchgrain.operators.choose import keep_one, nulls_last
from pitchgrain.operators.skew import spread_join


def _typed(df: DataFrame, ddl: str, values: dict[str, Column]) -> DataFrame:
    """The columns of a layout, each from ``values`` or by its own name, cast to its type."""
    out = []
    for field in S.struct(ddl).fields:
        if field.name in values:
            col = values[field.name]
        elif field.name == "data_source":
            col = F.lit(S.DATA_SOURCE)
        elif field.name == "ingested_at":
            col = F.current_timestamp()
        else:
            col = _cleaned(df, field.name)
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def _cleaned(df: DataFrame, name: str) -> Column:
    """A column without blanks and NaNs; NULL where the source lacks it."""
    if name not in df.columns:
        return F.lit(None)
    return C.clean(F.col(f"`{name}`"), df.schema[name].dataType)


def _order(df: DataFrame, *keys: str) -> Column:
    known = [c for c in ("row_order", "feed_order") if c in df.columns]
    parts = [part for name in (*known, *keys) for part in nulls_last(F.col(name))]
    return F.struct(*(part.alias(f"o{i}") for i, part in enumerate(parts)))


def competitions(raw: DataFrame) -> DataFrame:
    return _typed(raw, S.COMPETITIONS, {"competition_name": F.col("competition_name")})


def seasons(raw: DataFrame) -> DataFrame:
    return _typed(raw, S.SEASONS, {"season_name": F.col("season_name")})


def matches(raw: DataFrame) -> DataFrame:
    """ISO date, kick-off without its fraction, stadium and referee under their staging names."""
    kick_off = F.split_part(_cleaned(raw, "kick_off").cast("string"), F.lit("."), F.lit(1))
    return _typed(
        raw,
        S.MATCHES,
        {
            "match_date": F.to_date(F.col("match_date")),
            "kick_off": kick_off,
            "competition_stage": F.col("competition_stage"),
            "stadium_name": _cleaned(raw, "stadium"),
            "referee_name": _cleaned(raw, "referee"),
        },
    )


def _raw_sides(raw: DataFrame) -> DataFrame:
    """Two rows per raw match, home before away."""

    def side(place: int, role: str) -> Column:
        return F.struct(
            F.lit(place).alias("place"),
            F.col(f"{role}_team_id").alias("team_id"),
            F.col(f"{role}_team").alias("team_name"),
            _cleaned(raw, f"{role}_team_gender").cast("string").alias("team_gender"),
            _cleaned(raw, f"{role}_team_country_name").cast("string").alias("country_name"),
        )

    both = F.explode(F.array(side(0, "home"), side(1, "away")))
    return raw.select("match_id", _order(raw, "match_date", "match_id").alias("match_order"), both.alias("s")).select(
        "match_id", "match_order", "s.*"
    )


def teams(raw_matches: DataFrame) -> DataFrame:
    """Teams of both sides; what the first match says about a team stays."""
    sides = _raw_sides(raw_matches).drop("match_id")
    first = keep_one(sides, ["team_id"], [F.col("match_order"), F.col("place")])
    return _typed(first, S.TEAMS, {})


def players(raw_lineups: DataFrame, raw_matches: DataFrame) -> DataFrame:
    """Players of the line-ups: the first row inside a match counts, the last match wins.

    Reduced to one row per (match, player) before the match order is joined on.
    """
    rows = raw_lineups.select(
        "match_id",
        "player_id",
        "player_name",
        _cleaned(raw_lineups, "player_nickname").alias("player_nickname"),
        _cleaned(raw_lineups, "country").alias("country_name"),
        _order(raw_lineups, "player_id").alias("_row"),
    )
    per_match = keep_one(rows, ["match_id", "player_id"], [F.col("_row")])
    order = raw_matches.select("match_id", _order(raw_matches, "match_date", "match_id").alias("_match"))
    placed = spread_join(per_match, order, ["match_id"], ["player_id"])
    last = keep_one(placed, ["player_id"], [F.col("_match")], last=True)
    return _typed(last, S.PLAYERS, {})


def core_columns() -> set[str]:
    return set(S.columns(S.RAW_EVENTS_CORE))


def events(raw: DataFrame) -> DataFrame:
    """Core columns typed, everything else folded into the payload."""

    def col(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None)

    location = col("location").cast("array<double>")
    core = core_columns() | set(S.SEASON_KEYS)
    return _typed(
        raw,
        S.EVENTS,
        {
            "event_id": F.col("id"),
            "type": F.col("type"),
            "location_x": C.coordinate(location, 0),
            "location_y": C.coordinate(location, 1),
            "outcome": C.single_outcome(
                F.col("type"), col("pass_outcome").cast("string"), col("shot_outcome").cast("string")
            ),
            "payload": C.payload(raw.schema, core),
        },
    )


def _with_team(raw_lineups: DataFrame, raw_matches: DataFrame, how: str) -> DataFrame:
    sides = _raw_sides(raw_matches).select("match_id", "team_name", "team_id", "place")
    unique = keep_one(sides, ["match_id", "team_name"], [F.col("place")]).drop("place")
    return spread_join(raw_lineups, unique, ["match_id", "team_name"], ["player_id"], how)


def unplaced_lineups(raw_lineups: DataFrame, raw_matches: DataFrame) -> DataFrame:
    """(match_id, team_name) of line-ups whose team is on neither side of the match."""
    named = raw_lineups.select("match_id", "team_name").distinct()
    sides = _raw_sides(raw_matches).select("match_id", "team_name").distinct()
    return named.join(sides, ["match_id", "team_name"], "left_anti")


def _stints(raw_lineups: DataFrame) -> Column:
    empty = F.array().cast(raw_lineups.schema["positions"].dataType)
    return F.coalesce("positions", empty)


def lineups(raw_lineups: DataFrame, raw_matches: DataFrame) -> DataFrame:
    """One row per (match, team, player). A starter has any stint that began with the match."""
    started = F.exists(_stints(raw_lineups), lambda p: p.getField("start_reason") == S.STARTING_XI)
    placed = _with_team(raw_lineups, raw_matches, "inner").select(
        "match_id",
        "team_id",
        "player_id",
        _cleaned(raw_lineups, "jersey_number").alias("jersey_number"),
        F.coalesce(started, F.lit(False)).alias("started"),
        _order(raw_lineups, "player_id").alias("_row"),
    )
    merged = placed.groupBy("match_id", "team_id", "player_id").agg(
        F.min_by("jersey_number", "_row").alias("jersey_number"),
        F.bool_or("started").alias("is_starter"),
    )
    return _typed(merged, S.LINEUPS, {})


def positions(raw_lineups: DataFrame, raw_matches: DataFrame) -> DataFrame:
    """One row per stint, with the minutes taken from its clocks."""
    placed = _with_team(raw_lineups, raw_matches, "inner")
    flat = placed.select(
        "match_id", "team_id", "player_id",
        _order(raw_lineups, "player_id").alias("_row"),
        F.posexplode(_stints(raw_lineups)).alias("_pos", "p"),
    )
    # a player has a handful of stints in a match, so their numbering sorts small groups
    stints = Window.partitionBy("match_id", "team_id", "player_id").orderBy("_row", "_pos")
    flat = flat.withColumn("_stint", F.row_number().over(stints) - 1)

    def text(name: str) -> Column:
        return C.clean_text(F.col("p").getField(name))

    def number(name: str) -> Column:
        dtype = next(
            f.dataType
            for f in raw_lineups.schema["positions"].dataType.elementType.fields
            if f.name == name
        )
        return C.clean(F.col("p").getField(name), dtype)

    return _typed(
        flat,
        S.POSITIONS,
        {
            "ordinal": F.col("_stint"),
            "position_name": F.col("p").getField("position"),
            "statsbomb_position_id": number("position_id"),
            "from_period": number("from_period"),
            "from_minute": C.clock_minute(F.col("p").getField("from")),
            "to_period": number("to_period"),
            "to_minute": C.clock_minute(F.col("p").getField("to")),
            "start_reason": text("start_reason"),
            "end_reason": text("end_reason"),
        },
    )


__all__ = [
    "competitions", "events", "lineups", "matches", "players", "positions", "seasons", "teams",
    "unplaced_lineups",
]
