from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pitchgrain import schemas as S
from pitchgrain.plans.facts import player_match_stats, team_formation

EVENT = {
    "match_id": 1, "index": 0, "period": 1, "minute": 0, "type": "Carry", "team_id": 10,
    "player_id": 7, "outcome": None, "xg": None, "payload": "{}",
}


def events(spark, *changes):
    data = []
    for n, change in enumerate(changes):
        e = {**EVENT, "index": n, **change}
        data.append(tuple(e[k] for k in EVENT))
    kinds = (
        "match_id int, index bigint, period smallint, minute smallint, type string, team_id int, "
        "player_id int, outcome string, xg string, payload string"
    )
    df = spark.createDataFrame(data, kinds)
    return df.withColumn("shot_statsbomb_xg", F.col("xg").cast("decimal(6,4)")).drop("xg")


def lineups(spark, *data):
    return spark.createDataFrame(list(data), S.LINEUPS)


def positions(spark, *data):
    """(player, ordinal, name, from_period, from_minute, to_minute)"""
    full = [(1, 10, p, o, n, None, fp, fm, None, tm, None, None) for p, o, n, fp, fm, tm in data]
    return spark.createDataFrame(full, S.POSITIONS)


def fact(spark, ev, lu=None, pos=None, player=7):
    lu = lu if lu is not None else spark.createDataFrame([], S.LINEUPS)
    pos = pos if pos is not None else spark.createDataFrame([], S.POSITIONS)
    found = player_match_stats(ev, lu, pos).filter(F.col("player_id") == player).collect()
    return found[0].asDict() if found else None


def test_counts(spark):
    f = fact(
        spark,
        events(
            spark,
            {"type": "Pass", "payload": '{"pass_goal_assist":true}'},
            {"type": "Pass", "payload": '{"pass_goal_assist":false}', "outcome": "Incomplete"},
            {"type": "Pass", "payload": '{"pass_goal_assist":null}'},
            {"type": "Pass"},
            {"type": "Shot", "outcome": "Goal", "xg": "0.5", "period": 5},
            {"type": "Shot", "outcome": "Saved", "xg": "0.25"},
            {"type": "Shot", "outcome": "Off T"},
            {"type": "Duel", "payload": '{"duel_type":"Tackle"}'},
            {"type": "Duel", "payload": '{"duel_type":"Aerial"}'},
            {"type": "Dribble"},
            {"type": "Pressure"},
            {"type": "Foul Committed", "payload": '{"foul_committed_card":"Yellow Card"}'},
            {"type": "Bad Behaviour", "payload": '{"bad_behaviour_card":"Yellow Card"}'},
            {"type": "Bad Behaviour", "payload": '{"bad_behaviour_card":"Second Yellow"}'},
            {"type": "Foul Committed", "payload": '{"bad_behaviour_card":"Red Card"}'},
            {"player_id": None, "type": "Pass", "minute": 90},
        ),
    )
    want = {
        "passes_attempted": 4, "passes_completed": 3, "assists": 2, "shots": 3, "shots_on_target": 2,
        "goals": 1, "xg": Decimal("0.7500"), "tackles": 1, "dribbles_attempted": 1,
        "dribbles_completed": 1, "pressures": 1, "yellow_cards": 2, "red_cards": 1,
        "pass_completion_rate": Decimal("0.7500"), "xa": Decimal("0.0000"),
        "progressive_passes": None, "is_starter": False, "minutes_played": Decimal("0.00"),
        "position_played": None, "team_id": 10,
    }
    assert {k: f[k] for k in want} == want


def test_no_passes_means_no_rate(spark):
    assert fact(spark, events(spark, {}))["pass_completion_rate"] is None


def test_lineup_team_overrides_and_unknown_team_is_left_out(spark):
    ev = events(spark, {"team_id": 10}, {"team_id": None, "player_id": 8})
    lu = lineups(spark, (1, 20, 7, None, True))
    assert fact(spark, ev, lu)["team_id"] == 20
    assert fact(spark, ev, lu)["is_starter"] is True
    assert fact(spark, ev, lu, player=8) is None


@pytest.mark.parametrize(
    "stints, minutes, position",
    [
        ([(7, 0, "A", 1, 0, 45)], 45, "A"),
        ([(7, 0, "A", 2, 60, None)], 35, "A"),
        ([(7, 0, "A", 1, None, None)], 0, "A"),
        ([(7, 0, "A", 1, 50, 40)], 0, "A"),
        ([(7, 0, "A", 1, 0, 30), (7, 1, "B", 1, 30, None)], 95, "B"),
        # equal lengths: earlier period, then earlier minute, a missing period last, then order
        ([(7, 0, "A", 2, 50, 60), (7, 1, "B", 1, 10, 20)], 20, "B"),
        ([(7, 0, "A", 1, 30, 40), (7, 1, "B", 1, 10, 20)], 20, "B"),
        ([(7, 0, "A", None, 0, 10), (7, 1, "B", 2, 80, 90)], 20, "B"),
        ([(7, 5, "A", 1, 0, 10), (7, 3, "B", 1, 0, 10)], 20, "B"),
    ],
)
def test_minutes_and_position(spark, stints, minutes, position):
    ev = events(spark, {}, {"player_id": None, "minute": 95, "period": 5})
    f = fact(spark, ev, lineups(spark, (1, 10, 7, None, False)), positions(spark, *stints))
    assert (f["minutes_played"], f["position_played"]) == (Decimal(minutes), position)


def test_timeline_of_events(spark):
    code = '{"tactics":{"formation":%s}}'
    ev = events(
        spark,
        {"type": "Starting XI", "minute": None, "payload": code % 442},
        {"type": "Tactical Shift", "minute": 30, "payload": code % 442},
        {"type": "Tactical Shift", "minute": 40, "payload": "{}"},
        {"type": "Tactical Shift", "minute": 60, "payload": code % 433},
        {"type": "Tactical Shift", "minute": 61, "team_id": None, "payload": code % 352},
        {"type": "Pass", "minute": 62, "payload": code % 352},
    )
    assert sorted(rows(team_formation(ev))) == [
        (1, 10, 0, 60, "442", "Starting XI"),
        (1, 10, 60, None, "433", "Tactical Shift"),
    ]


def test_facts_add_up_to_the_events(tables):
    counted = tables.events.filter("player_id is not null")
    want = counted.agg(F.expr("count_if(type = 'Pass')"), F.expr("count_if(type = 'Shot')")).first()
    got = tables.facts.agg(F.sum("passes_attempted"), F.sum("shots")).first()
    assert tuple(got) == tuple(want)
    assert tables.facts.groupBy("match_id", "player_id").count().filter("count > 1").count() == 0


def test_timelines_do_not_overlap(tables):
    a, b = tables.timeline.alias("a"), tables.timeline.alias("b")
    same = (F.col("a.match_id") == F.col("b.match_id")) & (F.col("a.team_id") == F.col("b.team_id"))
    inside = (F.col("a.from_minute") < F.col("b.from_minute")) & (
        F.col("a.to_minute").isNull() | (F.col("b.from_minute") < F.col("a.to_minute"))
    )
    assert a.join(b, same & inside).count() == 0
