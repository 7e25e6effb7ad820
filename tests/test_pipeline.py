import json

import pytest

from conftest import rows
from pitchgrain import schemas as S
from pitchgrain.operators.scope import Scope
from pitchgrain.plans import documents, ingest, normalise, pipeline, quality, runlog
from pitchgrain.sources.landing import Landing
from pitchgrain.sources.warehouse import Warehouse, snapshot


def stint(position, start, end, period=1, reason="Starting XI"):
    return {
        "position": position, "position_id": 1, "from": start, "to": end, "from_period": period,
        "to_period": None, "start_reason": reason, "end_reason": " ",
    }


def match(mid, home=10, away=20, season=106, day="2022-12-05", **more):
    return {
        "match_id": mid, "competition_id": 43, "season_id": season, "match_date": day,
        "kick_off": "16:00:00.000", "home_team_id": home, "away_team_id": away,
        "home_team": f"T{home}", "away_team": f"T{away}", "home_team_gender": "male",
        "away_team_country_name": " ", "home_score": 1, "away_score": 0,
        "competition_stage": "Group Stage", "stadium": " ", "referee": "R", **more,
    }


def event(mid, n, kind="Pass", team=10, player=1, **more):
    return {
        "id": f"00000000-0000-0000-{mid:04d}-{n:012d}", "match_id": mid, "index": n, "period": 1,
        "timestamp": " ", "minute": n, "second": 0, "type": kind, "team_id": team,
        "player_id": player, "location": [60.25, 40.0], "duration": 1.5, **more,
    }


def lineup(mid, team, player, nickname, positions, order=0):
    return {
        "match_id": mid, "team_name": f"T{team}", "player_id": player, "player_name": f"P{player}",
        "player_nickname": nickname, "country": "", "jersey_number": 9 + order,
        "positions": positions,
    }


def land(root, feed, records):
    folder = root / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")


def full_landing(root, goals_in_two=True):
    land(
        root,
        "competitions",
        [
            {"competition_id": 43, "season_id": 106, "competition_name": "Cup", "season_name": "2022"},
            {"competition_id": 43, "season_id": 3, "competition_name": "Cup", "season_name": "2018"},
        ],
    )
    land(root, "matches", [match(1), match(2, 20, 10), match(3, 10, 20, season=3)])
    events = [
        event(1, 0, "Starting XI", player=None, tactics={"formation": 442, "lineup": []}),
        event(1, 1, pass_goal_assist=True),
        event(1, 2, "Shot", shot_outcome="Goal", shot_statsbomb_xg=0.4),
        event(1, 90, "Pass", team=20, player=2, pass_outcome="Incomplete"),
        event(3, 0),
    ]
    if goals_in_two:
        events.append(event(2, 0, "Shot", team=20, player=2, shot_outcome="Saved"))
    land(root, "events", events)
    land(
        root,
        "lineups",
        [
            lineup(1, 10, 1, "one", [stint("Forward", "00:00", "60:10"), stint("Wing", "60:10", None, 2)]),
            lineup(1, 20, 2, "two", [stint("Back", "00:00", None)]),
            lineup(1, 20, 2, "again", None, order=1),
            lineup(2, 20, 2, "newer", []),
            lineup(3, 10, 1, "old", []),
        ],
    )


@pytest.fixture
def place(tmp_path):
    full_landing(tmp_path / "landing")
    return tmp_path


def run(spark, place, **more):
    return pipeline.run(spark, str(place / "landing"), str(place / "wh"), **more)


def table(spark, place, name):
    return Warehouse(spark, str(place / "wh")).read(name)


def facts(spark, place):
    df = table(spark, place, "fact_player_match_stats")
    return sorted(rows(df.drop("aggregated_at")), key=repr)


def test_full_run(spark, place):
    done = run(spark, place)
    assert done == {
        "competitions": 1, "seasons": 1, "teams": 2, "players": 2, "matches": 2, "events": 5,
        "lineups": 3, "formation": 1, "fact": 3,
    }
    ev = {r["index"]: r for r in table(spark, place, "events").filter("match_id = 1").collect()}
    assert json.loads(ev[1].payload) == {"pass_goal_assist": True}
    assert json.loads(ev[0].payload) == {"tactics": {"formation": 442, "lineup": []}}
    assert str(ev[2].location_x) == "60.25" and ev[2].outcome == "Goal" and ev[2].timestamp is None
    m = table(spark, place, "matches").filter("match_id = 1").first()
    assert (str(m.match_date), m.kick_off, m.stadium_name, m.referee_name) == ("2022-12-05", "16:00:00", None, "R")
    players = {r.player_id: r.player_nickname for r in table(spark, place, "players").collect()}
    assert players == {1: "one", 2: "newer"}  # first within a match, last match over all
    one = table(spark, place, "fact_player_match_stats").filter("match_id = 1 and player_id = 1").first()
    assert (str(one.minutes_played), one.position_played, one.is_starter) == ("90.00", "Forward", True)
    assert (one.assists, one.goals, str(one.xg)) == (1, 1, "0.4000")
    assert rows(table(spark, place, "team_match_formation"), "formation_code", "to_minute") == [("442", None)]
    states = rows(runlog.run_states(table(spark, place, "ingestion_runs")), "status", "matches_processed", "events_processed")
    assert states == [("success", 2, 5)]


def test_running_again_changes_nothing(spark, place):
    run(spark, place)
    before = facts(spark, place)
    run(spark, place)
    assert facts(spark, place) == before
    assert table(spark, place, "events").count() == 5
    assert table(spark, place, "teams").count() == 2


def test_failed_run_leaves_all_tables(spark, place, monkeypatch):
    run(spark, place)
    names = [t for t in S.TABLES if t not in ("ingestion_runs", "embedding_documents")]
    before = {t: sorted(rows(table(spark, place, t)), key=repr) for t in names}
    full_landing(place / "landing", goals_in_two=False)

    def fail(*_):
        raise RuntimeError("in the middle")

    monkeypatch.setattr(ingest, "player_match_stats", fail)
    with pytest.raises(RuntimeError, match="middle"):
        run(spark, place)
    assert {t: sorted(rows(table(spark, place, t)), key=repr) for t in names} == before
    states = rows(runlog.run_states(table(spark, place, "ingestion_runs")), "status")
    assert sorted(states) == [("failed",), ("success",)]
    wh = Warehouse(spark, str(place / "wh"))
    assert wh.drop_unused() > 0 and wh.drop_unused() == 0
    assert {t: sorted(rows(table(spark, place, t)), key=repr) for t in names} == before


def test_writes_of_one_load_show_at_its_end(spark, place):
    one, two = (Warehouse(spark, str(place / "wh")) for _ in range(2))
    with one.publishing():
        runlog.start(one, Scope())
        assert one.read("ingestion_runs").count() == 1 and two.read("ingestion_runs").count() == 0
        runlog.start(two, Scope())
    assert two.read("ingestion_runs").count() == 2
    assert spark.table(two.view("ingestion_runs")).count() == 2


def test_stored_tables_join_by_match_without_an_exchange(spark, place):
    run(spark, place)
    lineups, stints = (table(spark, place, t) for t in ("match_lineups", "match_lineup_positions"))
    joined = lineups.hint("merge").join(stints, "match_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    wh = Warehouse(spark, str(place / "wh"))
    pruned = wh.read("events").filter("competition_id = 9")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in pruned


def test_match_without_rows_disappears_and_others_stay(spark, place):
    run(spark, place)
    full_landing(place / "landing", goals_in_two=False)
    run(spark, place, match_ids=[2])
    assert {r[0] for r in facts(spark, place)} == {1}
    assert table(spark, place, "matches").count() == 2
    run(spark, place, match_ids=[2, 2])
    assert len(facts(spark, place)) == 2


def test_seasons_do_not_touch_each_other(spark, place):
    run(spark, place)
    run(spark, place, season_id=3)
    assert {r[0] for r in facts(spark, place)} == {1, 2, 3}
    assert table(spark, place, "seasons").count() == 2
    # the season is emptied completely
    wh = Warehouse(spark, str(place / "wh"))
    ingest.invalidate_analytics(wh, Scope(), None)
    assert {r[0] for r in facts(spark, place)} == {3}


def test_single_table_and_derived_steps(spark, place):
    wh = Warehouse(spark, str(place / "wh"))
    landing = Landing(spark, str(place / "landing"))
    ingest.run(landing, wh, Scope(), "matches")
    assert ingest.run(landing, wh, Scope(), "events") == {"events": 5}
    assert ingest.aggregate(wh, Scope(), "formation") == {"formation": 1}
    with pytest.raises(ValueError, match="unknown"):
        ingest.run(landing, wh, Scope(), "nothing")


def test_errors(spark, place):
    with pytest.raises(ValueError, match="skip both"):
        run(spark, place, skip_staging=True, skip_analytics=True)
    with pytest.raises(ValueError, match=r"\[99\]"):
        run(spark, place, match_ids=[1, 99])
    log = runlog.run_states(table(spark, place, "ingestion_runs"))
    status, message = rows(log, "status", "error_message")[0]
    assert status == "failed" and "99" in message
    with pytest.raises(ValueError, match="not found"):
        Landing(spark, str(place / "landing")).competition_row(Scope(1, 2))


def test_lineup_of_a_strange_team_is_an_error(spark, place):
    land(place / "landing", "lineups", [lineup(1, 77, 1, "x", [])])
    with pytest.raises(ValueError, match="T77"):
        run(spark, place)


def test_partitioned_landing_folder(spark, tmp_path):
    full_landing(tmp_path / "flat")
    for feed, season in (("events", 106), ("lineups", 106), ("matches", 106), ("competitions", 106)):
        text = (tmp_path / "flat" / feed / "part.json").read_text(encoding="utf-8")
        kept = [r for r in map(json.loads, text.splitlines()) if r.get("match_id") != 3]
        folder = feed if feed in ("matches", "competitions") else f"{feed}/competition_id=43/season_id={season}"
        land(tmp_path / "landing", folder, kept)
    landing = Landing(spark, str(tmp_path / "landing"))
    matches = landing.matches(Scope())
    got = landing.of_matches("events", Scope(), matches)
    assert got.count() == 5 and "season_id" not in got.columns
    assert landing.of_matches("events", Scope(43, 3), matches).count() == 0


def test_documents_are_rebuilt_and_embedded_once(spark, place):
    run(spark, place)
    wh = Warehouse(spark, str(place / "wh"))
    docs = documents.build(wh.tables(), Scope(), team_id=10, rival_id=20)
    wh.rebuild_documents(docs, documents.DOC_TYPES)
    stored = wh.read("embedding_documents")
    assert dict(rows(documents.counts_by_type(stored))) == {
        "match_report": 2, "tactical_pattern": 2, "player_profile": 2,
    }
    assert wh.store_embeddings() == 6
    assert wh.store_embeddings() == 0
    kept = rows(wh.read("embedding_documents"), "doc_id", "embedding")
    # rebuilding one type resets only its embeddings
    wh.rebuild_documents(docs.filter("doc_type = 'match_report'"), ["match_report"])
    open_rows = wh.read("embedding_documents").filter("embedding is null")
    assert {r[0] for r in rows(open_rows, "doc_type")} == {"match_report"}
    assert wh.store_embeddings() == 2
    assert sorted(kept, key=repr) == sorted(rows(wh.read("embedding_documents"), "doc_id", "embedding"), key=repr)


def test_table_presence(spark, place):
    run(spark, place)
    found = {r.scope: r.status for r in quality.check_tables(Warehouse(spark, str(place / "wh"))).collect()}
    assert found["events"] == "ok" and found["embedding_documents"] == "fail"
    assert set(found) == set(S.TABLES)
    wh = Warehouse(spark, str(place / "wh"))
    spark.range(3).write.saveAsTable(f"{wh.database}.left_over")
    extra = quality.check_tables(wh).filter("check = 'extra table'").collect()
    assert [(r.scope, r.status) for r in extra] == [("left_over", "warn")]


def test_snapshot(spark, tmp_path):
    df = spark.sql("select cast(1.50 as decimal(5,2)) as v, date '2022-12-05' as d")
    snapshot({"q": df}, str(tmp_path / "out"))
    text = next((tmp_path / "out" / "q").glob("*.json")).read_text()
    assert json.loads(text) == {"v": 1.5, "d": "2022-12-05"}


def test_first_team_row_wins(spark):
    data = [
        {**match(2), "home_team_country_name": "second"},
        {**match(1), "home_team_country_name": "first"},
    ]
    raw = spark.createDataFrame([{k: v for k, v in d.items()} for d in data], S.RAW_MATCHES)
    out = {r.team_id: (r.country_name, r.team_gender) for r in normalise.teams(raw).collect()}
    assert out == {10: ("first", "male"), 20: (None, None)}


def test_stored_tables_are_written_once(spark, tables, place):
    again = tables.stored("teams")
    assert rows(again.teams.orderBy("team_id"), "team_id") == rows(tables.teams.orderBy("team_id"), "team_id")
    assert again.teams.inputFiles() and "events.parquet" not in again.teams.inputFiles()[0]
    kept = Warehouse(spark, str(place / "wh")).tables()
    assert kept.stored("teams", "facts") is kept
