import json

from pyspark.sql import functions as F

from conftest import rows
from pitchgrain import schemas as S
from pitchgrain.operators.scope import Scope
from pitchgrain.plans import analytics as A
from pitchgrain.plans import documents as D
from pitchgrain.plans import matchup as M
from pitchgrain.plans.search import embed_pending
from pitchgrain.plans.tables import MatchTables
from pitchgrain.plans.wording import Labels

LABELS = Labels(team_title="South Korea", team_short="Korea", team_local="한국", key_prefix="korea")


def small(spark, opp_pressures=160, score=(2, 1)):
    def one(ddl, **values):
        names = S.columns(ddl)
        return tuple(values.get(n) for n in names)

    matches = spark.createDataFrame(
        [
            one(
                S.MATCHES, match_id=5, competition_id=43, season_id=106, home_team_id=1, away_team_id=2,
                home_score=score[0], away_score=score[1], competition_stage="Round of 16",
            )
        ],
        S.MATCHES,
    ).withColumn("match_date", F.lit("2022-12-05").cast("date"))
    zero = dict.fromkeys(
        "passes_attempted passes_completed shots shots_on_target goals assists tackles interceptions "
        "pressures blocks dribbles_attempted dribbles_completed carries yellow_cards red_cards".split(), 0
    )
    base = {**zero, "match_id": 5, "is_starter": True}
    from decimal import Decimal

    facts = spark.createDataFrame(
        [
            one(S.FACTS, **{**base, "player_id": 11, "team_id": 1, "minutes_played": Decimal(90), "xg": Decimal("1.2550"),
                "passes_attempted": 16, "passes_completed": 13, "goals": 2, "tackles": 3, "position_played": "Forward"}),
            one(S.FACTS, **{**base, "player_id": 21, "team_id": 2, "minutes_played": Decimal("45.5"), "xg": Decimal("0.5"),
                "pressures": opp_pressures, "is_starter": False}),
        ],
        S.FACTS,
    )
    empty = lambda ddl: spark.createDataFrame([], ddl)
    return MatchTables(
        competitions=empty(S.COMPETITIONS),
        seasons=empty(S.SEASONS),
        teams=spark.createDataFrame([one(S.TEAMS, team_id=i, team_name=n) for i, n in ((1, "Korea Republic"), (2, "Brazil"))], S.TEAMS),
        players=spark.createDataFrame([one(S.PLAYERS, player_id=i, player_name=f"P{i}") for i in (11, 21)], S.PLAYERS),
        matches=matches,
        events=empty(S.EVENTS),
        lineups=empty(S.LINEUPS),
        positions=empty(S.POSITIONS),
        facts=facts,
        timeline=spark.createDataFrame(
            [(5, 1, 0, 60, "442", "Starting XI"), (5, 1, 60, None, "433", "Tactical Shift")], S.TIMELINE
        ),
    )


def test_match_report(spark):
    doc = D.match_reports(small(spark), Scope(), 1, LABELS).first()
    assert doc.content == (
        "World Cup 2022 match report — South Korea 2-1 Brazil (Round of 16, 2022-12-05). "
        "Result: Korea win. Expected goals: Korea 1.26 xG vs Brazil 0.50 xG. "
        "Defensive actions (tackles+interceptions+pressures+blocks): Korea 3, Brazil 160. "
        "Brazil applied 160 defensive actions against Korea, "
        "indicating a high-intensity pressing approach."
    )
    assert json.loads(doc.metadata) == {
        "match_id": 5, "opponent_id": 2, "opponent_name": "Brazil", "stage": "Round of 16",
        "korea_score": 2, "opp_score": 1, "korea_xg": 1.26, "opp_xg": 0.5, "opp_def_actions": 160,
    }


def test_match_report_of_a_quiet_opponent_and_without_score(spark):
    quiet = D.match_reports(small(spark, opp_pressures=159), Scope(), 1, LABELS).first().content
    assert quiet.endswith("indicating a measured defensive approach.")
    assert D.match_reports(small(spark, score=(None, None)), Scope(), 1, LABELS).count() == 0


def test_tactical_pattern_and_profile(spark):
    t = small(spark)
    pattern = {r.ref_id: r for r in D.tactical_patterns(t, Scope(), 1).collect()}
    assert pattern[1].content == (
        "Tactical pattern — Korea Republic at World Cup 2022 (1 matches). Formations used: 442, 433. "
        "Defensive profile: 3 tackles, 0 interceptions, 0 pressures, 0 blocks. "
        "Attacking output: 2 goals, 1.26 xG, pass completion 81.2% (13/16)."
    )
    assert "Formations used: n/a." in pattern[2].content and "pass completion n/a (0/0)" in pattern[2].content
    assert json.loads(pattern[1].metadata)["formations"] == ["442", "433"]
    profile = {r.ref_id: r for r in D.player_documents(t, Scope(), [1, 2]).collect()}
    assert profile[11].content == (
        "Player profile — P11 (Korea Republic, Forward) at World Cup 2022: 1 matches, 90 minutes. "
        "Attacking: 2 goals, 0 assists, 0 shots, 1.26 xG. Passing: 13/16 (81.2%). "
        "Defending: 3 tackles, 0 interceptions, 0 pressures, 0 blocks."
    )
    assert "(Brazil, unknown position)" in profile[21].content and " 46 minutes" in profile[21].content
    meta = json.loads(profile[21].metadata)
    assert meta["position"] is None and meta["minutes"] == 46.0


def test_document_ids_are_unique_and_stable(spark):
    t = small(spark)
    docs = D.build(t, Scope(), 1, 2)
    ids = [r[0] for r in rows(docs, "doc_id")]
    assert len(ids) == len(set(ids)) == 5
    assert sorted(ids) == sorted(r[0] for r in rows(D.build(t, Scope(), 1, 2), "doc_id"))
    only = D.build(t, Scope(), 1, 2, ["player_profile"])
    assert {r[0] for r in rows(only, "doc_type")} == {"player_profile"}


def test_result_labels_and_rounding(spark):
    t = small(spark, score=(None, None))
    assert {r[0] for r in rows(A.pass_accuracy_vs_result(t, Scope()), "result")} == {"loss"}
    facts = t.facts.withColumn(
        "xg", F.when(F.col("team_id") == 1, F.lit(0.494)).otherwise(F.lit(0.418)).cast("decimal(18,4)")
    )
    r = A.xg_balance(t.having(facts=facts), Scope(), 1).first()
    assert (str(r.team_xg), str(r.opp_xg), str(r.xg_diff)) == ("0.49", "0.42", "0.08")


def matchup(spark, rival=2, match_id=5):
    return spark.createDataFrame([(7, 1, rival, match_id)], "matchup_id bigint, focus_team_id int, rival_team_id int, match_id int")


def text_of(spark, t, m):
    lines = M.context_lines(t, Scope(), m, LABELS)
    return M.joined_lines(lines, "matchup_id", ["section", "key1", "key2", "key3"], "text").first().text


def test_context(spark):
    assert text_of(spark, small(spark), matchup(spark)) == "\n".join(
        [
            "## 상대팀 프로파일 — Brazil [출처: analytics.team_match_formation, fact_player_match_stats]",
            "Brazil: 1경기, 포메이션 n/a, 0골 0.50xG, 수비액션(태클 0/인터셉트 0/압박 160/블록 0), 패스성공 0/0.",
            "\n## 직전 맞대결 (match_id=5) [출처: staging.matches, team_match_formation]",
            "Round of 16 2022-12-05: Korea Republic 2-1 Brazil.",
            "  - Korea Republic 442 (0'~60')",
            "  - Korea Republic 433 (60'~종료)",
            "\n## 그 경기 한국 출전 선수 [출처: fact_player_match_stats match_id=5]",
            "  - P11 (Forward, 선발, 90.00분): 패스 13/16, 태클 3, 인터셉트 0, 압박 0, 2골 0도움",
            "\n## 한국 가용 선수 풀 (WC2022 시즌 집계) [출처: analytics.fact_player_match_stats team_id=1]",
            "  - P11 (Forward): 1경기 90분, 2골 0도움 1.26xG, 패스 13/16, 태클 3/인터셉트 0/압박 0/블록 0",
        ]
    )


def test_context_without_rival_or_meeting(spark):
    text = text_of(spark, small(spark), matchup(spark, rival=99, match_id=77))
    assert text.startswith("## 상대팀 프로파일 — 99 [")
    assert "직전 맞대결" not in text and "출전 선수" not in text and "가용 선수 풀" in text


def test_prompt(spark):
    t = small(spark)
    docs = embed_pending(D.build(t, Scope(), 1, 2))
    q = matchup(spark).withColumnRenamed("matchup_id", "question_id").withColumn("question", F.lit("Who is Forward P11?"))
    out = M.prompts(t, docs, Scope(), q, LABELS, guidance="GUIDE").collect()
    assert len(out) == 1
    text = out[0].prompt
    assert text.startswith("GUIDE\n\n=== SQL 실측 데이터 ===\n## 상대팀 프로파일 — Brazil")
    assert text.endswith("=== 질문 ===\nWho is Forward P11?\n")
    found = text.split("=== 검색된 유사 사례 ===\n")[1].split("\n\n=== 질문")[0].split("\n")
    assert found[0].startswith("## 벡터 유사 검색 결과")
    kinds = [line.split("[")[1].split(" ")[0] for line in found[1:]]
    assert kinds == ["tactical_pattern"] * 2 + ["player_profile"] * 2
    assert {line.split("ref=")[1].split(" ")[0] for line in found[3:5]} == {"11", "21"}
