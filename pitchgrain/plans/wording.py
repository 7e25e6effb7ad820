"""Fixed wording of documents, match-up context and prompts.

Fixed values: search results and prompts depend on every character. %s marks are filled in
order.
"""

from __future__ import annotations

from dataclasses import dataclass

MATCH_REPORT = (
    "%s match report — %s %s-%s %s (%s, %s). Result: %s %s. "
    "Expected goals: %s %s xG vs %s %s xG. "
    "Defensive actions (tackles+interceptions+pressures+blocks): %s %s, %s %s. "
    "%s applied %s defensive actions against %s, indicating %s."
)
HIGH_PRESS = "a high-intensity pressing approach"
MEASURED = "a measured defensive approach"
HIGH_PRESS_FROM = 160

TACTICAL_PATTERN = (
    "Tactical pattern — %s at %s (%s matches). Formations used: %s. "
    "Defensive profile: %s tackles, %s interceptions, %s pressures, %s blocks. "
    "Attacking output: %s goals, %s xG, pass completion %s (%s/%s)."
)

PLAYER_PROFILE = (
    "Player profile — %s (%s, %s) at %s: %s matches, %s minutes. "
    "Attacking: %s goals, %s assists, %s shots, %s xG. Passing: %s/%s (%s). "
    "Defending: %s tackles, %s interceptions, %s pressures, %s blocks."
)
UNKNOWN_POSITION = "unknown position"

RIVAL_HEADER = "## 상대팀 프로파일 — %s [출처: analytics.team_match_formation, fact_player_match_stats]"
RIVAL_LINE = (
    "%s: %s경기, 포메이션 %s, %s골 %sxG, 수비액션(태클 %s/인터셉트 %s/압박 %s/블록 %s), "
    "패스성공 %s/%s."
)
MEETING_HEADER = "\n## 직전 맞대결 (match_id=%s) [출처: staging.matches, team_match_formation]"
MEETING_LINE = "%s %s: %s %s-%s %s."
FORMATION_LINE = "  - %s %s (%s'~%s)"
UNTIL_END = "종료"
APPEARED_HEADER = "\n## 그 경기 %s 출전 선수 [출처: fact_player_match_stats match_id=%s]"
APPEARED_LINE = (
    "  - %s (%s, %s, %s분): 패스 %s/%s, 태클 %s, 인터셉트 %s, 압박 %s, %s골 %s도움"
)
STARTED = "선발"
CAME_ON = "교체"
SQUAD_HEADER = (
    "\n## %s 가용 선수 풀 (%s 시즌 집계) [출처: analytics.fact_player_match_stats team_id=%s]"
)
SQUAD_LINE = (
    "  - %s (%s): %s경기 %s분, %s골 %s도움 %sxG, 패스 %s/%s, 태클 %s/인터셉트 %s/압박 %s/블록 %s"
)
TACTICAL_SEARCH = "%s pressing tactics formation against %s"
HITS_HEADER = "## 벡터 유사 검색 결과 (pgvector cosine) [출처: analytics.embedding_documents]"
HIT_LINE = "  - [%s ref=%s score=%s] %s"
PROMPT = "%s\n\n=== SQL 실측 데이터 ===\n%s\n\n=== 검색된 유사 사례 ===\n%s\n\n=== 질문 ===\n%s\n"
# Own wording, no fixed value: the rival and the match come from the question.
GUIDANCE = (
    "Opponent: %s. Last meeting: match %s. Draft a one-page briefing for the staff from the sections below, "
    "which are all that is known; say so where they leave a question open. Start with the opponent's habits "
    "and weak spots, go on to your side's plan and the people who carry it out, and end with the risks. Quote "
    "numbers as they stand, and after each paragraph name in brackets the section it rests on."
)


@dataclass(frozen=True)
class Labels:
    """How the event and the team in focus are called. A missing team label is the team's name."""

    event: str = "World Cup 2022"
    event_short: str = "WC2022"
    team_title: str | None = None  # "South Korea"
    team_short: str | None = None  # "Korea"
    team_local: str | None = None  # "한국"
    key_prefix: str = "focus"  # metadata keys: focus_score, focus_xg
