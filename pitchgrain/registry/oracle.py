"""The DuckDB statement for each registered query."""

from __future__ import annotations

from pitchgrain import schemas as S
from pitchgrain.functions.encoder import QUERY_PREFIX
from pitchgrain.plans import wording as W
from pitchgrain.plans.quality import METRIC_EVENTS
from pitchgrain.plans.search import CODE_BITS, CODE_TABLES, FREE_BITS
from pitchgrain.registry.base_sql import half_up, with_tables

STATEMENTS: dict[str, str] = {}


def says(name: str, query: str, **extra: str) -> None:
    STATEMENTS[name] = with_tables(query, **extra)


def big(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n.split('.')[-1]}" for n in names)


FACT_COUNTS = (
    "passes_attempted", "passes_completed", "shots", "shots_on_target", "goals", "assists",
    "tackles", "interceptions", "pressures", "blocks", "dribbles_attempted", "dribbles_completed",
    "carries", "yellow_cards", "red_cards",
)

says(
    "fact_player_match_stats",
    f"""
    SELECT {big('match_id', 'player_id', 'team_id')}, CAST(minutes_played AS DOUBLE) AS minutes_played,
           is_starter, position_played, {big(*FACT_COUNTS)},
           CAST(pass_completion_rate AS DOUBLE) AS pass_completion_rate,
           CAST(NULL AS BIGINT) AS progressive_passes,
           CAST(xg AS DOUBLE) AS xg, CAST(0 AS DOUBLE) AS xa
    FROM fact""",
)
TIMELINE = f"""
    SELECT {big('match_id', 'team_id', 'from_minute', 'to_minute')}, formation_code,
           source_event_type
    FROM tl"""
says("team_match_formation", TIMELINE)
says("match_formation_timeline", TIMELINE)
says(
    "formation_at_minute",
    """
    SELECT CAST(p.match_id AS BIGINT) AS match_id, CAST(p.team_id AS BIGINT) AS team_id,
           CAST(p.minute AS BIGINT) AS minute, p.events, tl.formation_code
    FROM pts p LEFT JOIN tl ON tl.match_id = p.match_id AND tl.team_id = p.team_id
         AND tl.from_minute <= p.minute AND (tl.to_minute IS NULL OR p.minute < tl.to_minute)""",
    pts="SELECT match_id, team_id, minute, count(*) AS events FROM ev GROUP BY ALL",
)
says(
    "validation_counts",
    """
    SELECT 'matches' AS item, count(*) AS n FROM ms
    UNION ALL SELECT 'events', count(*) FROM ev
    UNION ALL SELECT 'fact', count(*) FROM fact
    UNION ALL SELECT 'formation', count(*) FROM tl""",
)
says(
    "goals_by_stage",
    f"""
    SELECT competition_stage, count(*) AS matches,
           {half_up('sum(home_score + away_score)', 'count(*)', 2)} AS avg_total_goals,
           CAST(sum(home_score + away_score) AS BIGINT) AS total_goals
    FROM ms JOIN stage USING (competition_stage)
    GROUP BY competition_stage""",
)
says(
    "top_xg",
    f"""
    SELECT player_name, team_name, CAST(CAST(sum(xg) AS DECIMAL(28,3)) AS DOUBLE) AS total_xg,
           CAST(sum(shots) AS BIGINT) AS shots, CAST(sum(goals) AS BIGINT) AS goals,
           {half_up('sum(minutes_played)', 'count(DISTINCT match_id)', 1)} AS avg_mins_per_match
    FROM fs JOIN player USING (player_id) JOIN team USING (team_id)
    GROUP BY player_id, player_name, team_name HAVING sum(xg) > 0
    ORDER BY CAST(sum(xg) AS DECIMAL(28,3)) DESC, player_id, team_name LIMIT 10""",
)
says(
    "pass_accuracy_vs_result",
    f"""
    SELECT result, count(*) AS team_matches,
           round(avg(CAST(pc AS DOUBLE) / pa), 4) AS avg_pass_completion_rate,
           {half_up('sum(pa)', 'count(*)', 1)} AS avg_passes_attempted
    FROM results JOIN passing USING (match_id, team_id) WHERE pa > 0 GROUP BY result""",
    results="""
    SELECT match_id, team_id, ['loss', 'draw', 'win'][2 + sign(team_score - opp_score)::INT] AS result FROM sides""",
    passing="""
    SELECT match_id, team_id, sum(passes_attempted) AS pa, sum(passes_completed) AS pc FROM fact GROUP BY ALL""",
)
says(
    "pass_under_pressure",
    f"""
    SELECT CASE WHEN under_pressure IS TRUE THEN 'under_pressure' ELSE 'no_pressure' END
             AS pressure_state,
           count(*) AS pass_attempts, count(*) FILTER (WHERE outcome IS NULL) AS passes_completed,
           {half_up('count(*) FILTER (WHERE outcome IS NULL)', 'count(*)', 4)} AS completion_rate
    FROM ev WHERE type = 'Pass' GROUP BY 1""",
)
says(
    "pass_pressure_drop",
    f"""
    SELECT {half_up('calm.good', 'calm.n', 4)} AS rate_no_pressure, {half_up('hot.good', 'hot.n', 4)} AS rate_under_pressure,
           round((CAST(calm.good AS DOUBLE) / calm.n - CAST(hot.good AS DOUBLE) / hot.n) * 100, 2) AS drop_pp
    FROM (SELECT * FROM passes WHERE NOT pressed) calm, (SELECT * FROM passes WHERE pressed) hot""",
    passes="""
    SELECT coalesce(under_pressure, false) AS pressed, count(*) AS n, count(*) - count(outcome) AS good
    FROM ev WHERE type = 'Pass' GROUP BY 1""",
)
says(
    "opponent_defense",
    """
    SELECT CAST(s.match_id AS BIGINT) AS match_id, CAST(s.team_id AS BIGINT) AS team_id,
           CAST(match_date AS VARCHAR) AS match_date, competition_stage,
           team_name AS opponent_name, home_score || '-' || away_score AS score, side,
           CAST(sum(tackles) AS BIGINT) AS opp_tackles,
           CAST(sum(interceptions) AS BIGINT) AS opp_interceptions,
           CAST(sum(pressures) AS BIGINT) AS opp_pressures,
           CAST(sum(blocks) AS BIGINT) AS opp_blocks, CAST(sum(def) AS BIGINT) AS opp_def_actions
    FROM sides s JOIN team ot ON ot.team_id = s.opponent_id
         JOIN fact f ON f.match_id = s.match_id AND f.team_id = s.opponent_id
    GROUP BY ALL""",
)
says(
    "finishing_efficiency",
    """
    SELECT player_name, team_name, CAST(sum(goals) AS BIGINT) AS goals,
           CAST(round(sum(xg), 3) AS DOUBLE) AS total_xg,
           CAST(round(sum(goals) - sum(xg), 3) AS DOUBLE) AS goals_minus_xg,
           CAST(sum(shots) AS BIGINT) AS shots
    FROM fs JOIN player USING (player_id) JOIN team USING (team_id)
    GROUP BY player_id, player_name, team_name HAVING sum(shots) >= 3
    ORDER BY round(sum(goals) - sum(xg), 3) DESC, player_id, team_name LIMIT 8""",
)
says(
    "defence_by_stage",
    f"""
    SELECT competition_stage, count(*) AS matches,
           {half_up('sum(def)', 'count(*)', 0)} AS avg_def_actions_per_match
    FROM ms JOIN defended USING (match_id) WHERE competition_stage IN (SELECT competition_stage FROM stage)
    GROUP BY competition_stage""",
    defended="SELECT match_id, sum(def) AS def FROM share GROUP BY match_id",
)
says(
    "xg_balance",
    f"""
    SELECT {big('match_id', 'team_id')}, CAST(match_date AS VARCHAR) AS match_date,
           competition_stage, opponent_name AS opponent, home_score || '-' || away_score AS score,
           CAST(round(team_xg, 2) AS DOUBLE) AS team_xg, CAST(round(opp_xg, 2) AS DOUBLE) AS opp_xg,
           CAST(round(team_xg - opp_xg, 2) AS DOUBLE) AS xg_diff
    FROM vs""",
)
says(
    "focus_matches",
    f"""
    SELECT {big('match_id', 'team_id', 'opponent_id', 'team_score', 'opp_score')},
           CAST(match_date AS VARCHAR) AS match_date, competition_stage, opponent_name,
           CAST(round(team_xg, 2) AS DOUBLE) AS team_xg, CAST(round(opp_xg, 2) AS DOUBLE) AS opp_xg,
           CAST(team_def AS BIGINT) AS team_def_actions, CAST(opp_def AS BIGINT) AS opp_def_actions
    FROM vs""",
)
PROFILE_COUNTS = ("passes_attempted", "passes_completed", "tackles", "interceptions", "pressures", "blocks")
says(
    "team_aggregates",
    f"""
    SELECT {big('team_id', 'matches', 'goals', *PROFILE_COUNTS)}, team_name,
           CAST(round(xg, 2) AS DOUBLE) AS xg
    FROM agg JOIN team USING (team_id)""",
)
says("team_formations", f"SELECT {big('team_id')}, formations FROM forms")
says(
    "player_profiles",
    f"""
    SELECT {big('player_id', 'team_id', 'matches', 'goals', 'assists', 'shots', *PROFILE_COUNTS)},
           player_name, team_name, position, CAST(round(minutes, 0) AS DOUBLE) AS minutes,
           CAST(round(xg, 2) AS DOUBLE) AS xg
    FROM prof""",
)
says(
    "h2h_meta",
    f"""
    SELECT {big('match_id', 'home_score', 'away_score', 'home_team_id', 'away_team_id')},
           CAST(match_date AS VARCHAR) AS match_date, competition_stage,
           ht.team_name AS home, awt.team_name AS away
    FROM m JOIN team ht ON ht.team_id = home_team_id JOIN team awt ON awt.team_id = away_team_id""",
)
says(
    "h2h_formations",
    f"""
    SELECT {big('match_id', 'team_id', 'from_minute', 'to_minute')}, team_name, formation_code
    FROM tl JOIN team USING (team_id)""",
)
says(
    "h2h_players",
    f"""
    SELECT {big('match_id', 'team_id', 'player_id', 'passes_completed', 'passes_attempted',
                'tackles', 'interceptions', 'pressures', 'goals', 'assists')},
           player_name, position_played, CAST(minutes_played AS DOUBLE) AS minutes_played, is_starter
    FROM fact JOIN player USING (player_id)""",
)
says(
    "bench_match_pass_agg",
    """
    SELECT CAST(match_id AS BIGINT) AS match_id, CAST(player_id AS BIGINT) AS player_id,
           count(*) FILTER (WHERE type = 'Pass') AS passes_attempted,
           count(*) FILTER (WHERE type = 'Pass' AND outcome IS NULL) AS passes_completed,
           count(*) FILTER (WHERE type = 'Shot') AS shots
    FROM ev WHERE player_id IS NOT NULL GROUP BY match_id, player_id""",
)
says(
    "bench_team_defence",
    """
    SELECT CAST(match_id AS BIGINT) AS match_id, CAST(team_id AS BIGINT) AS team_id,
           CAST(sum(tackles) AS BIGINT) AS tackles, CAST(sum(interceptions) AS BIGINT) AS interceptions,
           CAST(sum(pressures) AS BIGINT) AS pressures, CAST(sum(blocks) AS BIGINT) AS blocks
    FROM fact GROUP BY match_id, team_id""",
)
says(
    "bench_player_rows",
    f"""
    SELECT {big('match_id', 'player_id', 'passes_attempted', 'passes_completed')},
           CAST(xg AS DOUBLE) AS xg, CAST(pass_completion_rate AS DOUBLE) AS pass_completion_rate,
           CAST(minutes_played AS DOUBLE) AS minutes_played
    FROM fact""",
)
says(
    "bench_formation",
    f"""SELECT {big('match_id', 'team_id', 'from_minute', 'to_minute')}, formation_code FROM tl""",
)

# ---------------------------------------------------------------- counts

says(
    "staging_counts",
    """
    SELECT 'competitions' AS item, count(DISTINCT competition_id) AS n FROM m
    UNION ALL SELECT 'seasons', count(*) FROM season
    UNION ALL SELECT 'teams', count(*) FROM team
    UNION ALL SELECT 'players', count(*) FROM player
    UNION ALL SELECT 'matches', count(*) FROM ms
    UNION ALL SELECT 'events (season)', count(*) FROM ev JOIN ms USING (match_id)
    UNION ALL SELECT 'match_lineups (season)', count(*) FROM lu JOIN ms USING (match_id)""",
)
says(
    "analytics_counts",
    """
    SELECT 'fact (season)' AS item, count(*) AS n FROM fs
    UNION ALL SELECT 'fact (all seasons)', count(*) FROM fact
    UNION ALL SELECT 'fact (team, season)', count(*) FROM fs WHERE team_id = 0
    UNION ALL SELECT 'formation (season)', count(*) FROM tl JOIN ms USING (match_id)""",
)
says(
    "compression",
    """
    SELECT e AS events, f AS facts, CAST(e AS DOUBLE) / f AS ratio,
           '~' || printf('%.0f', CAST(e AS DOUBLE) / f) || 'x' AS reduction
    FROM n""",
    n="""
    SELECT (SELECT count(*) FROM ev JOIN ms USING (match_id)) AS e, (SELECT count(*) FROM fs) AS f""",
)
says(
    "rows_per_match",
    "SELECT CAST(match_id AS BIGINT) AS match_id, count(*) AS rows FROM ev GROUP BY match_id",
)

# ---------------------------------------------------------------- looking into matches

says(
    "goal_timeline",
    f"""
    SELECT {big('match_id')}, CAST(idx AS BIGINT) AS index,
           CASE WHEN period = 5 THEN 'shootout' ELSE 'regular' END AS phase,
           {big('minute', 'second')}, team_name AS team,
           coalesce(player_nickname, player_name, '?') AS player,
           '  ' || minute || '''' || printf('%02d', second) || '"  ' || rpad(team_name, 12, ' ') || ' '
             || coalesce(player_nickname, player_name, '?')
             || ' (xG ' || printf('%.2f', CAST(xg AS DOUBLE)) || ')' AS line
    FROM ev LEFT JOIN team USING (team_id) LEFT JOIN player USING (player_id)
    WHERE type = 'Shot' AND outcome = 'Goal'""",
)
says(
    "event_type_share",
    """
    SELECT type, n, CAST(n AS DOUBLE) / total * 100 AS pct,
           printf('%.1f', CAST(n AS DOUBLE) / total * 100) || '%' AS share
    FROM c
    ORDER BY n DESC, type LIMIT 12""",
    c="SELECT type, count(*) AS n, (SELECT count(*) FROM ev) AS total FROM ev GROUP BY type",
)
says(
    "shot_summary",
    f"""
    SELECT {big('match_id', 'team_id')}, team_name, count(*) AS shots,
           count(*) FILTER (WHERE outcome = 'Goal') AS goals, CAST(sum(xg) AS DOUBLE) AS xg
    FROM ev JOIN team USING (team_id) WHERE type = 'Shot' GROUP BY match_id, team_id, team_name""",
)
says(
    "event_sample",
    f"""
    SELECT {big('match_id')}, CAST(idx AS BIGINT) AS index, {big('period', 'minute', 'second')},
           team_name AS team, player_name AS player, type, outcome
    FROM ev LEFT JOIN team USING (team_id) LEFT JOIN player USING (player_id)
    WHERE type IN ('Goal', 'Shot', 'Substitution', 'Foul Committed', 'Pass')
    ORDER BY match_id, idx LIMIT 8""",
)

# ---------------------------------------------------------------- documents, context


def text(*parts: str) -> str:
    """SQL joining literal and column parts; a part starting with ' is a literal."""
    return " || ".join(parts)


def two(col: str) -> str:
    """A number as text with two decimals."""
    return f"CAST(CAST({col} AS DECIMAL(28,2)) AS VARCHAR)"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN printf('%.1f', CAST({part} AS DOUBLE) / {whole} * 100) || '%' ELSE 'n/a' END"


def doc(kind: str, ref: str, content: str, metadata: str, source: str) -> str:
    return f"""
    SELECT '{kind}' AS doc_type, CAST({ref} AS BIGINT) AS ref_id, {content} AS content,
           CAST(json_object({metadata}) AS VARCHAR) AS metadata
    FROM {source}"""


REPORT = doc(
    "match_report",
    "match_id",
    text(
        "'World Cup 2022 match report — '", "team_name", "' '", "team_score", "'-'", "opp_score",
        "' '", "opponent_name", "' ('", "competition_stage", "', '", "CAST(match_date AS VARCHAR)",
        "'). Result: '", "team_name", "' '",
        "CASE WHEN team_score > opp_score THEN 'win' WHEN team_score < opp_score THEN 'loss' ELSE 'draw' END",
        "'. Expected goals: '", "team_name", "' '", f"coalesce({two('team_xg')}, 'n/a')", "' xG vs '",
        "opponent_name", "' '", f"coalesce({two('opp_xg')}, 'n/a')",
        "' xG. Defensive actions (tackles+interceptions+pressures+blocks): '", "team_name", "' '",
        "coalesce(CAST(team_def AS VARCHAR), 'n/a')", "', '", "opponent_name", "' '",
        "coalesce(CAST(opp_def AS VARCHAR), 'n/a')", "'. '", "opponent_name", "' applied '",
        "coalesce(CAST(opp_def AS VARCHAR), 'n/a')", "' defensive actions against '", "team_name",
        "', indicating '",
        "CASE WHEN opp_def >= 160 THEN 'a high-intensity pressing approach' ELSE 'a measured defensive approach' END",
        "'.'",
    ),
    "'match_id', match_id, 'opponent_id', opponent_id, 'opponent_name', opponent_name, "
    "'stage', competition_stage, 'focus_score', team_score, 'opp_score', opp_score, "
    "'focus_xg', coalesce(CAST(round(team_xg, 2) AS DOUBLE), 0), "
    "'opp_xg', coalesce(CAST(round(opp_xg, 2) AS DOUBLE), 0), "
    "'opp_def_actions', CAST(coalesce(opp_def, 0) AS BIGINT)",
    "vs JOIN team USING (team_id)",
)
PATTERN = doc(
    "tactical_pattern",
    "team_id",
    text(
        "'Tactical pattern — '", "team_name", "' at World Cup 2022 ('", "matches",
        "' matches). Formations used: '", "coalesce(formations, 'n/a')", "'. Defensive profile: '",
        "tackles", "' tackles, '", "interceptions", "' interceptions, '", "pressures",
        "' pressures, '", "blocks", "' blocks. Attacking output: '", "goals", "' goals, '", two("xg"),
        "' xG, pass completion '", pct("passes_completed", "passes_attempted"), "' ('",
        "passes_completed", "'/'", "passes_attempted", "').'",
    ),
    "'team_id', team_id, 'team_name', team_name, "
    "'formations', coalesce(string_split(formations, ', '), []), 'matches', matches, "
    "'tackles', CAST(tackles AS BIGINT), 'interceptions', CAST(interceptions AS BIGINT), "
    "'pressures', CAST(pressures AS BIGINT), 'blocks', CAST(blocks AS BIGINT), "
    "'goals', CAST(goals AS BIGINT), 'xg', CAST(round(xg, 2) AS DOUBLE)",
    "agg JOIN team USING (team_id) LEFT JOIN forms USING (team_id)",
)
PROFILE = doc(
    "player_profile",
    "player_id",
    text(
        "'Player profile — '", "player_name", "' ('", "team_name", "', '",
        "coalesce(position, 'unknown position')", "') at World Cup 2022: '", "matches",
        "' matches, '", "minutes", "' minutes. Attacking: '", "goals", "' goals, '", "assists",
        "' assists, '", "shots", "' shots, '", two("xg"), "' xG. Passing: '", "passes_completed",
        "'/'", "passes_attempted", "' ('", pct("passes_completed", "passes_attempted"),
        "'). Defending: '", "tackles", "' tackles, '", "interceptions", "' interceptions, '",
        "pressures", "' pressures, '", "blocks", "' blocks.'",
    ),
    "'player_id', player_id, 'player_name', player_name, 'team_id', team_id, "
    "'team_name', team_name, 'position', position, 'minutes', CAST(minutes AS DOUBLE), "
    "'goals', CAST(goals AS BIGINT), 'assists', CAST(assists AS BIGINT), "
    "'xg', CAST(round(xg, 2) AS DOUBLE)",
    "prof",
)
says("doc_match_reports", REPORT)
says("doc_tactical_patterns", PATTERN)
says("doc_player_profiles", PROFILE)
says(
    "doc_counts",
    """
    SELECT 'match_report' AS doc_type, count(*) AS n FROM vs WHERE team_id = 0
    UNION ALL
    SELECT 'tactical_pattern', count(*) FROM agg
    WHERE team_id = 0 OR team_id IN (SELECT opponent_id FROM sides WHERE team_id = 0)
    UNION ALL
    SELECT 'player_profile', count(*) FROM prof WHERE team_id IN (0, 4)""",
)


def context(section: int, line: str, source: str, *keys: str) -> str:
    padded = [*keys, *["0"] * (3 - len(keys))]
    named = ", ".join(f"CAST({k} AS DOUBLE) AS key{i + 1}" for i, k in enumerate(padded))
    return f"""
    SELECT CAST(mu.match_id AS BIGINT) AS matchup_id, CAST({section} AS BIGINT) AS section, {named},
           {line} AS line
    FROM {source}"""


CONTEXT = "\nUNION ALL\n".join(
    [
        context(
            1,
            text(
                "'## 상대팀 프로파일 — '", "coalesce(team_name, CAST(mu.away_team_id AS VARCHAR))",
                "' [출처: analytics.team_match_formation, fact_player_match_stats]'",
            ),
            "ms mu LEFT JOIN tagg ON tagg.team_id = mu.away_team_id",
        ),
        context(
            2,
            text(
                "team_name", "': '", "matches", "'경기, 포메이션 '", "coalesce(formations, 'n/a')",
                "', '", "goals", "'골 '", two("xg"), "'xG, 수비액션(태클 '", "tackles",
                "'/인터셉트 '", "interceptions", "'/압박 '", "pressures", "'/블록 '", "blocks",
                "'), 패스성공 '", "passes_completed", "'/'", "passes_attempted", "'.'",
            ),
            "ms mu JOIN tagg ON tagg.team_id = mu.away_team_id",
        ),
        context(
            3,
            text(
                "chr(10)", "'## 직전 맞대결 (match_id='", "mu.match_id",
                "') [출처: staging.matches, team_match_formation]'",
            ),
            "ms mu",
        ),
        context(
            4,
            text(
                "competition_stage", "' '", "CAST(match_date AS VARCHAR)", "': '", "ht.team_name",
                "' '", "home_score", "'-'", "away_score", "' '", "awt.team_name", "'.'",
            ),
            "ms mu JOIN team ht ON ht.team_id = home_team_id "
            "JOIN team awt ON awt.team_id = away_team_id",
        ),
        context(
            5,
            text(
                "'  - '", "team_name", "' '", "formation_code", "' ('", "from_minute", "'''~'",
                "coalesce(to_minute || '''', '종료')", "')'",
            ),
            "ms mu JOIN tl ON tl.match_id = mu.match_id JOIN team USING (team_id)",
            "team_id", "from_minute",
        ),
        context(
            6,
            text(
                "chr(10)", "'## 그 경기 Team '", "home_team_id",
                "' 출전 선수 [출처: fact_player_match_stats match_id='", "mu.match_id", "']'",
            ),
            "ms mu WHERE EXISTS (SELECT 1 FROM fact f WHERE f.match_id = mu.match_id "
            "AND f.team_id = mu.home_team_id)",
        ),
        context(
            7,
            text(
                "'  - '", "player_name", "' ('", "coalesce(position_played, '?')", "', '",
                "CASE WHEN is_starter THEN '선발' ELSE '교체' END", "', '", two("minutes_played"),
                "'분): 패스 '", "passes_completed", "'/'", "passes_attempted", "', 태클 '", "tackles",
                "', 인터셉트 '", "interceptions", "', 압박 '", "pressures", "', '", "goals",
                "'골 '", "assists", "'도움'",
            ),
            "ms mu JOIN fact f ON f.match_id = mu.match_id AND f.team_id = mu.home_team_id "
            "JOIN player USING (player_id)",
            "CASE WHEN is_starter THEN 0 ELSE 1 END", "-minutes_played", "player_id",
        ),
        context(
            8,
            text(
                "chr(10)", "'## Team '", "home_team_id",
                "' 가용 선수 풀 (WC2022 시즌 집계) [출처: analytics.fact_player_match_stats team_id='",
                "home_team_id", "']'",
            ),
            "ms mu",
        ),
        context(
            9,
            text(
                "'  - '", "player_name", "' ('", "coalesce(position, '?')", "'): '", "matches",
                "'경기 '", "minutes", "'분, '", "goals", "'골 '", "assists", "'도움 '", two("xg"),
                "'xG, 패스 '", "passes_completed", "'/'", "passes_attempted", "', 태클 '", "tackles",
                "'/인터셉트 '", "interceptions", "'/압박 '", "pressures", "'/블록 '", "blocks",
            ),
            "ms mu JOIN prof ON prof.team_id = mu.home_team_id",
            "-minutes", "player_id",
        ),
    ]
)
TEAM_TOTALS = "SELECT * FROM agg JOIN team USING (team_id) LEFT JOIN forms USING (team_id)"
says("matchup_context", CONTEXT, tagg=TEAM_TOTALS)

# ---------------------------------------------------------------- vectors

_before, _between, _after = W.GUIDANCE.split("%s")
GUIDANCE = (f"'{_before}'", "rival", f"'{_between}'", "match_id", f"'{_after}'")
# The first 60 bits of a hash of what identifies a document.
DOC_ID = """CAST('0x' || substr(md5(concat_ws('|', doc_type, ref_id, coalesce(json_extract_string(metadata, '$.opponent_id'),
            json_extract_string(metadata, '$.team_id'), ''))), 1, 15) AS BIGINT)"""


def text_vectors(source: str, key: str, prefix: str = "") -> dict[str, str]:
    """CTEs giving the token-hash vector of ``text`` per ``key`` of a relation: (key, dim, c, x)."""
    return {
        f"{prefix}word": f"""
    SELECT {key}, w, count(*) AS times
    FROM (SELECT {key}, unnest(regexp_split_to_array(lower(text), '[ \\t\\r\\n\\f\\v]+')) AS w
          FROM {source})
    WHERE w <> '' GROUP BY ALL""",
        f"{prefix}slot": f"""
    SELECT {key}, h % 384 AS dim, sum(CASE WHEN (h // 384) % 2 = 0 THEN times ELSE -times END) AS c
    FROM (SELECT {key}, times, CAST('0x' || substr(md5(w), 1, 8) AS UBIGINT) AS h FROM {prefix}word)
    GROUP BY ALL""",
        f"{prefix}vec": f"""
    SELECT {key}, dim, c,
           CAST(CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS DOUBLE)
           AS FLOAT) AS DOUBLE) AS x
    FROM {prefix}slot""",
    }


says(
    "embed_documents",
    """
    SELECT d.doc_id, CAST(coalesce(used, 0) AS BIGINT) AS used, coalesce(norm, 0) AS norm,
           coalesce(weighted_sum, 0) AS weighted_sum
    FROM documents d LEFT JOIN measured USING (doc_id)""",
    **text_vectors("documents", "doc_id"),
    measured="""
    SELECT doc_id, count(*) FILTER (WHERE c <> 0) AS used, round(sqrt(sum(x * x)), 5) AS norm,
           round(sum(x * (dim + 1)), 4) AS weighted_sum
    FROM vec GROUP BY doc_id""",
)
says(
    "prompt_batch",
    f"""
    SELECT CAST(q.match_id AS BIGINT) AS question_id,
           {text(*GUIDANCE, "chr(10)", "chr(10)", "'=== SQL 실측 데이터 ==='", "chr(10)", "facts",
                 "chr(10)", "chr(10)", "'=== 검색된 유사 사례 ==='", "chr(10)", f"'{W.HITS_HEADER}'",
                 "coalesce(chr(10) || found, '')", "chr(10)", "chr(10)", "'=== 질문 ==='", "chr(10)",
                 "question", "chr(10)")} AS prompt
    FROM question q JOIN facttext USING (match_id) LEFT JOIN foundtext USING (match_id)""",
    tagg=TEAM_TOTALS,
    ctx=CONTEXT,
    question="""
    SELECT match_id, 'Who should start against ' || awt.team_name || '?' AS question,
           ht.team_name AS focus, awt.team_name AS rival
    FROM ms JOIN team ht ON ht.team_id = home_team_id JOIN team awt ON awt.team_id = away_team_id""",
    facttext="""
    SELECT matchup_id AS match_id,
           string_agg(line, chr(10) ORDER BY section, key1, key2, key3) AS facts
    FROM ctx GROUP BY matchup_id""",
    src=f"""
    SELECT {DOC_ID} AS doc_id, doc_type, ref_id, content AS text
    FROM (SELECT * FROM ({PATTERN}) UNION ALL SELECT * FROM ({PROFILE}))""",
    asked=f"""
    SELECT match_id * 2 AS query_id, match_id, 0 AS source, 'tactical_pattern' AS want, 3 AS k,
           '{QUERY_PREFIX}' || rival || ' pressing tactics formation against ' || focus AS text
    FROM question
    UNION ALL
    SELECT match_id * 2 + 1, match_id, 1, 'player_profile', 5, '{QUERY_PREFIX}' || question
    FROM question""",
    **text_vectors("src", "doc_id", "doc"),
    **text_vectors("asked", "query_id", "ask"),
    docnorm="SELECT doc_id, sqrt(sum(x * x)) AS n FROM docvec GROUP BY doc_id",
    asknorm="SELECT query_id, sqrt(sum(x * x)) AS n FROM askvec GROUP BY query_id",
    dots="""
    SELECT query_id, doc_id, sum(a.x * d.x) AS dot
    FROM askvec a JOIN docvec d USING (dim) GROUP BY query_id, doc_id""",
    scored="""
    SELECT asked.query_id, match_id, source, k, src.doc_id, doc_type, ref_id, src.text,
           round(coalesce(dot, 0) / (an.n * dn.n), 12) AS s
    FROM asked JOIN src ON doc_type = want
         JOIN asknorm an ON an.query_id = asked.query_id JOIN docnorm dn ON dn.doc_id = src.doc_id
         LEFT JOIN dots ON dots.query_id = asked.query_id AND dots.doc_id = src.doc_id""",
    ranked="""
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank
    FROM scored""",
    foundtext="""
    SELECT match_id, string_agg('  - [' || doc_type || ' ref=' || ref_id || ' score='
             || printf('%.3f', s) || '] ' || text, chr(10) ORDER BY source, rank) AS found
    FROM ranked WHERE rank <= k GROUP BY match_id""",
)
says(
    "document_search",
    """
    SELECT CAST(query_id AS BIGINT) AS query_id, rank, doc_id, doc_type, CAST(ref_id AS BIGINT) AS ref_id, text AS content
    FROM ranked WHERE rank <= 3""",
    src=f"""
    SELECT {DOC_ID} AS doc_id, doc_type, ref_id, content AS text
    FROM (SELECT * FROM ({REPORT}) UNION ALL SELECT * FROM ({PROFILE}))""",
    asked=f"""
    SELECT team_id AS query_id, '{QUERY_PREFIX}' || team_name || ' pressing and passing' AS text FROM team""",
    **text_vectors("src", "doc_id", "doc"),
    **text_vectors("asked", "query_id", "ask"),
    dots="""
    SELECT query_id, doc_id, sum(a.x * d.x) AS dot FROM askvec a JOIN docvec d USING (dim) GROUP BY query_id, doc_id""",
    lengths="SELECT doc_id, sqrt(sum(x * x)) AS n FROM docvec GROUP BY doc_id",
    asked_lengths="SELECT query_id, sqrt(sum(x * x)) AS m FROM askvec GROUP BY query_id",
    ranked="""
    SELECT al.query_id, src.doc_id, doc_type, ref_id, src.text, row_number() OVER (
             PARTITION BY al.query_id ORDER BY round(coalesce(dot, 0) / (n * m), 12) DESC, src.doc_id) AS rank
    FROM src JOIN lengths ln ON ln.doc_id = src.doc_id JOIN asked_lengths al ON true
         LEFT JOIN dots ON dots.query_id = al.query_id AND dots.doc_id = src.doc_id""",
)
ELEMENTS = """
    SELECT vec_id, label, unnest(embedding) AS x,
           generate_subscripts(embedding, 1) AS i FROM embeddings"""
says(
    "vector_topk",
    """
    SELECT CAST(0 AS BIGINT) AS query_id, row_number() OVER (ORDER BY s DESC, vec_id) AS rank,
           vec_id AS doc_id, CAST(label AS VARCHAR) AS doc_type, round(s, 6) AS score
    FROM scored ORDER BY s DESC, vec_id LIMIT 10""",
    el=ELEMENTS,
    mean="SELECT list(a ORDER BY i) AS v FROM (SELECT i, avg(CAST(x AS DOUBLE)) AS a FROM el GROUP BY i)",
    scored="""
    SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM mean)) AS s
    FROM embeddings""",
)
says(
    "vector_topk_batch",
    """
    SELECT query_id, rank, doc_id, doc_type, score FROM ranked WHERE rank <= k""",
    el=ELEMENTS,
    mean="""
    SELECT label, list(a ORDER BY i) AS v
    FROM (SELECT label, i, avg(CAST(x AS DOUBLE)) AS a FROM el GROUP BY label, i) GROUP BY label""",
    q="""
    SELECT label * 2 AS query_id, label AS want, 3 AS k, v FROM mean
    UNION ALL SELECT label * 2 + 1, NULL, 5, v FROM mean""",
    ranked="""
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id AS doc_id, CAST(label AS VARCHAR) AS doc_type, k,
           round(s, 6) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank
    FROM (SELECT q.query_id, q.k, e.vec_id, e.label,
                 list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.v) AS s
          FROM embeddings e JOIN q ON q.want IS NULL OR q.want = e.label)""",
)

says(
    "vector_topk_lsh",
    """
    SELECT query_id, rank, doc_id, doc_type, score FROM ranked WHERE rank <= k""",
    el=ELEMENTS,
    mean="SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM el GROUP BY label, i",
    signs=f"""
    SELECT i, b // {CODE_BITS} AS t, b % {CODE_BITS} AS b, CASE WHEN substr(md5(i || ':' || b), 1, 1) >= '8' THEN 1 ELSE -1 END AS s
    FROM (SELECT DISTINCT i FROM el), unnest(range({CODE_TABLES * CODE_BITS})) AS u(b)""",
    doc_codes="""
    SELECT vec_id, t, sum(CASE WHEN p > 0 THEN 1 << CAST(b AS INTEGER) ELSE 0 END) AS code
    FROM (SELECT vec_id, t, b, sum(s * CAST(x AS DOUBLE)) AS p FROM el JOIN signs USING (i) GROUP BY ALL) GROUP BY ALL""",
    query_codes=f"""
    SELECT label, t, sum(CASE WHEN p > 0 AND r > {FREE_BITS} THEN 1 << CAST(b AS INTEGER) ELSE 0 END) AS code,
           sum(CASE WHEN r > {FREE_BITS} THEN 1 << CAST(b AS INTEGER) ELSE 0 END) AS sure
    FROM (SELECT *, row_number() OVER (PARTITION BY label, t ORDER BY abs(p), b) AS r
          FROM (SELECT label, t, b, sum(s * x) AS p FROM mean JOIN signs USING (i) GROUP BY ALL)) GROUP BY ALL""",
    found="SELECT DISTINCT q.label, d.vec_id FROM query_codes q JOIN doc_codes d ON q.t = d.t AND CAST(d.code AS BIGINT) & CAST(q.sure AS BIGINT) = CAST(q.code AS BIGINT)",
    whole="SELECT label, list(x ORDER BY i) AS v FROM mean GROUP BY label",
    ranked="""
    SELECT CAST(m.label * 2 + a.wide AS BIGINT) AS query_id, vec_id AS doc_id, CAST(e.label AS VARCHAR) AS doc_type, a.k,
           round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), m.v), 6) AS score,
           row_number() OVER (PARTITION BY m.label, a.wide ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), m.v) DESC, vec_id) AS rank
    FROM whole m JOIN found USING (label) JOIN embeddings e USING (vec_id), (VALUES (0, 3), (1, 5)) AS a(wide, k)
    WHERE a.wide = 1 OR m.label = e.label""",
)

says(
    "stored_upsert",
    f"""
    SELECT {big('team_id')}, CASE WHEN team_id % 2 = 0 THEN team_name || ' again' ELSE team_name END AS team_name FROM team
    UNION ALL SELECT CAST(team_id + 1000 AS BIGINT), team_name FROM team WHERE team_id % 5 = 0""",
)
says(
    "stored_replace",
    f"""
    SELECT {big('match_id')}, CAST(CASE WHEN match_id % 3 = 0 THEN home_score + 1 ELSE home_score END AS BIGINT) AS home_score
    FROM ms WHERE match_id % 6 <> 3""",
)

# ---------------------------------------------------------------- normalised landing rows

says(
    "competitions_dim",
    """
    SELECT CAST(competition_id AS BIGINT) AS competition_id, 'Competition 43' AS competition_name,
           CAST(NULL AS VARCHAR) AS country_name, 'male' AS competition_gender,
           'statsbomb_open' AS data_source
    FROM season WHERE competition_id = 43 AND season_id = 106""",
)
says(
    "seasons_dim",
    f"""SELECT {big('competition_id', 'season_id')}, 'Season ' || season_id AS season_name FROM season""",
)
says(
    "normalize_matches",
    f"""
    SELECT {big('match_id', 'competition_id', 'season_id', 'home_team_id', 'away_team_id',
                'home_score', 'away_score')},
           CAST(match_date AS VARCHAR) AS match_date,
           CASE WHEN match_id % 3 <> 0 THEN printf('%02d:30:00', CAST(match_id % 24 AS INTEGER)) END
             AS kick_off,
           'available' AS match_status, competition_stage,
           CAST(match_id // 70 AS BIGINT) AS match_week,
           CASE WHEN match_id % 2 <> 0 THEN 'Ground ' || home_team_id END AS stadium_name,
           CAST(NULL AS VARCHAR) AS referee_name, 'statsbomb_open' AS data_source
    FROM m""",
)
says(
    "teams_dim",
    """
    SELECT CAST(team_id AS BIGINT) AS team_id, team_name, 'male' AS team_gender,
           CASE WHEN team_id < 3 THEN team_name
                ELSE 'Country ' || (SELECT min(match_id) FROM m WHERE away_team_id = team_id) END
             AS country_name,
           'statsbomb_open' AS data_source
    FROM team WHERE team_id IN (SELECT home_team_id FROM m UNION SELECT away_team_id FROM m)""",
)
says(
    "players_dim",
    """
    SELECT DISTINCT ON (player_id) CAST(player_id AS BIGINT) AS player_id,
           'Player ' || player_id AS player_name,
           'Nick ' || match_id || '-' || ordinal AS player_nickname,
           CAST(NULL AS VARCHAR) AS country_name, 'statsbomb_open' AS data_source
    FROM pos ORDER BY player_id, match_id DESC, ordinal""",
)
says(
    "normalize_events",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, {big('match_id')}, CAST(idx AS BIGINT) AS index,
           {big('period')}, CASE WHEN k % 9 <> 0 THEN '00:01:02.500' END AS timestamp,
           {big('minute', 'second')}, type, {big('team_id', 'player_id')},
           CASE WHEN k % 20 <> 19 THEN k * CAST(1.25 AS DOUBLE) END AS location_x,
           CASE WHEN k % 20 <> 19 THEN k * CAST(0.75 AS DOUBLE) END AS location_y,
           CASE WHEN k % 6 <> 0 THEN k / CAST(8 AS DOUBLE) END AS duration,
           under_pressure, outcome, CAST(xg AS DOUBLE) AS shot_statsbomb_xg
    FROM ev""",
)


def announced(player: str, on_player: bool) -> str:
    number = f"CAST({player} % 40 AS INTEGER)"
    name = f"'Announced ' || {player}"
    position = "json_object('id', k % 5, 'name', 'P' || (k % 5))"
    if on_player:
        who = f"json_object('id', {player}, 'name', {name}, 'jersey_number', {number})"
        return f"json_object('player', {who}, 'position', {position})"
    who = f"json_object('id', {player}, 'name', {name})"
    return f"json_object('player', {who}, 'position', {position}, 'jersey_number', {number})"


says(
    "event_payload",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CAST(CASE
             WHEN assist_key IS NOT NULL THEN json_object('pass_goal_assist', true)
             WHEN duel = 'Tackle' THEN json_object('duel_type', duel)
             WHEN type = 'Foul Committed' AND card = 'Yellow Card'
               THEN json_object('foul_committed_card', card)
             WHEN type = 'Bad Behaviour' AND card = 'Yellow Card'
               THEN json_object('bad_behaviour_card', card)
             WHEN formation IS NOT NULL
               THEN json_object('tactics', json_object('formation', CAST(formation AS INTEGER),
                    'lineup', json_array({announced('user_id', False)},
                                         {announced('(user_id + 6)', True)})))
             ELSE json_object() END AS VARCHAR) AS payload
    FROM ev JOIN (SELECT event_id, user_id FROM b) USING (event_id)""",
)
says(
    "lineups",
    f"""
    SELECT {big('match_id', 'team_id', 'player_id')}, CAST(player_id % 30 AS BIGINT) AS jersey_number,
           is_starter
    FROM lu""",
)
says(
    "lineup_positions",
    f"""
    SELECT {big('match_id', 'team_id', 'player_id')}, 
           row_number() OVER (PARTITION BY match_id, team_id, player_id ORDER BY ordinal) - 1 AS ordinal,
           position_name, CAST(NULL AS BIGINT) AS statsbomb_position_id,
           {big('from_period', 'from_minute')}, CAST(NULL AS BIGINT) AS to_period,
           {big('to_minute')}, start_reason, CAST(NULL AS VARCHAR) AS end_reason
    FROM pos""",
)
for _name, _same in (("teams", "teams_dim"), ("players", "players_dim"), ("lineups", "lineups"), ("positions", "lineup_positions")):
    STATEMENTS[f"landed_{_name}"] = STATEMENTS[_same]
says(
    "unplaced_lineups",
    """
    SELECT DISTINCT CAST(match_id AS BIGINT) AS match_id, team_name
    FROM lu JOIN team USING (team_id) JOIN m USING (match_id)
    WHERE away_score > home_score AND team_id = away_team_id""",
)
SLOTS = """
    SELECT match_id, team_id, event_id AS idx, formation, k, 0 AS slot_no, user_id AS player_id
    FROM ev JOIN (SELECT event_id, user_id FROM b) USING (event_id)
    WHERE type = 'Starting XI' AND formation IS NOT NULL
    UNION ALL
    SELECT match_id, team_id, event_id, formation, k, 1, user_id + 6
    FROM ev JOIN (SELECT event_id, user_id FROM b) USING (event_id)
    WHERE type = 'Starting XI' AND formation IS NOT NULL"""
says(
    "starting_xi",
    f"""
    SELECT CAST(s.match_id AS BIGINT) AS match_id, CAST(idx AS BIGINT) AS index, {big('slot_no')},
           CAST(s.team_id AS BIGINT) AS team_id, team_name, formation,
           CAST(s.player_id AS BIGINT) AS player_id,
           CASE WHEN lu.player_id IS NOT NULL AND p.player_id IS NOT NULL
                THEN coalesce(player_nickname, player_name)
                ELSE '#' || (s.player_id % 40) || ' Announced ' || s.player_id END AS label,
           'P' || (k % 5) AS position
    FROM slots s LEFT JOIN lu ON lu.match_id = s.match_id AND lu.player_id = s.player_id
         LEFT JOIN player p ON p.player_id = s.player_id
         LEFT JOIN team ON team.team_id = s.team_id""",
    slots=SLOTS,
)
says(
    "bench_players",
    f"""
    SELECT {big('match_id', 'team_id', 'player_id')}, CAST(NULL AS BIGINT) AS jersey_number,
           coalesce(player_nickname, player_name) AS label
    FROM lu JOIN player USING (player_id)
    WHERE NOT EXISTS (SELECT 1 FROM slots s WHERE s.match_id = lu.match_id
                      AND s.team_id = lu.team_id AND s.player_id = lu.player_id)""",
    slots=SLOTS,
)

# ---------------------------------------------------------------- merges

says(
    "upsert_latest",
    """
    SELECT CAST(player_id AS BIGINT) AS player_id, type AS last_type,
           CAST(match_id AS BIGINT) AS match_id, CAST(idx AS BIGINT) AS index
    FROM (SELECT * FROM late
          UNION ALL
          SELECT * FROM early WHERE player_id NOT IN (SELECT player_id FROM late))""",
    early="""
    SELECT DISTINCT ON (player_id) player_id, type, match_id, idx FROM ev
    WHERE player_id IS NOT NULL AND period = 1 ORDER BY player_id, idx""",
    late="""
    SELECT DISTINCT ON (player_id) player_id, type, match_id, idx FROM ev
    WHERE player_id IS NOT NULL AND period <> 1 ORDER BY player_id, idx DESC""",
)
says(
    "scoped_replace",
    """
    SELECT CAST(match_id AS BIGINT) AS match_id, events, 'old' AS version
    FROM c WHERE match_id NOT IN (SELECT match_id FROM ms)
    UNION ALL
    SELECT match_id, events, 'new' FROM c WHERE goals > 1 AND match_id IN (SELECT match_id FROM ms)""",
    c="""
    SELECT match_id, count(*) AS events,
           count(*) FILTER (WHERE type = 'Shot' AND outcome = 'Goal') AS goals
    FROM ev GROUP BY match_id""",
)
says(
    "run_log_state",
    """
    SELECT CAST(match_id AS VARCHAR) AS run_id, match_date || ' 00:00:00' AS started_at,
           CASE WHEN goals > 0 THEN match_date || ' 01:00:00' END AS finished_at,
           CASE WHEN goals = 0 THEN 'running' WHEN home_score >= away_score THEN 'success'
                ELSE 'failed' END AS status,
           CASE WHEN goals > 0 THEN CAST(1 AS BIGINT) END AS matches_processed,
           CASE WHEN goals > 0 THEN CAST(goals AS BIGINT) END AS events_processed,
           CASE WHEN goals > 0 AND home_score < away_score THEN 'away win' END AS error_message
    FROM (SELECT *, home_score + away_score AS goals FROM m)""",
)

# ---------------------------------------------------------------- quality


def finding(check: str, scope: str, observed: str, expected: str, status: str, source: str) -> str:
    return f"""
    SELECT '{check}' AS "check", {scope} AS scope, CAST({observed} AS DOUBLE) AS observed,
           CAST({expected} AS DOUBLE) AS expected, {status} AS status
    FROM {source}"""


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def judged(good: str, otherwise: str) -> str:
    return f"CASE WHEN {good} THEN 'ok' ELSE '{otherwise}' END"


# per table: its source here and how many rows of each column are filled (c: the column's own
# count, all: every row, none: no row)
COLUMNS = {
    "competitions": ("comp", {
        "competition_id": "all", "competition_name": "all", "country_name": "none",
        "competition_gender": "none", "data_source": "all", "ingested_at": "all",
    }),
    "seasons": ("season", {"competition_id": "all", "season_id": "all", "season_name": "all"}),
    "teams": ("team", {
        "team_id": "c", "team_name": "c", "team_gender": "none", "country_name": "none",
        "data_source": "all", "ingested_at": "all",
    }),
    "players": ("player", {
        "player_id": "c", "player_name": "c", "player_nickname": "c", "country_name": "none",
        "data_source": "all", "ingested_at": "all",
    }),
    "matches": ("m", {
        "match_id": "c", "competition_id": "c", "season_id": "c", "match_date": "c",
        "kick_off": "none", "home_team_id": "c", "away_team_id": "c", "home_score": "c",
        "away_score": "c", "match_status": "none", "competition_stage": "c", "match_week": "none",
        "stadium_name": "none", "referee_name": "none", "data_source": "all", "ingested_at": "all",
    }),
    "events": ("ev", {
        "event_id": "c", "match_id": "c", "index": "all", "period": "c", "timestamp": "none",
        "minute": "c", "second": "c", "type": "c", "team_id": "c", "player_id": "c",
        "location_x": "c", "location_y": "c", "duration": "none", "under_pressure": "c",
        "outcome": "c", "shot_statsbomb_xg": "xg", "payload": "all", "ingested_at": "all",
    }),
    "match_lineups": ("lu", {
        "match_id": "c", "team_id": "c", "player_id": "c", "jersey_number": "none",
        "is_starter": "c",
    }),
    "match_lineup_positions": ("pos", {
        "match_id": "c", "team_id": "c", "player_id": "c", "ordinal": "c", "position_name": "c",
        "statsbomb_position_id": "none", "from_period": "c", "from_minute": "c",
        "to_period": "none", "to_minute": "c", "start_reason": "c", "end_reason": "none",
    }),
    "fact_player_match_stats": ("fact", {
        "match_id": "c", "player_id": "c", "team_id": "c", "minutes_played": "c",
        "is_starter": "c", "position_played": "c", "passes_attempted": "c",
        "passes_completed": "c", "pass_completion_rate": "c", "progressive_passes": "none",
        "shots": "c", "shots_on_target": "c", "goals": "c", "assists": "c", "xg": "c", "xa": "all",
        "tackles": "c", "interceptions": "c", "pressures": "c", "blocks": "c",
        "dribbles_attempted": "c", "dribbles_completed": "c", "carries": "c", "yellow_cards": "c",
        "red_cards": "c", "aggregated_at": "all",
    }),
    "team_match_formation": ("tl", {
        "match_id": "c", "team_id": "c", "from_minute": "c", "to_minute": "c",
        "formation_code": "c", "source_event_type": "c",
    }),
}
COMP = "SELECT DISTINCT competition_id, 'Competition 43' AS competition_name FROM m"


def filled_count(column: str, how: str) -> str:
    return {"all": "count(*)", "none": "0", "c": f"count({column})"}.get(how, f"count({how})")


def schema_statement(table: str) -> str:
    source, columns = COLUMNS[table]
    return union(
        [
            finding("column", f"'{table}.{c}'", filled_count(c, how), "count(*)", "'ok'", source)
            for c, how in columns.items()
        ]
    )


says("dq_schema", union([schema_statement(t) for t in COLUMNS]), comp=COMP)


def key_statement(table: str, keys: list[str], required: list[str]) -> str:
    source = COLUMNS[table][0]
    names = ["idx" if k == "index" else k for k in keys]
    twice = f"(SELECT {', '.join(names)} FROM {source} GROUP BY ALL HAVING count(*) > 1)"
    n = "count(*)"
    parts = [finding("duplicate key", f"'{table}'", n, "0", judged(f"{n} = 0", "fail"), twice)]
    for c in [*keys, *required]:
        how = COLUMNS[table][1][c]
        nulls = f"count(*) - {filled_count(c, how)}"
        parts.append(
            finding("null", f"'{table}.{c}'", nulls, "0", judged(f"{nulls} = 0", "fail"), source)
        )
    return union(parts)


says(
    "dq_keys",
    union([key_statement(t, S.PRIMARY_KEYS[t], S.NOT_NULL[t]) for t in COLUMNS]),
    comp=COMP,
)


def reference_statement(child: str, keys: list[str], parent: str, parent_keys: list[str]) -> str:
    source, target = COLUMNS[child][0], COLUMNS[parent][0]
    match = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(keys, parent_keys))
    given = " AND ".join(f"c.{a} IS NOT NULL" for a in keys)
    orphans = (
        f"(SELECT 1 FROM {source} c WHERE {given} "
        f"AND NOT EXISTS (SELECT 1 FROM {target} p WHERE {match}))"
    )
    n = "count(*)"
    scope = f"'{child}({', '.join(keys)}) -> {parent}'"
    return finding("orphan", scope, n, "0", judged(f"{n} = 0", "fail"), orphans)


says("dq_foreign_keys", union([reference_statement(*fk) for fk in S.FOREIGN_KEYS]), comp=COMP)
says(
    "dq_damaged",
    union(
        [
            finding("duplicate key", "'teams'", "count(*)", "0", judged("count(*) = 0", "fail"), "twice"),
            finding("null", "'teams.team_id'", "count(*) - count(team_id)", "0", judged("count(*) = count(team_id)", "fail"), "broken"),
            finding("null", "'teams.team_name'", "count(*) - count(team_name)", "0", judged("count(*) = count(team_name)", "fail"), "broken"),
            finding("orphan", "'matches(home_team_id) -> teams'", "count(*)", "0", judged("count(*) = 0", "fail"), "stray"),
            finding("orphan", "'matches(away_team_id) -> teams'", "count(*)", "0", judged("count(*) = 0", "fail"), "away_stray"),
            finding("event id", "'events'", "count(*)", "0", judged("count(*) = 0", "warn"), "ev"),
        ]
    ),
    broken="SELECT team_id, team_name FROM team UNION ALL SELECT team_id, NULL FROM team WHERE team_id % 2 = 0",
    twice="SELECT team_id FROM broken GROUP BY 1 HAVING count(*) > 1",
    stray="SELECT 1 FROM m WHERE home_team_id + CASE WHEN match_id % 5 = 0 THEN 100 ELSE 0 END NOT IN (SELECT team_id FROM team)",
    away_stray="SELECT 1 FROM m WHERE away_team_id NOT IN (SELECT team_id FROM team)",
)
says(
    "dq_matches",
    union(
        [
            finding("season row", "'seasons'", "count(*)", "1", judged("count(*) >= 1", "fail"),
                    "season WHERE competition_id = 43 AND season_id = 106"),
            finding("season id shared", "'seasons'", "count(DISTINCT competition_id)", "NULL",
                    judged("count(DISTINCT competition_id) > 1", "warn"),
                    "season WHERE season_id = 106"),
            finding("match count", "'matches'", "count(*)", "64", judged("count(*) = 64", "warn"), "ms"),
            finding("stage", "competition_stage", "count(*)", "NULL", "'ok'",
                    "ms GROUP BY competition_stage"),
            finding("team matches", "'matches'", "count(*)", "NULL", judged("count(*) > 0", "warn"),
                    "sides WHERE team_id = 0"),
            finding("teams", "'matches'", "count(DISTINCT team_id)", "NULL", "'ok'", "sides"),
        ]
    ),
)


def having(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


says(
    "dq_event_profile",
    union(
        [
            finding("events", "'events'", "count(*)", "100000", judged("count(*) >= 100000", "warn"), "ev"),
            finding("located", "'events'", "count(location_x)", "count(*)", "'ok'", "ev"),
            finding("outcome filled", "'Pass'", "count(outcome)", "count(*)", "'ok'",
                    "ev WHERE type = 'Pass'"),
            finding("outcome filled", "'Shot'", "count(outcome)", "count(*)", "'ok'",
                    "ev WHERE type = 'Shot'"),
            finding("goals", "'Shot'", having("outcome = 'Goal'"), "NULL", "'ok'", "ev WHERE type = 'Shot'"),
            finding("assist key", "'Pass'", "count(assist_key)", "NULL",
                    judged("count(assist_key) > 0", "warn"), "ev"),
            finding("under pressure", "'events'", having("under_pressure"), "NULL", "'ok'", "ev"),
            finding("events per match", "'events'", "round(avg(n), 0)", "NULL", "'ok'",
                    "(SELECT count(*) AS n FROM ev GROUP BY match_id)"),
            finding("frequent type", "type", "n", "NULL", "'ok'", "top5"),
            finding("sparse attribute", "key", "n", "NULL", "'ok'", "keys"),
        ]
    ),
    top5="SELECT type, count(*) AS n FROM ev GROUP BY type ORDER BY n DESC, type LIMIT 5",
    keys="""
    SELECT key, count(*) AS n
    FROM (SELECT CASE WHEN assist_key IS NOT NULL THEN 'pass_goal_assist'
                      WHEN duel IS NOT NULL THEN 'duel_type'
                      WHEN type = 'Foul Committed' AND card IS NOT NULL THEN 'foul_committed_card'
                      WHEN type = 'Bad Behaviour' AND card IS NOT NULL THEN 'bad_behaviour_card'
                      WHEN formation IS NOT NULL THEN 'tactics' END AS key FROM ev)
    WHERE key IS NOT NULL GROUP BY key""",
)
WHERE = "match_id || '/' || team_id"
says(
    "dq_lineups",
    union(
        [
            finding("squad size", WHERE, "squad", "NULL", "'ok'", "squads"),
            finding("with positions", WHERE, "placed", "squad", judged("placed > 0", "fail"), "squads"),
            finding("bench", WHERE, "squad - placed", "NULL", judged("squad > placed", "warn"), "squads"),
        ]
    ),
    squads="""
    SELECT lu.match_id, lu.team_id, count(*) AS squad, count(p.player_id) AS placed
    FROM lu LEFT JOIN (SELECT DISTINCT match_id, team_id, player_id FROM pos) p
         ON p.match_id = lu.match_id AND p.team_id = lu.team_id AND p.player_id = lu.player_id
    GROUP BY ALL""",
)
says(
    "dq_formations",
    union(
        [
            finding("formation type", "type", "count(*)", "NULL", "'ok'", "shapes GROUP BY type"),
            finding("formation code", "formation", "count(*)", "NULL", "'ok'", "shapes GROUP BY formation"),
            finding("formation reports", "'events'", "n", "games", judged("n >= games", "warn"), "two"),
        ]
    ),
    two="SELECT (SELECT count(*) FROM shapes) AS n, (SELECT count(*) FROM m) AS games",
)
says(
    "dq_feasibility",
    union(
        [
            *[
                finding("metric source", f"'{metric}'", having(f"type = '{kind}'"), "NULL",
                        judged(f"{having(f'''type = '{kind}' ''')} > 0", "warn"), "ev")
                for metric, kind in METRIC_EVENTS.items()
            ],
            finding("metric source", "'cards'", having("type IN ('Foul Committed', 'Bad Behaviour')"),
                    "NULL", judged(f"{having('''type IN ('Foul Committed', 'Bad Behaviour')''')} > 0", "warn"),
                    "ev"),
            finding("fact rows", "'facts'", "f", "10000", judged("f <= 10000", "warn"), "vol"),
            finding("reduction", "'facts'", "round(CAST(e AS DOUBLE) / f, 0)", "NULL", "'ok'", "vol"),
        ]
    ),
    vol="""
    SELECT (SELECT count(*) FROM ev) AS e,
           (SELECT count(*) FROM (SELECT DISTINCT match_id, player_id FROM ev
                                  WHERE player_id IS NOT NULL)) AS f""",
)
