"""The match tables as DuckDB common table expressions over the ``events`` view.

Each name maps to (tables it needs, body). ``with_tables`` emits only what a statement uses.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "b0": """
        SELECT event_id, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS d,
               CAST((hour(ts) * 60 + minute(ts)) // 15 AS INTEGER) AS minute,
               CAST(second(ts) AS INTEGER) AS second,
               CAST(user_id % 6 AS INTEGER) AS team_id
        FROM events""",
    "b": """
        SELECT *, d * 10 + slot AS match_id,
               CASE WHEN k % 50 = 49 THEN 5 WHEN minute < 48 THEN 1 ELSE 2 END AS period,
               CASE event_type
                 WHEN 'click' THEN 'Pass'
                 WHEN 'purchase' THEN 'Shot'
                 WHEN 'view' THEN CASE WHEN k < 50 THEN 'Pressure' ELSE 'Duel' END
                 WHEN 'error' THEN CASE WHEN k < 20 THEN 'Foul Committed'
                      WHEN k < 40 THEN 'Bad Behaviour' WHEN k < 60 THEN 'Interception'
                      WHEN k < 80 THEN 'Block' ELSE 'Dribble' END
                 ELSE CASE WHEN k < 15 THEN 'Starting XI' WHEN k < 45 THEN 'Tactical Shift'
                      ELSE 'Carry' END
               END AS type
        FROM (SELECT *, CASE WHEN team_id < 3 THEN team_id
                             ELSE (((team_id - 3 + d) % 3) + 3) % 3 END AS slot FROM b0)""",
    "ev": """
        SELECT event_id, match_id, event_id AS idx, period, minute, second, type, team_id, k, value,
               CASE WHEN k % 33 <> 32 THEN user_id END AS player_id,
               CASE WHEN k % 20 <> 19 THEN CAST(k * 1.2 AS DECIMAL(6,2)) END AS location_x,
               CASE WHEN k % 20 <> 19 THEN CAST(k * 0.8 AS DECIMAL(6,2)) END AS location_y,
               CASE WHEN k % 8 = 0 THEN true WHEN k % 8 <> 1 THEN false END AS under_pressure,
               CASE type WHEN 'Pass' THEN CASE WHEN k % 4 = 0 THEN 'Incomplete' END
                         WHEN 'Shot' THEN CASE k % 5 WHEN 0 THEN 'Goal' WHEN 1 THEN 'Saved'
                                                     ELSE 'Off T' END END AS outcome,
               CASE WHEN type = 'Shot' THEN CAST(least(value / 500, 0.99) AS DECIMAL(6,4)) END AS xg,
               CASE WHEN type = 'Pass' AND k % 10 = 1 THEN 'true' END AS assist_key,
               CASE WHEN type = 'Duel' THEN CASE WHEN k % 2 = 0 THEN 'Tackle' ELSE 'Aerial' END END
                 AS duel,
               CASE WHEN type = 'Foul Committed'
                    THEN CASE k % 3 WHEN 0 THEN 'Yellow Card' WHEN 1 THEN 'Red Card' END
                    WHEN type = 'Bad Behaviour'
                    THEN CASE k % 3 WHEN 0 THEN 'Yellow Card' WHEN 1 THEN 'Second Yellow' END
               END AS card,
               CASE WHEN type IN ('Starting XI', 'Tactical Shift') AND k % 13 <> 12
                    THEN CASE k % 4 WHEN 0 THEN '442' WHEN 1 THEN '433' WHEN 2 THEN '4231'
                                    ELSE '352' END END AS formation
        FROM b""",
    "m": """
        SELECT d * 10 + slot AS match_id, d, slot, 43 AS competition_id,
               CASE WHEN d IN (10, 20) THEN 3 ELSE 106 END AS season_id,
               DATE '2024-01-01' + CAST(d AS INTEGER) AS match_date,
               slot AS home_team_id,
               3 + (((slot - d) % 3) + 3) % 3 AS away_team_id,
               count(*) FILTER (WHERE type = 'Shot' AND k % 5 = 0 AND team_id < 3) AS home_score,
               count(*) FILTER (WHERE type = 'Shot' AND k % 5 = 0 AND team_id >= 3) AS away_score,
               CASE WHEN d < 18 THEN 'Group Stage' WHEN d < 24 THEN 'Round of 16'
                    WHEN d < 27 THEN 'Quarter-finals' WHEN d < 28 THEN 'Semi-finals'
                    WHEN d < 29 THEN '3rd Place Final' ELSE 'Final' END AS competition_stage
        FROM b GROUP BY d, slot""",
    "pos": """
        SELECT match_id, team_id, user_id AS player_id, event_id AS ordinal,
               'P' || (k % 5) AS position_name,
               CASE WHEN minute < 48 THEN 1 ELSE 2 END AS from_period,
               CASE WHEN k % 25 <> 24 THEN minute END AS from_minute,
               lead(minute) OVER (PARTITION BY match_id, user_id ORDER BY event_id) AS to_minute,
               CASE WHEN k % 3 = 0 THEN 'Starting XI' ELSE 'Substitution' END AS start_reason
        FROM b WHERE k % 33 <> 32 AND k % 7 <> 6""",
    "lu": """
        SELECT match_id, team_id, player_id, bool_or(start_reason = 'Starting XI') AS is_starter
        FROM pos GROUP BY ALL""",
    "team": "SELECT DISTINCT team_id, 'Team ' || team_id AS team_name FROM b",
    "player": """
        SELECT DISTINCT user_id AS player_id, 'Player ' || user_id AS player_name,
               CASE WHEN user_id % 2 = 1 THEN 'Nick ' || user_id END AS player_nickname FROM b""",
    "season": "SELECT DISTINCT competition_id, season_id FROM m",
    # ---- one long list of what each event adds to its player, as (metric, weight)
    "adds": """
        SELECT match_id, player_id, team_id, unnest([
               {'m': 'attempt', 'w': (type = 'Pass')::INT::DECIMAL(18,4)},
               {'m': 'arrived', 'w': (type = 'Pass' AND outcome IS NULL)::INT},
               {'m': 'assist', 'w': (type = 'Pass' AND assist_key IS NOT NULL)::INT},
               {'m': 'shot', 'w': (type = 'Shot')::INT},
               {'m': 'target', 'w': (type = 'Shot' AND outcome IN ('Goal', 'Saved'))::INT},
               {'m': 'goal', 'w': (type = 'Shot' AND outcome = 'Goal')::INT},
               {'m': 'chance', 'w': coalesce(xg, 0)},
               {'m': 'tackle', 'w': (type = 'Duel' AND duel = 'Tackle')::INT},
               {'m': type, 'w': 1},
               {'m': 'dribbled', 'w': (type = 'Dribble' AND outcome IS NULL)::INT},
               {'m': 'yellow', 'w': (card = 'Yellow Card')::INT},
               {'m': 'red', 'w': (card IN ('Red Card', 'Second Yellow'))::INT}], recursive := true)
        FROM ev WHERE player_id IS NOT NULL""",
    "tally": """
        SELECT match_id, player_id, max(team) AS team, map_from_entries(list((m, total))) AS v
        FROM (SELECT match_id, player_id, m, max(team_id) AS team, sum(coalesce(w, 0)) AS total
              FROM adds GROUP BY ALL)
        GROUP BY ALL""",
    # ---- stints written out minute by minute
    "on_pitch": """
        SELECT pos.*, len(range(CASE WHEN from_minute IS NULL THEN 0 ELSE from_minute END,
                                CASE WHEN from_minute IS NULL THEN 0 ELSE coalesce(to_minute, final) END)) AS stayed
        FROM pos JOIN (SELECT match_id, max(minute) AS final FROM ev GROUP BY 1) USING (match_id)""",
    "squad": """
        SELECT match_id, player_id, any_value(team_id) AS squad_team, sum(stayed) AS minutes,
               bool_or(start_reason = 'Starting XI') AS began,
               arg_min(position_name, {'s': -stayed, 'p': coalesce(from_period, 99),
                                       'm': coalesce(from_minute, 9999), 'o': ordinal}) AS place
        FROM on_pitch GROUP BY 1, 2""",
    "fact": """
        SELECT match_id, player_id, team_id, coalesce(minutes, 0) AS minutes_played,
               coalesce(began, false) AS is_starter, place AS position_played,
               passes_attempted, passes_completed,
               CASE WHEN passes_attempted > 0
                    THEN ((20000 * passes_completed + passes_attempted)
                          // (2 * passes_attempted)) / 10000.0 END AS pass_completion_rate,
               * EXCLUDE (match_id, player_id, team_id, minutes, began, place, passes_attempted, passes_completed),
               tackles + interceptions + pressures + blocks AS def
        FROM (SELECT match_id, player_id, coalesce(squad_team, team) AS team_id, minutes, began, place,
                     v['attempt']::BIGINT AS passes_attempted, v['arrived']::BIGINT AS passes_completed,
                     v['shot']::BIGINT AS shots, v['target']::BIGINT AS shots_on_target,
                     v['goal']::BIGINT AS goals, v['assist']::BIGINT AS assists, v['chance'] AS xg,
                     v['tackle']::BIGINT AS tackles, coalesce(v['Interception'], 0)::BIGINT AS interceptions,
                     coalesce(v['Pressure'], 0)::BIGINT AS pressures, coalesce(v['Block'], 0)::BIGINT AS blocks,
                     coalesce(v['Dribble'], 0)::BIGINT AS dribbles_attempted,
                     v['dribbled']::BIGINT AS dribbles_completed, coalesce(v['Carry'], 0)::BIGINT AS carries,
                     v['yellow']::BIGINT AS yellow_cards, v['red']::BIGINT AS red_cards
              FROM tally LEFT JOIN squad USING (match_id, player_id))
        WHERE team_id IS NOT NULL""",
    # ---- shapes of a team in a match as one list, of which what repeats the one before is dropped
    "shapes": """
        SELECT match_id, team_id, type, formation, {'i': idx, 'at': coalesce(minute, 0), 'f': formation, 't': type} AS shape
        FROM ev WHERE formation IS NOT NULL""",
    "turns": """
        SELECT match_id, team_id, unnest(list_filter(all_shapes, lambda s, i: i = 1 OR s.f <> all_shapes[i - 1].f)) AS s
        FROM (SELECT match_id, team_id, list(shape ORDER BY shape.i) AS all_shapes FROM shapes GROUP BY ALL)""",
    "lasting": """
        SELECT match_id, team_id, list(last ORDER BY last.i) AS seq
        FROM (SELECT match_id, team_id, s.at AS minute, arg_max(s, s.i) AS last FROM turns GROUP BY ALL)
        GROUP BY ALL""",
    "tl": """
        SELECT match_id, team_id, seq[n].at AS from_minute, seq[n + 1].at AS to_minute,
               seq[n].f AS formation_code, seq[n].t AS source_event_type
        FROM lasting, unnest(range(1, len(seq) + 1)) AS u(n)""",
    "ms": "SELECT * FROM m WHERE competition_id = 43 AND season_id = 106",
    "fs": "SELECT f.* FROM fact f WHERE match_id IN (SELECT match_id FROM ms)",
    "sides": """
        SELECT ms.*, 'home' AS side, home_team_id AS team_id, away_team_id AS opponent_id,
               home_score AS team_score, away_score AS opp_score FROM ms
        UNION ALL
        SELECT ms.*, 'away', away_team_id, home_team_id, away_score, home_score FROM ms""",
    "stage": """
        SELECT * FROM (VALUES ('Group Stage', 1), ('Round of 16', 2), ('Quarter-finals', 3),
                              ('Semi-finals', 4), ('3rd Place Final', 5), ('Final', 6))
               AS s(competition_stage, stage_rank)""",
    "agg": """
        SELECT team_id, count(DISTINCT match_id) AS matches, sum(goals) AS goals, sum(xg) AS xg,
               sum(passes_attempted) AS passes_attempted, sum(passes_completed) AS passes_completed,
               sum(tackles) AS tackles, sum(interceptions) AS interceptions,
               sum(pressures) AS pressures, sum(blocks) AS blocks
        FROM fs GROUP BY team_id""",
    "forms": """
        SELECT team_id, string_agg(formation_code, ', ' ORDER BY first_use) AS formations
        FROM (SELECT team_id, formation_code, min(match_id * 1000 + from_minute) AS first_use
              FROM tl WHERE match_id IN (SELECT match_id FROM ms) GROUP BY ALL)
        GROUP BY team_id""",
    "liking": """
        SELECT player_id, arg_min(place, {'m': -mins, 'p': place}) AS position
        FROM (SELECT player_id, position_played AS place, sum(minutes_played) AS mins FROM fact GROUP BY ALL)
        WHERE place IS NOT NULL GROUP BY player_id""",
    "prof": """
        SELECT *, (SELECT any_value(player_name) FROM player p WHERE p.player_id = x.player_id) AS player_name,
               (SELECT any_value(team_name) FROM team t WHERE t.team_id = x.team_id) AS team_name,
               (SELECT any_value(position) FROM liking l WHERE l.player_id = x.player_id) AS position
        FROM (SELECT player_id, team_id, count(DISTINCT match_id) AS matches, sum(minutes_played) AS minutes,
                     sum(COLUMNS('^(passes_attempted|passes_completed|goals|assists|shots|xg|tackles|interceptions|pressures|blocks)$'))
              FROM fs GROUP BY player_id, team_id) x
        WHERE minutes > 0""",
    # ---- a match's sums, and each side's share of them; the other side has the rest
    "share": "SELECT match_id, team_id, sum(xg) AS xg, sum(def) AS def FROM fact GROUP BY ALL",
    "vs": """
        SELECT s.match_id, s.team_id, s.match_date, s.competition_stage, s.opponent_id, team_name AS opponent_name,
               s.home_score, s.away_score, s.team_score, s.opp_score,
               own.xg AS team_xg, own.def AS team_def,
               nullif(total.parts, (own.team_id IS NOT NULL)::INT) * 0 + total.xg - coalesce(own.xg, 0) AS opp_xg,
               nullif(total.parts, (own.team_id IS NOT NULL)::INT) * 0 + total.def - coalesce(own.def, 0) AS opp_def
        FROM sides s
        JOIN (SELECT match_id, sum(xg) AS xg, sum(def) AS def, count(*) AS parts FROM share GROUP BY 1) total
          ON total.match_id = s.match_id
        LEFT JOIN share own ON own.match_id = s.match_id AND own.team_id = s.team_id
        JOIN team ON team.team_id = s.opponent_id""",
}


def with_tables(query: str, **extra: str) -> str:
    """``query`` with a WITH clause for every table above (or in ``extra``) that it reaches."""
    known = {**TABLES, **extra}
    needed: set[str] = set()

    def reach(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", text):
            if name in known and name not in needed:
                needed.add(name)
                reach(known[name])

    reach(query)
    body = ",\n".join(f"{n} AS ({known[n].strip()})" for n in known if n in needed)
    return f"WITH {body}\n{query.strip()}" if needed else query.strip()


def half_up(part: str, whole: str, places: int) -> str:
    """SQL for a non-negative ratio rounded half up by integer arithmetic, as a double."""
    scale = 10**places
    return (
        f"CAST((2 * {scale} * CAST({part} AS HUGEINT) + {whole}) // (2 * CAST({whole} AS HUGEINT))"
        f" AS DOUBLE) / {scale}"
    )
