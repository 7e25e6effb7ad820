-- defensive totals per match; :team_id NULL means every team
SELECT match_id,
       team_id,
       sum(tackles)       AS tackles,
       sum(interceptions) AS interceptions,
       sum(pressures)     AS pressures,
       sum(blocks)        AS blocks
FROM {facts}
WHERE :team_id IS NULL OR team_id = :team_id
GROUP BY match_id, team_id
ORDER BY match_id, team_id
