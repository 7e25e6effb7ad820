-- formation intervals; a NULL parameter does not restrict
SELECT match_id,
       team_id,
       formation_code,
       from_minute,
       to_minute
FROM {timeline}
WHERE (:match_id IS NULL OR match_id = :match_id)
  AND (:team_id IS NULL OR team_id = :team_id)
ORDER BY match_id, team_id, from_minute
