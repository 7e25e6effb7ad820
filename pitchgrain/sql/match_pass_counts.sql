-- passes and shots per player and match; :match_id NULL means every match
SELECT match_id,
       player_id,
       count_if(type = 'Pass')                     AS passes_attempted,
       count_if(type = 'Pass' AND outcome IS NULL) AS passes_completed,
       count_if(type = 'Shot')                     AS shots
FROM {events}
WHERE player_id IS NOT NULL
  AND (:match_id IS NULL OR match_id = :match_id)
GROUP BY match_id, player_id
