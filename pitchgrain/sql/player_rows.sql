-- five measures of a player's matches; :player_id NULL means every player
SELECT match_id,
       player_id,
       xg,
       passes_attempted,
       passes_completed,
       pass_completion_rate,
       minutes_played
FROM {facts}
WHERE :player_id IS NULL OR player_id = :player_id
