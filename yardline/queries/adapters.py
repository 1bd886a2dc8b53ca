"""Play-by-play shaped views over the test tables, in SQL both engines run unchanged.

Eight neighbouring order keys make a game, so games, teams and players grow with the data while a game
keeps about 32 plays. Teams form leagues of 25; a team's players carry its name.
"""

from __future__ import annotations

PLAYS = """
WITH base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CAST((l_orderkey - l_orderkey % 8) / 8 AS BIGINT) AS g,
         CAST((l_orderkey % 8) * 8 + l_linenumber AS INT) AS seq,
         CAST(l_quantity AS INT) AS q, CAST(l_partkey % 23 AS INT) AS pk,
         CAST(round(l_discount * 100) AS INT) AS disc, CAST(round(l_tax * 100) AS INT) AS tax,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM {lineitem}),
flagged AS (
  SELECT base.*, CAST(2016 + g % 8 AS INT) AS season,
         CAST(1 + CAST((g - g % 8) / 8 AS BIGINT) % 18 AS INT) AS week,
         CAST((g - g % 144) / 144 AS BIGINT) AS home_no,
         CASE WHEN pk > 1 AND l_returnflag = 'A' THEN 1 ELSE 0 END AS rush_attempt,
         CASE WHEN pk > 1 AND l_returnflag <> 'A' THEN 1 ELSE 0 END AS pass_attempt,
         CASE WHEN pk > 1 AND l_returnflag = 'R' AND disc >= 8 THEN 1 ELSE 0 END AS sack
  FROM base),
teams AS (
  SELECT flagged.*,
         concat('T', lpad(CAST(home_no AS STRING), 6, '0')) AS home_team,
         concat('T', lpad(CAST(home_no - home_no % 25 + (home_no % 25 + 1 + g % 24) % 25 AS STRING), 6, '0'))
           AS away_team,
         CASE WHEN pass_attempt = 1 AND sack = 0 AND tax <= 5 THEN 1 ELSE 0 END AS complete_pass,
         CASE WHEN pass_attempt = 1 AND sack = 0 AND tax = 8 THEN 1 ELSE 0 END AS interception
  FROM flagged),
sides AS (
  SELECT teams.*,
         CASE WHEN l_linestatus = 'O' THEN home_team ELSE away_team END AS posteam,
         CASE WHEN l_linestatus = 'O' THEN away_team ELSE home_team END AS defteam,
         CASE WHEN (rush_attempt = 1 OR complete_pass = 1) AND q >= 48 THEN 1 ELSE 0 END AS touchdown
  FROM teams)
SELECT concat(CAST(season AS STRING), '_', lpad(CAST(week AS STRING), 2, '0'), '_', away_team, '_', home_team)
         AS game_id,
       g AS game_no, season, week,
       CASE WHEN week >= 18 THEN 'POST' ELSE 'REG' END AS season_type,
       CAST(make_date(season, 9, 1) + CAST(week * 7 + home_no % 3 AS INT) * INTERVAL '1' DAY AS DATE) AS game_date,
       l_orderkey * 8 + l_linenumber AS play_seq, l_suppkey * 1000000000 + cents AS play_tie,
       home_team, away_team, posteam, defteam,
       CASE WHEN rush_attempt = 1 THEN 'RUSH' WHEN sack = 1 THEN 'SACK' WHEN pass_attempt = 1 THEN 'PASS'
            WHEN pk = 0 THEN 'FIELD_GOAL' ELSE 'XP_KICK' END AS play_type_nfl,
       CASE WHEN rush_attempt = 1 THEN 'run' WHEN pass_attempt = 1 THEN 'pass'
            WHEN pk = 0 THEN 'field_goal' ELSE 'extra_point' END AS play_type,
       rush_attempt, pass_attempt, pass_attempt AS qb_dropback, sack, complete_pass, interception,
       CASE WHEN rush_attempt = 1 OR complete_pass = 1 THEN q - 10 WHEN sack = 1 THEN -(q % 10) ELSE 0 END
         AS yards_gained,
       CASE WHEN pass_attempt = 1 AND sack = 0 THEN nullif(q % 30 - 2, -2) END AS air_yards,
       CASE WHEN complete_pass = 1 THEN q % 13 END AS yards_after_catch,
       1 + q % 10 AS ydstogo,
       CASE WHEN NOT (pk = 5 AND q = 13) THEN CAST(CAST(q - 25 - disc AS DOUBLE) / 8 AS DOUBLE) END AS epa,
       CASE WHEN pass_attempt = 1 AND sack = 0 THEN CAST(CAST(q * 2 - 50 AS DOUBLE) / 4 AS DOUBLE) END AS cpoe,
       CASE WHEN q >= 25 THEN 1 ELSE 0 END AS success,
       touchdown,
       CASE WHEN touchdown = 1 THEN posteam END AS td_team,
       CASE WHEN rush_attempt = 1 AND q <= 4 THEN 1 ELSE 0 END AS fumble,
       CASE WHEN rush_attempt = 1 AND q <= 2 THEN 1 ELSE 0 END AS fumble_lost,
       CASE WHEN interception = 1 AND q >= 45 THEN 1 ELSE 0 END AS return_touchdown,
       CASE WHEN sack = 1 AND q = 50 THEN 1 ELSE 0 END AS safety,
       CASE WHEN pass_attempt = 1 THEN concat(posteam, '_Q', CAST(CASE WHEN l_suppkey % 10 < 7 THEN season % 2 ELSE 2 END AS STRING)) END
         AS passer_player_id,
       CASE WHEN pass_attempt = 1 THEN
            CASE WHEN l_suppkey % 10 >= 7 THEN concat('Alex ', posteam) ELSE concat('Q', CAST(season % 2 AS STRING), '. ', posteam) END END
         AS passer_player_name,
       CASE WHEN pass_attempt = 1 AND sack = 0 AND l_partkey % 17 <> 0
            THEN concat(posteam, '_P', CAST(l_partkey % 8 AS STRING)) END AS receiver_player_id,
       CASE WHEN pass_attempt = 1 AND sack = 0 AND l_partkey % 17 <> 0
            THEN concat('P', CAST(l_partkey % 8 AS STRING), '.', posteam) END AS receiver_player_name,
       CASE WHEN rush_attempt = 1 AND l_partkey % 11 = 0 THEN concat(posteam, '_Q', CAST(season % 2 AS STRING))
            WHEN rush_attempt = 1 THEN concat(posteam, '_P', CAST(l_partkey % 3 AS STRING)) END AS rusher_player_id,
       CASE WHEN rush_attempt = 1 AND l_partkey % 11 = 0 THEN concat('Q', CAST(season % 2 AS STRING), '. ', posteam)
            WHEN rush_attempt = 1 THEN concat('P', CAST(l_partkey % 3 AS STRING), '.', posteam) END
         AS rusher_player_name,
       CASE WHEN pk <= 1 THEN concat(posteam, '_K', CAST(season % 2 AS STRING)) END AS kicker_player_id,
       CASE WHEN pk <= 1 THEN concat('K', CAST(season % 2 AS STRING), '.', posteam) END AS kicker_player_name,
       CASE WHEN pk = 0 THEN q + 17 END AS kick_distance,
       CASE WHEN pk = 0 THEN CASE WHEN q <= 38 THEN 'made' ELSE 'missed' END END AS field_goal_result,
       CASE WHEN pk = 1 THEN CASE WHEN q <= 47 THEN 'good' ELSE 'failed' END END AS extra_point_result,
       CASE WHEN pk = 0 AND q >= 49 THEN 'blocker' END AS blocked_player_name,
       CASE WHEN pk = 2 AND q % 5 = 0 THEN 1 ELSE 0 END AS two_point_attempt,
       CASE WHEN pk = 2 AND q % 5 = 0 THEN CASE WHEN q >= 25 THEN 'success' ELSE 'failure' END END
         AS two_point_conv_result,
       CASE WHEN (pk = 0 AND q <= 38) OR (pk = 1 AND q <= 47) THEN 'kick is GOOD'
            WHEN pk > 1 AND q = 1 THEN 'Aborted snap' WHEN pk = 3 AND q = 9 THEN NULL ELSE 'play' END AS play_desc,
       CAST(1 + (seq - seq % 6) / 6 AS INT) AS drive,
       3600 - 55 * seq AS game_seconds_remaining,
       nullif(q % 15 - 7, 7) AS score_differential,
       nullif(q % 15 - 7, -7) + CASE WHEN touchdown = 1 THEN 6 WHEN pk = 0 AND q <= 38 THEN 3 ELSE 0 END
         AS score_differential_post,
       CAST(CAST((g * 7) % 29 - 14 AS DOUBLE) / 2 AS DOUBLE) AS spread_line,
       CAST(38 + CAST(g % 30 AS DOUBLE) / 2 AS DOUBLE) AS total_line,
       CAST(3 + (g * 13) % 38 AS INT) AS home_score, CAST(3 + (g * 29) % 35 AS INT) AS away_score,
       CASE WHEN g % 5 <> 0 THEN CAST(40 + g % 45 AS DOUBLE) END AS temp,
       CASE WHEN g % 5 <> 0 THEN CAST(g % 20 AS DOUBLE) END AS wind
FROM sides
"""

GAMES = """
WITH m AS (
  SELECT DISTINCT game_id, game_no, season, week, season_type, game_date, home_team, away_team,
         home_score, away_score, spread_line, total_line, temp, wind
  FROM {plays}),
n AS (SELECT m.*, CAST(CAST(substr(home_team, 2) AS BIGINT) % 25 AS INT) AS site FROM m)
SELECT game_id, game_no, season, week, season_type, game_date, home_team, away_team, home_score, away_score,
       spread_line, total_line, temp, wind,
       CASE WHEN game_no % 5 = 0 THEN 'dome' ELSE 'outdoors' END AS roof,
       4 + home_score % 11 AS home_rest, 4 + away_score % 11 AS away_rest,
       concat('C', home_team, '_', CAST(season % 2 AS STRING)) AS home_coach,
       concat('C', away_team, '_', CAST(season % 2 AS STRING)) AS away_coach,
       concat(home_team, '_Q', CAST(season % 2 AS STRING)) AS home_qb_id,
       concat(away_team, '_Q', CAST(season % 2 AS STRING)) AS away_qb_id,
       CASE WHEN game_no % 97 = 0 THEN 'Wembley Stadium' ELSE concat('S', home_team) END AS stadium,
       CASE WHEN game_no % 97 = 0 THEN CAST(51.556 AS DOUBLE)
            ELSE CAST(25 AS DOUBLE) + CAST(site AS DOUBLE) * CAST(0.875 AS DOUBLE) END AS lat,
       CASE WHEN game_no % 97 = 0 THEN CAST(-0.2796 AS DOUBLE)
            ELSE CAST(-120 AS DOUBLE) + CAST(site AS DOUBLE) * CAST(2 AS DOUBLE) END AS long,
       CASE CAST(game_no % 5 AS INT) WHEN 0 THEN 'Adrian Hall' WHEN 1 THEN 'Bill Vinocich' WHEN 2 THEN 'Gene Stetatore'
            WHEN 3 THEN 'John Perry' ELSE 'Jerome Boger' END AS referee,
       -150 - home_score AS home_ml, 120 + away_score AS away_ml
FROM n
"""

DRAWS = """
SELECT user_id AS row_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS draw, value
FROM {events}
"""

# one row per game and player who touched the ball, with the share of snaps played
SNAPS = """
WITH touched AS (
  SELECT DISTINCT game_id, season, week, posteam,
         coalesce(receiver_player_id, CASE WHEN rusher_player_id LIKE '%!_P%' ESCAPE '!' THEN rusher_player_id END)
           AS player_id FROM {plays}
  WHERE receiver_player_id IS NOT NULL OR rusher_player_id LIKE '%!_P%' ESCAPE '!'),
numbered AS (SELECT touched.*, CAST(right(player_id, 1) AS INT) AS player_no FROM touched)
SELECT game_id, season, week, player_id, concat('P', CAST(player_no AS STRING), '.', posteam) AS player,
       posteam AS team,
       CASE WHEN season = 2021 THEN CAST((player_no * 13 + week * 5) % 64 AS DOUBLE) / 64
            WHEN NOT (player_no = 5 AND week = 9) THEN CAST((player_no * 13 + week * 5) % 64 AS DOUBLE) END AS offense_pct
FROM numbered
"""

DEPTH = """
SELECT player_id, season, week,
       CASE WHEN max(CAST(right(player_id, 1) AS INT)) < 3 THEN 'RB'
            WHEN max(CAST(right(player_id, 1) AS INT)) < 6 THEN 'WR' ELSE 'TE' END AS position,
       CAST(1 + (max(CAST(right(player_id, 1) AS INT)) + week) % 3 AS DOUBLE) AS depth_team
FROM {snaps} WHERE NOT (week = 4 AND right(player_id, 1) = '7') GROUP BY player_id, season, week
"""

# passer statistics per season, week, player and team
PASSERS = """
SELECT season, week, max(season_type) AS season_type, 'QB' AS position, passer_player_id AS player_id,
       max(passer_player_name) AS player_name, posteam AS recent_team,
       CAST(sum(pass_attempt - sack) AS INT) AS attempts, CAST(sum(complete_pass) AS INT) AS completions,
       CAST(sum(interception) AS INT) AS interceptions,
       CAST(sum(CASE WHEN sack = 0 THEN yards_gained ELSE 0 END) AS DOUBLE) AS passing_yards,
       coalesce(sum(epa), 0) AS passing_epa,
       coalesce(sum(CASE WHEN sack = 1 THEN epa END), 0) AS rushing_epa
FROM {plays} WHERE passer_player_id IS NOT NULL
GROUP BY season, week, passer_player_id, posteam
"""

VIEWS = {"plays": PLAYS, "games": GAMES, "draws": DRAWS, "snaps": SNAPS, "depth": DEPTH, "passers": PASSERS}
