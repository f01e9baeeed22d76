"""Relational answers, in DuckDB SQL, to the model queries over packed bronze."""

from __future__ import annotations

ORDER_GAME = """
  SELECT o_orderkey AS ok, o_custkey AS cust, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    year(o_orderdate) AS y, o_orderkey // 2 AS game_id,
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 4 ELSE 2 END AS INTEGER) AS game_type,
    CASE o_orderstatus WHEN 'F' THEN 'FINAL' WHEN 'O' THEN 'OFF' ELSE 'LIVE' END AS game_state,
    CAST(o_orderdate AS DATE) AS game_date,
    o_orderdate + to_microseconds(o_orderkey) AS fetched_at_utc
  FROM orders
"""

# Latest competitive fetch per game, shared by landing and boxscore.
GAMES = f"""
games AS (
  SELECT *, CAST(cust % 32 AS INTEGER) AS away_team_id, CAST(game_id % 32 AS INTEGER) AS home_team_id,
    CAST(y AS VARCHAR) || CAST(y + 1 AS VARCHAR) AS season,
    CAST(game_date AS TIMESTAMP) + to_hours(ok % 24) + to_minutes(30) AS start_time_utc
  FROM ({ORDER_GAME}) WHERE game_type IN (2, 3)
  QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY fetched_at_utc DESC) = 1
)"""

LANDING = f"""{GAMES},
landing AS (
  SELECT game_date AS ingest_date, fetched_at_utc, game_id, game_type, game_date, start_time_utc,
    away_team_id, home_team_id, season, game_state,
    'T_' || away_team_id || '_' || y AS away_team_abbrev, 'T_' || home_team_id || '_' || y AS home_team_abbrev,
    CAST(CASE WHEN cust % 11 <> 0 THEN cents % 7 END AS INTEGER) AS away_score,
    CAST((cents // 7) % 7 AS INTEGER) AS home_score, 3 AS reg_periods,
    ok % 2 = 0 AS ot_in_use, ok % 3 = 0 AS shootout_in_use,
    'Venue ' || home_team_id AS venue_name, 'Zone/' || home_team_id AS venue_timezone,
    CASE cents % 3 WHEN 0 THEN 'REG' WHEN 1 THEN 'OT' ELSE 'SO' END AS final_period_type
  FROM games
)"""


def _box_group(side: str, shift: int, g: int, mod: int, group: str) -> str:
    slot = shift * 3 + g
    absent = "AND ok % 10 <> 0" if group == "D" else ""
    skater = group != "G"
    null = "CAST(NULL AS INTEGER)"
    return f"""
  SELECT game_id, {side}_team_id AS team_id, '{group}' AS position_type,
    CAST(cust * 100 + {slot * 10} + i AS INTEGER) AS player_id,
    CAST(((ok + i) % 60) * 60 + (ok * 7 + i) % 60 AS INTEGER) AS toi_s,
    {"CAST(i % 3 AS INTEGER)" if skater else null} AS goals,
    {"CAST((ok + i) % 4 AS INTEGER)" if skater else null} AS assists,
    {"CAST((ok * 5 + i) % 9 AS INTEGER)" if skater else null} AS shots,
    {null if skater else "CAST((ok * 3 + i) % 40 AS INTEGER)"} AS saves,
    {null if skater else "CAST((ok + i) % 6 AS INTEGER)"} AS goals_against
  FROM (SELECT *, unnest(range(1, 1 + (ok + {shift}) % {mod})) AS i FROM games WHERE true {absent})"""


PLAYERS = f"""{GAMES},
players AS ({" UNION ALL ".join(
    _box_group(side, shift, g, mod, group)
    for shift, side in enumerate(("away", "home"))
    for g, (mod, group) in enumerate(((4, "F"), (3, "D"), (2, "G")))
)})"""

# Kind of play, member that names its first participant, and its second.
_PLAYS = [
    ("period-start", None, None),
    ("goal", "scoringPlayerId", "assist1PlayerId"),
    ("shot-on-goal", "shootingPlayerId", "goalieInNetId"),
    ("hit", "hittingPlayerId", "hitteePlayerId"),
    ("blocked-shot", "blockingPlayerId", None),
    ("faceoff", "winningPlayerId", "losingPlayerId"),
    ("penalty", "committedByPlayerId", "drawnByPlayerId"),
    ("give-away-late", "playerId", None),
]
_FIRST = [f"WHEN {k} THEN ',\"{p[1]}\":' || first_id" for k, p in enumerate(_PLAYS) if p[1]]
_SECOND = [f"WHEN {k} THEN ',\"{p[2]}\":' || second_id" for k, p in enumerate(_PLAYS) if p[2]]
_NAMES = " ".join(f"WHEN {k} THEN '{p[0]}'" for k, p in enumerate(_PLAYS))

PLAY_GAMES = """
play_games AS (
  SELECT *, doc_id // 2 AS game_id, CAST((doc_id * 7 + 1) % 4 + 1 AS INTEGER) AS game_type,
    CAST('2024-01-16' AS TIMESTAMP) + to_microseconds(doc_id) AS fetched_at_utc
  FROM documents WHERE (doc_id * 7 + 1) % 4 + 1 IN (2, 3)
  QUALIFY row_number() OVER (PARTITION BY doc_id // 2 ORDER BY doc_id DESC) = 1
)"""
EVENTS = f"""{PLAY_GAMES},
lines AS (
  SELECT game_id, doc_id, n_chars, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS i
  FROM play_games
),
plays AS (
  SELECT *, (n_chars + i) % 8 AS kind, (doc_id + i) % 500 AS first_id, (doc_id * 3 + i) % 500 AS second_id,
    (n_chars + i) % 200 - 100 AS x, CASE WHEN i % 4 <> 0 THEN (n_chars * 3 + i) % 84 - 42 END AS y
  FROM lines
),
game_events AS (
  SELECT game_id, CASE kind {_NAMES} END AS type_desc_key, 'REG' AS period_type,
    lpad(CAST((n_chars + i) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((doc_id + i) % 60 AS VARCHAR), 2, '0') AS time_in_period_raw,
    CAST(i + 1 AS INTEGER) AS event_sequence, CAST(i % 3 + 1 AS INTEGER) AS period,
    CAST(CASE WHEN kind <> 0 THEN doc_id % 32 END AS INTEGER) AS event_team_id,
    CAST(CASE WHEN kind <> 0 THEN x END AS INTEGER) AS x_coord,
    CAST(CASE WHEN kind <> 0 THEN y END AS INTEGER) AS y_coord,
    CASE WHEN kind <> 0 THEN '{{"eventOwnerTeamId":' || (doc_id % 32) || ',"xCoord":' || x
      || coalesce(',"yCoord":' || y, '')
      || coalesce(CASE kind {" ".join(_FIRST)} END, '') || coalesce(CASE kind {" ".join(_SECOND)} END, '')
      || ',"line":' || CAST(to_json(line) AS VARCHAR) || '}}' END AS details_json,
    CAST(((n_chars + i) % 60) * 60 + (doc_id + i) % 60 AS INTEGER) AS period_time_elapsed_s,
    CAST(CASE WHEN kind <> 0 THEN first_id END AS INTEGER) AS primary_player_id,
    CAST(CASE WHEN kind IN (1, 2, 3, 5, 6) THEN second_id END AS INTEGER) AS secondary_player_id
  FROM plays
)"""

FCT_EVENT = f"""{EVENTS},
fct_game_event AS (
  SELECT game_id, period, period_time_elapsed_s, x_coord, y_coord, event_team_id AS team_id,
    primary_player_id, secondary_player_id, details_json,
    game_id || '_' || event_sequence AS event_id,
    CASE type_desc_key WHEN 'shot-on-goal' THEN 'shot' ELSE replace(type_desc_key, '-', '_') END AS event_type
  FROM game_events
)"""


def _latest_orders(name: str) -> str:
    return f"""
{name}_latest AS (
  SELECT o_orderkey AS ok, o_custkey AS cust, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    CAST(year(o_orderdate) AS VARCHAR) || CAST(year(o_orderdate) + 1 AS VARCHAR) AS season,
    CAST(o_orderdate AS DATE) AS ingest_date, o_orderdate + to_microseconds(o_orderkey) AS fetched_at_utc
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate + to_microseconds(o_orderkey) DESC) = 1
)"""


_SUMMARY_DEDUP = """
  QUALIFY row_number() OVER (PARTITION BY season, player_id ORDER BY fetched_at_utc DESC, j) = 1"""

SKATERS = f"""{_latest_orders("skater")},
skaters AS (
  SELECT ingest_date, fetched_at_utc, CAST(cust % 50 * 10 + (ok + j) % 4 AS INTEGER) AS player_id,
    CAST(ok % 82 AS INTEGER) AS games_played, CAST((ok + j) % 60 AS INTEGER) AS goals,
    CAST((ok * 3 + j) % 70 AS INTEGER) AS assists,
    CAST((ok + j) % 60 + (ok * 3 + j) % 70 AS INTEGER) AS points, season,
    'Skater ' || (cust % 50 * 10 + (ok + j) % 4) || ' ' || ok || ' ' || j AS skater_full_name,
    'ANA' || CASE WHEN ok % 2 = 0 THEN ',BUF' ELSE '' END AS team_abbrevs,
    CASE (ok + j) % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'L' WHEN 2 THEN 'R' WHEN 3 THEN 'D' ELSE 'X' END AS position_code,
    CAST((cents % 3000 + 5) // 10 AS INTEGER) AS shots, CAST(ok % 41 - 20 AS INTEGER) AS plus_minus,
    CASE WHEN ok % 3 <> 0 THEN (cents % 1000) / 1000 END AS faceoff_win_pct,
    (cents % 15000) / 10 AS toi_per_game_s, j
  FROM (SELECT *, unnest(range(1, 2 + ok % 5)) AS j FROM skater_latest)
  {_SUMMARY_DEDUP}
)"""

GOALIES = f"""{_latest_orders("goalie")},
goalies AS (
  SELECT ingest_date, fetched_at_utc, CAST(cust % 40 * 10 + 2 + (ok + j) % 5 AS INTEGER) AS player_id,
    CAST(ok % 60 AS INTEGER) AS games_played, season,
    'Goalie ' || (cust % 40 * 10 + 2 + (ok + j) % 5) || ' ' || ok || ' ' || j AS goalie_full_name,
    'TOR' AS team_abbrevs, CAST(CASE WHEN ok % 4 <> 0 THEN ok % 40 END AS INTEGER) AS wins,
    CAST((ok + j) % 30 AS INTEGER) AS losses, CAST(NULL AS INTEGER) AS ot_losses,
    CASE WHEN ok % 6 <> 0 THEN (cents % 1000) / 1000 END AS save_pct,
    (cents % 400) / 100 AS goals_against_avg, CAST(j AS INTEGER) AS shutouts, j
  FROM (SELECT *, unnest(range(1, 1 + ok % 3)) AS j FROM goalie_latest)
  {_SUMMARY_DEDUP}
)"""

TEAMS = """
team_latest AS (
  SELECT s_suppkey AS s, CAST(round(s_acctbal * 100) AS BIGINT) AS cents,
    CAST('2024-02-01' AS TIMESTAMP) + to_microseconds(s_suppkey) AS fetched_at_utc
  FROM supplier
  QUALIFY row_number() OVER (PARTITION BY s_suppkey // 2 ORDER BY s_suppkey DESC) = 1
),
teams AS (
  SELECT CAST(fetched_at_utc AS DATE) AS ingest_date, fetched_at_utc, CAST((s + j * 7) % 40 AS INTEGER) AS team_id,
    CAST(s % 82 AS INTEGER) AS games_played, CAST(20202021 + s % 3 * 10001 AS VARCHAR) AS season,
    'Team ' || s || ' ' || j AS team_full_name, CAST(s % 50 AS INTEGER) AS wins,
    CAST(s % 30 AS INTEGER) AS losses, CAST(s % 12 AS INTEGER) AS ot_losses,
    CAST((s % 50) * 2 AS INTEGER) AS points,
    CASE WHEN s % 4 <> 0 THEN abs(cents) % 1000 / 1000 END AS point_pct,
    CAST(CASE WHEN s % 5 <> 0 THEN s % 45 END AS INTEGER) AS regulation_and_ot_wins,
    abs(cents) % 500 / 100 AS goals_for_per_game, abs(cents) % 400 / 100 AS goals_against_per_game
  FROM (SELECT *, unnest(range(1, 2 + s % 3)) AS j FROM team_latest)
  QUALIFY row_number() OVER (PARTITION BY season, team_id ORDER BY fetched_at_utc DESC, j) = 1
)"""

CLUB_LATEST = """
club_latest AS (
  SELECT c_custkey AS c, c_mktsegment AS segment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
    '20002001' AS season, 'K' || (c_custkey // 2) AS team_abbrev
  FROM customer
  QUALIFY row_number() OVER (PARTITION BY c_custkey // 2 ORDER BY c_custkey DESC) = 1
)"""


def _roster_group(g: int, code: str, group: str, count: str, where: str = "true") -> str:
    return f"""
  SELECT CAST('2024-03-01' AS DATE) AS ingest_date, CAST('2024-03-01' AS TIMESTAMP) + to_microseconds(c) AS fetched_at_utc,
    season, team_abbrev, '{group}' AS position_group, CAST(c % 90 * 10 + (j + {g}) % 5 AS INTEGER) AS player_id,
    '{code}' AS position_code, 'First' || (c % 90 * 10 + (j + {g}) % 5) AS first_name,
    CASE WHEN (c + j) % 6 <> 0 THEN 'Last' || c END AS last_name,
    CAST(CASE WHEN c % 4 <> 0 THEN (c + j) % 99 END AS INTEGER) AS sweater_number,
    CASE WHEN c % 2 = 0 THEN 'L' ELSE 'R' END AS shoots_catches, CAST(66 + (c + j) % 14 AS INTEGER) AS height_in,
    CAST(CASE WHEN c % 7 <> 0 THEN 100 + c % 90 END AS INTEGER) AS weight_lb,
    CASE WHEN c % 5 <> 0 THEN CAST('1980-01-01' AS DATE) + CAST(abs(cents) % 9000 AS INTEGER) END AS birth_date,
    substring(segment, 1, 3) AS birth_country, {g} AS g, j
  FROM (SELECT *, unnest(range(1, 1 + {count})) AS j FROM club_latest WHERE {where})"""


ROSTER = f"""{CLUB_LATEST},
rosters AS (
  SELECT * FROM ({_roster_group(0, "C", "F", "c % 4")}
  UNION ALL {_roster_group(1, "D", "D", "(c + 1) % 3", "c % 6 <> 0")}
  UNION ALL {_roster_group(2, "G", "G", "(c % 2 + 1)")})
  QUALIFY row_number() OVER (PARTITION BY season, team_abbrev, player_id ORDER BY g, j) = 1
)"""

PLAYER_SPINE = f"""{ROSTER}, {SKATERS}, {GOALIES},
r AS (SELECT * FROM rosters QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY fetched_at_utc DESC) = 1),
s AS (SELECT * FROM skaters QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY fetched_at_utc DESC) = 1),
g AS (SELECT * FROM goalies QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY fetched_at_utc DESC) = 1),
ids AS (SELECT player_id FROM r UNION SELECT player_id FROM s UNION SELECT player_id FROM g),
player_spine AS (
  SELECT ids.player_id, r.first_name, r.last_name, r.shoots_catches, r.height_in, r.weight_lb, r.birth_date, r.birth_country,
    coalesce(r.first_name || ' ' || r.last_name, s.skater_full_name, g.goalie_full_name) AS full_name,
    coalesce(r.position_group, CASE WHEN s.position_code IN ('C', 'L', 'R') THEN 'F' WHEN s.position_code = 'D' THEN 'D'
      WHEN g.player_id IS NOT NULL THEN 'G' END) AS position_group,
    coalesce(r.position_code, s.position_code) AS position_code
  FROM ids LEFT JOIN r USING (player_id) LEFT JOIN s USING (player_id) LEFT JOIN g USING (player_id)
)"""

TEAM_SPINE = f"""{LANDING}, {TEAMS},
sides AS (
  SELECT home_team_id AS team_id, home_team_abbrev AS team_abbrev, fetched_at_utc FROM landing
  UNION ALL SELECT away_team_id, away_team_abbrev, fetched_at_utc FROM landing
),
team_spine AS (
  SELECT a.team_id, a.team_abbrev, n.team_full_name
  FROM (SELECT team_id, team_abbrev FROM sides QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY fetched_at_utc DESC) = 1) AS a
  LEFT JOIN (SELECT team_id, team_full_name FROM teams QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY fetched_at_utc DESC) = 1) AS n
  USING (team_id)
)"""

DIM_TEAM = f"""{TEAM_SPINE},
dim_team AS (
  SELECT team_id, 1 AS league_id, team_abbrev, team_full_name, CAST(NULL AS VARCHAR) AS arena_name,
    CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state_province, CAST(NULL AS VARCHAR) AS country_code,
    '{{"nhl_api_team_id":' || team_id || '}}' AS external_ids
  FROM team_spine
)"""
DIM_PLAYER = f"""{PLAYER_SPINE},
dim_player AS (
  SELECT player_id, full_name, first_name, last_name, position_group, position_code, shoots_catches, height_in,
    weight_lb, birth_date, birth_country, '{{"nhl_api_player_id":' || player_id || '}}' AS external_ids
  FROM player_spine
)"""
FCT_GAME = """
fct_game AS (
  SELECT game_id, 1 AS league_id, season, start_time_utc AS game_datetime_utc, home_team_id, away_team_id,
    home_team_id AS venue_team_id, game_type, game_state AS status
  FROM landing
)"""
FCT_OUTCOME = """
fct_game_outcome AS (
  SELECT game_id, home_score AS home_goals, away_score AS away_goals, final_period_type AS period_end,
    CASE WHEN home_score > away_score THEN home_team_id ELSE away_team_id END AS winning_team_id,
    home_score > away_score AS home_win
  FROM landing
)"""
FCT_LINEUP = """
fct_game_lineup AS (
  SELECT game_id || '_' || player_id AS lineup_id, game_id, team_id, player_id, position_type, toi_s,
    goals, assists, shots, saves, goals_against
  FROM players
)"""

MODEL_SQL: dict[str, str] = {
    "stg_landing": f"WITH {LANDING} SELECT * FROM landing",
    "stg_boxscore": f"""WITH {GAMES} SELECT game_date AS ingest_date, fetched_at_utc, game_id, game_type, game_date,
      start_time_utc, away_team_id, home_team_id, season, game_state,
      'T_' || away_team_id || '_' || y AS away_team_abbrev, 'T_' || home_team_id || '_' || y AS home_team_abbrev,
      CASE cents % 3 WHEN 0 THEN 'REG' WHEN 1 THEN 'OT' ELSE 'SO' END AS last_period_type,
      CAST(CASE WHEN cents % 3 = 1 AND ok % 5 <> 0 THEN ok % 4 END AS INTEGER) AS ot_periods,
      CAST(ok % 4 AS BIGINT) AS away_forwards FROM games""",
    "stg_play_by_play": f"""WITH {PLAY_GAMES} SELECT CAST('2024-01-16' AS DATE) AS ingest_date, fetched_at_utc, game_id,
      game_type, CAST('2024-01-15' AS DATE) AS game_date, CAST('2024-01-15 19:00:00' AS TIMESTAMP) AS start_time_utc,
      CAST(doc_id % 32 AS INTEGER) AS away_team_id, CAST((doc_id + 1) % 32 AS INTEGER) AS home_team_id,
      '20232024' AS season, 'OFF' AS game_state, lang AS away_team_abbrev, source AS home_team_abbrev,
      '[{{"playerId":' || doc_id || '}}]' AS roster_spots_json,
      CAST(len(string_split(text, chr(10))) AS BIGINT) AS play_count FROM play_games""",
    "stg_skater_summary": f"WITH {SKATERS} SELECT * EXCLUDE (j) FROM skaters",
    "stg_goalie_summary": f"WITH {GOALIES} SELECT * EXCLUDE (j) FROM goalies",
    "stg_team_summary": f"WITH {TEAMS} SELECT * FROM teams",
    "stg_roster": f"WITH {ROSTER} SELECT * EXCLUDE (g, j) FROM rosters",
    "stg_club_schedule_season": f"""WITH {CLUB_LATEST} SELECT CAST('2024-03-02' AS DATE) AS ingest_date,
      CAST('2024-03-02' AS TIMESTAMP) + to_microseconds(c) AS fetched_at_utc, season, team_abbrev,
      CASE WHEN c % 9 <> 0 THEN '[' || coalesce(array_to_string([
        '{{"id":' || (c * 10 + i) || ',"gameType":' || (i % 3 + 1) || '}}' for i in range(1, 1 + c % 7)], ','), '') || ']' END AS games_json,
      '20002001' AS current_season, '19992000' AS previous_season, '20012002' AS next_season,
      'Zone/' || segment AS club_timezone, '-04:00' AS club_utc_offset,
      CASE WHEN c % 9 <> 0 THEN c % 7 END AS game_count FROM club_latest""",
    "int_game_events": f"WITH {EVENTS} SELECT * FROM game_events",
    "int_game_players": f"WITH {PLAYERS} SELECT * FROM players",
    "int_game_skater_stats": f"WITH {PLAYERS} SELECT * EXCLUDE (saves, goals_against) FROM players WHERE position_type <> 'G'",
    "int_game_goalie_stats": f"WITH {PLAYERS} SELECT * EXCLUDE (goals, assists, shots) FROM players WHERE position_type = 'G'",
    "int_player_spine": f"WITH {PLAYER_SPINE} SELECT * FROM player_spine",
    "int_team_spine": f"WITH {TEAM_SPINE} SELECT * FROM team_spine",
    "dim_team": f"WITH {DIM_TEAM} SELECT * FROM dim_team",
    "dim_player": f"WITH {DIM_PLAYER} SELECT * FROM dim_player",
    "fct_game": f"WITH {LANDING}, {FCT_GAME} SELECT * FROM fct_game",
    "fct_game_outcome": f"WITH {LANDING}, {FCT_OUTCOME} SELECT * FROM fct_game_outcome",
    "fct_game_event": f"WITH {FCT_EVENT} SELECT * FROM fct_game_event",
    "fct_game_lineup": f"WITH {PLAYERS}, {FCT_LINEUP} SELECT * FROM fct_game_lineup",
}


def _box_side(shift: int) -> str:
    def group(g: int, mod: int, own: str) -> str:
        player = (
            f"""'{{"playerId":' || (cust * 100 + {(shift * 3 + g) * 10} + i) || ',"toi":"' || """
            "lpad(CAST((ok + i) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((ok * 7 + i) % 60 AS VARCHAR), 2, '0') || '\"' || "
            f"{own} || '}}'"
        )
        return f"'[' || coalesce(array_to_string([{player} for i in range(1, 1 + (ok + {shift}) % {mod})], ','), '') || ']'"

    skater = """',"goals":' || (i % 3) || ',"assists":' || ((ok + i) % 4) || ',"sog":' || ((ok * 5 + i) % 9)"""
    goalie = """',"goalsAgainst":' || ((ok + i) % 6) || ',"saves":' || ((ok * 3 + i) % 40)"""
    return f"""'{{"forwards":' || {group(0, 4, skater)} || CASE WHEN ok % 10 <> 0 THEN ',"defense":' || {group(1, 3, skater)} ELSE '' END
      || ',"goalies":' || {group(2, 2, goalie)} || '}}'"""


# The staged bodies themselves, beside the other columns.
MODEL_SQL["stg_boxscore"] = f"""
  SELECT x.*, b.player_by_game_stats_json FROM ({MODEL_SQL["stg_boxscore"]}) AS x
  JOIN (WITH {GAMES} SELECT game_id, '{{"awayTeam":' || {_box_side(0)} || ',"homeTeam":' || {_box_side(1)} || '}}' AS player_by_game_stats_json
    FROM games) AS b USING (game_id)"""
MODEL_SQL["stg_play_by_play"] = f"""
  SELECT x.*, b.plays_json FROM ({MODEL_SQL["stg_play_by_play"]}) AS x
  JOIN (WITH {EVENTS} SELECT game_id, '[' || string_agg('{{"eventId":' || event_sequence || ',"typeDescKey":"' || type_desc_key
      || '","timeInPeriod":"' || time_in_period_raw || '","periodDescriptor":{{"number":' || period || ',"periodType":"REG"}}'
      || coalesce(',"details":' || details_json, '') || '}}', ',' ORDER BY event_sequence) || ']' AS plays_json
    FROM game_events GROUP BY game_id) AS b USING (game_id)"""
MODEL_SQL["stg_boxscore_whole"] = f"SELECT * EXCLUDE (away_forwards) FROM ({MODEL_SQL['stg_boxscore']})"
MODEL_SQL["stg_play_by_play_whole"] = MODEL_SQL["stg_play_by_play"]

# Test, then the columns it holds for by table; stated apart from the package's own list.
_GAME_COLUMNS = (
    "game_id season game_type game_date game_state start_time_utc away_team_id away_team_abbrev home_team_id "
    "home_team_abbrev ingest_date fetched_at_utc"
)
_ALL_NULLS = {
    "dim_sport": "sport_id sport_name sport_slug",
    "dim_league": "league_id sport_id league_name league_abbreviation country_code",
    "stg_landing": _GAME_COLUMNS,
    "stg_boxscore": f"{_GAME_COLUMNS} player_by_game_stats_json",
    "stg_play_by_play": f"{_GAME_COLUMNS} play_count plays_json",
    "stg_skater_summary": "season player_id games_played goals assists points ingest_date fetched_at_utc",
    "stg_goalie_summary": "season player_id games_played ingest_date fetched_at_utc",
    "stg_team_summary": "season team_id games_played ingest_date fetched_at_utc",
    "stg_roster": "season team_abbrev player_id position_group ingest_date fetched_at_utc",
    "stg_club_schedule_season": "season team_abbrev games_json ingest_date fetched_at_utc",
    "int_team_spine": "team_id team_abbrev",
    "int_player_spine": "player_id full_name",
    "int_game_skater_stats": "game_id team_id player_id position_type toi_s",
    "int_game_goalie_stats": "game_id team_id player_id position_type toi_s",
    "dim_team": "team_id league_id team_abbrev external_ids",
    "dim_player": "player_id full_name external_ids",
    "fct_game": "game_id league_id season game_datetime_utc home_team_id away_team_id venue_team_id game_type status",
    "fct_game_outcome": "game_id home_goals away_goals winning_team_id period_end home_win",
    "fct_game_event": "event_id game_id period period_time_elapsed_s event_type",
    "fct_game_lineup": "lineup_id game_id team_id player_id position_type toi_s",
}
_ALL_UNIQUE = (
    "dim_sport.sport_id dim_sport.sport_slug dim_league.league_id stg_landing.game_id stg_boxscore.game_id stg_play_by_play.game_id "
    "int_team_spine.team_id int_player_spine.player_id dim_team.team_id dim_player.player_id fct_game.game_id "
    "fct_game_outcome.game_id fct_game_event.event_id fct_game_lineup.lineup_id"
)
_ALL_ACCEPTED = {
    "2, 3": "stg_landing.game_type stg_boxscore.game_type stg_play_by_play.game_type fct_game.game_type",
    "'FINAL', 'OFF'": "stg_landing.game_state stg_boxscore.game_state stg_play_by_play.game_state fct_game.status",
    "'F', 'D', 'G'": "stg_roster.position_group int_player_spine.position_group dim_player.position_group fct_game_lineup.position_type",
    "'F', 'D'": "int_game_skater_stats.position_type",
    "'G'": "int_game_goalie_stats.position_type",
    "'REG', 'OT', 'SO'": "fct_game_outcome.period_end",
}
_ALL_FOREIGN = {
    "dim_sport.sport_id": "dim_league.sport_id",
    "dim_league.league_id": "dim_team.league_id fct_game.league_id",
    "dim_team.team_id": "fct_game.home_team_id fct_game.away_team_id fct_game.venue_team_id fct_game_outcome.winning_team_id "
    "fct_game_event.team_id fct_game_lineup.team_id",
    "fct_game.game_id": "fct_game_outcome.game_id fct_game_event.game_id fct_game_lineup.game_id",
    "dim_player.player_id": "fct_game_event.primary_player_id fct_game_event.secondary_player_id fct_game_lineup.player_id",
}


def _all_tests_sql() -> str:
    """Long-form results of the declared tests of every table."""
    bodies = {t: MODEL_SQL[t] for t in _ALL_NULLS if t in MODEL_SQL}
    bodies["dim_sport"] = "SELECT 1 AS sport_id, 'Ice Hockey' AS sport_name, 'ice_hockey' AS sport_slug"
    bodies["dim_league"] = (
        "SELECT 1 AS league_id, 1 AS sport_id, 'National Hockey League' AS league_name, 'NHL' AS league_abbreviation, 'US' AS country_code"
    )
    head = "SELECT '{0}' AS model, '{1}' AS \"column\", '{2}' AS test, CAST(count(*) AS BIGINT) AS failures FROM "
    parts = [head.format(t, c, "not_null") + f"{t} WHERE {c} IS NULL" for t, cols in _ALL_NULLS.items() for c in cols.split()]
    for t, c in (x.split(".") for x in _ALL_UNIQUE.split()):
        parts.append(
            head.format(t, c, "unique") + f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        )
    for values, columns in _ALL_ACCEPTED.items():
        for t, c in (x.split(".") for x in columns.split()):
            parts.append(head.format(t, c, "accepted_values") + f"{t} WHERE {c} NOT IN ({values})")
    for parent, columns in _ALL_FOREIGN.items():
        p, k = parent.split(".")
        for t, c in (x.split(".") for x in columns.split()):
            parts.append(
                head.format(t, c, "relationships")
                + f"{t} AS x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} AS q WHERE q.{k} = x.{c})"
            )
    return "WITH " + ", ".join(f"{t} AS MATERIALIZED ({sql})" for t, sql in bodies.items()) + " " + " UNION ALL ".join(parts)


MODEL_SQL["silver_table_tests"] = MODEL_SQL["silver_all_table_tests"] = _all_tests_sql()
# Merged batch by batch, they are the same rows.
MODEL_SQL["kept_latest_rows"] = MODEL_SQL["stg_landing"]
MODEL_SQL["facts_by_season"] = MODEL_SQL["fct_game_outcome"]
