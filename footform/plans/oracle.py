"""SQL that says what each query must return, over the same domain tables derived in SQL."""

from __future__ import annotations

DOMAIN = """
fixtures AS (
  SELECT o_orderkey AS id, c_nationkey % 5 AS league_id, (c_nationkey % 5) * 10000 + year(o_orderdate) AS season_id,
         o_orderdate + to_hours((o_orderkey % 24)::INT) AS starting_at, c_nationkey AS home_team_id, ((c_nationkey + 5 * (1 + o_orderkey % 4)) % 25) AS away_team_id,
         CASE WHEN o_orderstatus <> 'O' THEN floor(o_totalprice)::BIGINT % 4 END AS home_score,
         CASE WHEN o_orderstatus <> 'O' THEN floor(o_totalprice / 10)::BIGINT % 3 END AS away_score
  FROM orders JOIN customer ON o_custkey = c_custkey
), teams AS (SELECT n_nationkey AS id, n_name AS name, 'N' || n_nationkey AS short_code, NULL::VARCHAR AS image_path FROM nation
), players AS (SELECT p_partkey AS id, p_name || ' ' || p_brand AS name, p_name AS common_name, p_brand AS short_name, p_partkey % 25 AS team_id FROM part
), fixture_players AS (
  SELECT fixture_id, player_id, CASE WHEN ln % 2 = 1 THEN home_team_id ELSE away_team_id END AS team_id, ln <= 4 AS is_starter, q::INT AS minutes_played
  FROM (SELECT l_orderkey AS fixture_id, l_partkey AS player_id, min(l_linenumber) AS ln, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2) JOIN fixtures ON fixture_id = id
), fixture_player_statistics AS (
  SELECT l_orderkey AS fixture_id, l_partkey AS player_id, 42 AS type_id, (l_quantity % 5)::INT AS value FROM lineitem WHERE l_returnflag <> 'R'
  UNION ALL SELECT l_orderkey, l_partkey, 52, (l_quantity % 3)::INT FROM lineitem
), side_lines AS (
  SELECT l.*, CASE WHEN l_linenumber % 2 = 1 THEN home_team_id ELSE away_team_id END AS team_id FROM lineitem l JOIN fixtures ON l_orderkey = id
), side_sums AS (
  SELECT l_orderkey AS fixture_id, team_id, sum(l_quantity % 5)::INT AS s42, count(*) FILTER (WHERE l_returnflag = 'R' AND l_tax > 0.06) AS s83, count(*) FILTER (WHERE l_returnflag = 'A') AS s84 FROM side_lines GROUP BY 1, 2
), fixture_statistics AS (
  SELECT fixture_id, team_id, 42 AS type_id, s42 AS value FROM side_sums UNION ALL SELECT fixture_id, team_id, 83, s83 FROM side_sums UNION ALL SELECT fixture_id, team_id, 84, s84 FROM side_sums
), odds_outcomes AS (
  SELECT DISTINCT l_orderkey AS fixture_id, 1 + l_suppkey % 3 AS bookmaker_id, CASE WHEN l_linestatus = 'F' THEN 'player_shots' ELSE 'player_shots_on_target' END AS market_key, 'p' || l_partkey AS selection_key,
         'player' AS participant_type, CASE WHEN l_tax <> 0 THEN l_partkey END AS participant_id, 0.5 + l_linenumber % 3 AS line, (100 + 20 * round(l_discount * 100) + 10 * round(l_tax * 100)) / 100 AS price_decimal
  FROM lineitem
), seasons AS (
  SELECT season_id AS id, season_id // 10000 AS league_id, season_id % 10000 = 2001 AS is_current, make_timestamp(season_id % 10000, 1, 1, 0, 0, 0) AS start_date, make_timestamp(season_id % 10000, 12, 31, 0, 0, 0) AS end_date
  FROM (SELECT DISTINCT season_id FROM fixtures)
), fixture_participants AS (
  SELECT id AS fixture_id, home_team_id AS team_id, 'home' AS location, home_score AS score FROM fixtures UNION ALL SELECT id, away_team_id, 'away', away_score FROM fixtures
), types AS (
  SELECT * FROM (VALUES (42, 'Shots Total', 'shots-total'), (52, 'Goals', 'goals'), (83, 'Redcards', 'redcards'), (84, 'Yellowcards', 'yellowcards'), (85, 'Yellowred Cards', 'yellowred-cards'), (5304, 'Expected Goals (xG)', 'expected-goals')) v(id, name, code)
), odds_latest AS (
  SELECT l_orderkey AS fixture_id, CASE WHEN l_linenumber % 2 = 1 THEN CASE WHEN l_linenumber % 4 = 1 THEN 'home' ELSE 'away' END ELSE 'match' END AS side,
         CASE WHEN l_linenumber % 2 = 1 THEN 1.5 + l_partkey % 4 ELSE 3.5 + l_partkey % 6 END::DOUBLE AS line, last(((100 + 20 * round(l_discount * 100) + 10 * round(l_tax * 100)) / 100)::DOUBLE ORDER BY l_shipdate, ((100 + 20 * round(l_discount * 100) + 10 * round(l_tax * 100)) / 100)::DOUBLE) AS odds FROM lineitem GROUP BY ALL
), player_odds AS (
  SELECT DISTINCT l_orderkey AS fixture_id, l_partkey AS player_id, (0.5 + l_linenumber % 3)::DOUBLE AS line, ((100 + 20 * round(l_discount * 100) + 10 * round(l_tax * 100)) / 100)::DOUBLE AS odds FROM lineitem WHERE l_linestatus = 'F'
), form AS (
  SELECT f.id AS fixture_id, f.starting_at, a.team_id, b.team_id AS opponent_id, a.value::DOUBLE AS shots_for, b.value::DOUBLE AS shots_against, (a.value + b.value)::DOUBLE AS match_shots
  FROM fixture_statistics a JOIN fixture_statistics b ON a.fixture_id = b.fixture_id AND a.team_id <> b.team_id JOIN fixtures f ON f.id = a.fixture_id WHERE a.type_id = 42 AND b.type_id = 42
), finished AS (SELECT * FROM fixtures WHERE home_score IS NOT NULL AND away_score IS NOT NULL
), sides AS (
  SELECT id AS fixture_id, league_id, season_id, starting_at, home_team_id AS team_id, TRUE AS is_home, home_score AS scored, away_score AS conceded FROM finished
  UNION ALL SELECT id, league_id, season_id, starting_at, away_team_id, FALSE, away_score, home_score FROM finished
), apps AS (
  SELECT fp.*, f.starting_at, f.league_id, f.season_id FROM fixture_players fp JOIN finished f ON f.id = fp.fixture_id
)
"""

AS_OF = "TIMESTAMP '2001-08-02 00:00:00'"


def sql(body: str) -> str:
    return f"WITH {DOMAIN.strip()}\n{body.strip()}"


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def london(c: str) -> str:
    return f"CAST({c} AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/London' AS DATE)"


def seq(value: str, kind: str = "INT") -> str:
    return f"string_agg(coalesce(({value})::{kind}::VARCHAR, 'null'), ',' ORDER BY rn)"


def last(source: str, key: str, n: int | None, where: str = "TRUE") -> str:
    cut = "" if n is None else f" WHERE rn <= {n}"
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY starting_at DESC NULLS FIRST, fixture_id DESC) AS rn FROM {source} WHERE {where}){cut})"


def latest(league: int, season: int | None = None) -> str:
    where = f"league_id = {league}" + (f" AND season_id = {season}" if season else "")
    return f"(SELECT player_id, team_id AS latest_team_id, starting_at AS latest_at FROM {last('apps', 'player_id', 1, where)})"


TEAM = "t.name AS team_name, t.short_code AS team_short_code, t.image_path AS team_image_path"
PLAYER = "p.name AS player_name, p.common_name AS player_common_name, p.short_name AS player_short_name"


def player_windows(type_id: int, n: int, where: str, threshold: float = 0) -> str:
    return f"""(SELECT w.player_id, count(*) AS games, count(v) AS with_stat, count(*) FILTER (WHERE v >= {threshold}) AS games_hit, sum(v) AS total_value, avg(v) AS avg_value,
      {seq('v')} AS last_values, max(starting_at) AS last_at, min(starting_at) AS start_at, string_agg({_ts('starting_at')}, ',' ORDER BY rn) AS dates, max(team_id) FILTER (WHERE rn = 1) AS newest_team
      FROM {last('apps', 'player_id', n, where)} w
      LEFT JOIN (SELECT fixture_id, player_id, max(value) AS v FROM fixture_player_statistics WHERE type_id = {type_id} GROUP BY 1, 2) s ON s.fixture_id = w.fixture_id AND s.player_id = w.player_id
      GROUP BY w.player_id)"""


def streak_columns(team: str) -> str:
    return f"w.player_id, {PLAYER}, {team} AS team_id, {TEAM}, games, games_hit, round(avg_value, 6) AS avg_value, last_values, {_ts('last_at')} AS last_fixture_at, {_ts('start_at')} AS window_start_at"


def player_streak(type_id, n, threshold, required, where, extra="TRUE", limit=None, league=0) -> str:
    return f"""SELECT {streak_columns('latest_team_id')} FROM {player_windows(type_id, n, where, threshold)} w JOIN players p ON p.id = w.player_id JOIN {latest(league)} l USING (player_id)
      LEFT JOIN teams t ON t.id = latest_team_id WHERE games = {n} AND with_stat = {n} AND games_hit >= {required} AND {extra}
      ORDER BY games_hit DESC, w.avg_value DESC, w.player_id {'' if limit is None else f'LIMIT {limit}'}"""


def stat_games(type_id: int) -> str:
    return f"(SELECT s.team_id, s.fixture_id, f.league_id, f.season_id, f.starting_at, s.team_id = f.home_team_id AS is_home, max(value) AS v FROM fixture_statistics s JOIN finished f ON f.id = s.fixture_id WHERE type_id = {type_id} GROUP BY ALL)"


def conceded_games(type_id: int) -> str:
    return f"(SELECT a.* EXCLUDE (v), b.v FROM {stat_games(type_id)} a JOIN {stat_games(type_id)} b ON a.fixture_id = b.fixture_id AND a.team_id <> b.team_id)"


CARDS = "(SELECT s.team_id, s.fixture_id, f.league_id, f.season_id, f.starting_at, s.team_id = f.home_team_id AS is_home, sum(CASE WHEN type_id IN (83, 84, 85) THEN value ELSE 0 END) AS v FROM fixture_statistics s JOIN finished f ON f.id = s.fixture_id GROUP BY ALL)"


def team_windows(games: str, n: int | None, where: str, threshold: float = 0) -> str:
    return f"""(SELECT team_id, count(*) AS games, count(v) AS with_stat, count(*) FILTER (WHERE v >= {threshold}) AS games_hit, sum(v) AS total_value, avg(v) AS avg_value, {seq('v')} AS last_values, max(starting_at) AS last_at
      FROM {last(games, 'team_id', n, where)} GROUP BY team_id)"""


def team_streak(games, n, threshold, required, where, extra="TRUE", last_at=False) -> str:
    return f"""SELECT w.team_id, {TEAM}, games, games_hit, round(avg_value, 6) AS avg_value, last_values {f", {_ts('last_at')} AS last_fixture_at" if last_at else ""}
      FROM {team_windows(games, n, where, threshold)} w LEFT JOIN teams t ON t.id = w.team_id WHERE games = {n} AND with_stat = {n} AND games_hit >= {required} AND {extra}"""


def team_window(games, n, where, extra="TRUE") -> str:
    return f"""SELECT w.team_id, {TEAM}, games, total_value, round(avg_value, 6) AS avg_value, last_values, {_ts('last_at')} AS last_fixture_at
      FROM {team_windows(games, n, where)} w LEFT JOIN teams t ON t.id = w.team_id WHERE games = {n} AND with_stat = {n} AND {extra}"""


def meta(windows: str, n, qualifies: str, extra="TRUE", kind="teams") -> str:
    whole = f"games = {n} AND with_stat = {n} AND {extra}"
    return f"SELECT count(*) FILTER (WHERE games = {n}) AS candidate_{kind}_count, count(*) FILTER (WHERE {whole}) AS complete_windows_count, count(*) FILTER (WHERE {whole} AND {qualifies}) AS qualified_{kind}_count FROM {windows} w"


def score_windows(flag: str, n: int | None, where: str) -> str:
    return f"""(SELECT team_id, count(*) AS games, count(*) AS with_stat, count(*) FILTER (WHERE {flag}) AS hit_games, max(starting_at) AS last_at, avg(scored + conceded) AS avg_goals,
      {seq('scored + conceded')} AS goals, {seq(f'({flag})', 'BOOLEAN')} AS flags FROM {last('sides', 'team_id', n, where)} GROUP BY team_id)"""


L0 = "league_id = 0"
ON = "DATE '2001-07-31'"
TODAY = f"(SELECT * FROM fixtures WHERE league_id = 0 AND {london('starting_at')} = {ON})"
TODAY_TEAMS = f"(SELECT home_team_id AS team_id FROM {TODAY} UNION SELECT away_team_id FROM {TODAY})"
LIKELY = f"""(SELECT team_id, player_id, confidence, starting_at, fixture_id FROM (SELECT *, row_number() OVER (PARTITION BY team_id, player_id ORDER BY starting_at DESC NULLS FIRST, confidence DESC, fixture_id DESC) AS best FROM (
    SELECT a.*, dense_rank() OVER (PARTITION BY team_id ORDER BY starting_at DESC NULLS FIRST, fixture_id DESC) AS game, CASE WHEN is_starter THEN 1.0 WHEN minutes_played > 0 THEN 0.6 END AS confidence
    FROM apps a WHERE league_id = 0 AND starting_at >= {AS_OF} - INTERVAL 60 DAY) WHERE game <= 3 AND confidence IS NOT NULL) WHERE best = 1)"""
LIKELY_TODAY = f"(SELECT DISTINCT player_id FROM {LIKELY} WHERE team_id IN (SELECT team_id FROM {TODAY_TEAMS}))"
LINEUP_TODAY = f"(SELECT DISTINCT player_id FROM fixture_players WHERE fixture_id IN (SELECT id FROM {TODAY}))"
CALENDAR = lambda days, at="last_at": f"{london(at)} >= {london(AS_OF)} - {max(days, 1) - 1}"
ROLLING = lambda days, at="last_at": f"{at} >= {AS_OF} - INTERVAL {days} DAY"


def on_date(players: str, extra: str, limit: int | None = None) -> str:
    return f"""SELECT {streak_columns('newest_team')} FROM {player_windows(42, 2, f'{L0} AND player_id IN (SELECT player_id FROM {players})', 2)} w JOIN players p ON p.id = w.player_id LEFT JOIN teams t ON t.id = newest_team
      WHERE games = 2 AND with_stat = 2 AND games_hit >= 1 AND {extra} ORDER BY games_hit DESC, w.avg_value DESC, w.player_id {'' if limit is None else f'LIMIT {limit}'}"""


def player_total(type_id: int, name: str, limit: int) -> str:
    return f"""SELECT s.player_id, {PLAYER}, latest_team_id AS team_id, {TEAM}, s.total AS {name} FROM (SELECT s.player_id, sum(value) AS total FROM fixture_player_statistics s JOIN finished f ON f.id = s.fixture_id WHERE {L0} AND type_id = {type_id} GROUP BY 1) s
      JOIN players p ON p.id = s.player_id LEFT JOIN {latest(0)} l USING (player_id) LEFT JOIN teams t ON t.id = latest_team_id ORDER BY s.total DESC NULLS FIRST, s.player_id LIMIT {limit}"""


BTTS = "scored > 0 AND conceded > 0"
TEAM_META = "SELECT count(DISTINCT team_id) AS {0}, count(DISTINCT team_id) AS complete_windows_count, count(DISTINCT team_id) AS {1} FROM fixture_statistics s JOIN finished f ON f.id = s.fixture_id WHERE league_id = 0 AND type_id = 42"
PLAYER_META = "SELECT count(DISTINCT player_id) AS {0}, count(DISTINCT player_id) AS complete_windows_count, count(DISTINCT player_id) AS {1} FROM fixture_player_statistics s JOIN finished f ON f.id = s.fixture_id WHERE league_id = 0 AND type_id = 42"

ORACLES = {
    "player_streak_base": player_streak(42, 3, 2, 2, L0),
    "player_streak_base_filters": player_streak(42, 2, 1, 1, f"{L0} AND is_starter AND minutes_played >= 10", f"avg_value >= 1.5 AND {CALENDAR(200)}", 200),
    "player_streak": f"SELECT * FROM ({player_streak(42, 3, 2, 2, L0, limit=200)}) WHERE team_id = 5 ORDER BY games_hit DESC, avg_value DESC, player_id LIMIT 20",
    "player_streak_meta": meta(player_windows(42, 3, L0, 2), 3, "games_hit >= 2", kind="players"),
    "player_streak_playing_on_date": on_date(LIKELY_TODAY, CALENDAR(400)),
    "player_streak_playing_on_date_counts": f"""SELECT (SELECT count(*) FROM {TODAY}) AS today_fixtures_count, (SELECT count(*) FROM {TODAY_TEAMS}) AS today_teams_count, (SELECT count(*) FROM {LIKELY_TODAY}) AS candidate_players_count,
        complete_windows_count, qualified_players_count FROM ({meta(player_windows(42, 2, f'{L0} AND player_id IN (SELECT player_id FROM {LIKELY_TODAY})', 2), 2, 'games_hit >= 1', CALENDAR(400), 'players')})""",
    "player_streak_lineup_on_date": on_date(LINEUP_TODAY, ROLLING(900)),
    "players_on_date_counts": f"SELECT count(DISTINCT d.id) AS today_fixtures_count, count(DISTINCT player_id) AS today_players_count FROM {TODAY} d LEFT JOIN fixture_players fp ON fp.fixture_id = d.id",
    "player_stat_window_last_n": f"""SELECT w.player_id, {PLAYER}, latest_team_id AS team_id, {TEAM}, games, total_value, round(avg_value, 6) AS avg_value, last_values, {_ts('last_at')} AS last_fixture_at, {_ts('start_at')} AS window_start_at, dates AS last_fixture_dates
        FROM {player_windows(42, 3, L0)} w JOIN players p ON p.id = w.player_id JOIN {latest(0)} l USING (player_id) LEFT JOIN teams t ON t.id = latest_team_id WHERE games = 3 AND with_stat = 3 AND {ROLLING(900)}""",
    "player_stat_leaderboard": player_total(42, "total_value", 20),
    "player_stat_leaderboard_meta": PLAYER_META.format("candidate_players_count", "qualified_players_count"),
    "season_top_scorers": player_total(52, "goals_total", 20),
    "search_players": f"""SELECT player_id, player_name, player_common_name, player_short_name, team_id, team_name, team_short_code, last_fixture_at FROM (
        SELECT l.player_id, {PLAYER}, latest_team_id AS team_id, t.name AS team_name, t.short_code AS team_short_code, {_ts('latest_at')} AS last_fixture_at,
          CASE WHEN lower(p.short_name) = 'brand#1 4' THEN 1 WHEN lower(p.common_name) = 'brand#1 4' THEN 2 WHEN lower(p.name) = 'brand#1 4' THEN 3 WHEN lower(p.name) LIKE '%brand#1%' AND lower(p.name) LIKE '%4%' THEN 4
            WHEN lower(p.common_name) LIKE '%brand#1%' AND lower(p.common_name) LIKE '%4%' THEN 5 END AS rank
        FROM players p JOIN {latest(0)} l ON l.player_id = p.id LEFT JOIN teams t ON t.id = latest_team_id) WHERE rank IS NOT NULL ORDER BY rank, last_fixture_at DESC NULLS LAST, player_id LIMIT 10""",
    "team_stat_streak_last_n": team_streak(stat_games(42), 5, 5, 1, L0),
    "team_stat_streak_last_n_home": team_streak(stat_games(42), 5, 8, 1, f"{L0} AND is_home", ROLLING(300)),
    "team_stat_streak_last_n_meta": f"SELECT (SELECT count(*) FROM (SELECT team_id FROM sides WHERE {L0} GROUP BY 1 HAVING count(*) >= 5)) AS candidate_teams_count, complete_windows_count, qualified_teams_count FROM ({meta(team_windows(stat_games(42), 5, L0, 8), 5, 'games_hit >= 2')})",
    "team_stat_window_last_n": team_window(stat_games(42), 5, L0),
    "team_stat_leaderboard": f"SELECT s.team_id, {TEAM}, total_value FROM (SELECT team_id, sum(value) AS total_value FROM fixture_statistics s JOIN finished f ON f.id = s.fixture_id WHERE {L0} AND type_id = 42 GROUP BY 1) s LEFT JOIN teams t ON t.id = s.team_id",
    "team_stat_leaderboard_meta": TEAM_META.format("candidate_teams_count", "qualified_teams_count"),
    "leaderboard_meta_team": TEAM_META.format("candidate_count", "qualified_count"),
    "leaderboard_meta_player": PLAYER_META.format("candidate_count", "qualified_count"),
    "team_derived_stat_window_last_n": team_window(conceded_games(42), 5, L0),
    "team_derived_stat_leaderboard_last_n": team_window(conceded_games(42), 5, f"{L0} AND NOT is_home"),
    "team_derived_stat_streak_last_n": team_streak(conceded_games(42), 5, 8, 2, L0, last_at=True),
    "team_derived_stat_streak_meta": meta(team_windows(conceded_games(42), 5, L0, 8), 5, "games_hit >= 2"),
    "team_cards_window_last_n": team_window(CARDS, 5, L0),
    "team_cards_window_meta": meta(team_windows(CARDS, 5, L0), 5, "TRUE"),
    "team_cards_streak_last_n": team_streak(CARDS, 5, 1, 2, L0),
    "team_cards_streak_last_n_meta": meta(team_windows(CARDS, 5, L0, 1), 5, "games_hit >= 2"),
    "team_btts_pct_last_n": f"SELECT w.team_id, {TEAM}, games, hit_games AS btts_games, round(hit_games / 5, 6) AS btts_pct, flags AS last_flags FROM {score_windows(BTTS, 5, L0)} w JOIN teams t ON t.id = w.team_id WHERE games = 5",
    "team_btts_pct_season": f"SELECT w.team_id, {TEAM}, games, hit_games AS btts_games, round(hit_games / games, 6) AS btts_pct, {_ts('last_at')} AS last_fixture_at FROM {score_windows(BTTS, None, L0)} w JOIN teams t ON t.id = w.team_id",
    "team_btts_last_n_meta": meta(score_windows(BTTS, 5, L0), 5, "hit_games >= 2"),
    "team_over_goals_rate_last_n": f"SELECT w.team_id, {TEAM}, games, hit_games AS over_games, round(hit_games / games, 6) AS over_pct, round(avg_goals, 6) AS avg_goals, goals AS last_values, {_ts('last_at')} AS last_fixture_at FROM {score_windows('scored + conceded >= 3', 5, L0)} w LEFT JOIN teams t ON t.id = w.team_id WHERE games = 5",
    "team_over_goals_streak_last_n": f"SELECT w.team_id, {TEAM}, games, hit_games AS games_hit, round(avg_goals, 6) AS avg_goals, goals AS last_values, {_ts('last_at')} AS last_fixture_at FROM {score_windows('scored + conceded >= 3', 5, L0)} w LEFT JOIN teams t ON t.id = w.team_id WHERE games = 5 AND hit_games >= 2",
    "team_over_goals_streak_meta": meta(score_windows("scored + conceded >= 3", 5, L0), 5, "hit_games >= 2"),
    "team_clean_sheets": f"SELECT w.team_id, {TEAM}, games, hit_games AS clean_sheets, round(hit_games / games, 6) AS clean_sheet_pct, {_ts('last_at')} AS last_fixture_at, flags AS last_flags FROM {score_windows('conceded = 0', 10, L0)} w LEFT JOIN teams t ON t.id = w.team_id WHERE games = 10",
    "team_clean_sheets_all": f"SELECT w.team_id, {TEAM}, games, hit_games AS clean_sheets, round(hit_games / games, 6) AS clean_sheet_pct, {_ts('last_at')} AS last_fixture_at, flags AS last_flags FROM {score_windows('conceded = 0', None, L0)} w LEFT JOIN teams t ON t.id = w.team_id",
    "team_clean_sheets_meta": meta(score_windows("conceded = 0", 10, L0), 10, "hit_games >= 3"),
    "teams_playing_on_date": f"SELECT team_id, count(*) AS fixture_count FROM (SELECT home_team_id AS team_id FROM {TODAY} UNION ALL SELECT away_team_id FROM {TODAY}) GROUP BY 1",
    "refresh_team_likely_players": f"SELECT team_id, player_id, confidence::DOUBLE AS confidence, {_ts('starting_at')} AS last_seen_at, fixture_id AS source_fixture_id, {_ts(AS_OF)} AS updated_at FROM {LIKELY}",
}


RATE = lambda value, sizes, least: f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY team_id, line ORDER BY pct DESC, size) AS best FROM (
    SELECT w.team_id, lines.line, size, avg((v >= lines.line)::INT) AS pct, count(*) AS total, avg(v) AS avg, string_agg(v::INT::VARCHAR, ',' ORDER BY rn) AS seq
    FROM (SELECT team_id, {value} AS v, row_number() OVER (PARTITION BY team_id ORDER BY starting_at DESC NULLS FIRST, fixture_id DESC) AS rn FROM form) w
    CROSS JOIN (SELECT DISTINCT line FROM (SELECT line FROM odds_latest UNION ALL SELECT line FROM player_odds)) lines CROSS JOIN (SELECT unnest({list(sizes)}) AS size) s WHERE rn <= size AND v IS NOT NULL GROUP BY ALL
    HAVING count(*) >= {least})) WHERE best = 1)"""  # noqa: E731
NEAR = f"(SELECT * FROM fixtures WHERE starting_at BETWEEN {AS_OF} - INTERVAL 60 DAY AND {AS_OF} + INTERVAL 14 DAY)"


def shot_bets(side: str, own: str, other: str, own_value: str, other_value: str, market: str) -> str:
    return f"""SELECT o.fixture_id, '{market}' AS market, o.side, o.line, round(o.odds, 6) AS odds, f.{own} AS team_id, f.{other} AS opponent_id, round(a.pct, 6) AS team_pct, round(b.pct, 6) AS opp_pct, a.total AS team_samples, b.total AS opp_samples,
      a.size AS team_sample_size, b.size AS opp_sample_size, a.seq AS team_seq, b.seq AS opp_seq
      FROM odds_latest o JOIN {NEAR} f ON f.id = o.fixture_id JOIN {RATE(own_value, (10, 20), 3)} a ON a.team_id = f.{own} AND a.line = o.line JOIN {RATE(other_value, (10, 20), 3)} b ON b.team_id = f.{other} AND b.line = o.line
      WHERE o.side = '{side}' AND least(a.pct, b.pct) >= 0.5"""


FORMS = f"""(SELECT player_id, max(team_id) FILTER (WHERE rn = 1) AS team_id, count(*) AS n, list(v ORDER BY rn) AS shots FROM (SELECT w.*, s.v FROM {last('apps', 'player_id', 20)} w
    LEFT JOIN (SELECT fixture_id, player_id, max(value) AS v FROM fixture_player_statistics WHERE type_id = 42 GROUP BY 1, 2) s ON s.fixture_id = w.fixture_id AND s.player_id = w.player_id) GROUP BY player_id)"""
KEPT = "(SELECT * EXCLUDE (rank) FROM (SELECT *, row_number() OVER (PARTITION BY league_id ORDER BY is_current DESC, end_date DESC, id DESC) AS rank FROM seasons) WHERE rank <= 2)"
EXPORTED = f"(SELECT * FROM fixtures WHERE season_id IN (SELECT id FROM {KEPT}) AND ((home_score IS NOT NULL AND away_score IS NOT NULL) OR starting_at BETWEEN {AS_OF} AND {AS_OF} + INTERVAL 14 DAY))"
WINDOW = "(SELECT * FROM fixtures WHERE starting_at >= TIMESTAMP '2001-07-01' AND starting_at < TIMESTAMP '2001-07-16')"
OF_TEAM = "(SELECT *, row_number() OVER (ORDER BY starting_at DESC, fixture_id DESC) AS rn FROM sides WHERE team_id = 5)"

ORACLES |= {
    "stat_type_usage": """SELECT t.id AS type_id, t.code AS key, t.name, t.id IN (SELECT type_id FROM fixture_player_statistics) OR t.code = 'expected-goals' AS is_player, t.id IN (SELECT type_id FROM fixture_statistics) AS is_team FROM types t
        WHERE t.id IN (SELECT type_id FROM fixture_player_statistics UNION SELECT type_id FROM fixture_statistics) OR t.code LIKE 'expected-goal%'""",
    "stat_type_counts_by_league": f"""SELECT coalesce(a.type_id, b.type_id) AS type_id, player_rows, player_players_count, team_rows, team_teams_count
        FROM (SELECT type_id, count(*) AS player_rows, count(DISTINCT player_id) AS player_players_count FROM fixture_player_statistics JOIN finished ON id = fixture_id WHERE {L0} GROUP BY 1) a
        FULL JOIN (SELECT type_id, count(*) AS team_rows, count(DISTINCT team_id) AS team_teams_count FROM fixture_statistics JOIN finished ON id = fixture_id WHERE {L0} GROUP BY 1) b ON a.type_id = b.type_id""",
    "odds_target_fixtures": f"SELECT id, league_id, {_ts('starting_at')} AS starting_at, home_team_id, away_team_id FROM {WINDOW} WHERE league_id IN (0, 1)",
    "fixture_odds": "SELECT fixture_id, bookmaker_id, market_key, selection_key, participant_type, participant_id, round(line::DOUBLE, 6) AS line, round(price_decimal::DOUBLE, 6) AS price_decimal FROM odds_outcomes WHERE bookmaker_id = 2 AND fixture_id = 7",
    "player_odds_next_days": f"""SELECT fixture_id, {_ts('starting_at')} AS starting_at, participant_id AS player_id, selection_key, round(line::DOUBLE, 6) AS line, round(price_decimal::DOUBLE, 6) AS price_decimal FROM odds_outcomes JOIN fixtures f ON f.id = fixture_id
        WHERE {L0} AND starting_at >= TIMESTAMP '2001-07-01' AND starting_at < TIMESTAMP '2001-07-31' AND bookmaker_id = 2 AND market_key = 'player_shots' AND participant_id IS NOT NULL""",
    "filter_players_by_odds": f"""SELECT player_id, fixture_id, {_ts('starting_at')} AS starting_at, round(price_decimal::DOUBLE, 6) AS price_decimal, round(line::DOUBLE, 6) AS line, market_key, selection_key, bookmaker_id FROM (
        SELECT o.*, participant_id AS player_id, starting_at, row_number() OVER (PARTITION BY participant_id ORDER BY price_decimal DESC, fixture_id DESC, line, selection_key, bookmaker_id) AS best FROM odds_outcomes o JOIN fixtures f ON f.id = fixture_id
        WHERE {L0} AND {london('starting_at')} >= DATE '2001-05-01' AND {london('starting_at')} < DATE '2001-07-30' AND market_key = 'player_shots' AND price_decimal BETWEEN 1.2 AND 2.5 AND participant_id IN (SELECT id FROM players WHERE short_name < 'Brand#3')) WHERE best = 1""",
    "odds_coverage": f"""SELECT *, distinct_sot_05_players >= 20 AND coalesce(mapped_pct_player_outcomes, 0) >= 80 AS passed FROM (SELECT count(DISTINCT CASE WHEN market_key = 'player_shots_on_target' AND line = 0.5 THEN participant_id END) AS distinct_sot_05_players,
        round(100.0 * count(participant_id) / nullif(count(*), 0), 2) AS mapped_pct_player_outcomes FROM odds_outcomes WHERE fixture_id IN (SELECT id FROM fixtures WHERE {L0} AND {london('starting_at')} >= DATE '2001-07-01' AND {london('starting_at')} < DATE '2001-07-15'))""",
    "odds_latest": """SELECT fixture_id, market_key, selection_key, round(line::DOUBLE, 6) AS line, round(price::DOUBLE, 6) AS price_decimal FROM (
        SELECT l_orderkey AS fixture_id, CASE WHEN l_linestatus = 'F' THEN 'player_shots' ELSE 'player_shots_on_target' END AS market_key, trim(regexp_replace(lower(p_name || ' ' || p_brand || ' over ' || (0.5 + l_linenumber % 3)::DECIMAL(3,1)), '[^a-z0-9]+', '_', 'g'), '_') AS selection_key,
          0.5 + l_linenumber % 3 AS line, round(1 + l_discount, 2) AS price, row_number() OVER (PARTITION BY l_orderkey, l_linestatus, p_name, p_brand, l_linenumber % 3 ORDER BY l_shipdate DESC, round(1 + l_discount, 2) DESC) AS best FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE best = 1""",
    "team_shot_form": f"SELECT fixture_id, {_ts('starting_at')} AS starting_at, team_id, opponent_id, shots_for, shots_against, match_shots FROM form",
    "shot_over_odds": "SELECT fixture_id, side, line, round(odds, 6) AS odds FROM odds_latest",
    "team_shot_value_bets": " UNION ALL ".join([shot_bets("home", "home_team_id", "away_team_id", "shots_for", "shots_against", "team shots"), shot_bets("away", "away_team_id", "home_team_id", "shots_for", "shots_against", "team shots"), shot_bets("match", "home_team_id", "away_team_id", "match_shots", "match_shots", "match shots")]),
    "player_forms": f"SELECT player_id, team_id, size AS sample_size, array_to_string(list_transform(shots[1:size], lambda v: coalesce(v::VARCHAR, 'null')), ',') AS shots FROM {FORMS} CROSS JOIN (SELECT unnest([5, 10]) AS size) WHERE n >= size",
    "shots_hit_rates": f"""SELECT player_id, team_id, size AS sample_size, sample, hits, round(hits / sample, 6) AS rate, array_to_string(list_transform(shots[1:sample], lambda v: coalesce(v, 0)), ',') AS seq FROM (
        SELECT *, len(list_filter(shots[1:sample], lambda v: v >= 1)) AS hits FROM {FORMS} CROSS JOIN (SELECT unnest([11, 14, 15, 20]) AS size) CROSS JOIN (VALUES (11, 9), (14, 12), (15, 13), (20, 16)) v(sample, required) WHERE n >= size AND size >= sample) WHERE hits >= required""",
    "player_shot_value_bets": f"""SELECT o.fixture_id, o.player_id, l.latest_team_id AS team_id, opponent_id, o.line, round(o.odds, 6) AS odds, round(p.pct, 6) AS player_pct, round(r.pct, 6) AS opp_pct, p.size AS player_sample, r.size AS opp_sample_size, p.seq AS player_seq, r.seq AS opp_seq
        FROM player_odds o JOIN (SELECT * FROM fixtures WHERE starting_at BETWEEN {AS_OF} - INTERVAL 700 DAY AND {AS_OF} + INTERVAL 14 DAY) f ON f.id = o.fixture_id JOIN {latest(0)} l ON l.player_id = o.player_id AND l.latest_team_id IN (home_team_id, away_team_id)
        JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY pct DESC, size) AS best FROM (SELECT player_id, size, len(list_filter(known, lambda v: v >= 1)) / len(known) AS pct, array_to_string(known, ',') AS seq FROM (
          SELECT player_id, size, list_filter(shots[1:size], lambda v: v IS NOT NULL) AS known FROM {FORMS} CROSS JOIN (SELECT unnest([5, 10]) AS size) WHERE n >= size) WHERE len(known) > 0)) WHERE best = 1 AND pct >= 0.8) p ON p.player_id = o.player_id
        JOIN (SELECT team_id AS opponent_id, * EXCLUDE (team_id) FROM {RATE('shots_against', (5, 10), 1)}) r ON r.opponent_id = CASE WHEN l.latest_team_id = home_team_id THEN away_team_id ELSE home_team_id END AND r.line = o.line WHERE o.odds >= 1.25 AND r.pct >= 0.7""",
    "outside_box_sot": f"""SELECT player_id, p.name AS player, a.team_id, t.name AS team, hit_games, samples, seq FROM (
        SELECT player_id, team_id, count(*) FILTER (WHERE value >= 1) AS hit_games, count(*) AS samples, string_agg(value::INT::VARCHAR, '-' ORDER BY rn) AS seq FROM (
          SELECT s.*, fp.team_id, row_number() OVER (PARTITION BY s.player_id ORDER BY f.starting_at DESC NULLS LAST, s.fixture_id DESC, value DESC) AS rn FROM fixture_player_statistics s JOIN fixture_players fp ON fp.fixture_id = s.fixture_id AND fp.player_id = s.player_id JOIN fixtures f ON f.id = s.fixture_id WHERE type_id = 42)
        WHERE rn <= 10 GROUP BY 1, 2) a JOIN players p ON p.id = player_id JOIN teams t ON t.id = a.team_id ORDER BY hit_games DESC, samples DESC, player_id, a.team_id LIMIT 50""",
    "team_forms": f"SELECT team_id, count(*) AS games, round(avg(shots_for), 6) AS shots_for, round(avg(shots_against), 6) AS shots_against, string_agg(match_shots::INT::VARCHAR, ',' ORDER BY rn) AS match_shots FROM {last('form', 'team_id', 10)} GROUP BY 1",
    "player_availability": f"""SELECT l.player_id, latest_team_id AS team_id, team_games, coalesce(n, 0) AS appearances, round(coalesce(n, 0) / team_games, 6) AS availability FROM {latest(0)} l JOIN (SELECT team_id, count(*) AS team_games FROM {last('sides', 'team_id', 5, L0)} GROUP BY 1) g ON g.team_id = latest_team_id
        LEFT JOIN (SELECT fp.player_id, fp.team_id, count(*) AS n FROM fixture_players fp JOIN {last('sides', 'team_id', 5, L0)} w ON w.fixture_id = fp.fixture_id AND w.team_id = fp.team_id GROUP BY 1, 2) s ON s.player_id = l.player_id AND s.team_id = latest_team_id""",
    "freshness_report": f"""SELECT count(*) AS fixtures_total, count(*) FILTER (WHERE home_score IS NOT NULL) AS fixtures_scored, {_ts('max(starting_at) FILTER (WHERE home_score IS NOT NULL)')} AS max_scored_at, count(*) FILTER (WHERE home_score IS NOT NULL) AS participants_scored,
        {_ts('max(starting_at) FILTER (WHERE home_score IS NOT NULL)')} AS max_participants_scored_at, count(*) FILTER (WHERE home_score IS NOT NULL AND {L0} AND starting_at >= TIMESTAMP '2001-01-01') AS league_scored_since,
        count(*) FILTER (WHERE home_score IS NOT NULL AND starting_at >= TIMESTAMP '2001-01-01' AND 5 IN (home_team_id, away_team_id)) AS team_scored_since, max(starting_at) FILTER (WHERE home_score IS NOT NULL) < {AS_OF} - INTERVAL 30 DAY AS stale FROM fixtures""",
    "player_stat_staleness": f"""SELECT {_ts('a')} AS max_fixture_at, {_ts('b')} AS max_stat_at, CASE WHEN a IS NULL OR b IS NULL THEN 'skipped' WHEN b < TIMESTAMP '2000-01-01' THEN 'missing' WHEN a > b + INTERVAL 7 DAY THEN 'stale' ELSE 'ok' END AS status
        FROM (SELECT (SELECT max(starting_at) FROM finished WHERE league_id IN (0, 1)) AS a, (SELECT max(starting_at) FROM fixtures f JOIN fixture_player_statistics s ON s.fixture_id = f.id WHERE player_id = 7 AND type_id = 42 AND league_id IN (0, 1)) AS b)""",
    "team_results_sequence": f"""SELECT 5 AS team_id, string_agg(CASE WHEN scored > conceded THEN 'W ' WHEN scored < conceded THEN 'L ' ELSE 'D ' END || CASE WHEN is_home THEN scored || '-' || conceded ELSE conceded || '-' || scored END, ',' ORDER BY rn) AS results FROM {OF_TEAM} WHERE rn <= 5""",
    "team_stat_sequence": f"SELECT 5 AS team_id, string_agg(coalesce(v::VARCHAR, 'n/a'), ',' ORDER BY rn) AS values FROM {OF_TEAM} w LEFT JOIN (SELECT fixture_id, max(value) AS v FROM fixture_statistics WHERE team_id = 5 AND type_id = 84 GROUP BY 1) s ON s.fixture_id = w.fixture_id WHERE rn <= 5",
    "player_stat_sequence": """SELECT 7 AS player_id, string_agg(coalesce(v::VARCHAR, 'n/a'), ',' ORDER BY rn) AS values, string_agg(is_starter::VARCHAR, ',' ORDER BY rn) AS started FROM (SELECT fp.*, row_number() OVER (ORDER BY starting_at DESC, fixture_id DESC) AS rn FROM fixture_players fp JOIN fixtures f ON f.id = fixture_id WHERE player_id = 7) w
        LEFT JOIN (SELECT fixture_id, max(value) AS v FROM fixture_player_statistics WHERE player_id = 7 AND type_id = 42 GROUP BY 1) s ON s.fixture_id = w.fixture_id WHERE rn <= 10""",
    "find_player": """SELECT player_id, shirt AS player_name, fixture_players.team_id, fixture_id FROM fixture_players JOIN (SELECT id, CASE WHEN id % 3 = 0 THEN 'No. ' || short_name ELSE name END AS shirt FROM players) ON id = player_id
        WHERE lower(shirt) LIKE '%no. brand#1%' ORDER BY fixture_id DESC, player_id LIMIT 1""",
    "current_season": f"SELECT id, league_id, is_current, {_ts('start_date')} AS start_date, {_ts('end_date')} AS end_date FROM seasons WHERE {L0} ORDER BY is_current DESC, end_date DESC LIMIT 1",
    "reconcile_scores": """SELECT id, home_score, away_score, stored_home, stored_away, CASE WHEN found THEN 'mismatch' ELSE 'missing' END AS problem FROM (SELECT * FROM finished ORDER BY starting_at DESC, id DESC LIMIT 500) a
        LEFT JOIN (SELECT id, home_score + (id % 3 = 0)::INT AS stored_home, away_score AS stored_away, TRUE AS found FROM fixtures WHERE id % 5 <> 0) b USING (id) WHERE home_score IS DISTINCT FROM stored_home OR away_score IS DISTINCT FROM stored_away""",
    "keep_seasons": f"SELECT id, league_id, is_current, {_ts('start_date')} AS start_date, {_ts('end_date')} AS end_date FROM {KEPT}",
    "season_window": "SELECT id, strftime(start_date, '%Y-%m-%d') AS first_day, strftime(CASE WHEN is_current THEN least(end_date::DATE, DATE '2001-08-03') ELSE end_date::DATE END, '%Y-%m-%d') AS last_day FROM seasons",
    "fixtures_in_window": f"SELECT id, league_id, {_ts('starting_at')} AS starting_at FROM fixtures WHERE starting_at >= TIMESTAMP '2001-04-04' AND starting_at < TIMESTAMP '2001-08-04' AND league_id IN (0, 1)",
    "history_fixtures": f"SELECT id, season_id FROM fixtures WHERE season_id IN (SELECT id FROM {KEPT} WHERE league_id IN (0, 1))",
    "export_subset": f"""SELECT 'seasons' AS table_name, count(*) AS rows FROM {KEPT} UNION ALL SELECT 'fixtures', count(*) FROM {EXPORTED} UNION ALL SELECT 'teams', count(*) FROM (SELECT home_team_id FROM {EXPORTED} UNION SELECT away_team_id FROM {EXPORTED})
        UNION ALL SELECT 'players', count(*) FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_orderkey IN (SELECT id FROM {EXPORTED})) UNION ALL SELECT 'fixture_players', count(*) FROM fixture_players WHERE fixture_id IN (SELECT id FROM {EXPORTED})
        UNION ALL SELECT 'fixture_player_statistics', count(*) FROM fixture_player_statistics WHERE fixture_id IN (SELECT id FROM {EXPORTED}) UNION ALL SELECT 'fixture_statistics', count(*) FROM fixture_statistics WHERE fixture_id IN (SELECT id FROM {EXPORTED})
        UNION ALL SELECT 'odds_outcomes', count(*) FROM odds_outcomes WHERE fixture_id IN (SELECT id FROM {EXPORTED})""",
    "unknown_team_fixtures": "SELECT id FROM fixtures WHERE home_team_id >= 20 OR away_team_id >= 20",
    "dedupe_team_stats": "SELECT fixture_id, team_id, type_id, max(value) AS value FROM fixture_statistics GROUP BY ALL",
    "prune_fixtures": f"SELECT id, season_id FROM fixtures WHERE season_id IN (SELECT id FROM {KEPT}) OR season_id IS NULL",
    "export_odds_window": f"SELECT fixture_id, bookmaker_id, market_key, selection_key, round(line::DOUBLE, 6) AS line, round(price_decimal::DOUBLE, 6) AS price_decimal FROM odds_outcomes WHERE fixture_id IN (SELECT id FROM {WINDOW})",
    "odds_participant_patch": f"SELECT fixture_id, bookmaker_id, market_key, selection_key, round(line::DOUBLE, 6) AS line, participant_id, participant_type FROM odds_outcomes WHERE participant_id IS NOT NULL AND fixture_id IN (SELECT id FROM {WINDOW})",
    "merge_by_key": "SELECT id, CASE WHEN id % 2 = 0 THEN upper(name) ELSE name END AS name, short_code FROM teams",
    "upsert_outcomes": """SELECT fixture_id, selection_key, bookmaker_id, market_key, round(line::DOUBLE, 6) AS line, participant_id, round((price_decimal + CASE WHEN fixture_id % 3 = 0 THEN 1 ELSE 0 END)::DOUBLE, 6) AS price_decimal FROM (SELECT fixture_id, bookmaker_id, market_key, selection_key, line, max(participant_id) AS participant_id, max(price_decimal) AS price_decimal FROM odds_outcomes GROUP BY ALL)""",
}

_IDS = f"SELECT id FROM {EXPORTED}"
_OFFERS = "SELECT l_orderkey AS fixture_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS pulled_at, count(*) AS offers FROM lineitem"
ORACLES |= {
    "export_seasons": f"SELECT id, league_id FROM {KEPT}",
    "export_fixtures": f"SELECT id, season_id, {_ts('starting_at')} AS starting_at, home_team_id, away_team_id, home_score, away_score FROM {EXPORTED}",
    "export_teams": f"SELECT id, name, short_code FROM teams WHERE id IN (SELECT home_team_id FROM {EXPORTED} UNION SELECT away_team_id FROM {EXPORTED})",
    "export_players": f"SELECT id, name, team_id FROM players WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_orderkey IN ({_IDS}))",
    "export_fixture_players": f"SELECT fixture_id, player_id, team_id, is_starter, minutes_played FROM fixture_players WHERE fixture_id IN ({_IDS})",
    "export_fixture_player_statistics": f"SELECT fixture_id, player_id, type_id, value FROM fixture_player_statistics WHERE fixture_id IN ({_IDS})",
    "export_fixture_statistics": f"SELECT fixture_id, team_id, type_id, max(value) AS value FROM fixture_statistics WHERE fixture_id IN ({_IDS}) GROUP BY 1, 2, 3",
    "export_odds_outcomes": f"SELECT fixture_id, bookmaker_id, market_key, selection_key, round(line::DOUBLE, 6) AS line, participant_id, round(price_decimal::DOUBLE, 6) AS price_decimal FROM odds_outcomes WHERE fixture_id IN ({_IDS})",
    "export_odds_snapshots": f"{_OFFERS} WHERE l_orderkey IN ({_IDS}) GROUP BY ALL",
    "export_odds_window_snapshots": f"{_OFFERS} WHERE l_orderkey IN (SELECT id FROM {WINDOW}) GROUP BY ALL",
    "write_export": ORACLES["export_subset"],
    "stored_fixtures_in_window": ORACLES["fixtures_in_window"],
    "stored_odds_target_fixtures": ORACLES["odds_target_fixtures"],
    "stored_player_streak_base": ORACLES["player_streak_base"],
    "merge_partitions": f"""SELECT id, league_id, {_ts("CASE WHEN league_id = 1 AND strftime(starting_at, '%Y%m') = '199703' AND id % 7 = 0 THEN starting_at + INTERVAL 1 MONTH ELSE starting_at END")} AS starting_at,
        CASE WHEN league_id = 0 AND strftime(starting_at, '%Y%m') IN ('200105', '200106') THEN 9 ELSE home_score END AS home_score FROM fixtures
        UNION ALL SELECT -id, 77, {_ts('starting_at')}, home_score FROM fixtures WHERE league_id = 2 AND strftime(starting_at, '%Y%m') = '199801'""",
}
