"""Domain tables: their columns, types and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

SCHEMAS = {
    "seasons": "id int, league_id int, name string, start_date timestamp, end_date timestamp, is_current boolean, extra string",
    "teams": "id int, name string, short_code string, image_path string, extra string",
    "players": "id int, name string, short_name string, common_name string, team_id int, image_path string, extra string",
    "fixtures": "id int, league_id int, season_id int, starting_at timestamp, status string, status_code string, home_team_id int, away_team_id int, home_score int, away_score int, extra string",
    "fixture_participants": "fixture_id int, team_id int, location string, score int, extra string",
    "fixture_statistics": "fixture_id int, team_id int, type_id int, code string, location string, name string, value int, extra string",
    "fixture_players": "fixture_id int, player_id int, team_id int, name string, position string, lineup_type string, jersey_number string, position_name string, formation_field string, position_abbr string, is_starter boolean, minutes_played int, formation_position int, detailed_position_id int, detailed_position_name string, detailed_position_code string, extra string",
    "fixture_player_statistics": "fixture_id int, player_id int, type_id int, code string, team_id int, name string, value int, extra string",
    "types": "id int, name string, code string, developer_name string, model_type string, stat_group string",
    "team_likely_players": "team_id int, player_id int, confidence double, last_seen_at timestamp, source_fixture_id long, updated_at timestamp",
    "odds_snapshots": "id long, fixture_id long, bookmaker_id int, pulled_at timestamp, raw string",
    "odds_outcomes": "fixture_id long, bookmaker_id int, market_key string, selection_key string, participant_type string, participant_id long, line decimal(10,2), price_decimal decimal(10,4), price_american int, last_updated_at timestamp",
}

KEYS = {
    "seasons": ["id"],
    "teams": ["id"],
    "players": ["id"],
    "fixtures": ["id"],
    "fixture_participants": ["fixture_id", "team_id"],
    "fixture_statistics": ["fixture_id", "team_id", "type_id", "code", "location"],
    "fixture_players": ["fixture_id", "player_id"],
    "fixture_player_statistics": ["fixture_id", "player_id", "type_id", "code"],
    "types": ["id"],
    "team_likely_players": ["team_id", "player_id"],
    "odds_outcomes": ["fixture_id", "bookmaker_id", "market_key", "selection_key", "line"],
}


@dataclass(frozen=True)
class Tables:
    """The frames that operators read; a table that an operator does not read may be None."""

    fixtures: DataFrame | None = None
    teams: DataFrame | None = None
    players: DataFrame | None = None
    fixture_players: DataFrame | None = None
    fixture_player_statistics: DataFrame | None = None
    fixture_statistics: DataFrame | None = None
    fixture_participants: DataFrame | None = None
    seasons: DataFrame | None = None
    types: DataFrame | None = None
    team_likely_players: DataFrame | None = None
    odds_outcomes: DataFrame | None = None
    odds_snapshots: DataFrame | None = None
    odds_latest: DataFrame | None = None
    player_odds: DataFrame | None = None
    player_forms: DataFrame | None = None
    team_stats: DataFrame | None = None
    player_stats: DataFrame | None = None
