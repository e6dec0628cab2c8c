"""Player queries: streaks, windows, leaderboards and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Tables
from .core import (
    complete, counts, day, falling, finished_fixtures, last_n, latest_team, london_date, of_league, player_appearances, recent_calendar, recent_rolling,
    stat_value, top, window_agg, with_player, with_team,
)

NAMES = ["player_id", "player_name", "player_common_name", "player_short_name", "team_id", "team_name", "team_short_code", "team_image_path"]
STREAK = [*NAMES, "games", "games_hit", "avg_value", "last_values", "last_fixture_at", "window_start_at"]


def _windows(t: Tables, league, type_id, n, season=None, started_only=False, min_minutes=None, player=None, threshold=None, only: DataFrame | None = None) -> DataFrame:
    apps = player_appearances(t, league, season, started_only, min_minutes)
    if player is not None:
        apps = apps.filter(F.col("player_id") == player)
    if only is not None:
        apps = apps.join(only, "player_id", "left_semi")
    games = stat_value(last_n(apps, "player_id", n), of_league(t.fixture_player_statistics, league), type_id, ["fixture_id", "player_id"])
    return window_agg(games, "player_id", threshold=threshold)


def player_streak_base(
    t: Tables, *, league: int, type_id: int, n: int, threshold: float, required: int, min_avg: float | None = None, started_only: bool = False,
    min_minutes: int | None = None, season: int | None = None, recent_days: int | None = None, as_of=None, limit: int | None = 200,
) -> DataFrame:
    """Players whose last ``n`` appearances all have the statistic, ``required`` of them at ``threshold`` or more."""
    rows = _windows(t, league, type_id, n, season, started_only, min_minutes, threshold=threshold)
    rows = rows.filter(complete(n) & (F.col("games_hit") >= required) & recent_calendar(as_of, recent_days))
    if min_avg is not None:
        rows = rows.filter(F.col("avg_value") >= min_avg)
    named = with_team(with_player(rows, t).join(latest_team(t, league, season).select("player_id", "team_id"), "player_id"), t)
    return top(named.select(*STREAK), [*falling("games_hit", "avg_value"), F.col("player_id")], limit)


def player_streak(t: Tables, *, team: int | None = None, result_limit: int | None = 200, limit: int | None = 20, **params) -> DataFrame:
    """``player_streak_base`` cut to ``result_limit``, then a team's rows, then ``limit``."""
    rows = player_streak_base(t, limit=result_limit, **params)
    if team is not None:
        rows = rows.filter(F.col("team_id") == team)
    return top(rows, [*falling("games_hit", "avg_value"), F.col("player_id")], limit)


def player_streak_meta(t: Tables, *, league, type_id, n, threshold, required, started_only=False, min_minutes=None, season=None, recent_days=None, as_of=None) -> DataFrame:
    """Candidates, complete windows and qualified players in one pass: a window is full exactly for candidates."""
    whole = complete(n) & recent_calendar(as_of, recent_days)
    return _windows(t, league, type_id, n, season, started_only, min_minutes, threshold=threshold).agg(
        *counts(candidate_players_count=F.col("games") == n, complete_windows_count=whole, qualified_players_count=whole & (F.col("games_hit") >= required))
    )


def fixtures_on(t: Tables, on, league: int, season: int | None = None) -> DataFrame:
    fx = t.fixtures.filter((F.col("league_id") == league) & (london_date(F.col("starting_at")) == day(on)))
    return fx if season is None else fx.filter(F.col("season_id") == season)


def teams_on(t: Tables, on, league: int, season: int | None = None) -> DataFrame:
    sides = fixtures_on(t, on, league, season).select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    return sides.filter("team_id is not null").distinct()


def _candidates(t: Tables, on, league, season, team, source: str) -> DataFrame:
    if source == "lineup":
        today = fixtures_on(t, on, league, season).select(F.col("id").alias("fixture_id"))
        rows = t.fixture_players.join(today, "fixture_id", "left_semi")
    else:
        rows = t.team_likely_players.join(teams_on(t, on, league, season), "team_id", "left_semi")
    return (rows if team is None else rows.filter(F.col("team_id") == team)).select("player_id").distinct()


def _on_date(t: Tables, on, league, type_id, n, threshold, season, started_only, min_minutes, team, source) -> DataFrame:
    apps = player_appearances(t, league, season, started_only, min_minutes).join(_candidates(t, on, league, season, team, source), "player_id", "left_semi")
    games = stat_value(last_n(apps, "player_id", n), of_league(t.fixture_player_statistics, league), type_id, ["fixture_id", "player_id"])
    newest = games.filter("rn = 1").select("player_id", "team_id")
    # A missing value would count as 0 against the threshold; complete windows have none.
    return window_agg(games, "player_id", threshold=threshold).join(newest, "player_id")


def player_streak_playing_on_date(
    t: Tables, *, on, league: int, type_id: int, n: int, threshold: float, required: int, min_avg=None, started_only=False, min_minutes=None,
    season=None, team=None, recent_days=None, as_of=None, result_limit: int | None = 200, limit: int | None = 20, candidate_source: str = "likely",
) -> DataFrame:
    """Streaks of players likely to play on a London day: teams with a fixture that day, their likely players (or, with
    ``candidate_source="lineup"``, those in the day's line-ups, under the rolling recency rule)."""
    recent = recent_rolling if candidate_source == "lineup" else recent_calendar
    rows = _on_date(t, on, league, type_id, n, threshold, season, started_only, min_minutes, team, candidate_source)
    rows = rows.filter(complete(n) & (F.col("games_hit") >= required) & recent(as_of, recent_days))
    if min_avg is not None:
        rows = rows.filter(F.col("avg_value") >= min_avg)
    if team is not None:
        rows = rows.filter(F.col("team_id") == team)
    order = [*falling("games_hit", "avg_value"), F.col("player_id")]
    return top(top(with_team(with_player(rows, t), t).select(*STREAK), order, result_limit), order, limit)


def player_streak_playing_on_date_counts(
    t: Tables, *, on, league, type_id, n, threshold, required, started_only=False, min_minutes=None, season=None, team=None, recent_days=None, as_of=None
) -> DataFrame:
    whole = complete(n) & recent_calendar(as_of, recent_days)
    players = _on_date(t, on, league, type_id, n, threshold, season, started_only, min_minutes, team, "likely").agg(
        *counts(complete_windows_count=whole, qualified_players_count=whole & (F.col("games_hit") >= required))
    )
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    fixtures = one(fixtures_on(t, on, league, season), "today_fixtures_count")
    teams = one(teams_on(t, on, league, season), "today_teams_count")
    candidates = one(_candidates(t, on, league, season, team, "likely"), "candidate_players_count")
    return fixtures.crossJoin(teams).crossJoin(candidates).crossJoin(players)  # one row each


def player_streak_lineup_on_date(t: Tables, **params) -> DataFrame:
    return player_streak_playing_on_date(t, candidate_source="lineup", **params)


def players_on_date_counts(t: Tables, *, on, league, season=None) -> DataFrame:
    today = fixtures_on(t, on, league, season).select(F.col("id").alias("fixture_id"))
    rows = today.join(t.fixture_players.select("fixture_id", "player_id"), "fixture_id", "left")
    return rows.agg(F.countDistinct("fixture_id").alias("today_fixtures_count"), F.countDistinct("player_id").alias("today_players_count"))


def player_stat_window_last_n(
    t: Tables, *, league, type_id, n, player=None, started_only=False, min_minutes=None, season=None, recent_days=None, as_of=None, limit: int | None = 20
) -> DataFrame:
    rows = _windows(t, league, type_id, n, season, started_only, min_minutes, player).filter(complete(n) & recent_rolling(as_of, recent_days))
    named = with_team(with_player(rows, t).join(latest_team(t, league, season).select("player_id", "team_id"), "player_id"), t)
    columns = [*NAMES, "games", "total_value", "avg_value", "last_values", "last_fixture_at", "window_start_at", "last_fixture_dates"]
    return top(named.select(*columns), [*falling("avg_value", "total_value"), F.col("player_id")], limit)


def _player_facts(t: Tables, league, type_id, season) -> DataFrame:
    fx = finished_fixtures(t, league, season).select(F.col("id").alias("fixture_id"))
    return t.fixture_player_statistics.filter(F.col("type_id") == type_id).join(fx, "fixture_id", "left_semi")


def player_stat_leaderboard(t: Tables, *, league, type_id, season=None, limit: int | None = 20, total: str = "total_value") -> DataFrame:
    """Totals over all rows of a statistic; players without any value come first."""
    sums = _player_facts(t, league, type_id, season).groupBy("player_id").agg(F.sum("value").alias(total))
    named = with_team(with_player(sums, t).join(latest_team(t, league, season).select("player_id", "team_id"), "player_id", "left"), t)
    return top(named.select(*NAMES, total), [*falling(total), F.col("player_id")], limit)


def player_stat_leaderboard_meta(t: Tables, *, league, type_id, season=None) -> DataFrame:
    n = F.countDistinct("player_id")
    return _player_facts(t, league, type_id, season).agg(n.alias("candidate_players_count"), n.alias("complete_windows_count"), n.alias("qualified_players_count"))


def season_top_scorers(t: Tables, *, league, season=None, limit: int | None = 20) -> DataFrame:
    return player_stat_leaderboard(t, league=league, type_id=52, season=season, limit=limit, total="goals_total")


def search_players(t: Tables, *, league: int, query: str, limit: int | None = 10) -> DataFrame:
    """Players by name: exact short, common or full name, then names that hold every word of the query.

    ``%`` and ``_`` in the query match as in LIKE. A blank query finds nobody; neither does a player without a
    finished appearance in the league.
    """
    q = (query or "").strip(" ")
    words = [w for w in q.lower().split() if w]
    lower = lambda c: F.lower(F.col(c))
    exact = lambda c: F.coalesce(lower(c) == q.lower(), F.lit(False))
    has_all = lambda c: F.coalesce(_all_like(c, words), F.lit(False))
    rank = F.when(exact("player_short_name"), 1).when(exact("player_common_name"), 2).when(exact("player_name"), 3).when(has_all("player_name"), 4).when(has_all("player_common_name"), 5)
    found = with_player(latest_team(t, league), t)
    found = found.withColumn("rank", rank if q else F.lit(None).cast("int")).filter("rank is not null")
    order = [F.col("rank"), F.col("last_fixture_at").desc_nulls_last(), F.col("player_id")]
    columns = ["player_id", "player_name", "player_common_name", "player_short_name", "team_id", "team_name", "team_short_code", "last_fixture_at"]
    return top(with_team(found, t), order, limit).select(*columns)


def _all_like(column: str, words: list[str]):
    out = F.lit(bool(words))
    for w in words:
        out = out & F.lower(F.col(column)).like(f"%{w}%")
    return out
