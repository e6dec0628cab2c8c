"""Team queries: statistics, conceded statistics, cards, goals, clean sheets, fixtures of a day, likely players."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import Tables
from .core import (
    complete, counts, falling, finished_fixtures, instant, last_n, newest_first, recent_rolling, sequence, side_filter, team_appearances, top,
    window_agg, with_team,
)
from .players import fixtures_on, player_stat_leaderboard_meta

NAMES = ["team_id", "team_name", "team_short_code", "team_image_path"]
CARDS = (83, 84, 85)


def _facts(t: Tables, league, season) -> DataFrame:
    fx = finished_fixtures(t, league, season).select(F.col("id").alias("fixture_id"), "starting_at", "home_team_id")
    return t.fixture_statistics.select("fixture_id", "team_id", "type_id", "value").join(fx, "fixture_id")


def _side() -> Column:
    return (F.col("team_id") == F.col("home_team_id")).alias("is_home")


def stat_games(t: Tables, league, type_id, season=None) -> DataFrame:
    """A team's fixtures that have the statistic, repeated rows collapsed to their maximum."""
    one = _facts(t, league, season).filter(F.col("type_id") == type_id)
    return one.groupBy("team_id", "fixture_id", "starting_at", "home_team_id").agg(F.max("value").alias("value")).select("team_id", "fixture_id", "starting_at", _side(), "value")


def conceded_games(t: Tables, league, type_id, season=None) -> DataFrame:
    """As ``stat_games``, with the opponent's value: each fixture's few values meet in one group, without a self-join."""
    games = stat_games(t, league, type_id, season)
    grouped = games.groupBy("fixture_id", "starting_at").agg(F.collect_list(F.struct("team_id", "is_home", "value")).alias("sides"))
    own = grouped.select("fixture_id", "starting_at", F.explode("sides").alias("a"), "sides")
    pairs = own.select("fixture_id", "starting_at", "a.team_id", "a.is_home", F.explode(F.filter("sides", lambda b: b["team_id"] != F.col("a.team_id"))).alias("b"))
    return pairs.select("team_id", "fixture_id", "starting_at", "is_home", F.col("b.value").alias("value"))


def card_games(t: Tables, league, season=None) -> DataFrame:
    """Cards of each fixture that has any statistic of the team."""
    cards = F.sum(F.when(F.col("type_id").isin(*CARDS), F.col("value")).otherwise(0)).alias("value")
    return _facts(t, league, season).groupBy("team_id", "fixture_id", "starting_at", "home_team_id").agg(cards).select("team_id", "fixture_id", "starting_at", _side(), "value")


def _windows(games: DataFrame, n, home_only=False, away_only=False, team=None, threshold=None) -> DataFrame:
    return window_agg(last_n(side_filter(games, home_only, away_only, team), "team_id", n), "team_id", threshold=threshold)


def _streak(t, games, n, threshold, required, home_only, away_only, team, limit, recent_days, as_of, stats=True, how="left", last=False) -> DataFrame:
    rows = _windows(games, n, home_only, away_only, team, threshold).filter(complete(n, stats) & (F.col("games_hit") >= required) & recent_rolling(as_of, recent_days))
    columns = [*NAMES, "games", "games_hit", "avg_value", "last_values", *(["last_fixture_at"] if last else [])]
    return top(with_team(rows, t, how).select(*columns), [*falling("games_hit", "avg_value"), F.col("team_id")], limit)


def _window(t, games, n, home_only, away_only, team, limit, recent_days, as_of, stats=True) -> DataFrame:
    rows = _windows(games, n, home_only, away_only, team).filter(complete(n, stats) & recent_rolling(as_of, recent_days))
    columns = [*NAMES, "games", "total_value", "avg_value", "last_values", "last_fixture_at"]
    return top(with_team(rows, t).select(*columns), [*falling("avg_value", "total_value"), F.col("team_id")], limit)


def _meta(windows: DataFrame, n, qualifies: Column, stats=True, recent: Column | None = None) -> DataFrame:
    whole = complete(n, stats) & (F.lit(True) if recent is None else recent)
    return windows.agg(*counts(candidate_teams_count=F.col("games") == n, complete_windows_count=whole, qualified_teams_count=whole & qualifies))


def team_stat_streak_last_n(t: Tables, *, league, type_id, n, threshold, required, season=None, home_only=False, away_only=False, team=None, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    return _streak(t, stat_games(t, league, type_id, season), n, threshold, required, home_only, away_only, team, limit, recent_days, as_of)


def team_stat_streak_last_n_meta(t: Tables, *, league, type_id, n, threshold, required, season=None, home_only=False, away_only=False, team=None, recent_days=None, as_of=None) -> DataFrame:
    """Candidates are counted from fixtures, complete windows from statistics."""
    windows = _windows(stat_games(t, league, type_id, season), n, home_only, away_only, team, threshold)
    meta = _meta(windows, n, F.col("games_hit") >= required, recent=recent_rolling(as_of, recent_days)).drop("candidate_teams_count")
    games = side_filter(team_appearances(finished_fixtures(t, league, season)), home_only, away_only, team)
    return games.groupBy("team_id").count().agg(*counts(candidate_teams_count=F.col("count") >= n)).crossJoin(meta)  # one row each


def team_stat_window_last_n(t: Tables, *, league, type_id, n, season=None, team=None, home_only=False, away_only=False, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    return _window(t, stat_games(t, league, type_id, season), n, home_only, away_only, team, limit, recent_days, as_of)


def team_stat_leaderboard(t: Tables, *, league, type_id, season=None, limit: int | None = 20) -> DataFrame:
    sums = _facts(t, league, season).filter(F.col("type_id") == type_id).groupBy("team_id").agg(F.sum("value").alias("total_value"))
    return top(with_team(sums, t).select(*NAMES, "total_value"), [*falling("total_value"), F.col("team_id")], limit)


def team_stat_leaderboard_meta(t: Tables, *, league, type_id, season=None) -> DataFrame:
    n = F.countDistinct("team_id")
    return _facts(t, league, season).filter(F.col("type_id") == type_id).agg(n.alias("candidate_teams_count"), n.alias("complete_windows_count"), n.alias("qualified_teams_count"))


def leaderboard_meta(t: Tables, *, kind: str, league, type_id, season=None) -> DataFrame:
    one = player_stat_leaderboard_meta if kind == "player" else team_stat_leaderboard_meta
    return one(t, league=league, type_id=type_id, season=season).toDF("candidate_count", "complete_windows_count", "qualified_count")


def team_derived_stat_window_last_n(t: Tables, *, league, type_id, n, season=None, team=None, home_only=False, away_only=False, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    """Windows of what opponents did."""
    return _window(t, conceded_games(t, league, type_id, season), n, home_only, away_only, team, limit, recent_days, as_of)


team_derived_stat_leaderboard_last_n = team_derived_stat_window_last_n


def team_derived_stat_streak_last_n(t: Tables, *, league, type_id, n, threshold, required, season=None, home_only=False, away_only=False, team=None, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    return _streak(t, conceded_games(t, league, type_id, season), n, threshold, required, home_only, away_only, team, limit, recent_days, as_of, last=True)


def team_derived_stat_streak_meta(t: Tables, *, league, type_id, n, threshold, required, season=None, home_only=False, away_only=False, team=None, recent_days=None, as_of=None) -> DataFrame:
    windows = _windows(conceded_games(t, league, type_id, season), n, home_only, away_only, team, threshold)
    return _meta(windows, n, F.col("games_hit") >= required, recent=recent_rolling(as_of, recent_days))


def team_cards_window_last_n(t: Tables, *, league, n, season=None, team=None, home_only=False, away_only=False, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    return _window(t, card_games(t, league, season), n, home_only, away_only, team, limit, recent_days, as_of, stats=False)


def team_cards_window_meta(t: Tables, *, league, n, season=None, home_only=False, away_only=False, team=None) -> DataFrame:
    return _meta(_windows(card_games(t, league, season), n, home_only, away_only, team), n, F.lit(True), stats=False)


def team_cards_streak_last_n(t: Tables, *, league, n, threshold, required, season=None, home_only=False, away_only=False, team=None, limit: int | None = 20) -> DataFrame:
    return _streak(t, card_games(t, league, season), n, threshold, required, home_only, away_only, team, limit, None, None, stats=False, how="inner")


def team_cards_streak_last_n_meta(t: Tables, *, league, n, threshold, required, season=None, home_only=False, away_only=False, team=None) -> DataFrame:
    return _meta(_windows(card_games(t, league, season), n, home_only, away_only, team, threshold), n, F.col("games_hit") >= required, stats=False)


def _score_windows(t: Tables, league, season, n, home_only, away_only, team, flag: Column | None = None, value: Column | None = None) -> DataFrame:
    """Windows over scores: ``games``, ``hit_games``, sequence, newest kick-off; with a value also its average."""
    games = side_filter(team_appearances(finished_fixtures(t, league, season)), home_only, away_only, team).withColumn("flag", flag)
    out = [F.count(F.lit(1)).alias("games"), F.sum(F.col("flag").cast("long")).alias("hit_games"), F.max("starting_at").alias("last_fixture_at")]
    if value is not None:
        games = games.withColumn("value", value)
        out += [F.avg(F.col("value").cast("double")).alias("avg_goals"), sequence("value").alias("last_values")]
    else:
        out.append(sequence("flag").alias("last_flags"))
    return last_n(games, "team_id", n).groupBy("team_id").agg(*out)


def both_scored() -> Column:
    return (F.col("scored") > 0) & (F.col("conceded") > 0)


def _pct(of: Column | int) -> Column:
    return F.col("hit_games").cast("double") / of


def team_btts_pct_last_n(t: Tables, *, league, n, season=None, home_only=False, away_only=False, team=None, limit: int | None = 20) -> DataFrame:
    rows = _score_windows(t, league, season, n, home_only, away_only, team, both_scored()).filter(complete(n, False))
    rows = with_team(rows, t, "inner").select(*NAMES, "games", F.col("hit_games").alias("btts_games"), _pct(n).alias("btts_pct"), "last_flags")
    return top(rows, [*falling("btts_pct", "btts_games"), F.col("team_id")], limit)


def team_btts_pct_season(t: Tables, *, league, season=None, team=None, home_only=False, away_only=False, limit: int | None = 20) -> DataFrame:
    rows = _score_windows(t, league, season, None, home_only, away_only, team, both_scored())
    rows = with_team(rows, t, "inner").select(*NAMES, "games", F.col("hit_games").alias("btts_games"), _pct(F.col("games")).alias("btts_pct"), "last_fixture_at")
    return top(rows, [*falling("btts_pct", "btts_games"), F.col("team_id")], limit)


def team_btts_last_n_meta(t: Tables, *, league, n, season=None, required=None, home_only=False, away_only=False, team=None) -> DataFrame:
    windows = _score_windows(t, league, season, n, home_only, away_only, team, both_scored())
    return _meta(windows, n, F.lit(True) if required is None else F.col("hit_games") >= required, stats=False)


def total_goals() -> Column:
    return F.col("scored") + F.col("conceded")


def team_over_goals_rate_last_n(t: Tables, *, league, goals, n, season=None, home_only=False, away_only=False, team=None, limit: int | None = 20, recent_days=None, as_of=None) -> DataFrame:
    rows = _score_windows(t, league, season, n, home_only, away_only, team, total_goals() >= goals, total_goals()).filter(complete(n, False) & recent_rolling(as_of, recent_days))
    rows = with_team(rows, t).select(*NAMES, "games", F.col("hit_games").alias("over_games"), _pct(F.col("games")).alias("over_pct"), "avg_goals", "last_values", "last_fixture_at")
    return top(rows, [*falling("over_pct", "over_games"), F.col("team_id")], limit)


def team_over_goals_streak_last_n(t: Tables, *, required, limit: int | None = 20, **params) -> DataFrame:
    """Rows of the rate query, cut to ``limit`` first, with ``required`` games or more."""
    rows = team_over_goals_rate_last_n(t, limit=limit, **params).filter(F.col("over_games") >= required)
    rows = rows.select(*NAMES, "games", F.col("over_games").alias("games_hit"), "avg_goals", "last_values", "last_fixture_at")
    return top(rows, [*falling("games_hit", "avg_goals"), F.col("team_id")], limit)


def team_over_goals_streak_meta(t: Tables, *, league, goals, n, required, season=None, home_only=False, away_only=False, team=None, recent_days=None, as_of=None) -> DataFrame:
    windows = _score_windows(t, league, season, n, home_only, away_only, team, total_goals() >= goals)
    return _meta(windows, n, F.col("hit_games") >= required, stats=False, recent=recent_rolling(as_of, recent_days))


def team_clean_sheets(t: Tables, *, league, season=None, last=None, home_only=False, away_only=False, team=None, limit: int | None = 20) -> DataFrame:
    rows = _score_windows(t, league, season, last, home_only, away_only, team, F.col("conceded") == 0)
    if last is not None:
        rows = rows.filter(complete(last, False))
    rows = with_team(rows, t).select(*NAMES, "games", F.col("hit_games").alias("clean_sheets"), _pct(F.col("games")).alias("clean_sheet_pct"), "last_fixture_at", "last_flags")
    return top(rows, [*falling("clean_sheets", "clean_sheet_pct"), F.col("team_id")], limit)


def team_clean_sheets_meta(t: Tables, *, league, season=None, last=None, home_only=False, away_only=False, team=None, required=None) -> DataFrame:
    rows = _score_windows(t, league, season, last, home_only, away_only, team, F.col("conceded") == 0)
    whole = F.lit(True) if last is None else complete(last, False)
    return rows.agg(*counts(candidate_teams_count=whole, complete_windows_count=whole, qualified_teams_count=whole & (F.lit(True) if required is None else F.col("hit_games") >= required)))


def teams_playing_on_date(t: Tables, *, on, league, season=None) -> DataFrame:
    sides = fixtures_on(t, on, league, season).select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).filter("team_id is not null")
    return sides.groupBy("team_id").agg(F.count(F.lit(1)).alias("fixture_count")).orderBy("team_id")


def likely_players(t: Tables, *, league, recent_days: int | None = 30, last: int = 1, as_of=None) -> DataFrame:
    """Players of each team's newest ``last`` finished fixtures with a line-up: 1.0 for starters, 0.6 for others with
    minutes; a player's newest row, then the most confident."""
    fx = finished_fixtures(t, league).select(F.col("id").alias("fixture_id"), "starting_at").filter(recent_rolling(as_of, recent_days, "starting_at"))
    rows = t.fixture_players.join(fx, "fixture_id")
    newest = Window.partitionBy("team_id").orderBy(*newest_first())
    ranked = rows.withColumn("game", F.dense_rank().over(newest)).filter(F.col("game") <= max(last, 1))
    confidence = F.when(F.col("is_starter"), F.lit(1.0)).when(F.col("minutes_played") > 0, F.lit(0.6))
    sure = ranked.withColumn("confidence", confidence).filter("confidence is not null")
    order = F.struct(F.col("starting_at").isNull().alias("open"), "starting_at", "confidence", "fixture_id")
    best = F.max_by(F.struct("confidence", "starting_at", "fixture_id"), order)
    one = sure.groupBy("team_id", "player_id").agg(best.alias("x"))
    stamp = instant(as_of) if as_of is not None else F.current_timestamp()
    return one.select("team_id", "player_id", "x.confidence", F.col("x.starting_at").alias("last_seen_at"), F.col("x.fixture_id").cast("long").alias("source_fixture_id"), stamp.alias("updated_at"))


def refreshed_count(t: Tables, **params) -> DataFrame:
    """``upserted``: how many rows a refresh writes, new or in place of known ones."""
    return likely_players(t, **params).agg(F.count(F.lit(1)).alias("upserted"))


def refresh_team_likely_players(t: Tables, **params) -> DataFrame:
    """The table after a refresh: fresh rows replace those of their key, stale rows stay. See :func:`refreshed_count`."""
    from ..sources.merge import merge_by_key

    fresh = likely_players(t, **params)
    return fresh if t.team_likely_players is None else merge_by_key(t.team_likely_players, fresh, ["team_id", "player_id"])
