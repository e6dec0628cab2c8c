"""Registered queries: each operator over the derived tables, with parameters that give rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import catalog, odds, players, quality, teams, value
from ..schemas import Tables
from ..sources import ingest, merge, sinks, store
from ..sources.folders import scratch_dir
from ..sources.proxy import tables
from . import landing
from .oracle import DOMAIN, ORACLES, sql

AS_OF = "2001-08-02 00:00:00"
ON = "2001-07-31"
TIME = "yyyy-MM-dd HH:mm:ss"


def _as_text(values: Column, kind: T.DataType) -> Column:
    return F.transform(values, lambda x: F.date_format(x, TIME) if isinstance(kind, T.TimestampType) else x.cast("string"))


def flat(df: DataFrame) -> DataFrame:
    """Columns as both engines print them: sequences comma-joined, times as text, doubles at six places."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(_as_text(c, f.dataType.elementType), ",", "null")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, TIME)
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def _on(operator: Callable[..., DataFrame], **params) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat(operator(tables(spark, sf_dir), **params))


def _likely(operator: Callable[..., DataFrame], **params) -> Callable[[SparkSession, str], DataFrame]:
    """As ``_on``, with the likely players of the last 60 days."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tables(spark, sf_dir)
        return flat(operator(replace(t, team_likely_players=teams.likely_players(t, league=0, recent_days=60, last=3, as_of=AS_OF)), **params))

    return run


STAT = {"league": 0, "type_id": 42}
TEAM5 = {**STAT, "n": 5, "limit": None}
QUERIES = {
    "player_streak_base": _on(players.player_streak_base, **STAT, n=3, threshold=2, required=2, limit=None),
    "player_streak_base_filters": _on(players.player_streak_base, **STAT, n=2, threshold=1, required=1, min_avg=1.5, started_only=True, min_minutes=10, recent_days=200, as_of=AS_OF),
    "player_streak": _on(players.player_streak, **STAT, n=3, threshold=2, required=2, team=5),
    "player_streak_meta": _on(players.player_streak_meta, **STAT, n=3, threshold=2, required=2),
    "player_streak_playing_on_date": _likely(players.player_streak_playing_on_date, **STAT, on=ON, n=2, threshold=2, required=1, recent_days=400, as_of=AS_OF, limit=None, result_limit=None),
    "player_streak_playing_on_date_counts": _likely(players.player_streak_playing_on_date_counts, **STAT, on=ON, n=2, threshold=2, required=1, recent_days=400, as_of=AS_OF),
    "player_streak_lineup_on_date": _on(players.player_streak_lineup_on_date, **STAT, on=ON, n=2, threshold=2, required=1, recent_days=900, as_of=AS_OF, limit=None, result_limit=None),
    "players_on_date_counts": _on(players.players_on_date_counts, on=ON, league=0),
    "player_stat_window_last_n": _on(players.player_stat_window_last_n, **STAT, n=3, recent_days=900, as_of=AS_OF, limit=None),
    "player_stat_leaderboard": _on(players.player_stat_leaderboard, **STAT),
    "player_stat_leaderboard_meta": _on(players.player_stat_leaderboard_meta, **STAT),
    "season_top_scorers": _on(players.season_top_scorers, league=0),
    "search_players": _on(players.search_players, league=0, query=" Brand#1 4 "),
    "team_stat_streak_last_n": _on(teams.team_stat_streak_last_n, **TEAM5, threshold=5, required=1),
    "team_stat_streak_last_n_home": _on(teams.team_stat_streak_last_n, **TEAM5, threshold=8, required=1, home_only=True, recent_days=300, as_of=AS_OF),
    "team_stat_streak_last_n_meta": _on(teams.team_stat_streak_last_n_meta, **STAT, n=5, threshold=8, required=2),
    "team_stat_window_last_n": _on(teams.team_stat_window_last_n, **TEAM5),
    "team_stat_leaderboard": _on(teams.team_stat_leaderboard, **STAT, limit=None),
    "team_stat_leaderboard_meta": _on(teams.team_stat_leaderboard_meta, **STAT),
    "leaderboard_meta_team": _on(teams.leaderboard_meta, kind="team", **STAT),
    "leaderboard_meta_player": _on(teams.leaderboard_meta, kind="player", **STAT),
    "team_derived_stat_window_last_n": _on(teams.team_derived_stat_window_last_n, **TEAM5),
    "team_derived_stat_leaderboard_last_n": _on(teams.team_derived_stat_leaderboard_last_n, **TEAM5, away_only=True),
    "team_derived_stat_streak_last_n": _on(teams.team_derived_stat_streak_last_n, **TEAM5, threshold=8, required=2),
    "team_derived_stat_streak_meta": _on(teams.team_derived_stat_streak_meta, **STAT, n=5, threshold=8, required=2),
    "team_cards_window_last_n": _on(teams.team_cards_window_last_n, league=0, n=5, limit=None),
    "team_cards_window_meta": _on(teams.team_cards_window_meta, league=0, n=5),
    "team_cards_streak_last_n": _on(teams.team_cards_streak_last_n, league=0, n=5, threshold=1, required=2, limit=None),
    "team_cards_streak_last_n_meta": _on(teams.team_cards_streak_last_n_meta, league=0, n=5, threshold=1, required=2),
    "team_btts_pct_last_n": _on(teams.team_btts_pct_last_n, league=0, n=5, limit=None),
    "team_btts_pct_season": _on(teams.team_btts_pct_season, league=0, limit=None),
    "team_btts_last_n_meta": _on(teams.team_btts_last_n_meta, league=0, n=5, required=2),
    "team_over_goals_rate_last_n": _on(teams.team_over_goals_rate_last_n, league=0, goals=3, n=5, limit=None),
    "team_over_goals_streak_last_n": _on(teams.team_over_goals_streak_last_n, league=0, goals=3, n=5, required=2, limit=None),
    "team_over_goals_streak_meta": _on(teams.team_over_goals_streak_meta, league=0, goals=3, n=5, required=2),
    "team_clean_sheets": _on(teams.team_clean_sheets, league=0, last=10, limit=None),
    "team_clean_sheets_all": _on(teams.team_clean_sheets, league=0, limit=None),
    "team_clean_sheets_meta": _on(teams.team_clean_sheets_meta, league=0, last=10, required=3),
    "teams_playing_on_date": _on(teams.teams_playing_on_date, on=ON, league=0),
    "refresh_team_likely_players": _on(teams.refresh_team_likely_players, league=0, recent_days=60, last=3, as_of=AS_OF),
}

OFFER = ["fixture_id", "bookmaker_id", "market_key", "selection_key", "line"]


def _derived(build: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: flat(build(tables(spark, sf_dir)))


def _pulled(t) -> DataFrame:
    return odds.odds_latest(odds.parsed_rows(t.odds_snapshots))


def _shot_bets(t) -> DataFrame:
    bets = value.team_shot_value_bets(t, as_of=AS_OF, min_pct=0.5, min_samples=3, lookback=60, limit=None)
    return bets.select("fixture_id", "market", "side", "line", "odds", "team_id", "opponent_id", "team_pct", "opp_pct", "team_samples", "opp_samples", "team_sample_size", "opp_sample_size", "team_seq", "opp_seq")


def _player_bets(t) -> DataFrame:
    current = t.players.join(players.latest_team(t, 0).select(F.col("player_id").alias("id"), F.col("team_id").alias("current_team_id")), "id", "left")
    bets = value.player_shot_value_bets(replace(t, players=current, player_forms=value.player_forms(t)), as_of=AS_OF, lookback=700, limit=None)
    return bets.select("fixture_id", "player_id", "team_id", "opponent_id", "line", "odds", "player_pct", "opp_pct", "player_sample", "opp_sample_size", "player_seq", "opp_seq")


def _forms(t) -> DataFrame:
    return value.player_forms(t).select("player_id", "team_id", "sample_size", F.transform("raw_fixtures", lambda x: x["shots"]).alias("shots"))


def _export(t) -> DataFrame:
    out = sinks.export_subset(t, as_of=AS_OF)
    return sinks.export_counts(replace(out, fixture_participants=None, types=None, odds_latest=None, player_odds=None, team_stats=None, player_stats=None, odds_snapshots=None))


def _offers(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("fixture_id", "pulled_at", F.size(F.from_json("raw", "data array<string>")["data"]).alias("offers"))


def _exported(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """What an export has of one table."""

    def build(t) -> DataFrame:
        df = getattr(sinks.export_subset(t, as_of=AS_OF), name)
        return df.select(*columns) if columns else _offers(df)

    return _derived(build)


def _written_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(sinks.export_counts(replace(sinks.write_export(tables(spark, sf_dir), scratch_dir(spark, "export"), as_of=AS_OF), odds_snapshots=None)))


def _stored(operator: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    """An operator over tables that were stored by league and month."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, path = tables(spark, sf_dir), scratch_dir(spark, "store")
        store.write_store(Tables(**{n: getattr(t, n) for n in names}), path)
        return flat(operator(store.read_store(spark, path)))

    return run


def _merged_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored fixtures after two months of a league got other scores, one fixture in seven of another month moved away, and a league was added."""
    fx, path = tables(spark, sf_dir).fixtures, scratch_dir(spark, "merge-store")
    store.write_store(Tables(fixtures=fx), path)
    stored = fx.withColumn("starting_month", store.month())
    scored = stored.filter("league_id = 0 and starting_month in (200105, 200106)").withColumn("home_score", F.lit(9))
    moved = stored.filter("league_id = 1 and starting_month = 199703 and id % 7 = 0")
    later = moved.withColumn("starting_at", F.col("starting_at") + F.expr("interval 1 month")).withColumn("starting_month", store.month())
    added = stored.filter("league_id = 2 and starting_month = 199801").withColumn("league_id", F.lit(77)).withColumn("id", -F.col("id"))
    updates = scored.unionByName(later).unionByName(added)
    store.merge_partitions(spark, f"{path}/fixtures", updates, ["id"], store.BY, gone=moved.select("id", *store.BY))
    return flat(store.read_store(spark, path).fixtures.select("id", "league_id", "starting_at", "home_score"))


def _reconcile(t) -> DataFrame:
    stored = t.fixtures.filter("id % 5 <> 0").withColumn("home_score", F.col("home_score") + (F.col("id") % 3 == 0).cast("int"))
    return quality.reconcile_scores(t.fixtures, stored, n=500)


def _shirts(t):
    """Line-ups with names of their own: every third player plays under another one, every fifth has no row of players."""
    shirt = F.when(F.col("id") % 3 == 0, F.concat(F.lit("No. "), "short_name")).otherwise(F.col("name"))
    names = t.players.select(F.col("id").alias("player_id"), shirt.alias("name"))
    return replace(t, fixture_players=t.fixture_players.join(names, "player_id"), players=t.players.filter("id % 5 <> 0"))


def _upsert(t) -> DataFrame:
    current = t.odds_outcomes.groupBy(*OFFER).agg(F.max("participant_type").alias("participant_type"), F.max("participant_id").alias("participant_id"), F.max("price_decimal").alias("price_decimal"))
    new = current.filter("fixture_id % 3 = 0").withColumn("participant_id", F.lit(None).cast("long")).withColumn("price_decimal", (F.col("price_decimal") + 1).cast("decimal(10,4)"))
    return odds.upsert_outcomes(current, new).select(*OFFER, "participant_id", "price_decimal")


def _merged(t) -> DataFrame:
    teams = t.teams.select("id", "name", "short_code")
    return merge.merge_by_key(teams, teams.filter("id % 2 = 0").select("id", F.upper("name").alias("name")), ["id"])


def _days(df: DataFrame) -> DataFrame:
    return df.select("id", F.date_format("first_day", "yyyy-MM-dd").alias("first_day"), F.date_format("last_day", "yyyy-MM-dd").alias("last_day"))


SINCE = "2001-01-01 00:00:00"
QUERIES |= {
    "stat_type_usage": _on(catalog.stat_type_usage),
    "stat_type_counts_by_league": _on(catalog.stat_type_counts_by_league, league=0),
    "odds_target_fixtures": _on(odds.odds_target_fixtures, leagues=[0, 1], as_of="2001-07-01", days=14),
    "fixture_odds": _on(odds.fixture_odds, fixture=7),
    "player_odds_next_days": _on(odds.player_odds_next_days, league=0, days=30, market="player_shots", as_of="2001-07-01 00:00:00"),
    "filter_players_by_odds": _derived(lambda t: odds.filter_players_by_odds(t, t.players.filter("short_name < 'Brand#3'").select(F.col("id").alias("player_id")), on="2001-05-01", league=0, market="player_shots", least=1.2, most=2.5, days=90)),
    "odds_coverage": _on(odds.odds_coverage, as_of="2001-07-01 00:00:00", league=0),
    "odds_latest": _derived(lambda t: _pulled(t).select("fixture_id", "market_key", "selection_key", "line", "price_decimal")),
    "upsert_outcomes": _derived(_upsert),
    "team_shot_form": _on(value.team_shot_form),
    "shot_over_odds": _derived(lambda t: value.shot_over_odds(t.odds_latest)),
    "team_shot_value_bets": _derived(_shot_bets),
    "player_forms": _derived(_forms),
    "shots_hit_rates": _derived(lambda t: value.shots_hit_rates(value.player_forms(t, sizes=(11, 14, 15, 20)))),
    "player_shot_value_bets": _derived(_player_bets),
    "outside_box_sot": _on(value.outside_box_sot, words=("shots",)),
    "team_forms": _on(value.team_forms),
    "player_availability": _on(value.player_availability, league=0),
    "freshness_report": _on(quality.freshness_report, as_of=AS_OF, league=0, team=5, since=SINCE),
    "player_stat_staleness": _on(quality.player_stat_staleness, player=7, type_id=42, leagues=[0, 1], cutoff="2000-01-01 00:00:00"),
    "team_results_sequence": _on(quality.team_results_sequence, team=5),
    "team_stat_sequence": _on(quality.team_stat_sequence, team=5),
    "player_stat_sequence": _on(quality.player_stat_sequence, player=7),
    "find_player": _derived(lambda t: quality.find_player(_shirts(t), name="no. brand#1")),
    "current_season": _on(quality.current_season, league=0),
    "reconcile_scores": _derived(_reconcile),
    "keep_seasons": _derived(lambda t: ingest.keep_seasons(t.seasons)),
    "season_window": _derived(lambda t: _days(ingest.season_window(t.seasons, AS_OF))),
    "fixtures_in_window": _derived(lambda t: ingest.recent_window(t, AS_OF, [0, 1]).select("id", "league_id", "starting_at")),
    "history_fixtures": _derived(lambda t: ingest.history_fixtures(t, [0, 1]).select("id", "season_id")),
    "export_subset": _derived(_export),
    "unknown_team_fixtures": _derived(lambda t: sinks.unknown_team_fixtures(t.fixtures, t.teams.filter("id < 20"))),
    "dedupe_team_stats": _on(sinks.dedupe_team_stats),
    "prune_fixtures": _derived(lambda t: sinks.prune_fixtures(t, ingest.keep_seasons(t.seasons)).select("id", "season_id")),
    "export_odds_window": _derived(lambda t: sinks.export_odds_window(t, as_of="2001-07-01", days=14)["odds_outcomes"].select(*OFFER, "price_decimal")),
    "odds_participant_patch": _on(sinks.odds_participant_patch, as_of="2001-07-01", days=14),
    "merge_by_key": _derived(_merged),
    "export_seasons": _exported("seasons", "id", "league_id"),
    "export_fixtures": _exported("fixtures", "id", "season_id", "starting_at", "home_team_id", "away_team_id", "home_score", "away_score"),
    "export_teams": _exported("teams", "id", "name", "short_code"),
    "export_players": _exported("players", "id", "name", "team_id"),
    "export_fixture_players": _exported("fixture_players", "fixture_id", "player_id", "team_id", "is_starter", "minutes_played"),
    "export_fixture_player_statistics": _exported("fixture_player_statistics", "fixture_id", "player_id", "type_id", "value"),
    "export_fixture_statistics": _exported("fixture_statistics", "fixture_id", "team_id", "type_id", "value"),
    "export_odds_outcomes": _exported("odds_outcomes", *OFFER, "participant_id", "price_decimal"),
    "export_odds_snapshots": _exported("odds_snapshots"),
    "export_odds_window_snapshots": _derived(lambda t: _offers(sinks.export_odds_window(t, as_of="2001-07-01", days=14)["odds_snapshots"])),
    "write_export": _written_export,
    "stored_fixtures_in_window": _stored(lambda t: ingest.recent_window(t, AS_OF, [0, 1]).select("id", "league_id", "starting_at"), "fixtures"),
    "stored_odds_target_fixtures": _stored(lambda t: odds.odds_target_fixtures(t, leagues=[0, 1], as_of="2001-07-01", days=14), "fixtures"),
    "stored_player_streak_base": _stored(lambda t: players.player_streak_base(t, **STAT, n=3, threshold=2, required=2, limit=None), "fixtures", "fixture_players", "fixture_player_statistics", "players", "teams"),
    "merge_partitions": _merged_partitions,
}

QUERIES |= {name: (lambda spark, sf_dir, run=run: flat(run(spark, sf_dir))) for name, run in landing.QUERIES.items()}

ORACLE_SQL = {name: sql(body) for name, body in ORACLES.items()} | {name: landing.landing_sql(DOMAIN, body) for name, body in landing.ORACLES.items()}
