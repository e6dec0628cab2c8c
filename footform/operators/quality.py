"""Data-quality reports: freshness, staleness, golden sequences, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import Tables
from .core import instant, last_n, sequence, team_appearances


def freshness_report(t: Tables, *, as_of, league: int, team: int, since, max_age: int = 30) -> DataFrame:
    """One row: totals, scored fixtures and their newest kick-off, by fixtures and by participants, and whether all is stale."""
    scored = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
    since = F.col("starting_at") >= instant(since)
    sides = t.fixture_participants.groupBy("fixture_id").agg(*(F.max((F.lower("location") == s) & F.col("score").isNotNull()).alias(s) for s in ("home", "away")), F.count_if(F.col("team_id") == team).alias("of_team"))
    joined = t.fixtures.join(sides, t.fixtures["id"] == sides["fixture_id"], "left")
    both = F.coalesce(F.col("home") & F.col("away"), F.lit(False))
    out = joined.agg(
        F.count(F.lit(1)).alias("fixtures_total"), F.count_if(scored).alias("fixtures_scored"), F.max(F.when(scored, F.col("starting_at"))).alias("max_scored_at"), F.count_if(both).alias("participants_scored"),
        F.max(F.when(both, F.col("starting_at"))).alias("max_participants_scored_at"), F.count_if(scored & since & (F.col("league_id") == league)).alias("league_scored_since"),
        F.coalesce(F.sum(F.when(scored & since, F.col("of_team"))), F.lit(0)).alias("team_scored_since"),
    )
    newest = F.greatest("max_scored_at", "max_participants_scored_at")
    return out.withColumn("stale", newest.isNull() | (newest < instant(as_of) - F.make_dt_interval(F.lit(max_age))))


def player_stat_staleness(t: Tables, *, player: int, type_id: int, leagues: list[int], cutoff, max_gap: int = 7) -> DataFrame:
    """One row: newest finished fixture, newest fixture with the player's statistic, and skipped / missing / stale / ok."""
    fx = t.fixtures.filter(F.col("league_id").isin(leagues))
    newest = fx.filter("home_score is not null and away_score is not null").agg(F.max("starting_at").alias("max_fixture_at"))
    own = t.fixture_player_statistics.filter((F.col("player_id") == player) & (F.col("type_id") == type_id)).select("fixture_id")
    stat = fx.join(own.withColumnRenamed("fixture_id", "id"), "id", "left_semi").agg(F.max("starting_at").alias("max_stat_at"))
    status = (
        F.when(F.col("max_fixture_at").isNull() | F.col("max_stat_at").isNull(), "skipped")
        .when(F.col("max_stat_at") < instant(cutoff), "missing")
        .when(F.col("max_fixture_at") > F.col("max_stat_at") + F.make_dt_interval(F.lit(max_gap)), "stale")
        .otherwise("ok")
    )
    return newest.crossJoin(stat).withColumn("status", status)  # one row each


def _of_team(t: Tables, team: int, league: int | None) -> DataFrame:
    fx = t.fixtures.filter("home_score is not null and away_score is not null").filter(F.lit(team).isin(F.col("home_team_id"), F.col("away_team_id")))
    games = team_appearances(fx if league is None else fx.filter(F.col("league_id") == league)).filter(F.col("team_id") == team)
    return games


def team_results_sequence(t: Tables, *, team: int, n: int = 5, league: int | None = None) -> DataFrame:
    """Newest first: letter from the team's side, score printed home-away."""
    games = last_n(_of_team(t, team, league), "team_id", n)
    letter = F.when(F.col("scored") > F.col("conceded"), "W").when(F.col("scored") < F.col("conceded"), "L").otherwise("D")
    score = F.when(F.col("is_home"), F.concat_ws("-", "scored", "conceded")).otherwise(F.concat_ws("-", "conceded", "scored"))
    return games.groupBy("team_id").agg(sequence(F.concat_ws(" ", letter, score)).alias("results"))


def team_stat_sequence(t: Tables, *, team: int, type_id: int = 84, n: int = 5, league: int | None = None) -> DataFrame:
    games = last_n(_of_team(t, team, league), "team_id", n)
    best = t.fixture_statistics.filter((F.col("team_id") == team) & (F.col("type_id") == type_id)).groupBy("fixture_id").agg(F.max("value").alias("value"))
    return games.join(best, "fixture_id", "left").groupBy("team_id").agg(sequence(F.coalesce(F.col("value").cast("string"), F.lit("n/a"))).alias("values"))


def player_stat_sequence(t: Tables, *, player: int, type_id: int = 42, n: int = 10) -> DataFrame:
    """Newest appearances, finished or not: the statistic and whether the player started."""
    apps = t.fixture_players.filter(F.col("player_id") == player).join(t.fixtures.select(F.col("id").alias("fixture_id"), "starting_at"), "fixture_id")
    best = t.fixture_player_statistics.filter((F.col("player_id") == player) & (F.col("type_id") == type_id)).groupBy("fixture_id").agg(F.max("value").alias("value"))
    games = last_n(apps, "player_id", n).join(best, "fixture_id", "left")
    return games.groupBy("player_id").agg(sequence(F.coalesce(F.col("value").cast("string"), F.lit("n/a"))).alias("values"), sequence(F.coalesce(F.col("is_starter"), F.lit(False))).alias("started"))


def find_player(t: Tables, *, name: str, team: int | None = None) -> DataFrame:
    """The player of the newest fixture id among line-ups whose own name of a player holds ``name``, in any case."""
    rows = t.fixture_players.withColumnRenamed("name", "player_name").filter(F.lower("player_name").contains(name.lower()))
    rows = rows if team is None else rows.filter(F.col("team_id") == team)
    return rows.orderBy(F.desc("fixture_id"), "player_id").limit(1).select("player_id", "player_name", "team_id", "fixture_id")


def golden_compare(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``check, ok`` for ``actual(check, values)`` against ``expected(check, values)``: whole sequences must be equal."""
    a, e = actual.select("check", F.col("values").alias("got")), expected.select("check", F.col("values").alias("want"))
    return e.join(a, "check", "left").select("check", F.col("got").eqNullSafe(F.col("want")).alias("ok"))


def reconcile_scores(source: DataFrame, stored: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` finished fixtures of a source that the store lacks or scores otherwise."""
    newest = source.filter("home_score is not null and away_score is not null").orderBy(F.col("starting_at").desc_nulls_last(), F.desc("id")).limit(n)
    own = stored.select("id", F.col("home_score").alias("stored_home"), F.col("away_score").alias("stored_away"), F.lit(True).alias("found"))
    both = newest.join(own, "id", "left")
    same = F.col("home_score").eqNullSafe(F.col("stored_home")) & F.col("away_score").eqNullSafe(F.col("stored_away"))
    return both.filter(~same).select("id", "home_score", "away_score", "stored_home", "stored_away", F.when(F.col("found"), "mismatch").otherwise("missing").alias("problem"))


def current_season(t: Tables, *, league: int) -> DataFrame:
    order = [F.col("is_current").desc_nulls_last(), F.col("end_date").desc_nulls_last(), F.desc("id")]
    return t.seasons.filter(F.col("league_id") == league).withColumn("rank", F.row_number().over(Window.partitionBy("league_id").orderBy(*order))).filter("rank = 1").drop("rank")

