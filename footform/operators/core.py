"""Building blocks: finished fixtures, appearances, the latest N games of an entity, their summary, and its gates.

Rules they hold to: a fixture is finished when both scores are known; a null kick-off counts as the newest; a null value
in a sequence stays in it; thresholds are "at least"; averages are doubles.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schemas import Tables

LONDON = "Europe/London"


def london_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, LONDON))


def instant(as_of: str | datetime) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def day(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def newest_first(at: str = "starting_at", by: str = "fixture_id") -> list[Column]:
    return [F.col(at).desc_nulls_first(), F.col(by).desc()]


def finished_fixtures(t: Tables, league: int, season: int | None = None) -> DataFrame:
    fx = t.fixtures.filter((F.col("league_id") == league) & F.col("home_score").isNotNull() & F.col("away_score").isNotNull())
    return fx if season is None else fx.filter(F.col("season_id") == season)


def team_appearances(fixtures: DataFrame) -> DataFrame:
    """Two rows a fixture from one scan: ``fixture_id, starting_at, team_id, is_home, scored, conceded, opponent_id``."""
    side = lambda home, own, other: F.struct(
        F.lit(home).alias("is_home"), F.col(f"{own}_team_id").alias("team_id"), F.col(f"{other}_team_id").alias("opponent_id"),
        F.col(f"{own}_score").alias("scored"), F.col(f"{other}_score").alias("conceded"),
    )
    both = F.explode(F.array(side(True, "home", "away"), side(False, "away", "home"))).alias("s")
    return fixtures.select(F.col("id").alias("fixture_id"), "starting_at", both).select("fixture_id", "starting_at", "s.*")


def of_league(facts: DataFrame, league: int) -> DataFrame:
    """Facts that are stored by league: only that league's; others stay as they are."""
    return facts.filter(F.col("league_id") == league).drop("league_id", "starting_month") if "league_id" in facts.columns else facts


def player_appearances(t: Tables, league: int, season: int | None = None, started_only: bool = False, min_minutes: int | None = None) -> DataFrame:
    """Line-ups of finished fixtures: ``fixture_id, starting_at, player_id, team_id``; unknown minutes fail a minimum."""
    rows = of_league(t.fixture_players, league)
    if started_only:
        rows = rows.filter("is_starter")
    if min_minutes is not None:
        rows = rows.filter(F.col("minutes_played") >= min_minutes)
    fx = finished_fixtures(t, league, season).select(F.col("id").alias("fixture_id"), "starting_at")
    return rows.select("fixture_id", "player_id", "team_id").join(fx, "fixture_id")


def side_filter(df: DataFrame, home_only: bool = False, away_only: bool = False, team: int | None = None) -> DataFrame:
    """Home and away together leave nothing; an unknown side fails either."""
    if home_only:
        df = df.filter("is_home")
    if away_only:
        df = df.filter("not is_home")
    return df if team is None else df.filter(F.col("team_id") == team)


def last_n(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The newest ``n`` rows of each key (all if None), numbered from 1 in ``rn``."""
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*newest_first())))
    return ranked if n is None else ranked.filter(F.col("rn") <= n)


def stat_value(df: DataFrame, stats: DataFrame, type_id: int, keys: list[str]) -> DataFrame:
    """``df`` with ``value``: repeated rows of a statistic collapse to their maximum.

    Facts meet the rows that ask for them before they are aggregated: those of other games never reach the aggregate,
    which needs no shuffle of its own, for the join has dealt rows by ``keys``.
    """
    facts = stats.filter(F.col("type_id") == type_id).select(*keys, "value")
    return df.join(facts, keys, "left").groupBy(*df.columns).agg(F.max("value").alias("value"))


def sequence(value: str | Column) -> Column:
    """Values newest first, nulls kept, of rows that ``last_n`` numbered."""
    value = F.col(value) if isinstance(value, str) else value
    return F.transform(F.array_sort(F.collect_list(F.struct("rn", value.alias("v")))), lambda x: x["v"])


def hits(value: str, threshold: float) -> Column:
    return F.sum((F.coalesce(F.col(value) >= threshold, F.lit(False))).cast("long"))


def window_agg(df: DataFrame, key: str, value: str = "value", threshold: float | None = None) -> DataFrame:
    out = [
        F.count(F.lit(1)).alias("games"), F.count(value).alias("games_with_stat"), F.sum(value).alias("total_value"),
        F.avg(F.col(value).cast("double")).alias("avg_value"), sequence(value).alias("last_values"),
        F.max("starting_at").alias("last_fixture_at"), F.min("starting_at").alias("window_start_at"), sequence("starting_at").alias("last_fixture_dates"),
    ]
    if threshold is not None:
        out.append(hits(value, threshold).alias("games_hit"))
    return df.groupBy(key).agg(*out)


def recent_rolling(as_of, days: int | None, at: str = "last_fixture_at") -> Column:
    return F.lit(True) if days is None else F.col(at) >= instant(as_of) - F.make_dt_interval(F.lit(days))


def recent_calendar(as_of, days: int | None, at: str = "last_fixture_at") -> Column:
    return F.lit(True) if days is None else london_date(F.col(at)) >= F.date_sub(london_date(instant(as_of)), max(days, 1) - 1)


def complete(n: int, stats: bool = True) -> Column:
    whole = F.col("games") == n
    return whole & (F.col("games_with_stat") == n) if stats else whole


def counts(**conditions: Column) -> list[Column]:
    """How many rows meet each condition, as columns of one aggregate."""
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in conditions.items()]


def latest_team(t: Tables, league: int, season: int | None = None) -> DataFrame:
    """``player_id, team_id``: the team of each player's newest finished appearance, as one aggregate."""
    order = F.struct(F.col("starting_at").isNull().alias("open"), "starting_at", "fixture_id")
    apps = player_appearances(t, league, season)
    newest = F.max_by(F.struct("team_id", "starting_at"), order)
    return apps.groupBy("player_id").agg(newest.alias("x")).select("player_id", F.col("x.team_id").alias("team_id"), F.col("x.starting_at").alias("last_fixture_at"))


def with_team(df: DataFrame, t: Tables, how: str = "left") -> DataFrame:
    names = t.teams.select(F.col("id").alias("team_id"), F.col("name").alias("team_name"), F.col("short_code").alias("team_short_code"), F.col("image_path").alias("team_image_path"))
    return df.join(names, "team_id", how)


def with_player(df: DataFrame, t: Tables) -> DataFrame:
    names = t.players.select(F.col("id").alias("player_id"), F.col("name").alias("player_name"), F.col("common_name").alias("player_common_name"), F.col("short_name").alias("player_short_name"))
    return df.join(names, "player_id")


def top(df: DataFrame, order: list[Column], limit: int | None) -> DataFrame:
    return df.orderBy(*order) if limit is None else df.orderBy(*order).limit(limit)


def falling(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_first() for n in names]
