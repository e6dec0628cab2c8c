"""Exports: a referentially closed subset, odds of a window, patches, appends and database loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.core import instant
from ..schemas import Tables
from .folders import written
from .ingest import in_months, keep_seasons


def exportable_fixtures(t: Tables, as_of: str, upcoming_days: int = 14) -> DataFrame:
    """Fixtures of kept seasons with both teams that are finished or start within ``upcoming_days``."""
    kept = keep_seasons(t.seasons).select(F.col("id").alias("season_id"))
    soon = F.col("starting_at").between(instant(as_of), instant(as_of) + F.make_dt_interval(F.lit(upcoming_days)))
    done = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
    return t.fixtures.filter("home_team_id is not null and away_team_id is not null").filter(done | soon).join(kept, "season_id", "left_semi")


def unknown_team_fixtures(fixtures: DataFrame, teams: DataFrame) -> DataFrame:
    ids = teams.select("id")
    home = fixtures.join(ids.toDF("home_team_id"), "home_team_id", "left_anti")
    away = fixtures.join(ids.toDF("away_team_id"), "away_team_id", "left_anti")
    return home.select("id").union(away.select("id")).distinct()


def export_subset(t: Tables, *, as_of: str, strict: bool = True, upcoming_days: int = 14, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> Tables:
    """Only what exported fixtures refer to. ``strict`` raises where a fixture's team is unknown, else it is dropped.

    ``keep`` gets fixtures, line-ups and player statistics by name before other tables are chosen by their ids, and
    returns them, as from a table that they were written to.
    """
    fixtures = exportable_fixtures(t, as_of, upcoming_days)
    bad = unknown_team_fixtures(fixtures, t.teams)
    if strict:
        if n := bad.count():
            raise ValueError(f"{n} fixtures have unknown teams")
    else:
        fixtures = fixtures.join(bad, "id", "left_anti")
    fixtures = keep("fixtures", fixtures)
    ids = fixtures.select(F.col("id").alias("fixture_id"))
    of = lambda df: None if df is None else df.join(ids, "fixture_id", "left_semi")
    lineups, facts = keep("fixture_players", of(t.fixture_players)), keep("fixture_player_statistics", of(t.fixture_player_statistics))
    players = lineups.select(F.col("player_id").alias("id")).union(facts.select("player_id")).distinct()
    teams = fixtures.select(F.explode(F.array("home_team_id", "away_team_id")).alias("id")).distinct()
    team_facts = None if t.fixture_statistics is None else dedupe_team_stats(replace(t, fixture_statistics=of(t.fixture_statistics)))
    return replace(
        t, seasons=keep_seasons(t.seasons), fixtures=fixtures, teams=t.teams.join(teams, "id", "left_semi"), players=t.players.join(players, "id", "left_semi"), fixture_players=lineups,
        fixture_player_statistics=facts, fixture_statistics=team_facts, odds_outcomes=of(t.odds_outcomes), odds_snapshots=of(t.odds_snapshots),
    )


EXPORTED = ("seasons", "fixtures", "teams", "players", "fixture_players", "fixture_player_statistics", "fixture_statistics", "odds_outcomes", "odds_snapshots")


def write_export(t: Tables, path: str, **choice) -> Tables:
    """Write the tables of :func:`export_subset` below ``path`` and read them back.

    Fixtures, line-ups and player statistics are written first, and the ids that choose all other rows are read from
    there: the choice is made once, however many tables hang on it.
    """
    done: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        done[name] = written(df, f"{path}/{name}")
        return done[name]

    out = export_subset(t, keep=keep, **choice)
    for name in EXPORTED:
        if name not in done and getattr(out, name) is not None:
            done[name] = written(getattr(out, name), f"{path}/{name}")
    return Tables(**done)


def dedupe_team_stats(t: Tables) -> DataFrame:
    return t.fixture_statistics.groupBy("fixture_id", "team_id", "type_id").agg(F.max("value").alias("value"))


def prune_fixtures(t: Tables, keep: DataFrame) -> DataFrame:
    """Fixtures whose season is in ``keep(id)``; a fixture without a season stays."""
    kept = t.fixtures.join(keep.select(F.col("id").alias("season_id")), "season_id", "left_semi")
    return kept.unionByName(t.fixtures.filter("season_id is null"))


def window_ids(t: Tables, as_of: str, days: int, leagues: list[int] | None = None) -> DataFrame:
    """Fixtures dated from today to today + ``days``, both included."""
    today = date.fromisoformat(str(as_of)[:10])
    fx = in_months(t.fixtures, today, today + timedelta(days=days)).filter((F.col("starting_at") >= instant(f"{today} 00:00:00")) & (F.col("starting_at") < instant(f"{today + timedelta(days=days + 1)} 00:00:00")))
    return (fx.filter(F.col("league_id").isin(leagues)) if leagues else fx).select(F.col("id").alias("fixture_id"))


def export_odds_window(t: Tables, *, as_of: str, days: int, leagues: list[int] | None = None, snapshots: bool = True) -> dict[str, DataFrame]:
    ids = window_ids(t, as_of, days, leagues)
    out = {"odds_outcomes": t.odds_outcomes.join(ids, "fixture_id", "left_semi")}
    if snapshots and t.odds_snapshots is not None:
        out["odds_snapshots"] = t.odds_snapshots.join(ids, "fixture_id", "left_semi")
    return out


def odds_participant_patch(t: Tables, *, as_of: str, days: int, leagues: list[int] | None = None) -> DataFrame:
    """Keys of mapped player outcomes of a window with their participant; write with :func:`write_csv`."""
    mapped = t.odds_outcomes.filter("participant_id is not null and participant_type = 'player'")
    return mapped.join(window_ids(t, as_of, days, leagues), "fixture_id", "left_semi").select("fixture_id", "bookmaker_id", "market_key", "selection_key", "line", "participant_id", "participant_type")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def export_counts(t: Tables) -> DataFrame:
    """``table_name, rows`` of every table that the bundle has."""
    out = None
    for name, df in vars(t).items():
        if df is not None:
            one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            out = one if out is None else out.union(one)
    return out


def append_snapshots(snapshots: DataFrame, path: str) -> None:
    """Adds snapshots below ``path``, by month of the pull; a month's rows go to as few files as their size asks for."""
    snapshots.withColumn("pulled_month", F.date_format("pulled_at", "yyyy-MM")).hint("rebalance", "pulled_month").write.mode("append").partitionBy("pulled_month").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, batch: int = 500) -> None:
    df.write.mode("append").option("batchsize", batch).jdbc(url, table, properties=properties or {})


def run_sql(spark: SparkSession, url: str, properties: dict[str, str] | None, *statements: str) -> None:
    given = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        given.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        for sql in statements:
            connection.createStatement().executeUpdate(sql)
    finally:
        connection.close()


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: list[str], properties: dict[str, str] | None = None, batch: int = 500) -> None:
    """Rows of ``df`` (a key once) into a database table: known keys are overwritten, others added.

    Executors load a staging table in batches; the database then merges it in one statement, so readers see all or
    nothing, and a run that is repeated changes nothing more. Each run has a staging table of its own, which goes whether
    the merge succeeds or not: runs beside each other don't meet, and a failed one leaves the table as it was.
    """
    spark, quoted = df.sparkSession, lambda c: f'"{c}"'
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    rest = [c for c in df.columns if c not in keys]
    same = " AND ".join(f"a.{quoted(k)} = b.{quoted(k)}" for k in keys)
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{quoted(c)} = b.{quoted(c)}' for c in rest)}" if rest else ""
    insert = f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(quoted, df.columns))}) VALUES ({', '.join(f'b.{quoted(c)}' for c in df.columns)})"
    df.limit(0).write.option("batchsize", batch).jdbc(url, staging, properties=properties or {})  # made here: from now on it is ours to drop
    try:
        df.write.mode("append").option("batchsize", batch).jdbc(url, staging, properties=properties or {})
        run_sql(spark, url, properties, f"MERGE INTO {table} AS a USING {staging} AS b ON {same}{update}{insert}")
    finally:
        run_sql(spark, url, properties, f"DROP TABLE {staging}")
