"""Which statistics exist, and how much of them a league has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Tables


def stat_type_usage(t: Tables) -> DataFrame:
    """Types seen in facts with flags, then expected-goals types that facts lack, as player ones."""
    seen = lambda df, flag: df.filter("type_id is not null").select("type_id").distinct().withColumn(flag, F.lit(True))
    used = seen(t.fixture_player_statistics, "is_player").join(seen(t.fixture_statistics, "is_team"), "type_id", "full_outer")
    names = t.types.select(F.col("id").alias("type_id"), F.col("code").alias("key"), "name")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    base = names.join(used, "type_id").select("type_id", "key", "name", flag("is_player"), flag("is_team"))
    expected = F.lower("name").startswith("expected goals") | F.lower("key").startswith("expected-goal")
    return base.unionByName(names.filter(expected).join(used, "type_id", "left_anti").select("*", F.lit(True).alias("is_player"), F.lit(False).alias("is_team")))


def stat_type_counts_by_league(t: Tables, *, league: int) -> DataFrame:
    """Rows and entities of each type in finished fixtures; null where one kind has none."""
    fx = t.fixtures.filter((F.col("league_id") == league) & F.col("home_score").isNotNull() & F.col("away_score").isNotNull()).select(F.col("id").alias("fixture_id"))

    def kind(df: DataFrame, entity: str, name: str) -> DataFrame:
        own = df.join(fx, "fixture_id", "left_semi")
        # A count per entity first, so that no task holds all entities of one type.
        per = own.groupBy("type_id", entity).agg(F.count(F.lit(1)).alias("n"))
        return per.groupBy("type_id").agg(F.sum("n").alias(f"{name}_rows"), F.count(entity).alias(f"{name}_{name}s_count"))

    return kind(t.fixture_player_statistics, "player_id", "player").join(kind(t.fixture_statistics, "team_id", "team"), "type_id", "full_outer")
