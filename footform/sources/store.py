"""Tables on disk, laid out by league and month, so that what a query asks for by league or date is all it reads.

Months rather than days: a league plays few fixtures a day, and files of a few rows cost more than they spare. Within a
month rows are sorted by kick-off, so a file's own minima and maxima rule out most of what a day doesn't need.
"""

from __future__ import annotations

from dataclasses import fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Tables
from .folders import children, remove, scratch_dir, written
from .merge import merge_by_key

BY = ["league_id", "starting_month"]
OF_FIXTURE = ("fixture_players", "fixture_player_statistics", "fixture_statistics", "fixture_participants", "odds_outcomes", "odds_snapshots", "odds_latest", "player_odds", "team_stats", "player_stats")


def month(at: str = "starting_at") -> Column:
    return (F.year(at) * 100 + F.month(at)).alias("starting_month")


def write_store(t: Tables, path: str) -> None:
    """Write every table of ``t`` below ``path``; those of fixtures in partitions by their fixture's league and month."""
    places = t.fixtures.select(F.col("id").alias("fixture_id"), "league_id", month(), F.col("starting_at").alias("__at"))
    for f in fields(t):
        df = getattr(t, f.name)
        if df is None:
            continue
        if f.name == "fixtures":
            df = df.withColumn("starting_month", month()).withColumn("__at", F.col("starting_at"))
        elif f.name in OF_FIXTURE:
            df = df.drop(*BY).join(places, "fixture_id", "left")
        if "starting_month" not in df.columns:
            df.write.mode("overwrite").parquet(f"{path}/{f.name}")
        else:
            # Rows of a partition meet in as few tasks as their size asks for; a large one is split.
            df.hint("rebalance", *BY).sortWithinPartitions(*BY, "__at").drop("__at").write.mode("overwrite").partitionBy(*BY).parquet(f"{path}/{f.name}")


def read_store(spark: SparkSession, path: str) -> Tables:
    found = children(spark, path)
    return Tables(**{f.name: spark.read.option("basePath", f"{path}/{f.name}").parquet(f"{path}/{f.name}") for f in fields(Tables) if f.name in found})


def merge_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], by: list[str], gone: DataFrame | None = None) -> None:
    """Merge ``updates`` (a key once, with the columns ``by``) into the table at ``path``, partitioned by ``by``.

    Only partitions that updates name are read and written; as many values of them come to the driver as updates name.
    A key is looked for in the partition that its update names; one that has moved is given in ``gone(keys, by)`` with
    its former partition, and is dropped there. Touched partitions are written aside first and then replaced, so nothing is
    overwritten while it is read, and a merge that failed halfway can run again.
    """
    touched = updates.select(*by) if gone is None else updates.select(*by).unionByName(gone.select(*by))
    values = touched.distinct().collect()
    if not values:
        return
    one = lambda r: reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(r[c])) for c in by))
    if len(by) == 1:
        named = F.col(by[0]).isin([r[by[0]] for r in values if r[by[0]] is not None])
        named = named | F.col(by[0]).isNull() if any(r[by[0]] is None for r in values) else named
    else:
        named = reduce(lambda a, b: a | b, map(one, values))
    current = spark.read.parquet(path).filter(named)
    if gone is not None:
        current = current.join(gone.select(*keys, *by), [current[c].eqNullSafe(gone[c]) for c in (*keys, *by)], "left_anti")
    aside = scratch_dir(spark, "merge")
    merged = written(merge_by_key(current, updates, [*keys, *by]), aside)
    emptied = touched.distinct().join(merged.select(*by).distinct(), by, "left_anti").collect()
    merged.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    for r in emptied:  # a partition that lost its last row
        remove(spark, "/".join([path, *(f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else r[c]}" for c in by)]))
    remove(spark, aside)
