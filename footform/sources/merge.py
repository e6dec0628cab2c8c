"""Upserts without a table format: a new frame, written to a new version's path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_by_key(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``current`` with those of ``updates`` in their place: a column that updates lack keeps its value.

    ``updates`` must hold a key once. Null keys are keys like any other.
    """
    fresh = updates.toDF(*(f"__{c}" for c in updates.columns)).withColumn("__new", F.lit(True))
    on = [current[k].eqNullSafe(fresh[f"__{k}"]) for k in keys]
    both = current.join(fresh, on, "full_outer")
    value = lambda c: F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c)
    columns = [value(c) if c in updates.columns else F.col(c) for c in current.columns]
    return both.select(*columns, *(F.col(f"__{c}").alias(c) for c in updates.columns if c not in current.columns))


def latest_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key: the first by ``order``."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank")


def fill_by_key(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """As ``merge_by_key``, but an empty or null update keeps what is known."""
    fresh = updates.select(*keys, *(F.col(c).alias(f"__{c}") for c in updates.columns if c not in keys))
    both = current.join(fresh, keys, "full_outer")
    value = lambda c: F.coalesce(F.when(F.col(f"__{c}").cast("string") != "", F.col(f"__{c}")), F.col(c)).alias(c)
    return both.select(*(value(c) if c in updates.columns and c not in keys else F.col(c) for c in current.columns))
