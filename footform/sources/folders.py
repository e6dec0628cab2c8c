"""Folders that driver and executors share, by Hadoop's file systems, so that any store Spark writes to will do."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI; one is made here only for a local session that names none."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="footform-shared-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return base if "://" in base or not base.startswith("/") else f"file://{base}"


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; what is there goes when the session's JVM ends, unless removed before."""
    uri = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, path = _path(spark, uri)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return uri


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder; one that is not there is none."""
    fs, path = _path(spark, uri)
    fs.delete(path, True)


def children(spark: SparkSession, uri: str) -> dict[str, bool]:
    """Names below a folder, and whether Spark has finished writing there."""
    fs, path = _path(spark, uri)
    if not fs.exists(path):
        return {}
    found = [s.getPath() for s in fs.listStatus(path)]
    return {p.getName(): fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")) for p in found}


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is written meanwhile as soon as each is done, not when it next collects garbage."""
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_KEY, before)


def written(df: DataFrame, uri: str, **options: str) -> DataFrame:
    """``df`` after it was written to a folder as Parquet: read from there, its lineage cut and its shuffle files gone."""
    with cleaned(df.sparkSession):
        df.write.options(**options).mode("overwrite").parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)
