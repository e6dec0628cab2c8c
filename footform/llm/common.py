"""Shared helpers: the shared folder, file access inside tasks, Arrow batch size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.folders import shared_dir

ROW = "__footform_row"  # the column that tells rows apart where ids don't


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder (below ``within``) and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{within}/{name}-{uuid.uuid4().hex}" if within else fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(uri: str) -> None:
    """Delete a folder that no result reads any more; one that was never written is none."""
    fs, path = open_fs(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)


_HOLDER: list[Callable[[], None] | None] = []


def take_over(forget: Callable[[], None] | None = None) -> None:
    """Let go of what another operator's tasks remembered in this Python worker, which Spark uses for one operator after
    the other; ``forget`` does so for the caller's own memory when its turn is over. Call it from importable functions:
    Spark sends a nested function with the memory it names."""
    if _HOLDER != [forget]:
        for other in _HOLDER:
            if other:
                other()
        _HOLDER[:] = [forget]
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the second one's also trims the C heap
            pool.release_unused()


BATCH_ROWS = 128


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts fits a Python worker: one value for all operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def keep_where(docs: DataFrame, column: str, judge: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose value of ``column`` the judge keeps; each row on its own, all columns as they were."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


#: Ids of 8 bytes that a join may broadcast; more of them are shuffled.
BROADCAST_IDS = 500_000


def small(df: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``df`` marked for a broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def keyed(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with a column ``ROW`` that is never null and never repeats.

    Ids serve where they are whole numbers, unique and known. Else rows are numbered and written down once, so that a
    task that runs again finds the same numbers.
    """
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    if whole and docs.groupBy(F.col(id_col).alias("id")).count().filter("id is null or count > 1").isEmpty():
        return docs.withColumn(ROW, F.col(id_col).cast("long"))
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (of :func:`keyed`) without the rows in the one column of ``gone``, which are broadcast only if few."""
    gone = materialise(gone.toDF(ROW), "gone-rows")
    return docs.join(small(gone), ROW, "left_anti").drop(ROW)


def likely_first(order: Column, k: int, n: Column | int) -> Column:
    """Rows that may be among the ``k`` smallest of ``n`` rows by a 64-bit hash: about ``2 * k + 1000`` of them.

    Applied before rows meet in one task, so that what meets there doesn't grow with the input.
    """
    share = F.least(F.lit(1.0), F.lit(2.0 * k + 1000) / n)
    return order <= (share - 0.5) * 2.0**64


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for use inside tasks."""
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Write under an attempt's own name, then rename: a task that runs twice leaves one whole file."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(attempt) as out:
        out.write(data)
    fs.move(attempt, path)


def read_range(uri: str, offset: int, length: int) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return f.read_at(length, offset)


def numbered(rows: DataFrame, group: str, order: list[Column], name: str, within: str | None = None, about: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows`` with ``place``, from 0 in the order of ``order`` within ``group`` (never null), and the group's ``members``.

    Rows are dealt by ranges of group and order, ties by where they were read, so that a group of any size spreads over
    tasks, and are written down in their order; only counts by group and range meet in a window. ``about`` gets a table
    ``group, members`` with a row a group and returns it with more columns, which the group's rows then carry.
    """
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(F.col(group), *order, "__tie").sortWithinPartitions(group, *order, "__tie")
    dealt = materialise(dealt.drop("__tie").withColumn("__at", F.monotonically_increasing_id()), name, within)
    part = F.shiftright("__at", 33).alias("__part")  # the range that a row was written with
    ranges = dealt.groupBy(group, part).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    whole = Window.partitionBy(group)
    before = F.sum("__rows").over(whole.orderBy("__part")) - F.col("__rows")
    ranges = ranges.select(group, "__part", "__first", before.alias("__before"), F.sum("__rows").over(whole).alias("members"))
    ranges = materialise(ranges, f"{name}-ranges", within)
    if about:
        more = about(ranges.filter("__before = 0").select(group, "members"))
        ranges = ranges.join(more.drop("members"), group)
    out = dealt.withColumn("__part", part).join(small(ranges, BROADCAST_IDS // 5), [group, "__part"])
    return out.withColumn("place", F.col("__before") + F.col("__at") - F.col("__first")).drop("__part", "__first", "__before", "__at")
