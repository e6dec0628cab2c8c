"""The odds feed as a stream: snapshot files in, parsed and resolved outcomes out.

A micro-batch adds its own partition of Parquet below ``epochs``. Every so many of them the newest prices of all keys so
far are written as one table below ``bases``, and older partitions go: a read costs the live keys and few increments,
whatever the history. A micro-batch that runs again after a failure overwrites its partition with the same rows, or
changes nothing if a base has them already; a base that was not finished is no base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.odds import OUTCOME_KEY, latest_in_batch, parse_outcomes
from ..schemas import SCHEMAS, Tables
from ..sources.folders import children, remove, scratch_dir, written

OUTCOMES = SCHEMAS["odds_outcomes"] + ", pulled_at timestamp, place int"
COLUMNS = [x.strip().split(" ")[0] for x in OUTCOMES.replace("decimal(10,2)", "d").replace("decimal(10,4)", "d").split(",")]
KEPT = ["participant_type", "participant_id"]  # once known they stay known
ORDER = "struct<pulled_at: timestamp, epoch: int, place: int>"
STATE = OUTCOMES + ", epoch int" + "".join(f", {c}_order {ORDER}" for c in KEPT)
COMPACT_EVERY = 16
FEW = 200_000  # names that a broadcast carries at most


def read_snapshots(spark: SparkSession, path: str, late: str = "1 hour", files: int | None = None) -> DataFrame:
    """Snapshot rows of JSON files in ``path``; an id that comes again within ``late`` is dropped, late ids are not."""
    reader = spark.readStream.schema(SCHEMAS["odds_snapshots"])
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    seen = reader.json(path).withColumn("read_at", F.current_timestamp()).withWatermark("read_at", late)
    return seen.dropDuplicatesWithinWatermark(["id"]).drop("read_at")


def _numbers(spark: SparkSession, uri: str) -> list[int]:
    """Numbers of the finished folders below ``uri``, ascending."""
    return sorted(int(name.split("=")[1]) for name, finished in children(spark, uri).items() if finished and "=" in name)


def newest_base(spark: SparkSession, target: str) -> int:
    """The last epoch that a base holds, -1 if there is none."""
    return max(_numbers(spark, f"{target}/bases"), default=-1)


def _few(names: DataFrame, folder: str) -> DataFrame:
    """Names written down once; if they are few they are broadcast, so that offers stay where their fixture is."""
    stored = written(names, folder)
    return F.broadcast(stored) if stored.count() <= FEW else stored


def write_epoch(snapshots: DataFrame, epoch: int, target: str, t: Tables, every: int = COMPACT_EVERY) -> None:
    """The outcomes of a micro-batch, players and teams resolved by ``t``, as partition ``epoch`` of ``target``."""
    spark = snapshots.sparkSession
    base = newest_base(spark, target)
    if epoch <= base:
        return  # it runs again, and its rows are in the base
    folder = scratch_dir(spark, "snapshots")
    try:
        # Read and deduplicated once: several steps below need them.
        snapshots = written(snapshots, f"{folder}/rows", compression="zstd")
        if snapshots.isEmpty():
            return  # a micro-batch that only moves the watermark
        fixtures = t.fixtures.join(snapshots.select(F.col("fixture_id").alias("id")).distinct(), "id", "left_semi")
        outcomes = parse_outcomes(t, snapshots, fixtures, lambda name, df: _few(df, f"{folder}/{name}"))
        written(latest_in_batch(outcomes).select(*COLUMNS), f"{target}/epochs/epoch={epoch}")
    finally:
        remove(spark, folder)
    if epoch - base >= every:
        compact(spark, target)


def _rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows that count: the newest base's, which say since when they know what is kept, and those of later epochs."""
    base = newest_base(spark, target)
    later = [e for e in _numbers(spark, f"{target}/epochs") if e > base]
    rows = spark.createDataFrame([], STATE)
    if later:
        new = spark.read.schema(OUTCOMES + ", epoch int").option("basePath", f"{target}/epochs").parquet(*(f"{target}/epochs/epoch={e}" for e in later))
        rows = new.select("*", *(F.lit(None).cast(ORDER).alias(f"{c}_order") for c in KEPT))
    if base >= 0:
        old = spark.read.schema(STATE).parquet(f"{target}/bases/upto={base}")
        rows = rows.unionByName(old) if later else old
    return rows


def _newest(rows: DataFrame) -> DataFrame:
    """One row a key; rows without a line equal nothing and all stay."""
    order = F.struct("pulled_at", "epoch", "place")
    newest = [c for c in rows.columns if c not in OUTCOME_KEY and c not in KEPT and not c.endswith("_order")]
    since = {f"{c}_order": F.coalesce(f"{c}_order", F.when(F.col(c).isNotNull(), order).cast(ORDER)) for c in KEPT}
    known: list[Column] = []
    for c in KEPT:
        known += [F.max_by(c, f"{c}_order").alias(c), F.max(f"{c}_order").alias(f"{c}_order")]
    # Rows go their way as they are; the aggregate's partial results are wider, and no smaller in number.
    lined = rows.filter("line is not null").repartition("fixture_id").withColumns(since)
    one = lined.groupBy(*OUTCOME_KEY).agg(F.max_by(F.struct(*newest), order).alias("row"), *known).select(*OUTCOME_KEY, "row.*", *KEPT, *since)
    return one.unionByName(rows.filter("line is null").withColumns(since))


def compact(spark: SparkSession, target: str) -> None:
    """Write a base of all finished epochs. The epochs that the base before held go, and bases before that one: a reader
    that began with the last base still finds its files."""
    base, epochs = newest_base(spark, target), _numbers(spark, f"{target}/epochs")
    upto = max(epochs, default=-1)
    if upto <= base:
        return
    written(_newest(_rows(spark, target)).select(*spark.createDataFrame([], STATE).columns), f"{target}/bases/upto={upto}")
    for e in epochs:
        if e <= base:
            remove(spark, f"{target}/epochs/epoch={e}")
    for b in _numbers(spark, f"{target}/bases"):
        if b < base:
            remove(spark, f"{target}/bases/upto={b}")


def current_outcomes(spark: SparkSession, target: str) -> DataFrame:
    """The outcomes that all epochs leave: of a key the newest pull, then the later epoch and place.

    A participant once known stays known where a newer row lacks it. Rows without a line equal nothing and all stay.
    """
    base = newest_base(spark, target)
    alone = base >= 0 and not any(e > base for e in _numbers(spark, f"{target}/epochs"))
    rows = _rows(spark, target)
    return (rows if alone else _newest(rows)).select([c for c in COLUMNS if c != "place"])  # a base has a key once


def odds_stream(spark: SparkSession, source: str, target: str, checkpoint: str, t: Tables, late: str = "1 hour", files: int | None = None, once: bool = False, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Starts the feed: each micro-batch of snapshots is parsed, resolved, reduced to its newest rows and added to ``target``."""
    writer = read_snapshots(spark, source, late, files).writeStream.foreachBatch(lambda df, epoch: write_epoch(df, epoch, target, t, every)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
