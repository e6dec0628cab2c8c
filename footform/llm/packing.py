"""Best-fit packing by a grouping genetic algorithm, on islands with elite migration.

Pieces are dealt to shards bounded by pieces or by tokens. Several islands evolve packings of the same shard, from best
fits of pieces in random order; between epochs the best packing of an island migrates to its neighbour. A chromosome is
a packing itself: crossover injects whole well-filled bins of one parent, takes their pieces out of the other's bins,
dissolves the bins that lost some and the emptiest ones, and best-fits the displaced pieces. Bins that a shard could not
fill are opened again and packed together with those of other shards, level by level.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches
from .tokens import WordTokenizer

CAPACITY = 4096
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, row long"


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; ``row`` numbers pieces apart even where an id is repeated."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = WordTokenizer.load(tokenizer).encode, TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(encode(text), "<u2")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.astype("<u4")), row))
                    row += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(order: np.ndarray, size: np.ndarray, bins: np.ndarray, free: list[tuple[int, int]], capacity: int) -> None:
    """Puts the items of ``order`` in turn where least room is left over; ``free`` is sorted, ``bins`` is filled in."""
    new = max((b for _, b in free), default=-1) + 1
    new = max(new, int(bins.max(initial=-1)) + 1)
    for item in order.tolist():
        need = int(size[item])
        k = bisect_left(free, (need, -1))
        if k < len(free):
            room, b = free.pop(k)
        else:
            room, b = capacity, new
            new += 1
        bins[item] = b
        if room > need:
            insort(free, (room - need, b))


def renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int64)


def fitness(bins: np.ndarray, size: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins, then fuller ones: larger is better."""
    fill = np.bincount(bins, size)
    return -len(fill), float(np.square(fill / capacity).sum())


def crossover(mine: np.ndarray, other: np.ndarray, size: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``mine`` with some of the well-filled bins of ``other``.

    Whole bins are injected, so their pieces are taken out of the child's own bins; bins that lost a piece are dissolved,
    and so are the child's emptiest ones, and the displaced pieces are put back by best fit, long ones first.
    """
    fill = np.bincount(other, size)
    best = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    chosen = rng.choice(best, max(1, min(len(best), len(fill) // 16)), replace=False)
    injected = np.isin(other, chosen)
    own = np.bincount(mine, size)
    emptiest = np.argsort(own, kind="stable")[: 1 + len(own) // 8]
    loose = np.isin(mine, np.union1d(np.unique(mine[injected]), emptiest)) & ~injected
    child = np.where(injected, other + len(mine), mine)
    child[loose] = -1
    keep = child >= 0
    child[keep] = renumber(child[keep])
    left = capacity - np.bincount(child[keep], size[keep]).astype(np.int64)
    free = sorted((int(r), b) for b, r in enumerate(left) if r > 0)
    items = np.flatnonzero(loose)
    best_fit(items[np.argsort(-size[items], kind="stable")], size, child, free, capacity)
    return renumber(child)


def evolve(size: np.ndarray, seeds: list[np.ndarray], capacity: int, population: int, generations: int, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """The best packing found, and in how many generations a child was better than all before it.

    ``seeds`` are packings that the island starts with; the rest of the population are best fits of pieces in random
    order. Evolution ends with the least possible number of bins, or after ``generations``; while no child has improved
    the best yet, and while the best misses the least number, it goes on to four times as many.
    """
    people = [renumber(s) for s in seeds]
    least = -(-int(size.sum()) // capacity)
    while len(people) < population:
        bins = np.full(len(size), -1, np.int64)
        best_fit(rng.permutation(len(size)), size, bins, [], capacity)
        people.append(bins)
    scores = [fitness(p, size, capacity) for p in people]
    gains = idle = 0
    for generation in range(4 * generations):
        best = max(scores)
        if -best[0] <= least or len(people) < 2 or (generation >= generations and idle > generations):
            break
        a, b = rng.choice(len(people), 2, replace=False)
        child = crossover(people[a], people[b], size, capacity, rng)
        score, worst = fitness(child, size, capacity), scores.index(min(scores))
        better = score > best
        gains, idle = gains + better, 0 if better else idle + 1
        if score > scores[worst]:
            people[worst], scores[worst] = child, score
    return people[scores.index(max(scores))], gains


def runs(size: np.ndarray, capacity: int, most: int) -> np.ndarray:
    """The run of each piece: a run is packed as one item. Up to ``most`` pieces are runs of their own.

    Of more pieces, those of one short length are put together up to a 64th of the capacity, all but the last of a
    length, which still fill small gaps one by one.
    """
    if len(size) <= most:
        return np.arange(len(size))
    per = np.maximum(1, capacity // 64 // size)
    order = np.argsort(size, kind="stable")
    _, first, count = np.unique(size[order], return_index=True, return_counts=True)
    nth = np.arange(len(size)) - np.repeat(first, count)
    whole = np.repeat(count, count) // per[order] - 1
    begins = (nth % per[order] == 0) | (nth >= whole * per[order])
    out = np.empty(len(size), np.int64)
    out[order] = np.cumsum(begins) - 1
    return out


def _islands(pieces: DataFrame, seeds: bool, capacity: int, shard_pieces: int, population: int, generations: int, epoch: int) -> DataFrame:
    """One epoch on every island of every shard: ``shard, island, row, length, bin, gains`` (of the island's best packing)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        shard, island = key
        rng = np.random.default_rng([shard, island, epoch])
        if seeds:
            origins = [g.sort_values("row") for _, g in group.groupby("origin")]
            rows, size, starts = origins[0]["row"].to_numpy(), origins[0]["length"].to_numpy(np.int64), [g["bin"].to_numpy(np.int64) for g in origins]
            before = max(int(g["gains"].iloc[0]) for g in origins)
        else:
            group = group.sort_values("row")
            rows, size, starts = group["row"].to_numpy(), group["length"].to_numpy(np.int64), []
            before = 0
        # All islands of a shard make the same runs, so a run lies in one bin of every seed.
        run_of = runs(size, capacity, 2 * shard_pieces)
        _, at = np.unique(run_of, return_index=True)
        bins, gains = evolve(np.bincount(run_of, size).astype(np.int64), [b[at] for b in starts], capacity, population, generations, rng)
        return pd.DataFrame({"shard": shard, "island": island, "row": rows, "length": size.astype(np.int32), "bin": bins[run_of], "gains": np.int32(before + gains)})

    return pieces.groupBy("shard", "island").applyInPandas(run, "shard long, island int, row long, length int, bin long, gains int")


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = 4096,
    islands: int = 2,
    epochs: int = 2,
    population: int = 4,
    generations: int = 24,
) -> DataFrame:
    """``row, sequence_id, offset, gains`` for ``pieces(row, length)``, lengths from 1 to ``capacity``, in few sequences.

    ``gains`` says in how many generations of the genetic search the packing that a piece lies in was improved.

    Full pieces are sequences of their own. A shard has about ``shard_pieces`` pieces, or about 64 sequences' worth of
    tokens where pieces are so short that this is more pieces. So with two shards or more a level opens a small part
    of its bins again: at most one in 64 and one more for each shard, while best fit leaves fewer than twice the least
    number of bins. Each level's tokens are under a tenth of the last one's, whatever the lengths, until one shard is
    left or no bin can be saved; 64 levels can't be reached. Nothing but counts passes through the driver.
    Sequence numbers are odd for full pieces, else made of the shard, the bin (under 65536) and the level.
    """
    spark = pieces.sparkSession
    full = pieces.filter(F.col("length") == capacity).select("row", F.expr("row * 2 + 1").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("gains"))
    done, rest, level = full, pieces.filter(F.col("length") < capacity).select("row", "length"), 0
    count = lambda df: df.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).head()
    n, tokens = count(rest)
    while n:
        least = -(-tokens // capacity)
        shards = min(-(-n // shard_pieces), -(-least // 64))
        dealt = rest.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)))
        both = dealt.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(islands)))))
        state = materialise(_islands(both, False, capacity, shard_pieces, population, generations, 0), "pack-epoch")
        for epoch in range(1, epochs):
            elite = state.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands))).withColumn("origin", F.lit(1))
            state = materialise(_islands(state.withColumn("origin", F.lit(0)).unionByName(elite), True, capacity, shard_pieces, population, generations, epoch), "pack-epoch")
        fill = state.groupBy("shard", "island", "bin").agg(F.sum("length").alias("fill"))
        score = fill.groupBy("shard", "island").agg(F.count(F.lit(1)).alias("bins"), F.sum(F.pow(F.col("fill") / capacity, 2)).alias("full"))
        best = score.groupBy("shard").agg(F.min(F.struct("bins", -F.col("full"), "island")).alias("best")).select("shard", "best.island", "best.bins")
        own = best.select("shard", "island")
        chosen = state.join(own, ["shard", "island"]).join(fill, ["shard", "island", "bin"])
        if shards > 1 and best.agg(F.sum("bins")).head()[0] > least:
            # A shard's emptiest bins, one for each 64 of its bins, meet those of other shards at the next level.
            ranked = fill.join(own, ["shard", "island"]).withColumn("rank", F.expr("row_number() over (partition by shard order by fill, bin)")).withColumn("of", F.expr("count(1) over (partition by shard)"))
            opened = ranked.filter(F.col("rank") <= F.ceil(F.col("of") / 64)).select("shard", "bin", F.lit(True).alias("open"))
            chosen = materialise(chosen.join(opened, ["shard", "bin"], "left").withColumn("open", F.coalesce("open", F.lit(False))), "pack-level")
            rest = chosen.filter("open").select("row", "length")
            chosen = chosen.filter("not open")
            n, tokens = count(rest)
        else:
            n = 0
        place = F.expr("sum(length) over (partition by shard, bin order by row rows between unbounded preceding and 1 preceding)")
        done = done.unionByName(chosen.select("row", F.expr(f"((shard * 65536 + bin) * 64 + {level}) * 2").alias("sequence_id"), F.coalesce(place, F.lit(0)).cast("long").alias("offset"), "gains"))
        level += 1
    return done


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset, gains`` of every piece of ``docs(doc_id, text)``.

    A null or empty text is the end id alone. Repeated ids are packed row by row. An empty table gives no rows. Extra
    columns are ignored.
    """
    pieces = materialise(cut(docs, tokenizer, capacity), "pieces")
    return pieces.join(pack(pieces, capacity), "row").select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset", "gains")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
