"""Repeated passages by a logarithmic family of suffix indexes.

A suffix is indexed where a text's content says so: every run of ``length`` bytes picks one anchor inside it (the
smallest fingerprint of ``gram`` bytes), so two equal runs pick the same anchor at the same place. A batch's index holds
its anchors sorted by fingerprint, as a sparse suffix array. A new batch is merge-scanned against the levels that exist;
levels of equal size merge, so n batches keep log n levels. Matching anchors are refined: an anchor whose whole
surroundings repeat needs no more; for others each run of ``length`` bytes is compared.

Bytes are compared by two 64-bit fingerprints. That of the anchor's own bytes rolls over the text: a polynomial modulo
2**64, which loses most of its bits on texts built like Thue-Morse words. That of the whole stretch is BLAKE2b of its
bytes and owes nothing to the first, so a run that differs keeps 64 bits of its own even there.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, fresh_dir, keyed, materialise, remove, small, small_batches

LENGTH, GRAM = 400, 160
PASSAGE = 256  # bytes: any shared run of so many shows in ``n_shared``
BASE = 0x9E3779B97F4A7C15 | 1
CHUNK = 1 << 20  # bytes of text that are fingerprinted at once, or one longer text
SALTS = 16  # files of a level that the anchors of one fingerprint are dealt to
BLOCK = 8  # starts that are refined together
HOT = 2000  # a kind with more than one row in so many is broadcast: there are fewer than that of them
ASKED = 1_000_000  # anchors or blocks of some 20 bytes that a join may broadcast to the texts; more are shuffled
ENTRY = "fp long, ext long, doc long, pos int, lo int, hi int"
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (BASE % 2**64, pow(BASE, -1, 2**64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sums:
    """Prefix sums of a byte string, from which any stretch's fingerprint follows."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        p, self.inverse = powers(len(data) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]

    def runs(self, length: int) -> np.ndarray:
        return (self.sums[length:] - self.sums[:-length]) * self.inverse[: len(self.sums) - length]


def digests(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """BLAKE2b of each stretch, 64 bits of it."""
    view = memoryview(raw)
    return np.array([int.from_bytes(blake2b(view[a:b], digest_size=8).digest(), "little") for a, b in zip(begin.tolist(), end.tolist(), strict=True)], np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones: minima of blocks from the left and from the right."""
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, 1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, whole: bool = True) -> tuple[np.ndarray, ...]:
    """Of texts side by side: (text number, fp, ext, pos, lo, hi) of each anchor; lo..hi are the starts of its runs.

    ``ext`` is of all that its runs cover, at most ``2 * length - gram`` bytes; 0 if ``whole`` is not asked for.
    """
    raw, sizes = b"".join(texts), np.array([len(t) for t in texts], np.int64)
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    begins = np.cumsum(sizes) - sizes
    sums, bits = Sums(raw), np.uint64(max(20, len(raw).bit_length()))
    grams = mix(sums.runs(gram))
    low = (np.uint64(1) << bits) - np.uint64(1)
    chosen = (sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & low).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(chosen)]
    starts = np.flatnonzero(np.arange(len(chosen)) + length <= (begins + sizes)[owner])
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.concatenate([[True], (np.diff(starts) > 1) | (np.diff(chosen[starts]) != 0) | (np.diff(owner[starts]) != 0)])
    first = np.flatnonzero(new)
    lo, hi = starts[first], starts[np.concatenate([first[1:], [len(starts)]]) - 1]
    pos = chosen[lo]
    shape = ((hi - lo) << 32 | (pos - lo)).astype(np.uint64)
    ext = mix(digests(raw, lo, hi + length) + mix(shape)) if whole else np.zeros(len(lo), np.uint64)
    text = owner[lo]
    return text, grams[pos].view(np.int64), ext.view(np.int64), pos - begins[text], lo - begins[text], hi - begins[text]


def chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes together, or of one longer text."""
    a = total = 0
    for k, n in enumerate(sizes):
        if k > a and total + n > CHUNK:
            yield a, k
            a = k
            total = 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def entries(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The anchors of ``docs(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), [t.encode() for t in batch.column(1).to_pylist()]
            for a, b in chunks([len(t) for t in texts]):
                text, fp, ext, pos, lo, hi = anchors(texts[a:b], length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(ext, pa.int64()), pa.array(ids[a + text] if len(text) else [], pa.int64()), *(pa.array(x, pa.int32()) for x in (pos, lo, hi))], ["fp", "ext", "doc", "pos", "lo", "hi"])

    return docs.mapInArrow(run, ENTRY)


def several(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """``doc, lo, hi`` of those ``rows(fp, ext, ...)`` whose kind has more than one row by ``kinds(fp, ext, n)``.

    A kind of many rows is never dealt out by its key: those with more than a HOTth of all rows are broadcast, the rest
    are small beside a partition.
    """
    key, most = ["fp", "ext"], max(1, rows.count() // HOT)
    hot = F.broadcast(kinds.filter(F.col("n") > most).select(*key))
    others = kinds.filter((F.col("n") > 1) & (F.col("n") <= most)).select(*key)
    return rows.join(hot, key, "left_semi").unionByName(rows.join(hot, key, "left_anti").join(others, key, "left_semi")).select("doc", "lo", "hi")


class IndexFamily:
    """Levels of a growing index in the shared folder: add batches, then ask for what is repeated."""

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM, folder: str | None = None):
        self.spark, self.length, self.gram = spark, length, gram
        self.folder, self.made = folder or fresh_dir(spark, "suffix-index"), 0
        self.levels: list[tuple[int, str]] = []  # (batches, path), large ones first
        self.matches: list[str] = []

    def _write(self, df: DataFrame) -> str:
        self.made += 1
        path = f"{self.folder}/{self.made}"
        df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "fp", F.pmod("doc", F.lit(SALTS))).sortWithinPartitions("fp").write.parquet(path)
        return path

    def _read(self, path: str, schema: str = ENTRY) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def add(self, docs: DataFrame) -> None:
        """Indexes a batch ``docs(doc, text)`` of new, unlike texts: scan against every level, then merge equal levels."""
        path = self._write(entries(docs.select("doc", "text"), self.length, self.gram))
        new = self._read(path)
        found = new.groupBy("fp").count().filter("count > 1").select("fp")
        once = new.select("fp").distinct()  # so that a fingerprint of many texts is one row of the scan
        for _, level in self.levels:
            found = found.unionByName(once.join(self._read(level).select("fp").distinct(), "fp", "left_semi"))
        self.matches.append(f"{self.folder}/match-{self.made}")
        found.distinct().write.parquet(self.matches[-1])
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            merged = self._write(self._read(other).unionByName(self._read(path)))
            remove(other)
            remove(path)
            path, size = merged, 2 * size
        self.levels.append((size, path))

    def repeated(self, docs: DataFrame) -> DataFrame:
        """``doc, lo, hi``: starts lo..hi of runs of ``length`` bytes that start somewhere else as well."""
        seen = self._read(self.matches[0], "fp long")
        for path in self.matches[1:]:
            seen = seen.unionByName(self._read(path, "fp long"))
        keep = lambda df, name: materialise(df, name, self.folder)
        seen = keep(seen.distinct(), "seen")
        held = None
        for _, path in self.levels:
            held = self._read(path) if held is None else held.unionByName(self._read(path))
        shared = keep(held.join(small(seen), "fp", "left_semi"), "shared")
        kinds = keep(shared.groupBy("fp", "ext").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "pos", "lo", "hi")).alias("one")), "kinds")
        whole = several(shared, kinds)
        # Where an anchor's surroundings differ, one anchor of each kind shows its runs, first in blocks of starts.
        unsure = kinds.filter("n = 1").select("fp").distinct()
        asked = kinds.join(unsure, "fp", "left_semi").select("fp", "one.doc", "one.pos", "one.lo", "one.hi")
        blocks = keep(self._refined(docs, asked, BLOCK), "blocks")
        sorts = keep(blocks.groupBy("fp", "ext").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "pos", "lo", "hi")).alias("one")), "kinds")
        some = several(blocks, sorts)
        # A block's core lies in all of its runs: only where the core repeats may a single run do.
        open_cores = sorts.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1").select("fp")
        asked = sorts.join(open_cores, "fp", "left_semi").select("fp", "one.doc", "one.pos", "one.lo", "one.hi")
        runs = keep(self._refined(docs, asked, 1), "runs")
        twice = keep(runs.groupBy("fp", "ext").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "twice")
        return whole.unionByName(some).unionByName(several(runs, twice))

    def _refined(self, docs: DataFrame, asked: DataFrame, block: int) -> DataFrame:
        """``asked(fp, doc, pos, lo, hi)`` cut into blocks of ``block`` starts, counted from ``pos``.

        Gives ``fp`` (of what all runs of a block have in common, and of the asked fp), ``ext`` (of the block's whole
        surroundings), doc, pos (the block's begin, also where the text has only some of its starts), lo, hi.
        """
        length = self.length
        few = asked.limit(ASKED + 1).count() <= ASKED
        by_doc = asked.groupBy("doc").agg(F.collect_list(F.struct("fp", "pos", "lo", "hi")).alias("asked"))
        by_doc = F.broadcast(by_doc) if few else by_doc

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for doc, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    fp, anchor, lo, hi = (np.array([w[k] for w in wanted], np.int64) for k in ("fp", "pos", "lo", "hi"))
                    first, last = (lo - anchor) // block, (hi - anchor) // block
                    n = last - first + 1
                    of = np.repeat(np.arange(len(lo)), n)
                    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[of]
                    begin = anchor[of] + number * block
                    a, b = np.maximum(lo[of], begin), np.minimum(hi[of], begin + block - 1)
                    raw = text.encode()
                    sums = Sums(raw)
                    core = mix(sums.of(begin + block - 1, begin + length) + mix(fp[of].view(np.uint64) + number.view(np.uint64)))
                    whole = mix(digests(raw, a, b + length) + mix(((a - begin) << 32 | (b - begin)).astype(np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), pa.array([doc] * len(a), pa.int64()), *(pa.array(x, pa.int32()) for x in (begin, a, b))], ["fp", "ext", "doc", "pos", "lo", "hi"])

        return docs.select("doc", "text").join(by_doc, "doc").mapInArrow(run, ENTRY)


def seeds(docs: DataFrame, passage: int, gram: int) -> DataFrame:
    """``fp, doc``: fingerprints of the ``gram`` bytes that each run of ``passage`` bytes picks, once for each doc."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), [t.encode() for t in batch.column(1).to_pylist()]
            for a, b in chunks([len(t) for t in texts]):
                text, fp, *_ = anchors(texts[a:b], passage, gram, whole=False)
                one = np.unique(np.stack([text, fp]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(one[1], pa.int64()), pa.array(ids[a + one[0]] if one.size else [], pa.int64())], ["fp", "doc"])

    return docs.mapInArrow(run, "fp long, doc long")


def shared_passages(docs: DataFrame, passage: int, gram: int, folder: str) -> DataFrame:
    """``doc, n_shared``: how many of the seeds of a doc another doc of ``docs(doc, text)`` holds too; docs with any."""
    own = materialise(seeds(docs.filter(F.octet_length("text") >= passage).select("doc", "text"), passage, gram), "seeds", folder)
    several = materialise(own.groupBy("fp").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("fp"), "several", folder)
    return materialise(own.join(small(several), "fp", "left_semi").groupBy("doc").agg(F.count(F.lit(1)).alias("n_shared")), "passages", folder)


def without_repeats(docs: DataFrame, batches: int = 3, length: int = LENGTH, gram: int = GRAM, passage: int = PASSAGE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary)``, n_shared`` for each row of ``docs(doc_id, text)``.

    A byte is removed if a run of ``length`` bytes that covers it starts anywhere else too, in the same text or in
    another; matches never cross texts. A null text is empty. Equal texts are indexed once and removed whole. Rows are
    told apart by their place, so null and repeated ids are rows as others. An empty table gives no rows; extra columns
    are ignored.

    ``n_shared`` removes nothing: it counts the strings of ``gram`` bytes, of those that any ``passage`` bytes pick by
    content, that another row holds too. It is above 0 for each row that shares a run of ``passage`` bytes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = fresh_dir(spark, "suffix")
    docs = keyed(docs.select("doc_id", "text")).select(F.col(ROW).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shared = shared_passages(docs, passage, min(gram, passage), work)
    long = docs.filter(F.octet_length("text") >= length)
    key = [F.sha2("text", 256).alias("sha")]
    hashes = materialise(long.select("doc", *key), "hashes", work)
    classes = hashes.groupBy("sha").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = materialise(hashes.join(small(materialise(classes, "classes", work)), "sha").select("doc", (F.col("doc") == F.col("first")).alias("stays")), "copies", work)
    unlike = long.join(small(copies.filter("not stays").select("doc")), "doc", "left_anti")
    family = IndexFamily(spark, length, gram, work)
    for k in range(batches):
        family.add(unlike.filter(F.pmod(F.xxhash64("doc"), F.lit(batches)) == k))
    spans = family.repeated(unlike)
    spans = spans.unionByName(copies.select("doc", F.lit(-1).alias("lo"), F.lit(-1).alias("hi")))  # -1: all of the text
    by_doc = materialise(spans.groupBy("doc").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi")).join(shared, "doc", "full_outer"), "suffix-result")
    remove(work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, lo, hi, n_shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                removed = spans_n = 0
                kept = raw
                if lo and min(lo) < 0:
                    removed, spans_n, kept = len(raw), 1, b""
                elif lo:
                    mark = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(mark, lo, 1)
                    np.add.at(mark, np.array(hi) + length, -1)
                    cover = np.cumsum(mark[:-1]) > 0
                    removed, spans_n = int(cover.sum()), int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~cover].tobytes()
                rows.append((doc, len(raw), removed, spans_n, kept, n_shared or 0))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_shared"])

    return docs.join(by_doc, "doc", "left").select("doc_id", "text", "lo", "hi", "n_shared").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_shared long")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared", (F.col("n_shared") > 0).alias("shares_passage"))
