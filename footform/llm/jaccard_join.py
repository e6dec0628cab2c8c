"""Exact join of documents whose word-shingle sets are close in Jaccard distance, as a metric-space join in regions.

Distance is 1 - |x & y| / |x | y|. Equal sets fall into one class first. A region holds the documents that share a key:
the first shingles of each set in one common order (rare before frequent), as many as the triangle inequality on set
sizes and the radius ask for, so that two documents within the radius always meet in a region, and a document on a
boundary is replicated to every region it could have a partner in. Each region has a pivot, its most central member;
all members are measured against it, and those within the radius form one component at once. Only members outside it
are joined further, with the members of their region that are in other components, behind an upper bound from bitmaps;
surviving pairs are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, fresh_dir, keyed, materialise, remove, small, small_batches, take_over, without_rows

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
MAX_BITS = 1 << 14
MOST_WORDS = 200_000  # that a Python worker remembers the hashes of
GROUP_ROWS = 2000  # members of regions that are joined in one group


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words as sorted 64-bit numbers; of fewer words, the whole sequence as one."""
    take_over(_WORDS.clear)
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    total = h[:n] * ODD[0]
    for k in range(1, width):
        total = mix(total) + h[k : k + n] * ODD[k % len(ODD)]
    return np.unique(mix(total))


def bits_for(n: int) -> int:
    return min(MAX_BITS, max(64, 1 << (4 * n - 1).bit_length()))


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the shingles' places in a bitmap of about four bits a shingle; larger ones fold to smaller by xor."""
    bits = bits_for(len(s))
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) xored down to ``size`` words."""
    return np.bitwise_xor.reduce(words.reshape(len(words), -1, size), 1)


def close_enough(overlap: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (nx + ny - overlap)


def may_link(n: int, own: bytes, ns: np.ndarray, others: list[bytes], percent: int) -> np.ndarray:
    """Which of the others could be close enough: two sets differ in at least as many shingles as their bitmaps in bits."""
    out = np.zeros(len(ns), bool)
    fits = 100 * np.minimum(ns, n) >= percent * np.maximum(ns, n)
    mine = np.frombuffer(own, np.uint64)[None]
    sizes = np.array([len(o) // 8 for o in others])
    for size in np.unique(sizes[fits]):
        at = np.flatnonzero(fits & (sizes == size))
        theirs = np.frombuffer(b"".join(others[i] for i in at), np.uint64).reshape(-1, size)
        small = min(size, mine.shape[1])
        apart = np.bitwise_count(fold(theirs, small) ^ fold(mine, small)).sum(1).astype(np.int64)
        out[at] = close_enough((ns[at] + n - apart) // 2, ns[at], np.int64(n), percent)
    return out


def prefix(n: int, percent: int) -> int:
    """How many first shingles two sets within the radius cannot both miss each other in."""
    return n - (percent * n + 99) // 100 + 1


def pick(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose doc is in ``ids(doc)`` (or is not): the ids are broadcast only if they are few."""
    return df.join(small(ids), "doc", how)


def described(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc, n, s1, s2, bitmap, keys``: size, fingerprints and bitmap of each set, its first shingles by number."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bitmap", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingles(text, width)
                prints = [int(np.array(mix(s ^ c).sum(), np.uint64).view(np.int64)) for c in ODD[:2]]
                rows.append((doc, len(s), *prints, bitmap(s) if len(s) else b"", s[: prefix(len(s), percent)].view(np.int64) if len(s) else []))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, schema.types, strict=True)], schema=schema)

    return docs.mapInArrow(run, "doc long, n long, s1 long, s2 long, bitmap binary, keys array<long>")


def reordered(docs: DataFrame, frequent: pd.DataFrame, width: int, percent: int) -> DataFrame:
    """``doc, keys``: first shingles when the frequent ones come last, the most frequent at the very end."""
    order = frequent.sort_values("h")
    shared = docs.sparkSession.sparkContext.broadcast((order["h"].to_numpy(np.int64), order["n"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            keys = []
            for text in batch.column(1).to_pylist():
                s = shingles(text, width).view(np.int64)
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                late = np.where(known[at] == s, counts[at], 0)
                keys.append(s[np.lexsort((s.view(np.uint64), late))[: prefix(len(s), percent)]] if len(s) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["doc", "keys"])

    return docs.mapInArrow(run, "doc long, keys array<long>")


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` that sizes and bitmaps leave possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, x, y = (c.to_pylist() for c in batch.columns)
            keep = np.array([bool(may_link(n, own, np.array([m]), [other], percent)[0]) for n, own, m, other in zip(na, x, nb, y, strict=True)], bool)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("y"))
    near = pairs.join(left, "a").join(right, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return near.select("a", "b", "na", "nb", "x", "y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, work: str) -> DataFrame:
    """Those of ``pairs(a, b)`` that are close enough, by their whole sets: ``a, b, overlap, united``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, width).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["doc", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                overlap = int((both[1:] == both[:-1]).sum())
                if close_enough(overlap, len(x), len(y), percent):
                    rows.append((a, b, overlap, len(x) + len(y) - overlap))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)], ["a", "b", "overlap", "united"])

    ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    whole = materialise(pick(docs, ids).mapInArrow(sets, "doc long, s binary"), "whole", work)
    left, right = whole.select(F.col("doc").alias("a"), F.col("s").alias("x")), whole.select(F.col("doc").alias("b"), F.col("s").alias("y"))
    return materialise(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, overlap long, united long"), "links", work)


def components(links: DataFrame, work: str) -> DataFrame:
    """``doc, component`` (the smallest doc) of every end of ``links(a, b)``: least labels spread along links, and each
    label is replaced by its own label, until nothing changes."""
    both = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both", work)
    label = materialise(both.groupBy(F.col("a").alias("doc")).agg(F.least(F.col("doc"), F.min("b")).alias("component")), "labels", work)
    while True:
        near = both.join(label.select(F.col("doc").alias("b"), "component"), "b").groupBy(F.col("a").alias("doc")).agg(F.min("component").alias("near"))
        up = label.select(F.col("doc").alias("component"), F.col("component").alias("up"))
        following = label.join(near, "doc").join(up, "component", "left").select("doc", F.col("component").alias("was"), F.least("component", "near", "up").alias("component"))
        following = materialise(following, "labels", work)
        label = following.select("doc", "component")
        if following.filter("was <> component").isEmpty():
            return label


def outside(regions: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, work: str, block: int = 500) -> DataFrame:
    """``a, b``: a member that its region's pivot did not reach, and one of another component that it may be close to.

    ``regions(key, doc, pivot, members)``. A region's members are dealt to blocks of about ``block``; members outside
    meet each block, so that no task holds a whole large region and no pair is emitted that the bound rules out.
    """
    known = lambda df, col, out: df.join(labels.select(F.col("doc").alias(col), F.col("component").alias(out)), col, "left").withColumn(out, F.coalesce(out, F.col(col)))
    held = known(known(regions.filter("members > 2"), "doc", "own"), "pivot", "main")
    mixed = held.groupBy("key").agg(F.sum((F.col("own") != F.col("main")).cast("long")).alias("out")).filter("out > 0").select("key")
    held = materialise(held.join(mixed, "key", "left_semi").filter("doc <> pivot").select("key", "pivot", "doc", "own", "main", "members"), "mixed", work)
    blocks = F.ceil(F.col("members") / block).cast("long")
    groups = 1 + held.count() // GROUP_ROWS
    full = held.join(sets.select("doc", "n", "bitmap"), "doc")
    # Regions of one pivot go to one group, as they hold the same pairs; a large region's blocks go to different ones.
    group = F.pmod(F.xxhash64("pivot", "block"), F.lit(groups)).alias("group")
    columns = ["key", "block", "doc", "own", "n", "bitmap"]
    right = full.withColumn("block", F.pmod(F.xxhash64("doc"), blocks)).select(group, *columns)
    left = full.filter("own <> main").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(group, *columns)
    left = left.toDF(*(f"{c}_" for c in left.columns))

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        facts = {d: (o, n, m) for df, e in ((x, "_"), (y, "")) for d, o, n, m in zip(df[f"doc{e}"], df[f"own{e}"], df[f"n{e}"], df[f"bitmap{e}"], strict=True)}
        members = {k: g.to_numpy(np.int64) for k, g in y.groupby(["key", "block"])["doc"]}
        partners: dict[int, list[np.ndarray]] = {}
        for k, g in x.groupby(["key_", "block_"])["doc_"]:
            if k in members:
                for doc in g:
                    partners.setdefault(doc, []).append(members[k])
        out = []
        for doc, lists in partners.items():
            own, n, m = facts[doc]
            others = [d for d in np.unique(np.concatenate(lists)).tolist() if facts[d][0] != own]
            if others:
                known = [facts[d] for d in others]
                hit = np.array(others)[may_link(int(n), m, np.array([f[1] for f in known]), [f[2] for f in known], percent)]
                out.append(np.stack([np.minimum(hit, doc), np.maximum(hit, doc)], 1))
        return pd.DataFrame(np.concatenate(out) if out else np.zeros((0, 2), np.int64), columns=["a", "b"])

    return left.groupBy("group_").cogroup(right.groupBy("group")).applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, frequent_from: int = 4, most_frequent: int = 200_000) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``ROW, doc_id, n_shingles, class_id, component_id, kept``.

    Documents link when ``100 * |x & y| >= percent * |x | y|``. class_id is the smallest doc_id with an equal set,
    component_id the smallest that links reach, and one row of it (that id's first) is ``kept``. Null and wordless texts
    have empty sets and are alone. Rows are told apart by their place: null and repeated ids are rows as others, each
    with the links of its own text; component_id is null where no row of a component has an id. An empty table gives no
    rows; extra columns are ignored. The order of shingles may be any: at most ``most_frequent`` counts shape it,
    without changing results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = fresh_dir(spark, "jaccard")
    rows = docs if ROW in docs.columns else keyed(docs.select("doc_id", "text"))
    docs = rows.select(F.col(ROW).alias("doc"), "text")
    sets = materialise(described(docs, width, percent), "sets", work)
    narrow = sets.select("doc", "n", "s1", "s2")
    firsts = materialise(narrow.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("alike")).filter("alike > 1").drop("alike"), "firsts", work)
    classes = materialise(narrow.join(small(firsts), ["n", "s1", "s2"], "left").select("doc", "n", F.coalesce("first", "doc").alias("first")), "classes", work)
    own = pick(sets.filter("n > 0"), classes.filter("doc <> first").select("doc"), "left_anti")
    counts = own.select(F.explode("keys").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= frequent_from)
    frequent = counts.orderBy(F.desc("n"), "h").limit(most_frequent).toPandas()
    first_keys = own.select("doc", "keys")
    if len(frequent):
        late = spark.createDataFrame(frequent[["h"]])
        touched = materialise(own.select("doc", F.explode("keys").alias("h")).join(F.broadcast(late), "h", "left_semi").select("doc").distinct(), "touched", work)
        first_keys = pick(first_keys, touched, "left_anti").unionByName(reordered(pick(docs, touched), frequent, width, percent))
    keys = materialise(first_keys.select("doc", F.explode("keys").alias("key")), "keys", work)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    member = materialise(keys.join(shared, "key"), "members", work)
    central = member.join(member.groupBy("doc").agg(F.count(F.lit(1)).alias("shared")), "doc")
    pivots = central.groupBy("key").agg(F.max(F.struct("shared", (-F.col("doc")).alias("neg")))["neg"].alias("neg"))
    regions = materialise(member.join(pivots, "key").select("key", "doc", (-F.col("neg")).alias("pivot"), "members"), "regions", work)
    spokes = regions.filter("doc <> pivot").select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct()
    links = verified(materialise(bounded(spokes, own, percent), "pairs", work), docs, width, percent, work)
    labels = components(links, work)
    rest = materialise(outside(regions, own, labels, percent, work), "pairs", work)
    if not rest.isEmpty():
        more = verified(rest, docs, width, percent, work)
        labels = components(labels.select(F.col("doc").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b")), work)
    out = classes.join(small(labels.select(F.col("doc").alias("first"), "component")), "first", "left").withColumn("component", F.coalesce("component", "first"))
    out = materialise(out, "joined", work)
    if rows.filter(~F.col(ROW).eqNullSafe(F.col("doc_id"))).isEmpty():
        result = out.select(F.col("doc").alias(ROW), F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("first").alias("class_id"), F.col("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"))
    else:
        result = _with_ids(out, rows.select(F.col(ROW).alias("doc"), "doc_id"), work)
    result = materialise(result, "jaccard-result")
    remove(work)
    return result


def _with_ids(out: DataFrame, ids: DataFrame, work: str) -> DataFrame:
    """Rows numbered by place named by their ids again: a class and a component by their smallest id."""
    held = materialise(out.join(ids, "doc"), "named", work)
    first = lambda by: held.groupBy(by).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc")).alias(f"best_{by}"))
    named = held.join(small(first("first")), "first").join(small(first("component")), "component")
    return named.select(
        F.col("doc").alias(ROW), "doc_id", F.col("n").alias("n_shingles"), F.col("best_first.doc_id").alias("class_id"), F.col("best_component.doc_id").alias("component_id"), (F.col("doc") == F.col("best_component.doc")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; columns as they were.

    Rows go, not ids: of rows that repeat an id, those linked with nothing stay. Null and wordless texts all stay. An
    empty table stays empty.
    """
    rows = keyed(docs)
    return without_rows(rows, near_duplicates(rows, width, percent).filter("not kept").select(ROW))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")
