"""Toxicity by a convolutional text classifier over hashed word embeddings.

Each word has two hashed vectors side by side, so that two words collide in one of them at most, and a third summed
over its hashed beginnings, so that the forms of one stem share what is learned. Filters of several widths
run over the whole text and are pooled by their maximum. Trained in numpy on a bounded sample of labelled rows, with
the sample's share of positives taken out of the scores again; thresholds are calibrated by language, on counts over
all labelled rows that the network has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import likely_first, small, small_batches
from .language_id import fold

#: Folds ASCII capitals and turns other ASCII than letters and digits into blanks, byte for byte.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 15, 12, (1, 2, 3), 8
PAD = BUCKETS  # stands between documents and at their ends, and for beginnings that a word is too short for
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # characters
COLUMNS = 2 + len(BEGINNINGS)
STRETCH = 1 << 16  # words that are filtered at once


class _Slots(dict):
    """A row of ``table`` for each word: two buckets of the whole word, one of each of its beginnings."""

    def __init__(self, most: int = 500_000):
        self.most, self.table = most, np.full((1024, COLUMNS), PAD, np.int32)
        self[b""] = 0  # the pad

    def __missing__(self, word: bytes) -> int:
        slot = len(self)
        if slot == len(self.table):
            self.table = np.concatenate([self.table, np.full_like(self.table, PAD)])
        h, text = xxhash.xxh64_intdigest(word), word.decode()
        row = [h % BUCKETS, (h >> 20) % BUCKETS] + [xxhash.xxh64_intdigest(text[:n].encode(), n) % BUCKETS if len(text) > n else PAD for n in BEGINNINGS]
        self.table[slot] = row
        self[word] = slot
        return slot

    def trim(self) -> None:
        """Forgets all words once there are too many; only between batches, as slots are then dealt anew."""
        if len(self) > self.most:
            self.clear()
            self.__init__(self.most)


_SLOTS = _Slots()


def word_numbers(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words (n, COLUMNS) of the texts one after another, with pads, and where each text begins."""
    _SLOTS.trim()
    gap = [0] * max(WIDTHS)
    out, starts = [], []
    for t in texts:
        starts.append(len(out))
        out += map(_SLOTS.__getitem__, (t or "").encode().translate(FOLD).split())
        out += gap
    return _SLOTS.table[np.array(out, np.int64)], np.array(starts)


class Classifier:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.E = (0.1 * rng.standard_normal((3, BUCKETS + 1, DIM))).astype(np.float32)
        self.E[:, PAD] = 0
        self.K = [(rng.standard_normal((w, 3 * DIM, FILTERS)) / np.sqrt(3 * DIM * w)).astype(np.float32) for w in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.o = (0.3 * rng.standard_normal(FILTERS * len(WIDTHS))).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.shift, self.thresholds = 0.0, {}

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.E[0, ids[:, 0]], self.E[1, ids[:, 1]], sum(self.E[2, ids[:, k]] for k in range(2, COLUMNS))], 1)

    def maps(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter responses at each place, for each width; places at the end that a width would overrun are left out."""
        n = len(x) - max(WIDTHS) + 1
        return [sum(x[k : k + n] @ K[k] for k in range(len(K))) + b for K, b in zip(self.K, self.b, strict=True)]

    def pooled(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each text and its place, (n, filters) each; ``STRETCH`` words at a time.

        A filter's place begins at a word of the text, or at the first of its pads, so no text sees its neighbour.
        """
        n, lap = len(ids), max(WIDTHS) - 1
        won, places = np.full((len(starts), len(self.o)), -np.inf, np.float32), np.zeros((len(starts), len(self.o)), np.int64)
        ends = np.append(starts[1:], n) - lap
        for a in range(0, n - lap, STRETCH):
            maps = np.concatenate(self.maps(self.vectors(ids[a : a + STRETCH + lap])), 1)
            first = np.searchsorted(starts, a, "right") - 1  # the text that the stretch begins in
            last = np.searchsorted(starts, a + len(maps))
            for k, (s, e) in enumerate(zip(np.maximum(starts[first:last] - a, 0), np.minimum(ends[first:last] - a, len(maps)), strict=True)):
                if s >= e:
                    continue
                at = maps[s:e].argmax(0)
                top = maps[s + at, np.arange(maps.shape[1])]
                more = top > won[first + k]
                won[first + k, more], places[first + k, more] = top[more], (a + s + at)[more]
        return won, places

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """One number per text, each text as a whole."""
        if not texts:
            return np.zeros(0)
        ids, starts = word_numbers(texts)
        return np.maximum(self.pooled(ids, starts)[0], 0) @ self.o + self.c[0] - self.shift

    def train(self, texts: list[str], y: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 0.1, seed: int = 7) -> Classifier:
        """Adagrad on the log loss; only the places that won the pooling get gradients."""
        rng = np.random.default_rng(seed)
        shared = [*self.K, *self.b, self.o, self.c]
        sums, table = [np.full_like(p, 1e-4) for p in shared], np.full(self.E.shape[:2], 1e-4, np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(texts), batch):
                own = order[at : at + batch]
                ids, starts = word_numbers([texts[i] for i in own])
                won, where = self.pooled(ids, starts)
                places = [where[:, w * FILTERS : (w + 1) * FILTERS] for w in range(len(WIDTHS))]
                hidden = np.maximum(won, 0)
                drop = (rng.random(hidden.shape) > 0.2) / np.float32(0.8)
                logit = (hidden * drop) @ self.o + self.c[0]
                d = ((1 / (1 + np.exp(-logit)) - y[own]) / len(own)).astype(np.float32)
                gp = d[:, None] * self.o * drop * (won > 0)
                gK, gb, gx = [], [], {}
                rows, grads = [], []
                for w, (K, p) in enumerate(zip(self.K, places, strict=True)):
                    g = gp[:, w * FILTERS : (w + 1) * FILTERS].astype(np.float32)
                    gb.append(g.sum(0))
                    one = np.zeros_like(K)
                    for k in range(len(K)):
                        one[k] = np.einsum("bfd,bf->df", self.vectors(ids[(p + k).ravel()]).reshape(*p.shape, -1), g)
                        rows.append((p + k).ravel())
                        grads.append((g[:, :, None] * K[k].T[None]).reshape(-1, 3 * DIM))
                    gK.append(one)
                for w, g, s in zip(shared, [*gK, *gb, ((hidden * drop) * d[:, None]).sum(0), d.sum(keepdims=True)], sums, strict=True):
                    s += g * g
                    w -= rate * g / np.sqrt(s)
                places_all, gx = np.concatenate(rows), np.concatenate(grads)
                at_won = ids[places_all]
                for third, columns in enumerate(([0], [1], range(2, COLUMNS))):
                    touched, inverse = np.unique(at_won[:, columns], return_inverse=True)
                    g = np.zeros((len(touched), DIM), np.float32)
                    np.add.at(g, inverse.reshape(len(at_won), -1), gx[:, None, third * DIM : (third + 1) * DIM])
                    table[third, touched] += (g * g).mean(1)
                    self.E[third, touched] -= rate * g / np.sqrt(table[third, touched])[:, None]
                self.E[:, PAD] = 0
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2500, **settings) -> Classifier | None:
    """A classifier from ``docs(doc_id, text, lang)`` and ``labels(doc_id, toxic)``.

    The network learns from at most ``per_class`` rows of each label, those that a hash of the id puts first among
    labelled texts, each text whole; the share of positives is counted over all labelled rows. The
    thresholds come from a second network that learns without an eighth of these ids: all labelled rows it has not
    seen, of any length, are scored and counted. Null labels and labels without a document don't count. None if one
    of the two labels is missing.
    """
    named = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", "text", "lang")
    some = texts.filter(F.length("text") > 0)
    known = some.select("doc_id").join(named, "doc_id").withColumn("h", F.xxhash64("doc_id", F.lit("toxic")))
    counts = {r["toxic"]: r["count"] for r in named.join(docs.select("doc_id"), "doc_id").groupBy("toxic").count().collect()}
    # Each label's first rows; later ones are dropped before they meet.
    first = lambda label: known.filter((F.col("toxic") == label) & likely_first(F.col("h"), per_class, counts.get(label, 1))).orderBy("h", "doc_id").limit(per_class).drop("h")
    chosen = first(0).unionByName(first(1))
    rows = sorted(some.join(F.broadcast(chosen), "doc_id").select("text", "toxic", F.coalesce("lang", F.lit("")).alias("lang"), (fold(8) == 1).alias("calibrate"), "doc_id").collect())

    def fit(rows: list) -> Classifier | None:
        if {r["toxic"] for r in rows} != {0, 1}:
            return None
        y = np.array([r["toxic"] for r in rows], np.float32)
        model = Classifier().train([r["text"] for r in rows], y, **settings)
        share, sampled = counts[1] / (counts[0] + counts[1]), float(y.mean())
        model.shift = float(np.log(sampled / (1 - sampled)) - np.log(share / (1 - share)))
        return model

    model, fresh = fit(rows), [r for r in rows if not r["calibrate"]]
    blind = model if len(fresh) == len(rows) else fit(fresh)
    if blind:
        seen = docs.sparkSession.createDataFrame(sorted({(r["doc_id"],) for r in fresh}), docs.select("doc_id").schema)
        model.thresholds = thresholds(calibration(texts, named, seen, blind).collect())
    return model


#: Buckets to each unit of a logit that scores are counted in for the thresholds.
STEPS = 20


def calibration(docs: DataFrame, labels: DataFrame, seen: DataFrame, model: Classifier) -> DataFrame:
    """``lang, bucket, toxic, seen, n``: counts over all rows of ``labels`` with a document, of texts of any length.

    ``seen`` are the few ids that the network learned from. Labels are broadcast if they are few; else all documents
    are scored and their buckets joined, so that texts are never shuffled.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            logits = np.concatenate([shared.value.logits(texts[a : a + 32]) for a in range(0, len(texts), 32)]) if texts else np.zeros(0)
            buckets = np.floor(np.clip(logits, -40, 40) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(buckets, pa.int32()), batch.column(2)], ["doc_id", "bucket", "lang"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    ids = labels.select("doc_id").distinct()
    few = small(ids)
    if few is not ids:
        texts = texts.join(few, "doc_id", "left_semi")
    scored = texts.mapInArrow(run, "doc_id long, bucket int, lang string").join(labels, "doc_id")
    marked = scored.join(F.broadcast(seen.withColumn("seen", F.lit(True))), "doc_id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    return marked.groupBy("lang", "bucket", "toxic", "seen").agg(F.count(F.lit(1)).alias("n"))


def thresholds(counts: list) -> dict[str, float]:
    """The cut of each language from rows of ``lang, bucket, toxic, seen, n``.

    Unseen rows say how the scores of a label are spread, all rows how frequent the label is. A language with under
    ten unseen positives or no unseen negative takes the cut of all languages together.
    """
    langs: dict[str, list] = {}
    for lang, *row in counts:
        langs.setdefault(lang, []).append(row)
    everything = best_cut([row for rows in langs.values() for row in rows], 1)
    cuts = {lang: best_cut(rows, 10) for lang, rows in langs.items()}
    return {lang: everything if cut is None else cut for lang, cut in cuts.items() if cut is not None or everything is not None}


def best_cut(rows: list, least: int) -> float | None:
    """The score with the best F1, the highest of equal ones; None below ``least`` unseen positives."""
    bucket, toxic, seen, n = np.array(rows, np.int64).reshape(-1, 4).T
    values, at = np.unique(bucket, return_inverse=True)
    share = []
    for label in (0, 1):
        fresh = np.bincount(at, n * ((toxic == label) & (seen == 0)), len(values))
        if fresh.sum() < (least if label else 1):
            return None
        # Rows of the label at or above each bucket, scaled to all of its rows.
        share.append(fresh[::-1].cumsum()[::-1] / fresh.sum() * n[toxic == label].sum())
    f1 = 2 * share[1] / (share[0] + share[1] + share[1][0])
    best = len(values) - 1 - int(np.argmax(f1[::-1]))
    return float(_sigmoid(values[best] / STEPS))


def toxicity(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: ``doc_id, score, flagged``.

    The score is made of the text alone; ``flagged`` holds it against the threshold of the row's language (0.5 where
    none was calibrated). Null and empty texts are scored as texts without words. Without a model all scores are 0.
    An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts, langs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores = np.concatenate([_sigmoid(net.logits(texts[a : a + 32])) for a in range(0, len(texts), 32)]) if net and texts else np.zeros(len(texts))
            flagged = [bool(s >= (net.thresholds.get(x or "", 0.5) if net else 1.1)) for s, x in zip(scores, langs, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(flagged, pa.bool_())], ["doc_id", "score", "flagged"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).mapInArrow(run, "doc_id long, score double, flagged boolean")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.filter(fold(4) != 2))
    return toxicity(docs, model).select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged")
