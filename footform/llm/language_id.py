"""Language identification by a bidirectional gated recurrent network over UTF-8 bytes.

Trained in numpy by backpropagation through time on a bounded sample of passages; every byte of every text is labelled
from both directions, and a document's probabilities are the mean over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep_where, likely_first, small, small_batches, take_over

UNKNOWN = "und"
WINDOW = 128  # bytes that one run of the network covers; each text is cut into whole such windows


def _tanh_gate(x: np.ndarray) -> np.ndarray:
    """Logistic function by tanh, which numpy vectorises."""
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Gru:
    """One direction: gates z, r and candidate n side by side; the input weights are a table by byte."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.h = hidden
        self.W = (0.3 * rng.standard_normal((256, 3 * hidden))).astype(np.float32)
        self.U = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.b = np.zeros(3 * hidden, np.float32)

    def forward(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, lanes, hidden) for bytes (time, lanes)."""
        k, W = self.h, self.W + self.b
        out, h = np.empty((*x.shape, k), np.float32), np.zeros((x.shape[1], k), np.float32)
        for t in range(len(x)):
            a, u = W[x[t]], h @ self.U
            zr = _tanh_gate(a[:, : 2 * k] + u[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(a[:, 2 * k :] + r * u[:, 2 * k :])
            if keep is not None:
                keep.append((h, z, r, n, u[:, 2 * k :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def backward(self, x: np.ndarray, kept: list, grad: np.ndarray) -> list[np.ndarray]:
        k = self.h
        gW, gU, gb = np.zeros_like(self.W), np.zeros_like(self.U), np.zeros_like(self.b)
        carry = np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, n, un = kept[t]
            d = grad[t] + carry
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            da = np.concatenate([dz, dr, dn], 1)
            du = np.concatenate([dz, dr, dn * r], 1)
            np.add.at(gW, x[t], da)
            gU += h.T @ du
            gb += da.sum(0)
            carry = d * z + du @ self.U.T
        return [gW, gU, gb]


class Network:
    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Gru(hidden, rng), Gru(hidden, rng)
        self.V = (rng.standard_normal((2 * hidden, len(languages))) / np.sqrt(2 * hidden)).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.W, self.ahead.U, self.ahead.b, self.back.W, self.back.U, self.back.b, self.V, self.c]

    def positions(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States and label probabilities of every byte of (time, lanes)."""
        a, b = keep or (None, None)
        h = np.concatenate([self.ahead.forward(x, a), self.back.forward(x[::-1], b)[::-1]], 2)
        logits = h.reshape(-1, h.shape[2]) @ self.V + self.c
        e = np.exp(logits - logits.max(1, keepdims=True))
        return h, (e / e.sum(1, keepdims=True)).reshape(*x.shape, -1)

    def train(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.01, seed: int = 7) -> Network:
        """Adam on the cross entropy of every byte's label; x, mask (windows, time), y (windows)."""
        rng, step = np.random.default_rng(seed), 0
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                own = order[at : at + batch]
                bx, bm = x[own].T, mask[own].T.astype(np.float32)
                keep: tuple[list, list] = ([], [])
                h, p = self.positions(bx, keep)
                p[:, np.arange(len(own)), y[own]] -= 1
                d = (p * (bm / bm.sum())[:, :, None]).astype(np.float32)
                flat = d.reshape(-1, d.shape[2])
                gh = (flat @ self.V.T).reshape(h.shape)
                k = self.ahead.h
                grads = [*self.ahead.backward(bx, keep[0], gh[:, :, :k]), *self.back.backward(bx[::-1], keep[1], gh[::-1, :, k:]), h.reshape(-1, 2 * k).T @ flat, flat.sum(0)]
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
                step += 1
                for w, g, (m, v) in zip(self.parameters(), grads, moments, strict=True):
                    g = g * min(1, 1 / (norm + 1e-9))
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= (rate * 0.8**epoch * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def documents(self, texts: list[bytes], lanes: int = 1024) -> np.ndarray:
        """Mean label probabilities over all bytes of each text (zeros for an empty one)."""
        counts = [-(-len(t) // WINDOW) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        raw = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True))
        x = np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)
        left = np.repeat([len(t) for t in texts], counts) - WINDOW * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
        total = np.zeros((len(texts), len(self.languages)))
        for at in range(0, len(x), lanes):
            own = slice(at, at + lanes)
            _, p = self.positions(np.ascontiguousarray(x[own].T))
            inside = np.arange(WINDOW)[:, None] < left[own]
            np.add.at(total, owner[own], (p * inside[:, :, None]).sum(0))
        return total / np.maximum(1, [len(t) for t in texts])[:, None]


def passages(docs: DataFrame, per_language: int, chars: int) -> DataFrame:
    """``lang, text``: one passage of at most ``chars`` characters from each of the ``per_language`` documents of each
    language that a hash of the id puts first."""
    named = docs.filter("lang is not null and text is not null and length(text) > 0")
    counts = small(named.groupBy("lang").agg(F.count(F.lit(1)).alias("of")))
    early = named.select("doc_id", "lang", F.xxhash64("doc_id", F.lit("passage")).alias("h")).join(counts, "lang").filter(likely_first(F.col("h"), per_language, F.col("of")))
    chosen = early.withColumn("n", F.expr("row_number() over (partition by lang order by h, doc_id)")).filter(F.col("n") <= per_language).select("doc_id").distinct()
    start = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - chars)).cast("int") + 1
    return named.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", F.substr("text", start, F.lit(chars)).alias("text")).filter(F.length("text") > 0)


def train(docs: DataFrame, per_language: int = 500, chars: int = 250, **settings) -> Network | None:
    """A network from ``docs(doc_id, text, lang)``; the sample is at most ``per_language`` passages for each language.

    None if there is no text with a language.
    """
    rows = sorted((r["lang"], r["text"]) for r in passages(docs, per_language, chars).collect())
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    windows = [(t[a : a + WINDOW], languages.index(lang)) for lang, text in rows for t in [text.encode()] for a in range(0, len(t), WINDOW) if len(t) - a >= WINDOW // 4 or a == 0]
    x = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w, _ in windows), np.uint8).reshape(-1, WINDOW)
    mask = np.arange(WINDOW)[None, :] < np.array([len(w) for w, _ in windows])[:, None]
    return Network(languages).train(x, mask, np.array([y for _, y in windows]), **settings)


def predicted(network: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and probability of each text; ``und`` and 0 for a null text, one without a letter, or without a network."""
    take_over()
    texts = [t if network and t and any(map(str.isalpha, t)) else "" for t in texts]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if any(texts):
        p = network.documents([t.encode() for t in texts])
        for k, t in enumerate(texts):
            if t:
                names[k], scores[k] = network.languages[int(p[k].argmax())], min(1.0, float(p[k].max()))
    return names, scores


def languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, lang_pred, score``.

    Only the text decides. ``und`` with score 0 where the text is null or has no letter, or where nothing was learned.
    Repeated ids are predicted row by row; an empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predicted(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_known_language(docs: DataFrame, least: float = 0.3, **settings) -> DataFrame:
    """``docs`` without rows that have no language: no letter, or no language as likely as ``least``; columns as they were.

    The network learns from the rows that name a language. If none does, nothing can be rejected and all rows stay. Each
    row is judged by its own text: null and empty texts go, repeated rows share one fate, null ids are rows as others.
    An empty table stays empty.
    """
    network = train(docs, **settings)
    if network is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def judge(texts: list[str | None]) -> list[bool]:
        names, scores = predicted(shared.value, texts)
        return [name != UNKNOWN and score >= least for name, score in zip(names, scores, strict=True)]

    return keep_where(docs, "text", judge)


def fold(of: int, id_col: str = "doc_id"):
    """crc32 of the id's text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % of


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = train(docs.filter(fold(5) != 0))
    return languages(docs, network).select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")
