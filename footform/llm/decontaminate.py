"""Benchmark decontamination: one Aho-Corasick automaton over the words of the test items.

The automaton's alphabet is the item words, numbered. A document is scanned once; words that no item has reset the
automaton, so only runs of known words reach it. ASCII folding is byte for byte, so offsets in the folded text are
offsets in the original.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, keep_where, keyed, materialise, small_batches, take_over, without_rows

#: Every byte that is neither a digit, a letter nor part of a non-ASCII character splits words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^\x20]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Automaton:
    """Windows of ``width`` words of each item (all its words if fewer), as one automaton over word numbers."""

    def __init__(self, items: list[tuple[int, str | None]], width: int = 10):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            seq = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for i in range(max(1, len(seq) - width + 1) if seq else 0):
                owners.setdefault(tuple(seq[i : i + width]), set()).add(item_id)
        self.shortest = min(map(len, owners), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, ids in owners.items():
            self.automaton.add_word(window, (len(window), sorted(ids)))
        if owners:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged (first, end) word intervals that windows cover, and the ids of items that own them."""
        hits: list[list[int]] = []
        items: set[int] = set()
        if not self.shortest or len(words) < self.shortest:
            return [], items
        seq = tuple(map(self.number.get, words, [0] * len(words)))
        found = sorted((end - n + 1, end + 1, ids) for end, (n, ids) in self.automaton.iter(seq))
        for start, end, ids in found:
            items.update(ids)
            if hits and start <= hits[-1][1]:
                hits[-1][1] = max(hits[-1][1], end)
            else:
                hits.append([start, end])
        return [(a, b) for a, b in hits], items


def offsets(text: str, hits: list[tuple[int, int]]) -> list[dict]:
    """Word intervals as code-point spans of the original text."""
    raw = text.encode()
    at = [m.span() for m in WORD.finditer(raw.translate(FOLD))]
    out, seen, chars = [], 0, 0
    for a, b in hits:
        start, end = at[a][0], at[b - 1][1]
        chars += len(raw[seen:start].decode())
        n = len(raw[start:end].decode())
        out.append({"start": chars, "end": chars + n})
        chars, seen = chars + n, end
    return out


_BUILT: dict[str, Automaton] = {}


def built(token: str, items: list[tuple[int, str | None]], width: int) -> Automaton:
    """The automaton of a part of the items, made once in a Python worker's life; only the newest is held."""
    take_over(_BUILT.clear)
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Automaton(items, width)
    return _BUILT[token]


def parts_of(benchmark: DataFrame, most_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items with an id and a text, in parts of about ``most_bytes`` of text; one empty part if there are none."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).head()["n"]
    parts = -(-size // most_bytes) or 1
    for p in range(parts):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p).collect()]


HIT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("from", pa.int32()), ("to", pa.int32())])  # words, code points
FOUND = "row long, doc_id long, n_words long, hits array<struct<start:int,end:int,`from`:int,`to`:int>>, items array<long>"
NAMES = ["row", "doc_id", "n_words", "hits", "items"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.list_(HIT), pa.list_(pa.int64())]


def merged(hits: list[dict]) -> list[dict]:
    """Hits of several parts as the intervals that they cover together."""
    out: list[dict] = []
    for h in sorted(hits, key=lambda h: (h["start"], h["end"])):
        if out and h["start"] <= out[-1]["end"]:
            out[-1] = {**out[-1], "end": max(out[-1]["end"], h["end"]), "to": max(out[-1]["to"], h["to"])}
        else:
            out.append(h)
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * len(KINDS), KINDS, strict=True)], NAMES)


def scanned(docs: DataFrame, items: list[tuple[int, str]], width: int, all_rows: bool = True) -> DataFrame:
    """``FOUND`` of the rows of ``docs(row, doc_id, text)``, or of those that a window of the items hits."""
    shared, token = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = built(token, shared.value, width)
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                hits, ids = automaton.scan(words)
                if hits or all_rows:
                    spans = offsets(text, hits) if hits else []
                    rows.append((row, doc_id, len(words), [{"start": a, "end": b, "from": x["start"], "to": x["end"]} for (a, b), x in zip(hits, spans, strict=True)], sorted(ids)))
            yield _batch(rows)

    return docs.select("row", "doc_id", "text").mapInArrow(run, FOUND)


def _together(found: DataFrame) -> DataFrame:
    """What the parts found of each row as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(row, doc_id, n, merged(hits), ids) for row, doc_id, n, hits, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True)])

    one = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return one.mapInArrow(run, FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, max_item_bytes: int = 4 << 20) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit, items, spans``.

    ``spans`` are code-point spans of the original text covered by a window of an item of
    ``benchmark(item_id, text)``. Null or wordless texts have no words; null or wordless items, and items without an
    id, have no windows; repeated items count once by id. Each row is judged on its own: null and repeated doc_ids are
    rows as others. Empty tables give no rows, or rows without hits. Extra columns are ignored.

    An automaton holds at most about ``max_item_bytes`` of item text (some 75 bytes of a worker's memory for each byte).
    A larger benchmark is dealt by item into parts, each of which scans the texts where they are; only what it hits is
    written down, and put together by row, so the result is the same and no text is written again.
    """
    small_batches(docs.sparkSession)
    texts = lambda df, row: df.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = list_ahead(parts_of(benchmark, max_item_bytes))
    part, last = next(parts)
    if last:
        found = scanned(texts(docs, F.lit(0).cast("long")), part, width)
    else:
        rows = texts(keyed(docs.select("doc_id", "text")), F.col(ROW))
        every = materialise(scanned(rows, part, width), "decontaminate")
        hits = every.filter("size(hits) > 0")
        for part, _ in parts:
            hits = hits.unionByName(materialise(scanned(rows, part, width, all_rows=False), "decontaminate"))
        both = every.select("row", "doc_id", "n_words").join(_together(hits).select("row", "hits", "items"), "row", "left")
        found = both.withColumns({c: F.coalesce(c, F.array().cast(every.schema[c].dataType)) for c in ("hits", "items")})
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    spans = F.transform("hits", lambda h: F.struct(h["from"].alias("start"), h["to"].alias("end")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))


def list_ahead(parts: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Each part and whether it is the last one; at most two are held."""
    held = next(parts)
    for following in parts:
        yield held, False
        held = following
    yield held, True


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, max_item_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` without rows that share a window with an item; columns as they were.

    Null and wordless texts share nothing and stay; repeated rows share one fate; ids, null or not, play no part. An
    empty table stays empty, an empty benchmark drops nothing. Parts of a large benchmark write down the rows they hit.
    """
    sc = docs.sparkSession.sparkContext
    parts = list_ahead(parts_of(benchmark, max_item_bytes))
    part, last = next(parts)
    if last:
        shared, token = sc.broadcast(part), uuid.uuid4().hex
        return keep_where(docs, "text", lambda texts: [not built(token, shared.value, width).scan(words_of(t))[0] for t in texts])
    small_batches(docs.sparkSession)
    rows = keyed(docs)
    texts = rows.select(F.col(ROW).alias("row"), F.lit(None).cast("long").alias("doc_id"), "text")
    gone = None
    for part, _ in itertools.chain([(part, last)], parts):
        one = materialise(scanned(texts, part, width, all_rows=False).select("row"), "decontaminate")
        gone = one if gone is None else gone.union(one)
    return without_rows(rows, gone.distinct())


def op2(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS s, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), occ AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)
), hit AS (SELECT DISTINCT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON win.s = o.s AND win.n = o.n
), covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
