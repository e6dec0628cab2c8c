"""Token ids as static range asymmetric numeral system (rANS) files.

One frequency table, counted over the whole corpus, serves every block. A block is coded on its own by interleaved
lanes; at regular rows the lane states and the place in the stream are kept as checkpoints, so that each segment
between two checkpoints decodes alone. Blocks and their ids carry CRC-32 checksums.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, open_fs, read_range, small_batches, write_file
from .tokens import WordTokenizer

BITS = 18  # of the table's total
LANES, ROWS, SEGMENT_ROWS = 128, 512, 128
BLOCK, SEGMENT = LANES * ROWS, LANES * SEGMENT_ROWS
FILE_TOKENS, UNIT_TOKENS = 8 << 20, 1 << 20
MAGIC = b"FFRANS01"
LOW, WORD_BITS = np.uint64(1 << 31), np.uint64(32)
_HEAD = struct.Struct("<8sIIIqqqII")  # magic, bits, lanes, rows, start, tokens, documents, blocks, bytes of the directory


def quantise(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for each id that occurs."""
    total, size = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, np.rint(counts * (size / total)).astype(np.int64)), 0)
    while (over := int(freq.sum()) - size) != 0:
        if over < 0:
            freq[np.argmax(freq)] -= over
        else:  # take from the most frequent, never below 1
            order = np.argsort(-freq)[: max(1, min(over, int((freq > 1).sum())))]
            freq[order] -= np.minimum(freq[order] - 1, max(1, over // len(order)))
    return freq


class Table:
    def __init__(self, freq: np.ndarray, bits: int = BITS):
        self.bits, self.mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)

    def encode(self, ids: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, words, states at each segment, words before each segment) of each block of ``ids``."""
        n = -(-len(ids) // BLOCK)
        padded = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], ids.dtype)]).reshape(n, ROWS, LANES)
        x = np.full((n, LANES), LOW, np.uint64)
        words, sent = np.empty((n, ROWS, LANES), np.uint32), np.zeros((n, ROWS, LANES), bool)
        states = np.empty((n, ROWS // SEGMENT_ROWS, LANES), np.uint64)
        room = np.uint64(63) - self.bits
        for row in range(ROWS - 1, -1, -1):
            s = padded[:, row]
            f = self.freq[s]
            out = x >= f << room
            words[:, row], sent[:, row] = x & np.uint64(0xFFFFFFFF), out
            x = np.where(out, x >> WORD_BITS, x)
            q = x // f
            x = (q << self.bits) + (x - q * f) + self.cum[s]
            if row % SEGMENT_ROWS == 0:
                states[:, row // SEGMENT_ROWS] = x
        blocks = []
        for k in range(n):
            # The decoder takes words at the end of a row's step, so those of a segment are those its rows sent.
            per = sent[k].reshape(-1, SEGMENT_ROWS * LANES).sum(1)
            before = np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.uint32)
            blocks.append((min(BLOCK, len(ids) - k * BLOCK), words[k][sent[k]], states[k], before))
        return blocks

    def decode(self, states: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ids of segments side by side: their states, one stream of words, each segment's place in it."""
        x, at = states.copy(), at.astype(np.int64)
        out = np.empty((len(x), SEGMENT_ROWS, LANES), np.uint16)
        words = np.concatenate([words, np.zeros(1, np.uint32)]).astype(np.uint64)
        for row in range(SEGMENT_ROWS):
            slot = x & self.mask
            s = self.symbol[slot]
            out[:, row] = s
            x = self.freq[s] * (x >> self.bits) + slot - self.cum[s]
            need = x < LOW
            rank = np.cumsum(need, 1)
            place = np.where(need, at[:, None] + rank - 1, len(words) - 1)
            x = np.where(need, (x << WORD_BITS) | words[place], x)
            at += rank[:, -1]
        return out.reshape(len(x), -1)


def pack_file(table: Table, start: int, doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A file: head, directory (documents, blocks, checkpoints; compressed, with a checksum), words of the blocks."""
    blocks = [b for at in range(0, len(ids), 16 * BLOCK) for b in table.encode(ids[at : at + 16 * BLOCK])]
    known = np.array([d is not None for d in doc_ids], bool)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    entries = np.zeros(len(blocks), [("n", "<u4"), ("offset", "<u8"), ("words", "<u4"), ("crc", "<u4"), ("ids_crc", "<u4"), ("before", "<u4", ROWS // SEGMENT_ROWS)])
    body, offset = [], 0
    for k, (n, words, _, before) in enumerate(blocks):
        raw = words.astype("<u4").tobytes()
        part = ids[k * BLOCK : k * BLOCK + n].astype("<u2").tobytes()
        entries[k] = (n, offset, len(words), zlib.crc32(raw), zlib.crc32(part), before)
        body.append(raw)
        offset += len(raw)
    states = np.array([b[2] for b in blocks], "<u8")
    directory = zlib.compress(known.tobytes() + numbers.tobytes() + np.array(sizes, "<u8").tobytes() + entries.tobytes() + states.tobytes(), 1)
    directory += struct.pack("<I", zlib.crc32(directory))
    head = _HEAD.pack(MAGIC, BITS, LANES, ROWS, start, len(ids), len(sizes), len(blocks), len(directory))
    return head + directory + b"".join(body)


class TokenFile:
    """Random access to one file: its documents, and the ids of any range of its tokens."""

    def __init__(self, uri: str, table: Table):
        self.uri, self.table = uri, table
        magic, bits, lanes, rows, self.start, self.n, docs, blocks, size = _HEAD.unpack(read_range(uri, 0, _HEAD.size))
        if (magic, bits, lanes, rows) != (MAGIC, BITS, LANES, ROWS):
            raise ValueError(f"{uri} is not such a file")
        packed = read_range(uri, _HEAD.size, size)
        if zlib.crc32(packed[:-4]) != struct.unpack("<I", packed[-4:])[0]:
            raise ValueError(f"directory of {uri} is damaged")
        raw, self.body = zlib.decompress(packed[:-4]), _HEAD.size + size
        kinds = [("?", docs), ("<i8", docs), ("<u8", docs), ([("n", "<u4"), ("offset", "<u8"), ("words", "<u4"), ("crc", "<u4"), ("ids_crc", "<u4"), ("before", "<u4", ROWS // SEGMENT_ROWS)], blocks), ("<u8", blocks * ROWS // SEGMENT_ROWS * LANES)]
        parts, at = [], 0
        for kind, count in kinds:
            parts.append(np.frombuffer(raw, kind, count, at))
            at += np.dtype(kind).itemsize * count
        self.known, self.doc_ids, self.sizes, self.blocks, states = parts
        self.states = states.reshape(blocks, ROWS // SEGMENT_ROWS, LANES)

    def ids(self, lo: int, hi: int) -> Iterator[np.ndarray]:
        """Ids lo..hi of the file, a bounded run of segments at a time; whole blocks are held against their checksums."""
        per = ROWS // SEGMENT_ROWS
        for first in range(lo // SEGMENT, -(-hi // SEGMENT), UNIT_TOKENS // SEGMENT):
            last = min(first + UNIT_TOKENS // SEGMENT, -(-hi // SEGMENT))
            b0, b1 = first // per, -(-last // per)
            own = self.blocks[b0:b1]
            raw = read_range(self.uri, self.body + int(own["offset"][0]), int(own["words"].sum()) * 4)
            words = np.frombuffer(raw, "<u4")
            base = np.concatenate([[0], np.cumsum(own["words"].astype(np.int64))])
            for k, b in enumerate(own):
                if zlib.crc32(raw[base[k] * 4 : base[k + 1] * 4]) != b["crc"]:
                    raise ValueError(f"block {b0 + k} of {self.uri} is damaged")
            seg = np.arange(first, last)
            states = self.states.reshape(-1, LANES)[first:last]
            at = base[seg // per - b0] + own["before"].reshape(-1)[seg - b0 * per]
            got = self.table.decode(states, words, at).reshape(-1)
            for k, b in enumerate(own):
                a = (b0 + k) * BLOCK - first * SEGMENT
                if a >= 0 and (b0 + k + 1) * per <= last and zlib.crc32(got[a : a + int(b["n"])].tobytes()) != b["ids_crc"]:
                    raise ValueError(f"ids of block {b0 + k} of {self.uri} are not what was written")
            yield got[max(0, lo - first * SEGMENT) : min(hi, self.n) - first * SEGMENT]


def tokenised(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Writes and rereads ``part, before, doc_id, ids`` in ascending doc_id order: a part is a range of ids, ``before``
    the ids of earlier documents in the part."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before, part = WordTokenizer.load(tokenizer).encode, 0, TaskContext.get().partitionId()
        for batch in batches:
            ids = [encode(t) for t in batch.column(1).to_pylist()]
            starts = np.cumsum([before, *(len(i) // 2 for i in ids)])
            before = int(starts[-1])
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), pa.array(starts[:-1], pa.int64()), batch.column(0), pa.array(ids, pa.binary())], schema=schema)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, "part int, before long, doc_id long, ids binary").write.parquet(f"{folder}/tokens")
    return spark.read.parquet(f"{folder}/tokens")


def frequencies(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs: one histogram a task, summed by id; at most ``vocabulary`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    for row in tokens.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["id"]] = row["n"]
    return counts


UNITS = "uri string, first int, last int, token long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int = 49408) -> DataFrame:
    """Writes the token files of ``docs(doc_id, text)`` below ``folder``; returns the list of decoding units.

    Documents come in ascending doc_id order (null first; repeated ids by text). A null or empty text is the end id
    alone. An empty table writes no files. Extra columns are ignored. Only one number for each range partition and
    one for each id of the vocabulary pass through the driver.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs, tokenizer, folder)
    sizes = {r["part"]: r["n"] for r in tokens.groupBy("part").agg((F.sum(F.octet_length("ids")) / 2).cast("long").alias("n")).collect()}
    offsets, at = {}, 0
    for part in sorted(sizes):
        offsets[part], at = at, at + sizes[part]
    freq = quantise(frequencies(tokens, vocabulary))
    raw = zlib.compress(freq.astype("<u4").tobytes())
    write_file(f"{folder}/table.bin", struct.pack("<I", zlib.crc32(raw)) + raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, units, held, docs, sizes, start, n = Table(freq), [], [], [], [], 0, 0

        def close() -> None:
            if not docs:
                return
            uri = f"{folder}/ids-{start:020d}.rans"
            write_file(uri, pack_file(table, start, docs, sizes, np.concatenate(held)))
            first = token = here = 0
            for k, size in enumerate(sizes):
                here += size
                if here - token >= UNIT_TOKENS or k + 1 == len(sizes):
                    units.append((uri, first, k + 1, token))
                    first, token = k + 1, here
            held.clear(), docs.clear(), sizes.clear()

        for batch in batches:
            for part, before, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = offsets[part] + before
                if docs and (place != start + n or n >= FILE_TOKENS):
                    close()
                if not docs:
                    start, n = place, 0
                held.append(np.frombuffer(ids, "<u2"))
                docs.append(doc_id), sizes.append(len(ids) // 2)
                n += len(ids) // 2
        close()
        cols = list(zip(*units, strict=True)) if units else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["uri", "first", "last", "token"])

    tokens.mapInArrow(run, UNITS).write.parquet(f"{folder}/units")
    return spark.read.schema(UNITS).parquet(f"{folder}/units")


def read_tokens(units: DataFrame, folder: str) -> DataFrame:
    """Decodes the files: one row per document, ``doc_id, start, n_tokens, ids_crc32, file``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(f"{folder}/table.bin")
        with fs.open_input_file(path) as f:
            raw = f.read()
        if zlib.crc32(raw[4:]) != struct.unpack("<I", raw[:4])[0]:
            raise ValueError("the frequency table is damaged")
        table, file = Table(np.frombuffer(zlib.decompress(raw[4:]), "<u4").astype(np.int64)), None
        for batch in batches:
            for u in batch.to_pylist():
                if file is None or file.uri != u["uri"]:
                    file = TokenFile(u["uri"], table)
                sizes = file.sizes[u["first"] : u["last"]].astype(np.int64)
                ends = u["token"] + np.cumsum(sizes)
                crcs, k, crc, at = [], 0, 0, u["token"]
                for ids in file.ids(u["token"], int(ends[-1])):
                    wide, lo = ids.astype("<u4"), at
                    while at < lo + len(ids):
                        stop = min(int(ends[k]), lo + len(ids))
                        crc = zlib.crc32(wide[at - lo : stop - lo], crc)
                        at = stop
                        if at == ends[k]:
                            crcs.append(crc)
                            k, crc = k + 1, 0
                known, own = file.known[u["first"] : u["last"]], file.doc_ids[u["first"] : u["last"]]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64(), mask=~known), pa.array(file.start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array([u["uri"]] * len(crcs), pa.string())], ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    spread = units.repartition(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), "uri", "first")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = fresh_dir(spark, "rans")
    units = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(units, folder).drop("file")
