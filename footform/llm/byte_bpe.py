"""Byte-level BPE from a rank file, by prefix dynamic programming.

For every prefix of a piece of text exactly one token can end its encoding: the one whose rest is a shorter prefix that
ends in a token it stands beside. So one entry a byte holds the encodings of all prefixes. Appending reads only the new
bytes, and an edit only until the entries agree with the old ones again.
"""

from __future__ import annotations

import base64
import itertools
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, take_over

PAIRS = 1_000_000  # pairs of tokens remembered in a worker
PIECES = 400_000  # pieces remembered in a worker; longer ones than PIECE_BYTES are not
PIECE_BYTES = 64
#: Letters and numbers that came after Unicode 16; the library of reference takes them for neither.
LATER = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9
11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
3D000-3FC3F
"""
_LATER = "[" + "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in LATER.split()) + "]"
_LOADED: dict[tuple[str, str], ByteBpe] = {}


#: Texts of characters below this one are split by the standard library's ``re``, which is faster.
NARROW = 0x250
_WIDE = re.compile(f"[^\\x00-{chr(NARROW - 1)}]")


def _ranges(chars: Iterable[int]) -> str:
    """A character class's inside for some code points."""
    out: list[list[int]] = []
    for c in chars:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """``pattern`` for texts of narrow characters, its classes spelled out; None if it has a class that isn't known here."""
    of = lambda kind: _ranges(c for c in range(NARROW) if unicodedata.category(chr(c)).startswith(kind))
    space = r"\t-\r \x85\xa0"
    known = {r"\p{L}": of("L"), r"\p{N}": of("N"), r"\s": space}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        inside = inside or part == "["
        if part in known:
            out.append(known[part] if inside else f"[{known[part]}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{space}]")
        elif part[0] == "\\" and part[1:2].isalpha():
            return None
        else:
            out.append(part)
        inside = inside and part != "]"
    return re.compile("".join(out))


class ByteBpe:
    """Ids of texts by the ranks in ``path`` (lines of base64 and rank), each match of ``pattern`` on its own."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        #: Finds all tokens that end at each byte; bytes are read as the characters of the same numbers.
        self.ends = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()
        joined = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.bytes, self.lengths = np.frombuffer(b"".join(joined), np.uint8), np.array([len(t) for t in joined], np.int64)
        self.length = self.lengths.tolist()
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.usual, self.later, self.narrow = regex.compile(pattern), regex.compile(_LATER), narrow_pattern(pattern)
        for kind in ("L", "N"):
            pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--{_LATER}]")
        self.split = regex.compile(pattern, regex.V1)  # right for any text; slower than the others
        self.beside: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.pieces: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        """One for a Python worker's life, so that later tasks find the pieces of earlier ones."""
        take_over(_LOADED.clear)
        if (path, pattern) not in _LOADED:
            _LOADED[path, pattern] = cls(path, pattern)
        return _LOADED[path, pattern]

    def merged(self, piece: bytes) -> list[int]:
        """The definition: of all neighbours the pair of the lowest rank merges first, the left one of equal ranks."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(itertools.pairwise(parts)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte and for a token that merges don't lead to."""
        if token not in self.made_of:
            of = self.bytes_of[token]
            rank = self.ranks.pop(of)  # merges go as far as they do without it
            parts = self.merged(of) if len(of) > 1 else []
            self.ranks[of] = rank
            self.made_of[token] = tuple(parts) if len(parts) == 2 and max(parts) < token else None
        return self.made_of[token]

    def stands(self, left: int, right: int) -> bool:
        """Whether the tokens are the encoding of their bytes: no merge crosses between them. -1 stands for no token.

        A merge of the left token's end with the right one's beginning happens if its rank comes before the ranks of the
        merges that took those two into their tokens. The later one of the two is taken apart next.
        """
        if left < 0:
            known = len(self.bytes_of[right]) == 1 or self.parts(right) is not None
        else:
            a, b, known = left, right, self.stands(-1, left) and self.stands(-1, right)
            until_a = until_b = 1 << 60
            while known:
                rank = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60)
                if rank < until_a and rank <= until_b and rank < 1 << 60:  # of equal ranks the left merge is first
                    known = False
                    break
                in_a, in_b = self.parts(a), self.parts(b)
                if in_a and (not in_b or a > b):
                    a, until_a = in_a[1], a
                elif in_b:
                    b, until_b = in_b[0], b
                else:
                    break
        if len(self.beside) >= PAIRS:
            self.beside.clear()
        self.beside[left << 32 | right] = known
        return known

    def grown(self, piece: bytes, last: list[int]) -> Iterator[int]:
        """Adds the entries that ``last`` lacks, one at a time: entry i is the token that ends the encoding of ``piece[:i]``.

        Of the tokens that end there it is the one that stands beside the last token of what is before it.
        """
        due = len(last)
        first = max(0, due - self.longest)  # a token that ends later begins here or later
        get = self.beside.get
        for end, (rank, length) in self.ends.iter(piece[first:].decode("latin-1")):
            if first + end + 1 == due:
                left = last[due - length]
                known = get(left << 32 | rank)
                if known or known is None and self.stands(left, rank):
                    last.append(rank)
                    yield due
                    due += 1

    def prefixes(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """The entries of all prefixes, carried on from those in ``last``; entry 0 is no token."""
        last = [-1] if last is None else last
        for _ in self.grown(piece, last):
            pass
        if len(last) <= len(piece):
            raise ValueError("the ranks lack a byte")
        return last

    def edited(self, old: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """``old`` with ``new`` in place of ``old[start:end]``, and its entries.

        Entries before the edit stay. Behind it, once as many entries in a row as the longest token has bytes agree with
        the old ones, all that follow do: each hangs on no more than those and on bytes that were not edited.
        """
        piece, shift, out, agree = old[:start] + new + old[end:], len(new) - (end - start), last[: start + 1], 0
        for at in self.grown(piece, out):
            behind = at - self.longest >= start + len(new)
            agree = agree + 1 if behind and out[at] == last[at - shift] else 0
            if agree >= self.longest:
                return piece, out + last[at - shift + 1 :]
        return piece, out

    def ids_of(self, last: list[int]) -> list[int]:
        """The encoding of the longest prefix, read back from its last token."""
        at, out, length = len(last) - 1, [], self.length
        while at:
            out.append(last[at])
            at -= length[last[at]]
        out.reverse()
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is a token is that token, even where no merges lead to it."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.ids_of(self.prefixes(piece))

    def _ids(self, piece: str) -> bytes:
        known = array("i", self.encode_piece(piece.encode())).tobytes()
        if len(piece) <= PIECE_BYTES:
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def matches(self, text: str) -> list[str]:
        if self.narrow and (text.isascii() or not _WIDE.search(text)):
            return self.narrow.findall(text)
        return (self.split if self.later.search(text) else self.usual).findall(text)

    def encode(self, text: str | None) -> array:
        get, ids = self.pieces.get, self._ids
        return array("i", b"".join([get(p) or ids(p) for p in self.matches(text or "")]))

    def decode(self, ids: array) -> bytes:
        """The bytes of all ids, one after the other."""
        at = np.asarray(ids, np.int64)
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + lengths, lengths)
        return self.bytes[places].tobytes()


class Encoded:
    """A text with its ids that can be appended to and edited; only pieces near the change are split and encoded again."""

    #: A match can hang on so many characters from its start (a contraction), or on two after its end (white space).
    START, END = 3, 2

    def __init__(self, bpe: ByteBpe, text: str = ""):
        self.bpe, self.text = bpe, text
        found = list(bpe.split.finditer(text))
        self.starts, self.tables = [m.start() for m in found], [self._table(m.group().encode()) for m in found]

    def _table(self, piece: bytes) -> tuple[bytes, list[int]]:
        return piece, self.bpe.prefixes(piece)

    @property
    def ids(self) -> list[int]:
        out = []
        for piece, last in self.tables:
            whole = self.bpe.ranks.get(piece)
            out += [whole] if whole is not None else self.bpe.ids_of(last)
        return out

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` to ``end``."""
        keep = 0  # matches that saw nothing of what changes
        for at, (piece, _) in zip(self.starts, self.tables, strict=True):
            if at + self.START > start or at + len(piece.decode()) + self.END > start:
                break
            keep += 1
        old_starts, old_tables = self.starts[keep:], self.tables[keep:]
        behind, shift = dict(zip(old_starts, range(len(old_starts)), strict=True)), len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        begin = old_starts[0] if old_starts else 0
        starts, tables, first = [], [], True
        for m in self.bpe.split.finditer(self.text, begin):
            k = behind.get(m.start() - shift)
            if k is not None and m.start() >= start + len(new):  # from here on the split is the old one
                starts += [s + shift for s in old_starts[k:]]
                tables += old_tables[k:]
                break
            piece = m.group().encode()
            starts.append(m.start())
            if first and old_tables and (table := self._carried(old_tables[0], piece)):
                tables.append(table)
            else:
                tables.append(self._table(piece))
            first = False
        self.starts, self.tables = self.starts[:keep] + starts, self.tables[:keep] + tables

    def _carried(self, old: tuple[bytes, list[int]], piece: bytes) -> tuple[bytes, list[int]] | None:
        """The entries of ``piece`` from those of a piece that it shares a beginning, and maybe an end, with."""
        was, last = old
        most = min(len(was), len(piece))
        head = next((i for i in range(most) if was[i] != piece[i]), most)
        if not head:
            return None
        tail = next((i for i in range(most - head) if was[-1 - i] != piece[-1 - i]), most - head)
        return self.bpe.edited(was, last, head, len(was) - tail, piece[head : len(piece) - tail])


def encoded(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids`` of its whole texts' tokens, in place of one of that name.

    ``decoded`` names a further column: the bytes that the ids alone give back. A null or empty text has no ids. Each row
    is encoded on its own, so repeated rows and null ids are as others, all other columns stay, and an empty table stays
    empty. Ids are the same for any length of text.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (ids, decoded)]
    source = docs.select(*kept, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.load(path, pattern)
        for batch in batches:
            texts, columns = batch.column(batch.num_columns - 1), batch.columns[:-1]
            for k in range(0, batch.num_rows, 16):  # few whole texts' ids at a time
                coded = [bpe.encode(t.as_py()) for t in texts.slice(k, 16)]
                offsets = array("i", itertools.accumulate(map(len, coded), initial=0))
                values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(coded))])
                lists = pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(offsets), [None, pa.py_buffer(offsets)]), values)
                extra = [lists] + ([pa.array([bpe.decode(x) for x in coded], pa.binary())] if decoded else [])
                yield pa.RecordBatch.from_arrays([*(c.slice(k, 16) for c in columns), *extra], names=[*kept, ids, *([decoded] if decoded else [])])

    return source.mapInArrow(run, ", ".join(filter(None, [schema, f"`{ids}` array<int>", f"`{decoded}` binary" if decoded else ""])))


def op13(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
