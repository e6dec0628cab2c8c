"""Byte-level BPE by prefix tables against the tiktoken library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from footform.llm import byte_bpe
from footform.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "a", "'", "'re", "it's we'll  've", "\n\n  x", " \t 　x  ", "été ÅΣß straße", "日本語のテキスト", "👩‍👩‍👧 🇩🇪", "á̧", "\x00\x1c\x85", "1234567 ½ ٣", "<|endoftext|>", "ᲊ՘꟎\U000323b0\U0001ccf0"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN)


def mixed(rng, n):
    pool = ["the", "Zürich", " ", "  ", "\n", "'s", "'", "re", "12", "!?", "ß", "漢", "՘", "qzx", "aaaa", "ing", "-", "👍", "\t"]
    return "".join(rng.choice(pool) for _ in range(n))


def test_ids_are_the_librarys(bpe, library):
    rng = random.Random(1)
    texts = ODD + [mixed(rng, rng.randrange(60)) for _ in range(400)] + ["a" * 5000, " " * 3000, "ab" * 2000, "é" * 999, "".join(chr(rng.randrange(97, 123)) for _ in range(4000)), "=" * 1500 + "\n" * 700]
    for text in texts:
        ids = bpe.encode(text)
        assert list(ids) == library.encode_ordinary(text), text[:60]
        assert bpe.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(bpe_text):
    bpe = byte_bpe.ByteBpe.load(PATH, public_tokenizers.PATTERN)
    assert bpe.decode(bpe.encode(bpe_text)) == bpe_text.encode()
    for piece in bpe.split.findall(bpe_text):
        assert bpe.encode_piece(piece.encode()) == bpe.merged(piece.encode())


def test_neighbours_stand_where_merging_leaves_them(bpe):
    rng = random.Random(9)
    ranks = list(bpe.ranks.values())
    short = [r for r in ranks if len(bpe.bytes_of[r]) <= 3]
    pairs = [(rng.choice(pool), rng.choice(pool)) for pool in (ranks, short) for _ in range(6000)] + [(a, b) for a in range(60) for b in range(256, 330)]
    split = [bpe.merged(bpe.bytes_of[rng.choice(ranks)] + bpe.bytes_of[rng.choice(ranks)]) for _ in range(3000)]
    pairs += [x for ids in split for x in zip(ids, ids[1:])]
    got = [bpe.stands(*x) for x in pairs]
    assert got == [bpe.merged(bpe.bytes_of[a] + bpe.bytes_of[b]) == [a, b] for a, b in pairs] and 500 < sum(got) < len(got) - 500


def test_narrow_texts_are_split_alike(bpe):
    rng = random.Random(8)
    chars = [chr(c) for c in range(byte_bpe.NARROW)]
    texts = [a + c + b for c in chars for a in ("a", "1", "!", " ", "'") for b in ("", "z", " ")] + ["".join(rng.choice(chars) for _ in range(30)) for _ in range(2000)]
    assert all(bpe.narrow.findall(t) == bpe.split.findall(t) == bpe.matches(t) for t in texts)
    assert byte_bpe.narrow_pattern(r"\p{Lu}+|\s") is None


def test_entries_are_the_last_tokens_of_prefixes(bpe):
    piece = " internationalisations".encode() + "ß漢".encode()
    last = bpe.prefixes(piece)
    for end in range(1, len(piece) + 1):
        assert last[end] == bpe.merged(piece[:end])[-1] and bpe.ids_of(last[: end + 1]) == bpe.merged(piece[:end])


def test_appended_and_edited_pieces(bpe):
    rng = random.Random(2)
    letters = "etaoin shrdlu".replace(" ", "").encode()
    piece = bytes(rng.choice(letters) for _ in range(1500))
    assert bpe.prefixes(piece, bpe.prefixes(piece[:700])) == bpe.prefixes(piece)
    for _ in range(30):
        last = bpe.prefixes(piece)
        start = rng.randrange(len(piece))
        end = min(len(piece), start + rng.randrange(4))
        piece, last = bpe.edited(piece, last, start, end, bytes(rng.choice(letters) for _ in range(rng.randrange(5))))
        assert last == bpe.prefixes(piece)


def test_an_edit_reads_only_what_is_near(bpe, monkeypatch):
    piece = ("the" * 4000).encode()
    last, calls, own = bpe.prefixes(piece), [], bpe.grown
    monkeypatch.setattr(bpe, "grown", lambda *a: (calls.append(at) or at for at in own(*a)))
    changed, table = bpe.edited(piece, last, 6000, 6001, b"x")
    assert len(calls) <= 3 * bpe.longest + 50
    monkeypatch.undo()
    assert table == bpe.prefixes(changed)


def test_appended_and_edited_texts(bpe, library):
    rng = random.Random(3)
    for _ in range(40):
        text = byte_bpe.Encoded(bpe, mixed(rng, rng.randrange(30)))
        for _ in range(12):
            if rng.random() < 0.4:
                text.append(mixed(rng, rng.randrange(3)))
            else:
                start = rng.randrange(len(text.text) + 1)
                text.edit(start, min(len(text.text), start + rng.randrange(4)), mixed(rng, rng.randrange(3)))
            assert text.ids == library.encode_ordinary(text.text)


def test_a_token_that_no_merges_reach(tmp_path):
    ranks = [*(bytes([i]) for i in range(256)), b"ab", b"abc", b"xyz"]  # xyz lacks xy and yz
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    library = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    bpe = byte_bpe.ByteBpe(str(path), r"\S+|\s+")
    for text in ("xyz", "xyzx", "abxyz", "abc xyz", "abcab"):
        assert list(bpe.encode(text)) == library.encode_ordinary(text)


def test_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PAIRS", 50)
    monkeypatch.setattr(byte_bpe, "PIECES", 20)
    bpe, rng = byte_bpe.ByteBpe(PATH, public_tokenizers.PATTERN), random.Random(4)
    for _ in range(50):
        text = mixed(rng, 40)
        assert list(bpe.encode(text)) == library.encode_ordinary(text)
        assert len(bpe.beside) <= 50 and len(bpe.pieces) <= 20


def test_odd_rows(spark, library):
    docs = spark.createDataFrame([(None, t, 7, b"z", "k") for t in [None, *ODD, "long word " * 30_000]] + [(1, "same", 7, b"z", "k")] * 3, "doc_id long, text string, ids int, decoded binary, __key string")
    got = byte_bpe.encoded(docs, PATH, public_tokenizers.PATTERN, decoded="decoded").collect()
    assert len(got) == len(ODD) + 5 and {r["__key"] for r in got} == {"k"}
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encoded(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, sf_dir, library):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = QUERIES["op13_byte_bpe"](spark, sf_dir)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == want
