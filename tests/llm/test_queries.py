"""Registered queries that no SQL can express, against the library's ids."""

import math
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footform.llm.queries import QUERIES


@pytest.fixture(scope="module")
def ids(spark, sf_dir):
    """Each document's ids by the library, the end id last."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    return {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in rows}


def crc(values):
    return zlib.crc32(array("I", values).tobytes())


def test_token_files(spark, sf_dir, ids):
    start, want = 0, {}
    for i, values in ids.items():
        want[i] = (start, len(values), crc(values))
        start += len(values)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op1_rans_tokens"](spark, sf_dir).collect()} == want


def test_packing_reaches_the_bound(spark, sf_dir, ids):
    """Every piece in place, and no more sequences than the tokens and the best-fit-decreasing packing of them ask for."""
    want = {(i, k): (k * 4096, len(values[k * 4096 : (k + 1) * 4096]), crc(values[k * 4096 : (k + 1) * 4096])) for i, values in ids.items() for k in range(-(-len(values) // 4096))}
    got = QUERIES["op5_packing"](spark, sf_dir).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 4096
    room: list[int] = []
    for n in sorted((n for _, n, _ in want.values()), reverse=True):
        fits = [k for k, left in enumerate(room) if left >= n]
        if fits:
            room[min(fits, key=room.__getitem__)] -= n
        else:
            room.append(4096 - n)
    assert math.ceil(sum(map(len, ids.values())) / 4096) <= len(bins) <= len(room)
