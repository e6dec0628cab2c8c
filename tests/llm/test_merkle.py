"""The Merkle manifest against a plain version that holds whole trees."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from footform.llm import merkle
from footform.llm.queries import ORACLE_SQL, QUERIES
from tests.helpers import rows, sql_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, digest string, proof int, root int, members int, leaf int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(level):
    """Root of ``level`` and the siblings of each leaf, as (left, right) a level."""
    proofs, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place // 8 * 8
            proofs[i].append(("".join(level[first:place]), "".join(level[place + 1 : first + 8])))
        level = [h(*level[k : k + 8]) for k in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], proofs


def leaf(row, lowered=False):
    text = row["text"]
    if lowered and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(docs):
    """Sorted rows of op11 without Spark."""
    trees = {}
    for r in docs:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    below, roots = {}, []
    for lang in order:
        trees[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, proofs = plain_tree([leaf(r) for r in trees[lang]])
        below[lang] = (root, proofs)
        roots.append(root)
    root, upper = plain_tree(roots)
    out = []
    for lang, above in zip(order, upper, strict=True):
        subroot, proofs = below[lang]
        for r, own in zip(trees[lang], proofs, strict=True):
            proof = own + above
            d = leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for left, right in proof:
                d = h(left, d, right)
            out.append((r["doc_id"], leaf(r), subroot, root, h(*(a + b for a, b in proof)), d, d == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def of_query(docs, spark, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).select(COLUMNS).collect()), key=repr)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", "ÄÖ A\x00z", "Aa" * 30_000, "same", "lower only"]
    out = [(None, "A", None, None, None), (None, None, "en", "s", 3), (7, "Repeat", "en", "s", 1), (7, "Repeat", "en", "s", 1), (7, "Other", "en", "s", 1), (-3, "Minus", "", "", 0)]
    out += [(i, rng.choice(texts), rng.choice(["en", "de", "é", "zz", None]), rng.choice(["web", None]), rng.choice([1, None])) for i in range(300)]
    docs = spark.createDataFrame([(*r, "x", 1, "x", 1, 1, 1, 1) for r in out], DOCS)
    want = plain([r.asDict() for r in docs.collect()])
    assert of_query(docs, spark, tmp_path) == want
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_small_trees(spark, tmp_path, n):
    docs = spark.createDataFrame([(i, f"Text {i}", "en", "s", 1, "x", 1, "x", 1, 1, 1, 1) for i in range(n)], DOCS)
    assert of_query(docs, spark, tmp_path) == plain([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_of_few_levels(spark, levels):
    """Blocks of one and two levels give several rounds of messages, for the languages' trees and the one above them."""
    trees = [[h(f"{t} {i}") for i in range(n)] for t, n in [("", 500), *((str(k), 1 + k % 3) for k in range(90))]]
    rows_ = [(i, f"{t:03}", d) for t, leaves in enumerate(trees) for i, d in enumerate(leaves)]
    got = merkle.manifest(spark.createDataFrame(rows_, "doc_id long, lang string, leaf string"), "lang", "doc_id", levels=levels)
    below = [plain_tree(list(x)) for x in trees]
    root, upper = plain_tree([r for r, _ in below])
    want = {(i, f"{t:03}"): (d, below[t][0], root, below[t][1][i] + upper[t]) for t, leaves in enumerate(trees) for i, d in enumerate(leaves)}
    assert {(r.doc_id, r.lang): (r.leaf, r.subroot, r.root, [tuple(x) for x in r.proof]) for r in got.collect()} == want


def test_sweeps():
    leaves = [h(str(i)) for i in range(75)]
    nodes = merkle.sweep_up(leaves, merkle.levels_of(75))
    root, proofs = plain_tree(leaves)
    assert nodes[-1] == [root] and [len(x) for x in nodes] == [75, 10, 2, 1]
    assert merkle.sweep_down(nodes, [("a", "b")]) == [[*p, ("a", "b")] for p in proofs]


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], "doc_id long, lang string, leaf string"), "lang", "doc_id").count() == 0


def test_a_changed_proof_is_found(spark):
    rows_ = spark.createDataFrame([(i, "x", h(str(i))) for i in range(20)], "doc_id long, lang string, leaf string")
    proved = merkle.manifest(rows_, "lang", "doc_id")
    good = merkle.folded_root(F.col("leaf"), F.col("proof")) == F.col("root")
    assert proved.filter(good).count() == 20
    assert proved.withColumn("leaf", F.sha2("leaf", 256)).filter(good).count() == 0


def test_query_equals_sql(spark, sf_dir):
    assert rows(QUERIES["op11_merkle_manifest"](spark, sf_dir)) == sql_rows(ORACLE_SQL["op11_merkle_manifest"], sf_dir)
