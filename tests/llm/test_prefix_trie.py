"""The trie of conversations against a plain version that holds all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footform.llm import prefix_trie
from footform.llm.queries import ORACLE_SQL, QUERIES
from tests.helpers import rows, sql_rows

SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int, n int, p string, mark int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(turns):
    """Sorted rows of op12 for (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    said = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, children = defaultdict(list), defaultdict(set)
    ends = defaultdict(list)
    for c, mine in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(said.get(c - c % 20, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * words
    out = [
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node], sha(",".join(map(str, sorted(ends.get(node, []))))))
        for node, m in members.items()
    ]
    return sorted(out, key=repr)


def of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def frame(spark, turns):
    return spark.createDataFrame([(*t, "x", 1, 2, "y", 3) for t in turns], SCHEMA).repartition(3)


def test_odd_rows(spark):
    rng = random.Random(4)
    texts = [None, "", "a b", "a  b\x0bc", "été", "long " * 20_000]
    turns = [(None, 0, "user", "lost"), (5, None, None, None), (5, None, "user", "x"), (5, 3, "user", "twice"), (5, 3, "user", "twice"), (5, -1, "", "first"), (7, 0, "us", "er"), (8, 0, "use", "r")]
    for c in range(20, 400):
        turns += [(c, k, rng.choice(["user", None]), rng.choice(texts[:5])) for k in range(rng.randrange(1, 6))]
    turns += [(40, 9, "user", texts[5]), (60, 1, "user", None)]
    assert of(prefix_trie.prefix_trie(frame(spark, turns))) == plain(turns)


def test_copies_and_prefixes(spark):
    """One conversation many times, its beginnings, and groups whose own conversation is absent."""
    whole = [("user", f"turn {k} of it") for k in range(6)]
    turns = [(c, k, *whole[k]) for c in range(1, 600) if c % 20 for k in range(6 if c % 3 else 1 + c % 5)]
    want = plain(turns)
    assert of(prefix_trie.prefix_trie(frame(spark, turns))) == want
    assert max(r[3] for r in want if r[1] == 3) > 100


def test_turnless_conversations(spark):
    turns = [(c, 0, "user", "only") for c in range(21, 40)]  # nobody has turns of conversation 20
    want = plain(turns)
    assert of(prefix_trie.prefix_trie(frame(spark, turns))) == want and any(r[1] == 0 and r[7] != sha("") for r in want)


def test_long_conversations_are_dealt_in_blocks(spark):
    rng = random.Random(6)
    long = [("user", f"w{rng.randrange(9)} x") for _ in range(70)]
    turns = [(c, k, *t) for c, n in ((100, 70), (120, 70), (140, 15), (160, 16), (180, 17), (200, 31), (240, 48)) for k, t in enumerate(long[:n])]
    turns += [(220, k, *t) for k, t in enumerate([*long[:40], ("user", "other"), *long[41:60]])]
    for block in (4, 16):
        assert of(prefix_trie.prefix_trie(frame(spark, turns), block)) == plain(turns)


def test_end_lists_in_numeric_order(spark):
    ids = [9, 10, 100, -5, 65_535, 65_536, 2**40, 2**40 + 1, 131_073]
    ends = spark.createDataFrame([(i, 1, 2, 3) for i in ids] + [(7, 1, 2, 4)], "conv long, depth long, p long, q long")
    got = {r.q: r.ends_sha256 for r in prefix_trie.end_lists(ends).collect()}
    assert got == {3: sha(",".join(map(str, sorted(ids)))), 4: sha("7")}


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [(1, 0, "a", "b")]).limit(0)).count() == 0


def test_a_clash_of_fingerprints_is_an_error(spark):
    clash = spark.createDataFrame([(1, "a"), (1, "b")], "k int, mark string").groupBy("k").agg(prefix_trie.same("mark").alias("mark"))
    with pytest.raises(Exception, match="one fingerprint"):
        clash.collect()


def test_all_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.01")
    assert of(got) == plain([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert got.filter(F.col("depth") == 0).count() == 1


def test_query_equals_sql(spark, sf_dir):
    assert rows(QUERIES["op12_prefix_trie"](spark, sf_dir)) == sql_rows(ORACLE_SQL["op12_prefix_trie"], sf_dir)
