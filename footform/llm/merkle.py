"""A Merkle manifest of a dataset: leaf digests fold into one root, and each row gets the proof that it belongs to it.

Time-forward processing: a node is labelled (level, place), children before parents. A digest is a message to the
parent's label, and the smallest label with messages is served next, from a priority queue. In tasks the queue holds one
block of 8^4 nodes; what is due beyond a block waits in a table on the shared folder, ordered by label, for the round
that serves those labels, so that no queue grows with the input. A second sweep serves the labels in reverse: each node
hands its children its proof, with their siblings before it, until the leaves have theirs.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, materialise, numbered, take_over

RUN = 8  # children of a node
LEVELS = 4  # levels that one round serves

PROOF = "proof array<struct<left: string, right: string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(c: Column) -> Column:
    """A value as leaves hash it: ``-`` if null, else its length in UTF-8 bytes, a colon and its text."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def sweep_up(leaves: list[str], levels: int) -> list[list[str]]:
    """Digests of all nodes by level and place, labels served in ascending order."""
    nodes: list[list[str]] = [leaves, *([] for _ in range(levels))]
    queue = [(1, i // RUN, i % RUN, d) for i, d in enumerate(leaves)] if levels else []
    heapify(queue)
    while queue:
        level, place = queue[0][:2]
        parts = []
        while queue and queue[0][:2] == (level, place):
            parts.append(heappop(queue)[3])
        nodes[level].append(digest(parts))
        if level < levels:
            heappush(queue, (level + 1, place // RUN, place % RUN, nodes[level][-1]))
    return nodes


def sweep_down(nodes: list[list[str]], proof: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Each leaf's proof, leaf's siblings first, from its top's ``proof``; labels served in descending order."""
    out: list[list[tuple[str, str]]] = [[] for _ in nodes[0]]
    queue = [(1 - len(nodes), 0, proof)]
    while queue:
        level, place, proof = heappop(queue)
        if not level:
            out[-place] = proof
            continue
        first = -place * RUN
        run = nodes[-level - 1][first : first + RUN]
        for slot in range(len(run)):
            heappush(queue, (level + 1, -first - slot, [("".join(run[:slot]), "".join(run[slot + 1 :])), *proof]))
    return out


def _block_levels(table: pa.Table, levels: int) -> int:
    """A whole tree ends where one node remains; a block of a larger one goes as far as all its blocks."""
    return min(levels, levels_of(table["members"][0].as_py()))


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("place")


def _fold(table: pa.Table, levels: int) -> pa.Table:
    take_over()
    table = _in_order(table)
    top = sweep_up(table["digest"].to_pylist(), _block_levels(table, levels))[-1]
    place, members = table["place"][0].as_py() // RUN**levels, -(-table["members"][0].as_py() // RUN**levels)
    return pa.table({"tree": table["tree"][:1], "place": pa.array([place], pa.int64()), "members": pa.array([members], pa.int64()), "digest": pa.array(top, pa.string())})


def _unfold(nodes: pa.Table, top: pa.Table, levels: int) -> pa.Table:
    take_over()
    nodes = _in_order(nodes)
    given = [(x["left"], x["right"]) for x in top["proof"][0].as_py()]
    proofs = sweep_down(sweep_up(nodes["digest"].to_pylist(), _block_levels(nodes, levels)), given)
    offsets = [0]
    for p in proofs:
        offsets.append(offsets[-1] + len(p))
    flat = [pa.array((x[k] for p in proofs for x in p), pa.string()) for k in (0, 1)]
    proof = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(flat, ["left", "right"]))
    out = nodes.append_column("proof", proof)
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([top[name][0].as_py()] * len(nodes), pa.string()))
    return out


def _block(levels: int) -> Column:
    return F.shiftright("place", 3 * levels).alias("block")  # runs of 8


def folded(nodes: DataFrame, levels: int, within: str) -> list[DataFrame]:
    """``tree, place, members, digest`` of each round's lowest labels, from ``nodes`` up to one node a tree."""
    rounds = [nodes.select("tree", "place", "members", "digest")]
    most = nodes.agg(F.max("members")).first()[0] or 0
    while most > 1:
        up = rounds[-1].groupBy("tree", _block(levels)).applyInArrow(lambda x: _fold(x, levels), "tree string, place long, members long, digest string")
        rounds.append(materialise(up, f"round-{len(rounds)}", within))
        most = -(-most // RUN**levels)
    return rounds


def unfolded(nodes: DataFrame, tops: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with ``proof, subroot, root``, handed down from those of their blocks' ``tops``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    below = nodes.groupBy("tree", _block(levels))
    above = tops.select("tree", F.col("place").alias("block"), "proof", "subroot", "root").groupBy("tree", "block")
    return below.cogroup(above).applyInArrow(lambda a, b: _unfold(a, b, levels), f"{schema}, {PROOF}, subroot string, root string")


def handed_down(leaves: DataFrame, rounds: list[DataFrame], tops: DataFrame, levels: int, within: str) -> DataFrame:
    """``leaves``, which the first of ``rounds`` was read from, with the proofs that go out from ``tops``."""
    for k in range(len(rounds) - 2, 0, -1):
        tops = materialise(unfolded(rounds[k], tops, levels), f"proofs-{k}", within)
    if len(rounds) > 1:
        return unfolded(leaves, tops, levels)
    return leaves.join(tops.select("tree", "proof", "subroot", "root"), "tree")  # a row a tree on either side


def manifest(rows: DataFrame, tree_col: str, order_col: str, leaf_col: str = "leaf", levels: int = LEVELS) -> DataFrame:
    """``rows`` with ``proof, subroot, root``: a tree of runs of eight for each value of ``tree_col``, over its leaves in
    the order of ``order_col``, and one over the trees' roots in bytewise order of that value.

    ``leaf_col`` is a digest as hexadecimal text. ``proof`` lists, from the leaf to the root, the digests beside it in
    its run, joined: ``left`` of it and ``right`` of it (empty if there are none). A null in ``tree_col`` is a tree of its own
    and the first; a null in ``order_col`` comes first. Rows of equal order are ordered by their digest; those that agree
    in both swap places without a change of any digest. Each row is a leaf, repeated ones too. A single leaf is its
    tree's root, a single tree's root the root, with an empty proof. An empty table gives no rows. Other columns stay. ``levels`` are served in a round, in blocks of
    8^levels nodes.
    """
    within = fresh_dir(rows.sparkSession, "merkle")
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    kept = {c: f"__own_{i}" for i, c in enumerate(rows.columns)}
    own = rows.select(*(F.col(c).alias(k) for c, k in kept.items()), tree.alias("tree"), F.col(leaf_col).alias("digest"))
    own = materialise(own, "leaves", within)  # digests of whole texts are not computed again for the ranges
    leaves = materialise(numbered(own, "tree", [F.col(kept[order_col]).asc_nulls_first(), F.col("digest")], "ordered", within), "placed", within)
    rounds = folded(leaves, levels, within)
    roots = numbered(rounds[-1].select(F.lit("").alias("all"), F.col("tree").alias("of"), "digest"), "all", [F.col("of")], "roots", within)
    roots = materialise(roots.withColumnRenamed("all", "tree"), "roots-placed", within)
    upper = folded(roots, levels, within)
    root = upper[-1].select("tree", "place", F.array().cast(PROOF.removeprefix("proof ")).alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = handed_down(roots, upper, root, levels, within).select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "proof", F.col("digest").alias("subroot"), "root")
    out = handed_down(leaves, rounds, materialise(tops, "tops", within), levels, within)
    return out.select(*(F.col(k).alias(c) for c, k in kept.items()), "proof", "subroot", "root")


def folded_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def op11(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.when(changed, leaf_digest(*columns(F.translate("text", UPPER, LOWER))))
    leaves = docs.select("doc_id", "lang", leaf_digest(*columns(F.col("text"))).alias("leaf"), lowered.alias("tampered"))
    proved = manifest(leaves, "lang", "doc_id")
    siblings = F.array_join(F.transform("proof", lambda x: F.concat(x["left"], x["right"])), "")
    again = folded_root(F.coalesce("tampered", "leaf"), F.col("proof"))
    out = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = lambda text: "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
_CRC = """xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda crc, byte: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295::BIGINT), 4294967295::BIGINT)"""
#: Levels above the leaves of ``nodes(tree, pos, d)`` as recursion: each round is a whole level of all trees that have more than one node.
_TREE = """{name} AS (
  SELECT 0 AS level, tree, pos, d, count(*) OVER (PARTITION BY tree) AS members FROM {nodes}
  UNION ALL
  SELECT level + 1, tree, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (any_value(members) + 7) // 8 FROM {name} WHERE members > 1 GROUP BY level, tree, pos // 8
)"""
#: A node's siblings by level: those of its run before it and after it.
_PATH = """SELECT n.tree, n.pos, x.level, string_agg(x.d, '' ORDER BY x.pos) FILTER (WHERE x.pos < n.pos // (8 ** x.level)::BIGINT) AS lft, string_agg(x.d, '' ORDER BY x.pos) FILTER (WHERE x.pos > n.pos // (8 ** x.level)::BIGINT) AS rgt
  FROM {nodes} n JOIN {name} x ON x.tree = n.tree AND x.members > 1 AND x.pos // 8 = n.pos // (8 ** (x.level + 1))::BIGINT GROUP BY ALL"""
ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, {_LEAF("text")} AS d, doc_id,
         CASE WHEN {_CRC} % 3 = 0 THEN {_LEAF(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_LEAF("text")} END AS tampered FROM documents
), {_TREE.format(name="lower_tree", nodes="leaves")},
roots AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, d, tree AS of FROM lower_tree WHERE members = 1),
{_TREE.format(name="upper_tree", nodes="roots")},
path AS (
  SELECT tree, pos, level, coalesce(lft, '') AS lft, coalesce(rgt, '') AS rgt FROM ({_PATH.format(nodes="leaves", name="lower_tree")})
  UNION ALL
  SELECT l.tree, l.pos, 1000 + p.level, coalesce(p.lft, ''), coalesce(p.rgt, '') FROM leaves l JOIN roots r ON r.of = l.tree JOIN ({_PATH.format(nodes="roots", name="upper_tree")}) p ON p.pos = r.pos
), proofs AS (SELECT tree, pos, list(lft ORDER BY level) AS lft, list(rgt ORDER BY level) AS rgt, string_agg(lft || rgt, '' ORDER BY level) AS siblings FROM path GROUP BY 1, 2
), whole AS (
  SELECT doc_id, l.d AS leaf, r.d AS subroot, u.d AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(coalesce(list_transform(range(1, len(lft) + 1), lambda i: [lft[i], rgt[i]]), []), lambda x, y: [sha256(y[1] || x[1] || y[2])], [tampered])[1] AS folded_root
  FROM leaves l JOIN roots r ON r.of = l.tree JOIN (SELECT d FROM upper_tree WHERE members = 1) u ON TRUE LEFT JOIN proofs p ON p.tree = l.tree AND p.pos = l.pos
)
SELECT *, folded_root = root AS verified FROM whole
"""
