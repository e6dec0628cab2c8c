"""The trie of conversations' turns, by collapsing whole sequences.

Identical conversations become one weighted sequence with a list of those that end there; a sequence that an anti-join
finds as a proper prefix of another is no leaf; weighted prefixes are then added up. A prefix is known by its depth and
a fingerprint that running exclusive-ors give, so sequences of any length spread over tasks in blocks of turns, and the
rows of all steps together are as many as the distinct sequences' turns.

A node's smallest member names it: a conversation has one node at a depth. What is summed over a subtree is first summed
along each sequence over the nodes that it names, from each depth on, and then over the sequences through a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh_dir, materialise, numbered, take_over

WORD = r"[^\x20\x09-\x0D]+"
GROUP = 20  # conversations that begin with turns of one of them
BLOCK = 1024  # turns of a sequence that meet in one task
IDS = 65536  # range of ids that one text of a list of ends holds


def shared_turns(conv_id: Column) -> Column:
    """How many first turns of its group's conversation a conversation begins with."""
    return F.crc32(conv_id.cast("string")) % 4


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv, turn, mark, words``: what a turn says as a digest, and the words of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", mark.alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return rows.filter("conv is not null")


def rebuilt(conversations: DataFrame, within: str) -> tuple[DataFrame, DataFrame]:
    """``conv, depth, mark, words, n`` of all turns, conversations beginning with their group's, and ``conv, n`` of all."""

    def about(groups: DataFrame) -> DataFrame:
        base = groups.select(F.col("conv").alias("base"), F.col("members").alias("base_members"))
        h = shared_turns(F.col("conv")).alias("h")
        out = groups.select("*", h, (F.col("conv") - F.col("conv") % GROUP).alias("base")).join(base, "base", "left")
        borrowed = F.least("h", F.coalesce("base_members", F.lit(0))).alias("borrowed")
        return out.select("conv", "members", "h", borrowed, (borrowed + F.greatest(F.col("members") - F.col("h"), F.lit(0))).alias("n"))

    turns = materialise(numbered(turn_rows(conversations), "conv", [F.col("turn").asc_nulls_first(), F.col("mark")], "turns", within, about), "placed", within)
    convs = turns.filter("place = 0").select("conv", "h", "n")
    own = turns.filter("place >= h").select("conv", (F.col("place") + 1 - F.col("h") + F.col("borrowed")).alias("depth"), "mark", "words", "n")
    heads = turns.filter("place < 3").select(F.col("conv").alias("base"), "place", "mark", "words")
    first = convs.filter("h > 0").withColumn("base", F.col("conv") - F.col("conv") % GROUP).join(heads, "base").filter("place < h")
    return own.unionByName(first.select("conv", (F.col("place") + 1).alias("depth"), "mark", "words", "n")), convs


def with_prefixes(turns: DataFrame, block: int, within: str) -> DataFrame:
    """``turns`` with the fingerprint of the prefix that ends there (``p, q``), and of the one before it."""
    one = turns.withColumns({"block": F.floor(F.col("depth") / block), "hp": F.xxhash64("depth", "mark"), "hq": F.xxhash64("mark", F.lit("second"), "depth")})
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    one = one.withColumns({"p": F.bit_xor("hp").over(so_far), "q": F.bit_xor("hq").over(so_far)})
    one = materialise(one, "within-blocks", within)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    long = one.filter(F.col("n") >= block).groupBy("conv", "block").agg(F.bit_xor("hp").alias("bp"), F.bit_xor("hq").alias("bq"))
    long = long.select("conv", "block", F.bit_xor("bp").over(earlier).alias("bp"), F.bit_xor("bq").over(earlier).alias("bq"))
    out = one.join(long, ["conv", "block"], "left")
    whole = {c: F.col(c).bitwiseXOR(F.coalesce(f"b{c}", F.lit(0).cast("long"))) for c in "pq"}
    out = out.withColumns(whole).withColumns({"up_p": F.col("p").bitwiseXOR(F.col("hp")), "up_q": F.col("q").bitwiseXOR(F.col("hq"))})
    return out.select("conv", "block", "depth", "mark", "words", "n", "p", "q", "up_p", "up_q")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's list of ends; its texts come one after the other, and one is in memory at a time."""
    take_over()
    key, state = None, None
    schema = pa.schema([("depth", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("ends_sha256", pa.string())])

    def row(key, state):
        return {"depth": key[0], "p": key[1], "q": key[2], "ends_sha256": state.hexdigest()}

    for batch in batches:
        out = []
        depth, p, q = (batch.column(c).to_pylist() for c in range(3))
        for *now, text in zip(depth, p, q, batch.column(4), strict=True):
            if now != key:
                if key:
                    out.append(row(key, state))
                key, state = now, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.as_py().encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if key:
        yield pa.RecordBatch.from_pylist([row(key, state)], schema)


def end_lists(ends: DataFrame) -> DataFrame:
    """``depth, p, q, ends_sha256`` of ``ends(conv, depth, p, q)``: ids meet as texts of ranges, which are joined in order."""
    part = F.floor(F.col("conv") / IDS).alias("part")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    texts = ends.groupBy("depth", "p", "q", part).agg(ids.alias("ids"))
    ordered = texts.repartition("depth", "p", "q").sortWithinPartitions("depth", "p", "q", "part")
    return ordered.mapInArrow(_joined, "depth long, p long, q long, ends_sha256 string")


NODE = ["depth", "p", "q"]


def same(column: str) -> Column:
    """The one value of a group; two of them mean that a fingerprint stands for two prefixes."""
    return F.when(F.min(column) == F.max(column), F.min(column)).otherwise(F.raise_error(F.lit("two prefixes have one fingerprint")))


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, null first, ties by a digest of role and text; a null role or text counts as empty.
    A conversation begins with the first turns of its group's (see :func:`shared_turns`; none if that one is absent) and
    goes on with its own after as many of them. A turnless one is a member of the root alone. Rows without a ``conv_id``
    belong to no conversation and are left out; repeated rows are turns of their own. Other columns are ignored. No
    conversations give no rows, not even the root. At most ``block`` turns of a sequence meet in one task.

    Fingerprints of 128 bits tell prefixes apart, and it is checked that all members of a node agree in the last turn's
    SHA-256 and in the node before it, so that no two prefixes can have been taken for one.
    """
    within = fresh_dir(conversations.sparkSession, "trie")
    turns, convs = rebuilt(conversations, within)
    rows = materialise(with_prefixes(turns, block, within), "prefixes", within)
    none = lambda c: F.lit(0).cast("long").alias(c)
    ends = rows.filter("depth = n").select("conv", *NODE).unionByName(convs.filter("n = 0").select("conv", none("depth"), none("p"), none("q")))
    ends = materialise(ends, "ends", within)

    # Identical conversations become one sequence, and only its turns go on.
    sequences = materialise(ends.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight")), "sequences", within)
    blocks = sequences.select("conv", "weight", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("depth") / block))).alias("block"))
    paths = rows.join(blocks, ["conv", "block"])
    roots = sequences.select("conv", none("block"), none("depth"), F.lit("").alias("mark"), none("words"), F.col("depth").alias("n"), none("p"), none("q"), none("up_p"), none("up_q"), "weight")
    paths = materialise(paths.select(roots.columns).unionByName(roots), "paths", within)

    nodes = paths.groupBy(*NODE).agg(
        F.min("conv").alias("conv"), F.sum("weight").alias("n_convs"), F.max(F.col("n") > F.col("depth")).alias("inner"), same("up_p").alias("up_p"), same("up_q").alias("up_q"), same("mark").alias("mark"), F.max("words").alias("words"),
    )
    nodes = materialise(nodes, "nodes", within)
    leaves = sequences.join(nodes.filter("inner"), NODE, "left_anti").select(*NODE, F.lit(1).cast("long").alias("leaf"))
    named = nodes.join(leaves, NODE, "left").select("conv", "depth", F.coalesce("leaf", F.lit(0)).alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))

    # What each sequence's own nodes hold, from a depth on to its end.
    own = paths.join(named, ["conv", "depth"], "left").select("conv", "block", "n", *NODE, F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved"))
    here, seq = Window.partitionBy("conv", "block"), Window.partitionBy("conv")
    own = materialise(own.withColumns({c: F.sum(c).over(here) - F.sum(c).over(here.orderBy("depth")) + F.col(c) for c in ("leaf", "saved")}), "own", within)
    long = own.filter(F.col("n") >= block).filter(F.col("depth") % block == 0)  # a block's first depth has the block's sum
    long = long.select("conv", "block", *((F.sum(c).over(seq) - F.sum(c).over(seq.orderBy("block"))).alias(f"b{c}") for c in ("leaf", "saved")))
    sums = own.join(long, ["conv", "block"], "left").groupBy(*NODE).agg(*(F.sum(F.col(c) + F.coalesce(f"b{c}", F.lit(0))).alias(c) for c in ("leaf", "saved")))

    up = {"depth": F.col("depth") - 1, "p": F.col("up_p"), "q": F.col("up_q")}
    below = nodes.filter("depth > 0").select(F.col("conv").alias("child"), *(c.alias(k) for k, c in up.items()))
    children = below.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = below.join(nodes.select(*NODE, F.col("conv").alias("parent_conv_id")), NODE).select(F.col("child").alias("conv"), (F.col("depth") + 1).alias("depth"), "parent_conv_id")
    out = nodes.join(sums, NODE).join(children, NODE, "left").join(end_lists(ends), NODE, "left").join(parents, ["conv", "depth"], "left")
    no_ends = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", no_ends).alias("ends_sha256"),
    )


def op12(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


_CRC = """xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
    lambda crc, byte: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295::BIGINT), 4294967295::BIGINT)"""
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT conv_id, count(*) AS members, {_CRC} % 4 AS h FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, place AS depth, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % {GROUP} AND place <= h
  UNION ALL
  SELECT c.conv_id, place - c.h + least(c.h, coalesce(b.members, 0)), role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > c.h LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % {GROUP}
), keyed AS (
  SELECT conv_id, depth, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS key, len(regexp_extract_all(text, '{WORD}')) AS words FROM rebuilt
), paths AS (SELECT conv_id, depth, sha256(key) AS key, words FROM keyed UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), ends AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id
), nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256, NOT bool_or(n > depth) AS leaf
  FROM paths JOIN ends USING (conv_id) GROUP BY depth, key
), trees AS (
  SELECT p.depth, p.key, sum(leaf::INT) AS n_leaves, sum((n_convs - 1) * v.words) AS saved_tokens, count(*) FILTER (WHERE v.depth = p.depth + 1) AS n_children FROM nodes v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.key
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v JOIN trees USING (depth, key) LEFT JOIN paths p ON p.conv_id = v.conv_id AND p.depth = v.depth - 1 LEFT JOIN nodes u ON u.depth = p.depth AND u.key = p.key
"""
