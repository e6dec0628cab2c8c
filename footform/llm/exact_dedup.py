"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

DataFrame functions only. A text is read once for its length and the hash of its beginning; each level then works on
the narrow rows that the last one left, and the full content is read again only for those that share both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, fresh_dir, keyed, materialise, remove, small, without_rows

#: White space that does not count when texts are compared.
SPACE = r"[\x20\x09-\x0D]+"
LARGE_GROUP = 10_000  # rows; a group of so many is one of a few


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, digest: bool = False) -> DataFrame:
    """One row per input row: ``ROW, id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space. The row with most code points in its original text stays,
    ties by the smallest id (a null id last), then by row. A null text counts as empty; all empty texts form one
    group. Rows that repeat an id are rows of their own: exactly one row of a group is kept. An empty table gives an
    empty result. Other columns are ignored; ``ROW`` is the row's number (see :func:`common.keyed`).

    ``text_sha256`` is null for texts that the first two levels told apart. ``digest`` asks for the hash of all of
    them, as a result may show it; it is then taken while the text is read for the first level.
    """
    rows = (docs if ROW in docs.columns else keyed(docs.select(id_col, text_col), id_col)).select(F.col(ROW).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sha = F.sha2(F.col("norm"), 256).alias("sha")
    norm = rows.select("row", "id", F.length(F.coalesce("text", F.lit(""))).alias("n_cp"), normalised(F.col("text")).alias("norm"))
    columns = ["row", "id", "n_cp", F.octet_length("norm").alias("n"), F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")]
    work = fresh_dir(docs.sparkSession, "exact")
    texts = materialise(norm.select(*columns, *([sha] if digest else [])), "levels", work)
    more = lambda df, *keys: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    # Level 1: lengths that several texts have. Level 2: of those texts, the beginnings that several have.
    lengths = materialise(more(texts, "n"), "lengths", work)
    sized = materialise(texts.join(small(lengths), "n", "left_semi"), "sized", work)
    prefixes = materialise(more(sized, "n", "prefix"), "prefixes", work)
    alike = materialise(sized.join(small(prefixes), ["n", "prefix"], "left_semi"), "alike", work)
    # Level 3: the full content of the texts that are left.
    if not digest:
        left = small(alike.select("row"))
        alike = materialise(norm.join(left, "row", "left_semi").select("row", "id", "n_cp", sha), "full", work)
    best = F.struct("n_cp", (-F.col("id")).alias("neg_id"), (-F.col("row")).alias("neg_row"))
    groups = materialise(
        alike.groupBy("sha").agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
        .select("sha", (-F.col("best.neg_id")).alias("keep_id"), (-F.col("best.neg_row")).alias("keep_row"), "group_size"), "groups", work
    )
    # A group with very many rows meets its texts by broadcast: there can only be few of those.
    large = F.col("group_size") >= LARGE_GROUP
    hot, others = F.broadcast(groups.filter(large)), groups.filter(~large)
    members = alike.join(hot, "sha").unionByName(alike.join(hot.select("sha"), "sha", "left_anti").join(small(others), "sha"))
    found = members.select("row", "sha", "keep_id", "keep_row", "group_size", F.lit(True).alias("grouped"))
    sha_of = F.coalesce("sha", "own_sha") if digest else F.col("sha")
    out = (texts.withColumnRenamed("sha", "own_sha") if digest else texts).join(found, "row", "left").select(
        F.col("row").alias(ROW), F.col("id").alias(id_col), F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"), sha_of.alias("text_sha256"),
    )
    out = materialise(out, "exact-result")
    remove(work)
    return out


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; columns as they were.

    Rows go, not ids: of rows that repeat an id, those with a text of their own stay. Null texts count as empty, so
    one row of all empty ones stays. An empty table stays empty.
    """
    rows = keyed(docs, id_col)
    return without_rows(rows, exact_duplicates(rows, id_col, text_col).filter(~F.col("kept")).select(ROW))


def op10(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True).drop(ROW)


ORACLE = """
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_max(doc_id, n_cp::HUGEINT * 1000000000000 - doc_id) AS keep_id FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.norm) AS text_sha256 FROM n JOIN g ON n.norm = g.norm
"""
