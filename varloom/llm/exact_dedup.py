"""Operator 1, exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

Plan: one scan makes a table of ids, hashes and digests, without texts. Groups come from the hash alone (ids and
counts, added up in each task first). Only texts of groups of two rows or more are read again, and compared as bytes
inside their group: rows are grouped by (hash, bytes), each task leaving one row per distinct text, so a group with a
third of all rows doesn't meet in one task, and two texts that collide give two groups. A hash that stands once needs
no text. The last join broadcasts the hottest groups (join_keyed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import BROADCAST_IDS, SPACE_CLASS, durable, join_keyed, key_rows, table


def normalised(text: Column) -> Column:
    """White space runs become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash=hash128) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts equal empty ones. Rows that repeat an id with an equal text count in group_size and are all kept if
    theirs is the smallest id. A null id is never the smallest unless its group has no other; then keep_id is null and
    the row is kept. An empty table gives an empty result; other columns of docs are not read; texts are read whole.
    content_hash: makes the group hash from the normalised text; tests give weak ones to force collisions, or groups too
    fine to find copies."""
    rows = key_rows(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("h", content_hash(F.col("norm")))
    hashed = durable(rows.select("doc_id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "hashed")
    groups = durable(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "hash-groups")
    texts = join_keyed(rows, groups, ["h"], "rows").groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    same = durable(texts.filter("group_size > 1").select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"), "equal-texts")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return join_keyed(hashed, same, ["h", "sha"], "group_size", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows that exact_dedup() doesn't keep. A row goes by its id, which may be null, and
    the digest of its own text, so rows of one id with other texts have verdicts of their own. Null and empty texts are
    copies of each other; rows that repeat the id and text that stays all stay; an empty table stays empty."""
    digest = lambda sha: F.unhex(sha).alias("_the_digest")
    gone = durable(exact_dedup(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("_the_id"), digest("text_sha256")).distinct(), "copies")
    n = BROADCAST_IDS // 4  # a digest takes four times the bytes of an id
    gone = F.broadcast(gone) if gone.limit(n + 1).count() <= n else gone
    own = F.unhex(F.sha2(normalised(docs[f"`{text_col}`"].cast("string")), 256))
    return docs.join(gone, docs[f"`{id_col}`"].cast("long").eqNullSafe(gone["_the_id"]) & (own == gone["_the_digest"]), "left_anti")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
