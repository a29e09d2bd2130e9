"""Operator 13, conversation prefix trie: every node belongs to its smallest member.

Along a conversation's path the members of nodes only get fewer, so the smallest member never descends: a conversation owns the
nodes from some depth on, a suffix of its path, and each node has one owner. Windows along the path give prefixes and the text
so far. One group-by over prefixes then adds up over the members: what occurs from the node on less what is owned of it is what
sharing saves in the subtree, owned next nodes are children, owned leaves are leaves.

A prefix is the exclusive or of two 64-bit hashes of (place, MD5 of role and text), so it needs no text of the turns before, and
long conversations are scanned in chunks (scans.py). Owners come from an aggregate that is joined back rather than from a window
by prefix, in which a first turn that a third of all conversations share would meet in one task. Turns are put in order by ranges, so a conversation with a third of all rows
spans many tasks. A node of many members, such as the root, is added up in each task first; its owner is joined back as a
broadcast of the hottest nodes (join_keyed). Ids that end at a node are joined in runs first, and their digest streams over
the runs of a node: SHA-256 can't be split, but no task holds its input.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import discard, durable, join_keyed, table
from varloom.llm.scans import dealt, running

#: Conversations of a family share the first turns of its first; at most SHARED - 1 of them.
FAMILY, SHARED = 100, 6
#: Places of a chunk in which prefixes are scanned; ids of a run that is joined before it is digested.
CHUNK, RUN = 1024, 4096
_NODE = ["depth", "p1", "p2"]


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """The rebuilt conversations: conv_id, place (from 1), digest of role and text, size in code points, n_turns; and a row of
    place 0 for each conversation. A durable table."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    role, said = text("role"), text("text")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, said)).alias("digest"),
        F.length(said).cast("long").alias("size"), F.lit(1).alias("one"), role.alias("role"), F.substring(said, 1, 64).alias("head"),
    ).filter("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]
    parts = dealt(rows, "turns", *order)
    placed = durable(running(parts, ["conv_id"], "_part", order[1:], {"place": "one"}).select("conv_id", "place", "digest", "size"), "placed")
    start = F.col("conv_id") - F.col("conv_id") % family
    head = F.crc32(F.col("conv_id").cast("string")) % shared
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("n")).select("conv_id", "n", start.alias("start"), head.alias("h"))
    firsts = convs.filter("conv_id = start").select("start", F.col("n").alias("n_start"))
    given = F.least("h", F.coalesce("n_start", F.lit(0).cast("long")))
    convs = convs.join(firsts, "start", "left").withColumn("given", given).withColumn("n_turns", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = durable(convs.select("conv_id", "start", "h", "n", "given", "n_turns"), "convs")
    lead = placed.filter((F.col("place") < shared) & (F.col("conv_id") % family == 0)).select(F.col("conv_id").alias("start"), "place", "digest", "size")
    led = convs.filter("given > 0").join(lead, "start").filter("place <= given").select("conv_id", "place", "digest", "size", "n_turns")
    own = join_keyed(placed, convs.drop("start"), ["conv_id"], "n").filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "digest", "size", "n_turns")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("size"), "n_turns")
    out = durable(led.unionByName(own).unionByName(roots), "rebuilt")
    discard(parts, placed, convs)
    return out


def _ends_digest(batches):
    """Batches of (depth, p1, p2, run, ids) in that order: the SHA-256 of each node's ids, comma-joined, streamed."""
    node, sha = None, None
    out = lambda x, s: pa.RecordBatch.from_pydict({"depth": pa.array([x[0]], pa.int64()), "p1": pa.array([x[1]], pa.int64()), "p2": pa.array([x[2]], pa.int64()), "ends_sha256": pa.array([s.hexdigest()], pa.string())})
    for b in batches:
        done = []
        for d, p1, p2, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids"))):
            if (d, p1, p2) == node:
                sha.update(b",")
            else:
                if node:
                    done.append(out(node, sha))
                node, sha = (d, p1, p2), hashlib.sha256()
            sha.update(ids.encode())
        yield from done
    if node:
        yield out(node, sha)


def prefix_trie(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """One row per node: conv_id (owner), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, turn, role, text; other columns are not read. Turns are ordered by turn (null first), role, text; rows that
    repeat a turn are each a turn. Null role and text are empty. Rows with a null conv_id belong to no conversation and are left
    out. An empty table gives no node. Very long texts are digested, and only digests and sizes are shuffled but for the order."""
    paths = rebuilt(turns, family, shared)
    tag = lambda *c: F.when(F.col("place") > 0, F.xxhash64(*c)).otherwise(F.lit(0).cast("long"))
    marked = paths.select("conv_id", F.col("place").alias("depth"), "size", "n_turns", F.floor(F.col("place") / CHUNK).alias("chunk"), tag("place", "digest").alias("x1"), tag(F.lit("2"), "digest", "place").alias("x2"))
    steps = durable(running(marked, ["conv_id"], "chunk", ["depth"], {"so_far": "size"}, {"p1": "x1", "p2": "x2"}).drop("x1", "x2", "chunk"), "prefixes")
    ends = F.col("depth") == F.col("n_turns")
    members = steps.groupBy(*_NODE).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("members"), F.sum(ends.cast("long")).alias("stops")).filter("members > 1")
    members = durable(members, "members")
    owned = durable(join_keyed(steps, members, _NODE, "members", "left").withColumn("owner", F.coalesce("owner", "conv_id")), "owned")
    mine = F.col("owner") == F.col("conv_id")
    leaf = mine & ends & F.coalesce(F.col("members") == F.col("stops"), F.lit(True))  # all that come here end here
    paths_of = owned.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.when(mine, 0).otherwise(1)).alias("first"), F.max(F.when(~mine, F.col("owner"))).alias("handed"),
        F.sum(F.when(mine, 0).otherwise(F.col("size"))).alias("not_owned"), F.max(leaf.cast("long")).alias("leaf"),
    )
    paths_of = durable(paths_of, "paths")
    met = join_keyed(owned, paths_of, ["conv_id"], "rows")
    saved = F.when(F.col("depth") < F.col("first"), F.col("not_owned") - F.col("so_far") + F.col("size")).otherwise(0)
    child = (F.col("depth") + 1 >= F.col("first")) & ~ends
    nodes = met.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.min(F.when(mine, F.when(F.col("depth") == F.col("first"), F.col("handed")).when(F.col("depth") > 0, F.col("conv_id")))).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.sum(child.cast("long")).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"),
    )
    runs = steps.filter(ends).groupBy(*_NODE, F.floor(F.col("conv_id") / RUN).alias("run")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    digests = runs.repartition(*_NODE).sortWithinPartitions(*_NODE, "run").mapInArrow(_ends_digest, "depth long, p1 long, p2 long, ends_sha256 string")
    out = nodes.join(digests, _NODE, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    discard(paths)
    return out


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
                  length(coalesce(text, '')) AS size, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x
           FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
             list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, _: xor(y >> 1, 3988292384 * (y & 1))))) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
g AS (SELECT h.*, least(h, (SELECT count(*) FROM t WHERE t.conv_id = h.base)) AS given FROM h),
r AS (SELECT g.conv_id, t.p, size, x FROM g JOIN t ON t.conv_id = g.base WHERE t.p <= g.h
      UNION ALL SELECT conv_id, p - h + given, size, x FROM g JOIN t USING (conv_id) WHERE p > h),
pre AS (SELECT conv_id, p AS depth, size, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY p) AS prefix FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM g),
n AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size FROM pre GROUP BY prefix, depth),
kids AS (SELECT left(prefix, length(prefix) - 32) AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (prefix)),
sub AS (SELECT a.prefix, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.size) AS saved FROM m a JOIN m b ON starts_with(b.prefix, a.prefix) GROUP BY a.prefix),
ends AS (SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha FROM (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM pre GROUP BY conv_id) GROUP BY prefix)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM m JOIN sub USING (prefix) LEFT JOIN ends USING (prefix) LEFT JOIN m up ON m.depth > 0 AND up.prefix = left(m.prefix, length(m.prefix) - 32)
"""
