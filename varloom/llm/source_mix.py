"""Operator 12, mixing sources to target weights: a low-discrepancy schedule of slots over equal-token blocks.

Targets share all words by weight and stop at PASSES times their source's size (water level: a few aggregates of the table of
sources). Slot n is the point n / golden ratio, modulo 1, in 32-bit integers; the cumulated targets cut the unit interval,
and the cut that a point falls in names the slot's source. The k-th slot of a source takes the k-th block of its line: the
source's documents in a hashed order, laid end to end, as many passes as its target needs. A block has BLOCK words, the last
of a source what is left of its target. Where the points gave a source fewer slots than it has blocks, the missing ones
follow at the end; where more, the surplus is left out. So each source's words come to its target, rounded.

Only DataFrame functions are used. Texts are read once, for sizes and digests. Running sums and ranks are taken in chunks
(scans.py), so neither a source with a third of all rows nor its slots meet in one task; blocks join slots by source and
number, and no pair of them has more than BLOCK words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import BROADCAST_KEYS, discard, durable, join_keyed, table
from varloom.llm.scans import dealt, running

#: Weights of the sources in the order of their names, repeating; passes over a source at most; words of a block.
WEIGHTS, PASSES, BLOCK = (5, 2, 1), 3, 1024
#: 2^32 divided by the golden ratio; and 2^32.
GOLDEN, ONE = 2654435769, 1 << 32
#: Slots of a chunk in which ranks are taken.
CHUNK_BITS = 14


def n_words(text: Column) -> Column:
    """Number of runs of other characters than space and 9 to 13: each, with the space before it, becomes one letter."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+$", "")).cast("long")


def point(n: Column) -> Column:
    """n times GOLDEN, modulo 2^32, without overflow for n below 2^47."""
    return ((F.shiftright(n, 16) * GOLDEN) % ONE * 65536 + n.bitwiseAND(F.lit(65535)) * GOLDEN) % ONE


def _targets(sources: DataFrame, passes: int) -> DataFrame:
    """sources (src, source_size, weight) with target: shares of the sum of sizes by weight, none above passes times its size."""
    cap, share = F.col("source_size") * passes, lambda level: F.col("weight") * F.lit(level)
    total, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    level = total / weights if weights else 0.0
    while total:
        full = cap < share(level)
        capped, rest = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.sum(F.when(~full, F.col("weight")))).first()
        now = (total - capped) / rest
        if now <= level:
            break
        level = now
    return sources.withColumn("target", F.least(cap.cast("double"), share(level)))


def _line(docs: DataFrame, weights: tuple, passes: int, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """Sources (src, source_size, target, take, low), and documents on the line of their source (at: words before)."""
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    name = F.concat(F.when(source.isNull(), F.lit("1")).otherwise("0"), F.coalesce(source, F.lit("")))  # null after all names
    key = F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("null")), F.lit(" "), F.md5(F.coalesce(text, F.lit("")))))
    rows = durable(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), name.alias("src"), n_words(text).alias("size"), key.alias("key")), "mix-sizes")
    named = dealt(rows.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")).withColumn("one", F.lit(1)), "mix-names", F.col("src"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    weighed = durable(running(named, [], "_part", ["src"], {"nth": "one"}).withColumn("weight", weight), "mix-weights")
    take = F.least(F.col("source_size") * passes, F.floor(F.col("target") + 0.5))
    taking = durable(_targets(weighed, passes).withColumn("take", take), "mix-targets")
    sources = durable(running(taking, [], "_part", ["src"], {"upto": "take"}).drop("one", "_part", "weight"), "mix-sources")
    placed = running(rows.withColumn("chunk", F.substring("key", 1, 4)), ["src"], "chunk", ["key", "size"], {"end": "size"})
    line = durable(placed.select("doc_id", "src", "size", (F.col("end") - F.col("size")).alias("at")), "mix-line")
    discard(rows, named, weighed, taking)
    return sources, line


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """(slot, src, nth): slots in training order, each with the number of its source's block."""
    spark = sources.sparkSession
    total, n = sources.agg(F.coalesce(F.sum("take"), F.lit(0)), F.count(F.lit(1))).first()
    count, bits = math.ceil(total / block), 32 - min(24, n.bit_length() + 4)
    cut = lambda words: F.floor(words / F.lit(max(total, 1)) * ONE)
    ranges = sources.select("src", cut(F.col("upto") - F.col("take")).alias("low"), cut(F.col("upto")).alias("high")).filter("high > low")
    bins = ranges.select("*", F.explode(F.sequence(F.shiftright("low", bits), F.shiftright(F.col("high") - 1, bits))).alias("bin"))
    bins = F.broadcast(bins) if n + (1 << (32 - bits)) <= BROADCAST_KEYS else bins
    points = spark.range(count).select(F.col("id").alias("slot"), point(F.col("id")).alias("x"), F.lit(1).alias("one"), F.shiftright("id", CHUNK_BITS).alias("chunk"))
    drawn = points.withColumn("bin", F.shiftright("x", bits)).join(bins, "bin").filter("low <= x AND x < high").select("slot", "src", "chunk", "one")
    ranked = running(drawn, ["src"], "chunk", ["slot"], {"rank": "one"}).select("slot", "src", (F.col("rank") - 1).alias("nth"))
    need = sources.filter("take > 0").select("src", "nth", F.ceil(F.col("take") / block).alias("blocks"), F.col("nth").alias("order"))
    have = drawn.groupBy("src").agg(F.count(F.lit(1)).alias("have"))
    late = need.join(have, "src", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < blocks")
    late = late.select("src", "order", F.posexplode(F.sequence("have", F.col("blocks") - 1)).alias("k", "nth"))
    return ranked.unionByName(late.select((F.lit(count) + F.col("order") + F.col("k") * n).alias("slot"), "src", F.col("nth").cast("long")))


def _mixed(sources: DataFrame, line: DataFrame, block: int) -> DataFrame:
    here = join_keyed(line, sources.select("src", "source_size", "target", "take", "rows"), ["src"], "rows")
    start = F.col("pass") * F.col("source_size") + F.col("at")
    passes = F.sequence(F.lit(0).cast("long"), F.floor((F.col("take") - F.col("at") - 1) / F.col("source_size")))
    laid = here.filter("size > 0 AND at < take").select("*", F.explode(passes).alias("pass"))
    laid = laid.select("*", start.alias("start"), F.least(start + F.col("size"), F.col("take")).alias("stop"))
    pieces = laid.select("*", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))).alias("nth"))
    first, last = F.greatest("start", F.col("nth") * block), F.least("stop", (F.col("nth") + 1) * block)
    pieces = pieces.withColumns({"first": first - F.col("start"), "words": last - first})
    return pieces.join(_slots(sources, block), ["src", "nth"])


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, passes: int = PASSES, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture: slot, source, nth (block of the source), pass, doc_id, first and words: the words of the document, counted
    from 0, that stand in the slot. Sorted by slot and pass, then start, it is the order of training.

    Sources weigh by the order of their names (code points, null last). Null texts have no words and stand in no slot. A null
    id is a document like others; an id on several rows too. Rows that repeat id and text are each laid on the line. The order
    in a source hangs on id and text only, so reruns agree. Slot numbers of the blocks that follow at the end may have gaps.
    Very long texts spread over many slots. An empty table gives an empty mixture; other columns of docs are not read."""
    sources, line = _line(docs, weights, passes, id_col, text_col, source_col)
    name = F.when(F.col("src").startswith("0"), F.expr("substring(src, 2)"))
    return _mixed(sources, line, block).select("slot", name.alias("source"), "nth", "pass", "doc_id", "first", "words", "start")


def mix_totals(docs: DataFrame, weights: tuple = WEIGHTS, passes: int = PASSES, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, and taken, the words of it that stand in the mixture."""
    sources, line = _line(docs, weights, passes, id_col, text_col, source_col)
    ids = ["doc_id", "src", "at", "size", "source_size", "target"]  # of documents with words, none shares source and place
    taken = _mixed(sources, line, block).groupBy(*ids).agg(F.sum("words").alias("taken"))
    left = join_keyed(line, sources.select("src", "source_size", "target", "take", "rows"), ["src"], "rows").filter("size = 0 OR at >= take")
    return taken.unionByName(left.select(*ids, F.lit(0).cast("long").alias("taken"))).select("doc_id", "size", "source_size", "target", "taken")


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_totals(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ' ' || md5(coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM d GROUP BY source),
w AS (SELECT *, CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
o AS (SELECT *, coalesce(sum(3 * n) OVER (ORDER BY 3.0 * n / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(weight) OVER (ORDER BY 3.0 * n / weight, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
             sum(n) OVER () AS total FROM w),
l AS (SELECT arg_min(CAST(total - capped AS DOUBLE) / CAST(rest AS DOUBLE), {'full': 3.0 * n / weight, 'nth': nth}) AS level FROM o
      WHERE 3 * n >= CAST(total - capped AS DOUBLE) / CAST(rest AS DOUBLE) * weight),
t AS (SELECT source, n, least(CAST(3 * n AS DOUBLE), weight * level) AS target,
             least(3 * n, CAST(floor(least(CAST(3 * n AS DOUBLE), weight * level) + 0.5) AS BIGINT)) AS take FROM w, l),
p AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS ahead FROM d)
SELECT doc_id, size, n AS source_size, target,
       CASE WHEN n = 0 THEN 0 ELSE take // n * size + greatest(0, least(size, take % n - ahead)) END AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""
