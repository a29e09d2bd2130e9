"""Genome intervals: balanced cuts, overlaps, splitting, trimming around telomeres and centromeres, liftover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.functions.variants import GRCH38_LENGTHS, contig_index
from varloom.operators.joins import interval_lookup


def balanced_intervals(sites: DataFrame, n: int, per_bin: int = 10_000) -> DataFrame:
    """n runs of as many sites each, in genome order: part, start and end (contig, position), sites.

    Ranks come from counts of position bins (a small aggregate with a running sum) and the order inside a bin, so no
    task sorts the genome; sizes are those of ntile(n)."""
    bins = sites.select("contig", "position", contig_index(F.col("contig")).alias("ci"), F.floor(F.col("position") / per_bin).alias("bin"))
    counts = bins.groupBy("ci", "bin").agg(F.count(F.lit(1)).alias("c"))
    before = counts.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy("ci").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole = counts.groupBy("ci").agg(F.sum("c").alias("all"))
    ahead = whole.withColumn("ahead", F.coalesce(F.sum("all").over(Window.orderBy("ci").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per contig
    total = F.broadcast(counts.agg(F.sum("c").alias("total")))
    inside = F.row_number().over(Window.partitionBy("ci", "bin").orderBy("position"))
    ranked = bins.withColumn("inside", inside).join(before, ["ci", "bin"]).join(F.broadcast(ahead), "ci").crossJoin(total)  # total: one row
    rank = F.col("ahead") + F.col("before") + F.col("inside") - 1
    small, extra = F.floor(F.col("total") / n), F.col("total") % n
    part = F.when(rank < extra * (small + 1), F.floor(rank / (small + 1))).otherwise(extra + F.floor((rank - extra * (small + 1)) / F.greatest(small, F.lit(1))))
    at = F.struct("ci", "position", "contig")
    out = ranked.groupBy((part + 1).cast("int").alias("part")).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("sites"))
    return out.select("part", F.col("first.contig").alias("start_contig"), F.col("first.position").alias("start"), F.col("last.contig").alias("end_contig"), F.col("last.position").alias("end"), "sites")


def per_contig(cuts: list[tuple[str, int, str, int]], lengths: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """(contig, start, end) from balanced cuts: one that crosses contigs is split, the first of a contig starts at 1, the
    last ends at the contig's length, and where a gap would be left between neighbours the first reaches up to the second."""
    lengths = lengths or GRCH38_LENGTHS
    order = list(lengths)
    flat: list[list] = []
    for c1, s, c2, e in cuts:
        names = order[order.index(c1) : order.index(c2) + 1]
        for c in names:
            flat.append([c, s if c == c1 else 1, e if c == c2 else lengths[c]])
    for i, x in enumerate(flat):
        if i == 0 or flat[i - 1][0] != x[0]:
            x[1] = 1
        if i == len(flat) - 1 or flat[i + 1][0] != x[0]:
            x[2] = lengths[x[0]]
        else:
            x[2] = max(x[2], flat[i + 1][1] - 1)
    return [tuple(x) for x in flat]


def groom(intervals: list[tuple[str, int, int]], lengths: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """From the first base on; without trailing pieces of the mitochondrial contig, which comes back whole at the end; the
    last interval before it reaches its contig's end."""
    lengths = lengths or GRCH38_LENGTHS
    out = [x for x in intervals if x[0] != "chrM"]
    if out:
        out[0] = (out[0][0], 1, out[0][2])
        out[-1] = (*out[-1][:2], lengths[out[-1][0]])
    return [*out, ("chrM", 1, lengths["chrM"])]


def overlap(a: tuple[int, int], b: tuple[int, int]) -> int:
    """Length that two ranges share; 0 if they only touch."""
    return max(0, min(a[1], b[1]) - max(a[0], b[0]))


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def split_intervals(intervals: DataFrame, largest: int) -> DataFrame:
    """Each (contig, start, end) in even pieces, as many as keep each to about `largest`; a piece begins where the one
    before ends, and the last takes what is left over."""
    size = F.col("end") - F.col("start")
    each = intervals.withColumn("_n", F.greatest(F.lit(1), F.ceil(size / largest)).cast("int")).withColumn("_step", F.floor(size / F.col("_n")).cast("int"))
    each = each.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    start = F.col("start") + F.col("_i") * F.col("_step")
    return each.select("contig", start.cast("int").alias("start"), F.when(F.col("_i") == F.col("_n") - 1, F.col("end")).otherwise(start + F.col("_step")).cast("int").alias("end"))


def polish(intervals: list[tuple[str, int, int]], centromeres: dict[str, tuple[int, int]], telomeres: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The intervals without telomeres and centromeres, whose edges stay: a telomere from base 1 on moves the start to its
    end, another the end to its start; a centromere leaves what reaches out of it on either side."""
    out = []
    for contig, start, end in intervals:
        low, high = start, end
        for _, s, e in (t for t in telomeres if t[0] == contig and overlap(t[1:], (start, end))):
            low, high = (e, high) if s == 1 else (low, s)
        s, e = centromeres.get(contig, (0, 0))
        if not overlap((s, e), (start, end)):
            out.append((contig, low, high))
            continue
        out += [(contig, low, s)] * (s > start) + [(contig, e, high)] * (end > e)
    return out


def read_chain(lines) -> list[tuple[str, int, int, str, int, bool, int]]:
    """Aligned segments of a chain file: (contig, start, end, to_contig, to_start, reverse, to_size), 1-based, closed.

    to_start counts on the segment's strand."""
    out, at = [], None
    for line in lines:
        f = line.split()
        if not f or f[0].startswith("#"):
            continue
        if f[0] == "chain":
            at = [f[2], int(f[5]), f[7], int(f[8]), f[9] == "-", int(f[10])]
            continue
        n = int(f[0])
        out.append((at[0], at[1] + 1, at[1] + n, at[2], at[5] + 1, at[4], at[3]))
        if len(f) == 3:
            at[1], at[5] = at[1] + n + int(f[1]), at[5] + n + int(f[2])
    return out


def liftover(df: DataFrame, segments: list[tuple], contig: str = "contig", position: str = "position") -> DataFrame:
    """df with to_contig, to_position and to_reverse; NULL where no segment holds the position."""
    spark: SparkSession = df.sparkSession
    frame = spark.createDataFrame(segments, "contig string, start int, end int, to_contig string, to_start int, reverse boolean, to_size int")
    out = interval_lookup(df, frame, contig, position)
    plus = F.col("seg_to_start") + F.col(position) - F.col("seg_start")
    place = F.when(F.col("seg_reverse"), F.col("seg_to_size") - plus + 1).otherwise(plus)
    return out.select(*df.columns, F.col("seg_to_contig").alias("to_contig"), place.alias("to_position"), F.col("seg_reverse").alias("to_reverse"))
