"""Lookups by key, and joins of positions with intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.operators.matrix import CELLS, MatrixFrame

#: Intervals that become one OR of ranges (pushed to the scan); beyond it a join by bins.
FEW_INTERVALS = 64


def lookup(df: DataFrame, right: DataFrame, key: list[str], name: str, pick: list[Column] | None = None, fields: list[str] | None = None) -> DataFrame:
    """df with a struct `name` of right's fields, NULL on a miss. Never more rows than df has: of several matches the
    first by `pick` (else by a hash of the fields) counts, found by an aggregate that starts before the shuffle."""
    fields = fields or [c for c in right.columns if c not in key]
    body = F.struct(*fields)
    order = F.struct(*(pick or [F.xxhash64(*fields)]))
    one = right.groupBy(*key).agg(F.min_by(body, order).alias(name))
    return df.join(one, key, "left")


def in_intervals(df: DataFrame, intervals: list[tuple[str, int, int]], contig: str = "contig", position: str = "position", bin_size: int = 100_000) -> DataFrame:
    """Rows inside any of the closed intervals."""
    if len(intervals) <= FEW_INTERVALS:
        test = F.lit(False)
        for c, s, e in intervals:
            test = test | ((F.col(contig) == c) & F.col(position).between(s, e))
        return df.filter(test)
    frame = df.sparkSession.createDataFrame(intervals, "contig string, start int, end int")
    return interval_semi(df, frame, contig, position, bin_size)


def interval_semi(df: DataFrame, intervals: DataFrame, contig: str = "contig", position: str = "position", bin_size: int = 100_000) -> DataFrame:
    """Rows of df inside any interval (contig, start, end; closed): an equi-join on (contig, bin) with the exact test."""
    cut = intervals.select(F.col("contig").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    cut = cut.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_s") / bin_size), F.floor(F.col("_e") / bin_size))))
    d = df.withColumn("_bin", F.floor(F.col(position) / bin_size))
    test = (d[contig] == cut["_c"]) & (d["_bin"] == cut["_b"]) & d[position].between(cut["_s"], cut["_e"])
    return d.join(cut, test, "left_semi").drop("_bin")


def interval_lookup(df: DataFrame, segments: DataFrame, contig: str, position: str, bin_size: int = 1_000_000) -> DataFrame:
    """df left-joined with the segment (contig, start, end, ...) that holds the position; segments don't overlap."""
    s = segments.withColumnsRenamed({c: f"seg_{c}" for c in segments.columns})
    s = s.withColumn("_b", F.explode(F.sequence(F.floor(F.col("seg_start") / bin_size), F.floor(F.col("seg_end") / bin_size))))
    d = df.withColumn("_bin", F.floor(F.col(position) / bin_size))
    test = (d[contig] == s["seg_contig"]) & (d["_bin"] == s["_b"]) & d[position].between(s["seg_start"], s["seg_end"])
    return d.join(s, test, "left").drop("_bin", "_b")


def densify(sites: DataFrame, blocks: DataFrame, samples: DataFrame | None = None, by: list[str] | None = None, salts: int = 8) -> DataFrame:
    """For each (site, sample), the reference block that covers the site, if any.

    sites: by + position and more; blocks: by + s, start, end and fields; blocks of a sample don't overlap. by: contig,
    unless neither has it.
    Blocks are cut at bins of the position and joined by (by, bin, salt) with the exact test; the salt is a hash of the sample,
    and each site goes to all of them, so the samples of a bin are spread over `salts` tasks (more for larger cohorts) and only
    covered cells make rows; no sample's blocks meet in one task."""
    by, size = by or [c for c in ("contig",) if c in sites.columns or c in blocks.columns], 10_000
    b = blocks.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor(F.col("end") / size)))).withColumn("_salt", F.pmod(F.xxhash64("s"), F.lit(salts)).cast("int"))
    p = sites.withColumn("_bin", F.floor(F.col("position") / size)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = p.join(b, [*by, "_bin", "_salt"]).filter(F.col("position").between(F.col("start"), F.col("end"))).drop("_bin", "_salt")
    return out if samples is None else out.join(samples.select("s"), "s", "left_semi")


def fill_forward(sites: DataFrame, blocks: DataFrame, by: list[str]) -> DataFrame:
    """The same for cells (site, s) that are listed: the last block of (by, s) that starts at or before the position, kept
    if it reaches it. One sort per (by, s); for cohorts where each sample lists many sites."""
    fields = [c for c in blocks.columns if c not in (*by, "s", "start")]
    held = blocks.select(*by, "s", F.col("start").alias("position"), F.lit(0).alias("_kind"), F.struct(F.col("start"), *fields).alias("_block"), F.lit(None).cast("long").alias("site_id"))
    cells = sites.select(*by, "s", "position", F.lit(1).alias("_kind"), F.lit(None).cast(held.schema["_block"].dataType).alias("_block"), "site_id")
    w = Window.partitionBy(*by, "s").orderBy("position", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    out = held.unionByName(cells).withColumn("_last", F.last("_block", ignorenulls=True).over(w)).filter("_kind = 1")
    return out.select(*by, "s", "site_id", "position", F.when(F.col("_last.end") >= F.col("position"), F.col("_last")).alias("block"))


def fill_every(sites: DataFrame, blocks: DataFrame, samples: DataFrame, by: list[str] | None = None, cells_per_task: float = 2e7) -> DataFrame:
    """For every (site, sample) the fields of the reference block that covers it, NULL where none does: the fields of sites, s and
    those of blocks. samples: s, each once.

    Covered cells alone are joined and gathered by site; the others are made in place as the rows go out, so what is shuffled
    follows the covered cells, and a task holds one row of the matrix at a time. Tasks follow the number of all cells."""
    key, cols = sites.columns, samples.select("s", F.col("s").alias("col_idx"))
    fields = [c for c in blocks.columns if c not in (*key, "s", "start", "end")]
    m = MatrixFrame.from_long(densify(sites, blocks, by=by), cols, key, fields)
    tasks = max(sites.sparkSession.sparkContext.defaultParallelism, math.ceil(sites.count() * m.n_cols / cells_per_task))
    none = F.array().cast(m.held.schema[CELLS].dataType)
    rows = sites.join(m.held, key, "left").withColumn(CELLS, F.coalesce(CELLS, none)).repartition(tasks, *key)
    return m._like(rows).long(absent=True).drop("col_idx")


def cohort_changes(present: DataFrame, cohort: DataFrame, refresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(remove, add) of ids `s` for an incremental build: remove what left the cohort or is to be refreshed, add what
    is new or to be refreshed. Ids to refresh must be in the cohort."""
    present, cohort, refresh = (d.select("s").distinct() for d in (present, cohort, refresh))
    stray = refresh.join(cohort, "s", "left_anti").limit(10).collect()
    if stray:
        raise ValueError(f"ids to refresh aren't in the cohort: {[r[0] for r in stray]}")
    remove = present.join(cohort, "s", "left_anti").union(present.join(refresh, "s", "left_semi")).distinct()
    add = cohort.join(present, "s", "left_anti").union(cohort.join(refresh, "s", "left_semi")).distinct()
    return remove, add


def check_removals(n: int, confirmed: bool, threshold: int = 20) -> None:
    """Refuse to take many samples out unless told to."""
    if n >= threshold and not confirmed:
        raise ValueError(f"{n} samples would go (threshold {threshold}); confirm to go on")


def analysis_by_id(analyses: DataFrame, analysis_id, id_col: str = "id", status: str = "status"):
    """The row of a completed analysis, or None."""
    return analyses.filter((F.col(id_col) == analysis_id) & (F.upper(status) == "COMPLETED")).first()


def latest(analyses: DataFrame, by: list[str], stamp: str = "timestamp") -> DataFrame:
    """Of each group the analysis with the greatest timestamp text."""
    rest = [c for c in analyses.columns if c not in by]
    return analyses.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(stamp, *[c for c in rest if c != stamp])).alias("_a")).select(*by, "_a.*")
