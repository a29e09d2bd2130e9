"""A sparse cohort: variant entries with local alleles beside reference blocks, and the dense matrix made of both."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.calls import call, is_non_ref
from varloom.operators import split
from varloom.operators.joins import densify, in_intervals
from varloom.operators.matrix import CELLS, MatrixFrame
from varloom.sources.readers import exists

KEY = ["contig", "position"]
#: Intervals that are tested in the scan of blocks; more are joined.
FEW_INTERVALS = 100


@dataclass
class SparseFrame:
    """variants: contig, position, alleles, s, LA, LGT, LAD and more fields; blocks: contig, start, end, s and fields, those
    of a sample apart from each other; cols: col_idx and s."""

    variants: DataFrame
    blocks: DataFrame
    cols: DataFrame

    def write(self, path: str, mode: str = "overwrite", ranges: bool = False, target_records: int | None = None) -> None:
        """Three tables; that of the columns comes last, so a cohort with whole columns is whole. With ranges, variants and blocks
        are written in genome ranges, so that reading an interval opens few of them: as many as adaptive execution makes, or of
        about target_records each, for which they are counted first."""
        for name, part, at in (("variants", self.variants, "position"), ("blocks", self.blocks, "start"), ("cols", self.cols, None)):
            if at and (ranges or target_records):
                n = [max(1, -(-part.count() // target_records))] if target_records else []
                part = part.repartitionByRange(*n, "contig", at, "s").sortWithinPartitions("contig", at)
            part.write.mode(mode).parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str, intervals: list[tuple[str, int, int]] | None = None) -> SparseFrame:
        """With closed intervals, only variants inside them and blocks that reach into them. Up to FEW_INTERVALS make a test that
        reaches the scan; more are joined."""
        variants, blocks, cols = (spark.read.parquet(f"{path}/{n}") for n in ("variants", "blocks", "cols"))
        if intervals is not None:
            variants = in_intervals(variants, intervals)
            if len(intervals) <= FEW_INTERVALS:
                reach = lambda c, s, e: (F.col("contig") == c) & (F.col("start") <= e) & (F.col("end") >= s)
                blocks = blocks.filter(reduce(lambda x, y: x | y, [reach(*i) for i in intervals], F.lit(False)))
            else:
                frame = F.broadcast(spark.createDataFrame(intervals, "c string, s1 int, e1 int"))
                blocks = blocks.join(frame, (F.col("contig") == F.col("c")) & (F.col("start") <= F.col("e1")) & (F.col("end") >= F.col("s1")), "left_semi")
        return cls(variants, blocks, cols)

    def remove(self, gone: DataFrame) -> SparseFrame:
        """Without these samples, without alternate alleles that no call of the rest carries and sites without any."""
        sites = self.variants.select(*KEY, "alleles").distinct()
        sites, entries = split.remove_samples(sites, self.variants.drop("alleles"), gone, KEY)
        gone = gone.select("s").distinct()
        return SparseFrame(entries.join(sites, KEY), self.blocks.join(gone, "s", "left_anti"), self.cols.join(gone, "s", "left_anti"))

    def combine(self, *others: SparseFrame) -> SparseFrame:
        """These cohorts in one: each site has the longest reference and all alternate alleles, each entry its own by index and
        its likelihoods as they are. Fields that only some cohorts have are missing for the others' entries and blocks. Columns
        follow in the order of the cohorts; a sample that is in two of them is an error."""
        frames = [self, *others]
        cols = reduce(DataFrame.unionByName, [f.cols.select(F.lit(k).alias("_f"), "col_idx", "s") for k, f in enumerate(frames)])
        if both := cols.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("s").limit(10).collect():
            raise ValueError(f"samples are in two cohorts: {[r[0] for r in both]}")
        sizes = dict(cols.groupBy("_f").agg(F.max("col_idx") + 1).collect())  # one row for each cohort that is merged at once
        before = [sum(sizes.get(j, 0) for j in range(k)) for k in range(len(frames))]
        cols = cols.select((F.col("col_idx") + F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_f"))).cast(self.cols.schema["col_idx"].dataType).alias("col_idx"), "s")
        own = lambda v: v.select("*", F.col("alleles")[0].alias("ref"), F.transform(F.filter("LA", lambda a: a > 0), lambda a: F.get("alleles", a)).alias("alts")).drop("alleles", "LA").withColumnsRenamed({"LGT": "GT", "LAD": "AD"})
        union = lambda parts: reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
        _, entries = split.combine(union([own(f.variants) for f in frames]))
        return SparseFrame(entries, union([f.blocks for f in frames]), cols)

    @classmethod
    def merge_tree(cls, frames: list[SparseFrame], path: str, branch: int = 50, target_records: int | None = None) -> SparseFrame:
        """Many cohorts in one, `branch` at a time, level by level, each merge written under path in genome ranges: a plan never
        reads more than `branch` cohorts, and a build that was stopped goes on after the merges that are whole."""
        spark, level = frames[0].cols.sparkSession, 0
        while len(frames) > 1:
            merged = []
            for k, group in enumerate(frames[at : at + branch] for at in range(0, len(frames), branch)):
                out = f"{path}/level-{level}/{k}"
                if not exists(spark, f"{out}/cols"):
                    group[0].combine(*group[1:]).write(out, ranges=True, target_records=target_records)
                merged.append(cls.read(spark, out))
            frames, level = merged, level + 1
        return frames[0]

    def dense(self) -> MatrixFrame:
        """A matrix with an entry for each sample whose variant or reference block is known there; rows with one allele or
        without any non-reference call go. site_dp: sum of depths, ANS: twice the number of calls."""
        v = self.variants
        sites = v.groupBy(*KEY, "alleles").agg(F.bool_or(F.coalesce(is_non_ref(F.col("LGT")), F.lit(False))).alias("_carried")).filter(F.col("_carried") & (F.size("alleles") > 1)).drop("_carried")
        entry = [c for c in v.columns if c not in (*KEY, "alleles", "s")]
        shared = {c for c in self.blocks.columns if c in entry}
        made = {"LA": F.array(F.lit(0)), "LGT": call(F.lit(0), F.lit(0))}
        covered = densify(sites, self.blocks, by=["contig"])
        covered = covered.select(*KEY, "alleles", "s", F.lit(1).alias("_kind"), *[F.col(c) if c in shared else made.get(c, F.lit(None)).cast(v.schema[c].dataType).alias(c) for c in entry])
        cells = v.filter(F.size("alleles") > 1).select(*KEY, "alleles", "s", F.lit(0).alias("_kind"), *entry).unionByName(covered)  # a variant entry comes before a block
        m = MatrixFrame.from_long(cells, self.cols, [*KEY, "alleles"], entry, first="_kind").filter_rows(F.exists(F.col(CELLS)["e"]["LGT"], is_non_ref))
        e = F.col(CELLS)["e"]
        dp = F.aggregate(F.filter(e["DP"], lambda x: x.isNotNull()), F.lit(0).cast("long"), lambda s, x: s + x)
        return m.annotate_rows(site_dp=dp, ANS=(F.size(F.filter(e["LGT"], lambda x: x.isNotNull())) * 2).cast("long"))
