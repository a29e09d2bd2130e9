"""Per-sample variant text with reference blocks: read as a sparse cohort, written from one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.calls import genotype_number, genotype_pairs
from varloom.functions.variants import contig_index
from varloom.operators.sparse import SparseFrame
from varloom.sources.readers import parse_call, parse_variants, variant_lines

# Fixed value: the allele that stands for all that were not seen.
NON_REF = "<NON_REF>"
#: Fields of an entry that are read, with their types; GT, AD and PL become LGT, LAD and LPL of local alleles.
FORMAT = {"GQ": "int", "DP": "int", "MIN_DP": "int", "SB": "array<int>", "PID": "string"}

#: Files up to which their names are sent to all tasks.
BROADCAST_NAMES = 500_000


def _number(text: Column, t: str) -> Column:
    if t.startswith("array<"):
        return F.transform(F.split(F.nullif(text, F.lit(".")), ","), lambda x: x.try_cast(t[6:-1]))
    return F.nullif(text, F.lit(".")).try_cast(t)


def sample_names(spark: SparkSession, paths: str | list[str], block_gzip: bool = False) -> DataFrame:
    """(file, s) from the header line of each file. It reads all files once; callers that know the names spare that."""
    return _names(variant_lines(spark, paths, block_gzip))


def _names(lines: DataFrame) -> DataFrame:
    head = lines.filter(F.col("value").startswith("#CHROM\t"))
    return head.select("file", F.get(F.split("value", "\t"), F.lit(9)).alias("s"))


def read_gvcf(spark: SparkSession, paths: str | list[str], names: DataFrame | None = None, info: dict[str, str] | None = None, fields: dict[str, str] | None = None, block_gzip: bool = False) -> SparseFrame:
    """Files of one sample each as a sparse cohort.

    names: (file, s), by full path; without it, the names in the files' headers. Lines whose only alternate is NON_REF, or
    none, are reference blocks from their position to END (or the end of their reference); they keep GQ, DP and, if there,
    MIN_DP. Other lines are variants: NON_REF goes, LA counts the alleles that are left, LAD and LPL are cut to them, and a
    call of NON_REF is missing. info: INFO fields and their types, which make gvcf_info. A field that FORMAT doesn't name, or
    '.', is missing; an element '.' of a list too. Alleles of a site are those of all samples. Contigs and positions aren't
    checked."""
    fields = FORMAT if fields is None else fields
    lines = variant_lines(spark, paths, block_gzip)  # the files are listed once
    raw = parse_variants(lines, {"END": "int"} | (info or {}), genotypes=True)
    names = _names(lines).persist() if names is None else names  # headers are looked for once
    n_files = names.count()
    named = raw.withColumnRenamed("source", "file").join(F.broadcast(names) if n_files <= BROADCAST_NAMES else names, "file")
    keys, values = F.split("format", ":"), F.split(F.get("samples", F.lit(0)), ":")
    has = lambda f: F.get(values, (F.array_position(keys, F.lit(f)) - 1).cast("int"))  # noqa: E731  missing where FORMAT lacks it
    seen = F.filter("alleles", lambda a: a != NON_REF)
    e = named.select("contig", "position", "info", "s", seen.alias("alleles"), parse_call(has("GT")).alias("_gt"), _number(has("AD"), "array<int>").alias("_ad"), _number(has("PL"), "array<int>").alias("_pl"), *[_number(has(f), t).alias(f) for f, t in fields.items()])
    n = F.size("alleles")
    inside = F.col("_gt").isNotNull() & (F.col("_gt.a0") < n) & F.coalesce(F.col("_gt.a1") < n, F.lit(True))
    own = [F.struct(*[F.col(f"info.{f}").alias(f) for f in info]).alias("gvcf_info")] if info else []
    variants = e.filter(n > 1).select(
        "contig", "position", "alleles", "s", F.sequence(F.lit(0), n - 1).alias("LA"), F.when(inside, F.col("_gt")).alias("LGT"), F.slice("_ad", F.lit(1), n).alias("LAD"),
        F.slice("_pl", F.lit(1), (n * (n + 1) / 2).cast("int")).alias("LPL"), *fields, *own,
    )
    end = F.coalesce("info.END", F.col("position") + F.length(F.col("alleles")[0]) - 1)
    blocks = e.filter(n == 1).select("contig", F.col("position").alias("start"), end.alias("end"), "s", *[f for f in ("GQ", "DP", "MIN_DP") if f in fields])
    cols = names.select("s").distinct()
    if (n_cols := cols.count()) <= 1_000_000:
        cols = spark.createDataFrame([(i, r.s) for i, r in enumerate(cols.orderBy("s").collect())], "col_idx long, s string")  # the column axis
    else:
        raise ValueError(f"{n_cols} samples: the column axis holds a million at most")
    return SparseFrame(variants, blocks, cols).combine()  # from each line's alleles to those of the site


def write_gvcf(cohort: SparseFrame, path: str) -> None:
    """A folder s=<sample> for each sample with one file of its variants and blocks in genome order (GT:AD:DP:GQ:PL), header
    first. NON_REF is the last allele of each line; it has no reads, and likelihoods of its genotypes are 99. Each task puts its
    files in place itself, as there are as many as samples; _SUCCESS says that all are there."""
    text = lambda x, none=".": F.coalesce(x.cast("string"), F.lit(none))
    v, la = cohort.variants, F.col("LA")
    n = F.size(la)
    allele = lambda a: text(a)
    gt = F.when(F.col("LGT").isNull(), "./.").when(F.col("LGT.a1").isNull(), allele(F.col("LGT.a0"))).otherwise(F.concat(allele(F.col("LGT.a0")), F.when(F.col("LGT.phased"), "|").otherwise("/"), allele(F.col("LGT.a1"))))
    listed = lambda x: F.coalesce(F.array_join(x.cast("array<string>"), ",", "."), F.lit("."))
    pl = F.lit(".")
    if "LPL" in v.columns:
        pl = listed(genotype_pairs(F.sequence(F.lit(0), n), lambda a, b: F.when(b < n, F.get("LPL", genotype_number(a, b))).otherwise(F.lit(99))))
        pl = F.when(F.col("LPL").isNull(), ".").otherwise(pl)
    ad = F.when(F.col("LAD").isNull(), ".").otherwise(listed(F.concat("LAD", F.array(F.lit(0)))))
    alts = F.array_join(F.concat(F.transform(F.slice(la, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a: F.get("alleles", a)), F.array(F.lit(NON_REF))), ",")
    cell = F.concat_ws(":", gt, ad, text(F.col("DP")), text(F.col("GQ")), pl)
    line = lambda ref, alt, info, form, cell: F.concat_ws("\t", "contig", F.col("position").cast("string"), F.lit("."), ref, alt, F.lit("."), F.lit("."), info, form, cell)
    ci = contig_index(F.col("contig")).alias("ci")
    lines = v.select("s", ci, "position", line(F.col("alleles")[0], alts, F.lit("."), F.lit("GT:AD:DP:GQ:PL"), cell).alias("value"))
    b = cohort.blocks.withColumnRenamed("start", "position")
    block = F.concat_ws(":", F.lit("0/0"), text(F.col("DP")), text(F.col("GQ")))
    lines = lines.unionByName(b.select("s", ci, "position", line(F.lit("N"), F.lit(NON_REF), F.concat(F.lit("END="), F.col("end").cast("string")), F.lit("GT:DP:GQ"), block).alias("value")))
    top = F.array(F.lit("##fileformat=VCFv4.2"), F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), "s"))
    heads = cohort.cols.select("s", F.lit(-1).alias("ci"), F.posexplode(top).alias("position", "value"))
    whole = lines.unionByName(heads.select("s", "ci", "position", "value"))
    whole.repartition("s").sortWithinPartitions("s", "ci", "position").select("s", "value").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("s").text(path)
