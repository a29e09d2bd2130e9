"""Readers: variant text, consequence JSON, BED, interval lists, manifests, id files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.sources.blockgzip import read_lines
from varloom.sources.files import packed
from varloom.sources.regions import region_lines


def lines_of(spark: SparkSession, path: str) -> list[str]:
    """A small file's lines, by Spark's reader so that any store works, in order."""
    text = spark.read.text(path, wholetext=True).first()
    return text[0].splitlines() if text else []


def variant_lines(spark: SparkSession, paths: str | list[str], block_gzip: bool = False) -> DataFrame:
    """value and file of the lines of text files, plain or gzip; a gzip file is one task at most unless it is read as block gzip."""
    return read_lines(spark, paths) if block_gzip else packed(spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file")))


def read_variants(spark: SparkSession, paths: str | list[str], info: dict[str, str] | None = None, genotypes: bool = False, block_gzip: bool = False, intervals: list[tuple[str, int, int]] | None = None) -> DataFrame:
    """Sites of variant text files (plain, gzip or block gzip): contig, position, rsid, alleles, qual, filters, info.

    intervals: closed and one-based; only sites whose reference allele (or block up to END) overlaps one are read, and only
    their blocks, from block gzip files with position indexes.

    info stays a map of texts, so that a field with a wrong declared type does no harm; the named fields (name: Spark
    type, arrays split at commas) become a struct instead. genotypes: also format, samples (the texts after FORMAT) and source."""
    lines = variant_lines(spark, paths, block_gzip) if intervals is None else region_lines(spark, [paths] if isinstance(paths, str) else paths, intervals)
    return parse_variants(lines, info, genotypes)


def parse_variants(lines: DataFrame, info: dict[str, str] | None = None, genotypes: bool = False) -> DataFrame:
    """The same of lines (value, file) that were read."""
    raw = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    pairs = F.when(f[7] != ".", F.transform(F.split(f[7], ";"), lambda x: F.struct(F.split(x, "=", 2)[0].alias("k"), F.get(F.split(x, "=", 2), F.lit(1)).alias("v"))))
    fields = F.map_from_entries(F.coalesce(pairs, F.array().cast("array<struct<k:string,v:string>>")))
    as_map = fields if info is None else F.struct(*[(F.map_contains_key(fields, k) if t == "boolean" else _typed(fields[k], t)).alias(k) for k, t in info.items()])
    filters = F.when(f[6] == ".", F.lit(None)).when(f[6] == "PASS", F.array().cast("array<string>")).otherwise(F.split(f[6], ";"))
    alts = F.when(f[4] == ".", F.array().cast("array<string>")).otherwise(F.split(f[4], ","))
    more = [F.get(f, F.lit(8)).alias("format"), F.slice(f, 10, 1_000_000).alias("samples"), F.col("file").alias("source")] if genotypes else []
    return raw.select(f[0].alias("contig"), f[1].cast("int").alias("position"), F.nullif(f[2], F.lit(".")).alias("rsid"), F.concat(F.array(f[3]), alts).alias("alleles"), f[5].try_cast("double").alias("qual"), filters.alias("filters"), as_map.alias("info"), *more)


def _typed(x: Column, t: str) -> Column:
    if t.startswith("array<"):
        inner = t[6:-1]
        return F.transform(F.split(x, ","), lambda v: v.try_cast(inner))
    return x.try_cast(t)


def parse_call(text: Column) -> Column:
    """0/1, 1|1, 1 or ./. as a call; any missing allele makes it missing."""
    a = F.split(text, "[/|]")
    first, second = a[0].try_cast("int"), F.get(a, F.lit(1)).try_cast("int")
    missing = first.isNull() | ((F.size(a) > 1) & second.isNull())
    return F.when(~missing, F.struct(first.alias("a0"), second.alias("a1"), text.contains("|").alias("phased")))


def read_recalibrated(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Recalibrated sites for lookups: key, info without allele-specific and strand fields, filters."""
    sites = read_variants(spark, path)
    return sites.select("contig", "position", "alleles", F.map_filter("info", lambda k, _: ~(k.startswith("AS_") | (k == "SB"))).alias("info"), "filters")


# The annotator's JSON document, as far as the engine reads it.
_CONSEQUENCE = """allele_string string, transcript_consequences array<struct<allele_num int, amino_acids string, appris string, biotype string, canonical int,
cdna_start int, cdna_end int, codons string, consequence_terms array<string>, distance int, domains array<struct<db string, name string>>, exon string,
gene_id string, gene_symbol string, hgvsc string, hgvsp string, impact string, intron string, lof string, lof_filter string, lof_flags string, lof_info string,
polyphen_prediction string, polyphen_score double, protein_id string, protein_start int, protein_end int, sift_prediction string, sift_score double,
strand int, transcript_id string, variant_allele string>>, intergenic_consequences array<struct<allele_num int, consequence_terms array<string>, impact string, variant_allele string>>,
input string, most_severe_consequence string, seq_region_name string, start int, end int, strand int, variant_class string"""


def consequence_ddl() -> str:
    return " ".join(_CONSEQUENCE.split("\n"))


def read_consequences(spark: SparkSession, paths: str | list[str], ddl: str | None = None) -> DataFrame:
    """One JSON document a line under a declared schema: contig, position, alleles, vep. The key is in the document's input
    line (fields 1, 3 and 4); a field of a wrong type is NULL."""
    doc = spark.read.text(paths).select(F.from_json("value", ddl or consequence_ddl()).alias("vep"))
    f = F.split(F.col("vep.input"), "\t")
    return doc.select(F.col("vep.seq_region_name").alias("contig"), f[1].cast("int").alias("position"), F.array(f[3], f[4]).alias("alleles"), "vep")


def read_bed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Closed one-based intervals of a BED file."""
    out = []
    for line in lines_of(spark, path):
        f = line.split()
        if f:
            out.append((f[0], int(f[1]) + 1, int(f[2])))
    return out


def read_meres(spark: SparkSession, path: str) -> tuple[dict[str, tuple[int, int]], list[tuple[str, int, int]]]:
    """(centromeres by contig, telomeres) of an interval list; the last centromere of a contig counts."""
    centromeres, telomeres = {}, []
    for line in lines_of(spark, path):
        if line.startswith("@") or not line.strip():
            continue
        contig, start, end, _, kind = line.split("\t")[:5]
        if "centromere" in kind:
            centromeres[contig] = (int(start), int(end))
        else:
            telomeres.append((contig, int(start), int(end)))
    return centromeres, telomeres


def read_manifest(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(fragment, its index file) in the manifest's order, beside the manifest."""
    root = path.rstrip("/").rsplit("/", 1)[0]
    return [(f"{root}/{n.strip()}", f"{root}/{n.strip()}.tbi") for n in lines_of(spark, path) if n.strip()]


def read_ids(spark: SparkSession, path: str) -> list[str]:
    return [x.strip() for x in lines_of(spark, path) if x.strip()]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written whole."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def checkpoint(df: DataFrame, path: str, reuse: bool = False) -> DataFrame:
    """Write and read again; with reuse, a table that is whole is only read."""
    if not (reuse and exists(df.sparkSession, path)):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
