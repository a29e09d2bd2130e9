"""Variant text shards with a manifest, key tables as TSV, BED files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions.variants import GRCH38_LENGTHS, contig_index
from varloom.sources.blockgzip import write_lines
from varloom.sources.files import list_files
from varloom.sources.readers import variant_lines
from varloom.sources.regions import write_index

_KIND = {T.IntegerType: "Integer", T.LongType: "Integer", T.FloatType: "Float", T.DoubleType: "Float", T.BooleanType: "Flag"}


def header(schema: T.StructType, samples: list[str] | None = None, formats: dict[str, tuple[str, str]] | None = None) -> list[str]:
    """Header lines for the fields of a site table (and genotypes)."""
    lines = ["##fileformat=VCFv4.2", *[f"##contig=<ID={c},length={n}>" for c, n in GRCH38_LENGTHS.items()]]
    if "info" in schema.names:
        for f in schema["info"].dataType.fields:
            many = isinstance(f.dataType, T.ArrayType)
            kind = _KIND.get(type(f.dataType.elementType if many else f.dataType), "String")
            lines.append(f'##INFO=<ID={f.name},Number={"." if many else 0 if kind == "Flag" else 1},Type={kind},Description="">')
    lines += [f'##FORMAT=<ID={k},Number={n},Type={t},Description="">' for k, (n, t) in (formats or {}).items()]
    return [*lines, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *samples] if samples else [])])]


def _info(schema: T.StructType) -> Column:
    parts = []
    for f in schema["info"].dataType.fields if "info" in schema.names else ():
        x = F.col(f"info.`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            parts.append(F.when(x, F.lit(f.name)))
        else:
            text = F.array_join(x.cast("array<string>"), ",", ".") if isinstance(f.dataType, T.ArrayType) else x.cast("string")
            parts.append(F.concat(F.lit(f"{f.name}="), text))
    text = F.concat_ws(";", *parts) if parts else F.lit("")
    return F.when(text == "", F.lit(".")).otherwise(text)


def site_lines(df: DataFrame) -> Column:
    """A line of eight fields from contig, position, alleles and, if there, rsid, qual, filters, info."""
    has = set(df.columns)
    qual = F.coalesce(F.col("qual").cast("string"), F.lit(".")) if "qual" in has else F.lit(".")
    flt = F.when(F.size("filters") > 0, F.array_join(F.array_sort("filters"), ";")).when(F.size("filters") == 0, "PASS").otherwise(".") if "filters" in has else F.lit(".")
    alts = F.array_join(F.slice("alleles", 2, F.greatest(F.size("alleles") - 1, F.lit(0))), ",")
    rsid = F.coalesce("rsid", F.lit(".")) if "rsid" in has else F.lit(".")
    return F.concat_ws("\t", "contig", F.col("position").cast("string"), rsid, F.col("alleles")[0], F.when(alts == "", ".").otherwise(alts), qual, flt, _info(df.schema))


def _sorted(df: DataFrame, shards: int) -> DataFrame:
    ci = contig_index(F.col("contig"))
    return df.repartitionByRange(shards, ci, "position").sortWithinPartitions(ci, "position")


def write_sites(df: DataFrame, path: str, shards: int, separate_header: bool = False, compression: str = "gzip", index: bool = False) -> list[str]:
    """Shards of site lines in genome order and their manifest (shard-manifest.txt, returned as a list).

    A header stands in each shard, or, separate, in a first file of its own (00000-header). Readers go by the manifest.
    compression: block for block gzip, else one that Spark's text writer has. index: whether each block gzip shard gets a
    position index beside it, which the manifest doesn't list."""
    if index and compression != "block":
        raise ValueError("only block gzip has position indexes")
    spark = df.sparkSession
    head = header(df.schema)
    body = _sorted(df, shards).select(site_lines(df).alias("value"))

    def with_header(batches):
        import pyarrow as pa

        first = True
        for b in batches:
            yield pa.RecordBatch.from_pydict({"value": pa.array([*(head if first else []), *b.column(0).to_pylist()], pa.string())})
            first = False

    if compression == "block":
        write_lines(body, f"{path}/parts", head=None if separate_header else head)
    else:
        body = body if separate_header else body.mapInArrow(with_header, "value string")
        body.write.mode("overwrite").option("compression", compression).text(f"{path}/parts")
    names = []
    if separate_header:
        spark.createDataFrame([(x,) for x in head], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/00000-header")
        names.append("00000-header")
    names += [f"parts/{f.rsplit('/', 1)[-1]}" for f in list_files(spark, f"{path}/parts")]
    if index:
        write_index(spark, f"{path}/parts")
    spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(f"{path}/shard-manifest.txt")
    return names


def write_matrix(matrix, path: str, shards: int = 1, compression: str = "none", index: bool = False) -> list[str]:
    """All rows with a genotype for each sample (GT:GQ:DP:AD), in genome order; one file where shards is 1, else parts that are
    one when laid end to end, the header in the first. Returns the parts' names in order.

    compression and index: as in write_sites(). So a matrix of any size is written by many tasks, each of its parts can be
    read by regions, and plans/compose.py says how the parts become one file."""
    if index and compression != "block":
        raise ValueError("only block gzip has position indexes")
    m, samples = matrix.cells(), matrix.sample_ids()

    def cell(x):
        allele = lambda a: F.coalesce(a.cast("string"), F.lit("."))
        gt = F.when(x["GT"].isNull(), "./.").when(x["GT"]["a1"].isNull(), allele(x["GT"]["a0"])).otherwise(F.concat(allele(x["GT"]["a0"]), F.when(x["GT"]["phased"], "|").otherwise("/"), allele(x["GT"]["a1"])))
        return F.concat_ws(":", gt, F.coalesce(x["GQ"].cast("string"), F.lit(".")), F.coalesce(x["DP"].cast("string"), F.lit(".")), F.coalesce(F.array_join(x["AD"].cast("array<string>"), ","), F.lit(".")))

    absent = lambda k: F.repeat(F.lit("\t./.:.:.:."), k)
    each, rest = m.gaps(lambda x, k: F.concat(absent(k), F.lit("\t"), cell(x["e"])), absent)
    line = F.concat(site_lines(m.held), F.lit("\tGT:GQ:DP:AD"), F.array_join(each, ""), rest)
    formats = {"GT": ("1", "String"), "GQ": ("1", "Integer"), "DP": ("1", "Integer"), "AD": ("R", "Integer")}
    head = header(matrix.held.schema, samples, formats)
    spark = matrix.held.sparkSession
    rows = m.held.withColumns({"_ci": contig_index(F.col("contig")), "_i": F.col("position").cast("long"), "_head": F.lit(None).cast("string")})
    if compression != "block":
        top = spark.createDataFrame([(-1, i, x) for i, x in enumerate(head)], "_ci int, _i long, _head string")
        rows = top.unionByName(rows, allowMissingColumns=True)
    # rows are dealt and sorted by the cells that are there; lines, with all columns, are made as they are written
    whole = rows.repartitionByRange(shards, "_ci", "_i").sortWithinPartitions("_ci", "_i").select(F.coalesce("_head", line).alias("value"))
    if compression == "block":
        names = write_lines(whole, path, head=head, head_once=True)
        if index:
            write_index(spark, path)
        return names
    whole.write.mode("overwrite").option("compression", compression).text(path)
    return [f.rsplit("/", 1)[-1] for f in list_files(spark, path)]


def concat_fragments(spark: SparkSession, fragments: list[str], path: str, shards: int, block_gzip: bool = False) -> list[str]:
    """Variant text fragments, which may overlap, as one file in genome order: block gzip parts that are it when laid end to end
    (plans/compose.py says how), the header of the first fragment in the first. Returns the parts' names in order.

    Lines stay as they are; those of one position follow each other by fragment, then text. Fragments with other columns are an
    error. One shuffle by ranges of the genome merges all fragments at once, so neither a task nor a level of merges reads
    everything. block_gzip: whether the fragments are; gzip ones that aren't are a task each."""
    lines = variant_lines(spark, fragments, block_gzip)
    heads = [r[0] for r in lines.filter(F.col("value").startswith("#CHROM")).select("value").distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError("the fragments have no header line or several" if heads else "no fragment has a header line")
    head = [r[0] for r in variant_lines(spark, fragments[:1], block_gzip).filter(F.col("value").startswith("##")).select("value").collect()]
    f = F.split("value", "\t", 3)
    order = spark.createDataFrame([(file, i) for i, x in enumerate(fragments) for file in list_files(spark, x)], "file string, nth int")  # as long as the list
    body = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).join(F.broadcast(order), "file", "left")
    body = body.select(contig_index(f[0]).alias("ci"), f[0].alias("contig"), f[1].cast("int").alias("position"), "nth", "value")
    by = ["ci", "contig", "position", "nth", "value"]
    return write_lines(body.repartitionByRange(shards, *by).sortWithinPartitions(*by), path, head=[*head, heads[0]], head_once=True)


def write_tsv(df: DataFrame, path: str) -> None:
    """A small result as one tab-separated file with a header."""
    df.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def bed_lines(intervals: list[tuple[str, int, int]]) -> list[str]:
    """Zero-based, half-open lines of closed one-based intervals."""
    return [f"{c}\t{s - 1}\t{e}" for c, s, e in intervals]
