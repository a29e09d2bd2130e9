"""Identity of variants: contigs, positions, ids, types, minimal representation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from varloom.functions.nulls import strict_case

# Lengths of the primary contigs of the public GRCh38 assembly.
GRCH38_LENGTHS = {
    "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555, "chr5": 181538259, "chr6": 170805979,
    "chr7": 159345973, "chr8": 145138636, "chr9": 138394717, "chr10": 133797422, "chr11": 135086622, "chr12": 133275309,
    "chr13": 114364328, "chr14": 107043718, "chr15": 101991189, "chr16": 90338345, "chr17": 83257441, "chr18": 80373285,
    "chr19": 58617616, "chr20": 64444167, "chr21": 46709983, "chr22": 50818468, "chrX": 156040895, "chrY": 57227415, "chrM": 16569,
}


def contig_index(contig: Column) -> Column:
    """Place of a primary contig in the assembly's order; others come last."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in zip(GRCH38_LENGTHS, range(len(GRCH38_LENGTHS))) for x in kv])[contig], F.lit(len(GRCH38_LENGTHS)))


def short_contig(contig: Column) -> Column:
    return F.regexp_replace(contig, "^chr", "")


def contig_number(contig: Column, strict: bool = True) -> Column:
    """1-22, X 23, Y 24, M 25. Other contigs fail, or are NULL where not strict."""
    c = short_contig(contig)
    number = c.cast("int") if strict else c.try_cast("int")
    return strict_case([(c == "X", F.lit(23)), (c == "Y", F.lit(24)), (c.startswith("M"), F.lit(25))], number)


def xpos(contig: Column, position: Column) -> Column:
    return contig_number(contig).cast("long") * 1_000_000_000 + position


def _cut(text: Column, length: int | None) -> Column:
    return text if length is None else F.substring(text, 1, length)


def variant_id(contig: Column, position: Column, ref: Column, alt: Column, max_length: int | None = None) -> Column:
    """contig-position-ref-alt without chr."""
    dash = F.lit("-")
    return _cut(F.concat(short_contig(contig), dash, position.cast("string"), dash, ref, dash, alt), max_length)


def variant_ids(contig: Column, position: Column, alleles: Column, max_length: int | None = None) -> Column:
    """An id for each alternate allele; here chr stays."""
    one = lambda alt: _cut(F.concat(contig, F.lit("-"), position.cast("string"), F.lit("-"), alleles[0], F.lit("-"), alt), max_length)
    return F.transform(F.slice(alleles, 2, F.greatest(F.size(alleles) - 1, F.lit(0))), one)


def variant_type(ref: Column, alt: Column) -> Column:
    """D deletion, I insertion, M multi-nucleotide, S single."""
    r, a = F.length(ref), F.length(alt)
    return strict_case([(r > a, F.lit("D")), (r < a, F.lit("I")), (r > 1, F.lit("M"))], F.lit("S"))


def end_position(position: Column, ref: Column) -> Column:
    return position + F.length(ref) - 1


def is_snp(ref: Column, alt: Column) -> Column:
    """One base for another; equal-length alleles with one difference count. The star allele doesn't."""
    differ = F.size(F.filter(F.zip_with(F.split(ref, ""), F.split(alt, ""), lambda x, y: x != y), lambda x: x))
    return (alt != "*") & (F.length(ref) == F.length(alt)) & F.when(F.length(ref) == F.length(alt), differ == 1).otherwise(F.lit(False))


def is_indel(ref: Column, alt: Column) -> Column:
    return (alt != "*") & (F.length(ref) != F.length(alt))


def min_rep(position: Column, ref: Column, alt: Column) -> Column:
    """struct(position, ref, alt) without common ends: the suffix goes first, then the prefix; a base always stays.

    The star allele stays as it is."""
    shorter = F.least(F.length(ref), F.length(alt)) - 1
    ends = F.filter(F.sequence(F.lit(0), shorter), lambda n: F.right(ref, n.cast("int")) == F.right(alt, n.cast("int")))
    cut = F.when(alt == "*", 0).otherwise(F.array_max(ends))
    r, a = F.left(ref, F.length(ref) - cut), F.left(alt, F.length(alt) - cut)
    starts = F.filter(F.sequence(F.lit(0), shorter - cut), lambda n: F.left(r, n.cast("int")) == F.left(a, n.cast("int")))
    skip = F.when(alt == "*", 0).otherwise(F.array_max(starts))
    return F.struct((position + skip).alias("position"), F.substring(r, skip + 1, F.length(r)).alias("ref"), F.substring(a, skip + 1, F.length(a)).alias("alt"))
