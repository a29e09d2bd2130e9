"""Per-variant summaries of a matrix's entries: genotype lists, sample sets in bins, call statistics, interest filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.calls import allele_balance, called, capped_depth, count_allele, num_alt
from varloom.functions.nulls import or_missing, sorted_set
from varloom.operators.joins import lookup  # noqa: F401  part of this module's interface
from varloom.operators.matrix import CELLS

GQ_BINS = [(i, i + 5) for i in range(0, 95, 5)]
AB_BINS = [(i, i + 5) for i in range(0, 45, 5)]


def genotype(e: Column, sample_id: Column) -> Column:
    """{num_alt, gq, ab, ad, dp, sample_id} of an entry."""
    return F.struct(
        num_alt(e["GT"]).alias("num_alt"), called(e["GT"], e["GQ"]).alias("gq"), allele_balance(e["GT"], e["AD"]).alias("ab"),
        called(e["GT"], F.array_join(e["AD"].cast("array<string>"), ",")).alias("ad"), capped_depth(e["GT"], e["DP"]).alias("dp"), sample_id.alias("sample_id"),
    )


def genotype_list(entries: Column, samples: list[str]) -> Column:
    """The genotypes of a row's entries, in the order of the columns."""
    one = lambda e, i: genotype(e, F.get(F.array(*[F.lit(s) for s in samples]), i))
    return F.transform(F.arrays_zip(entries["GT"].alias("GT"), entries["GQ"].alias("GQ"), entries["AD"].alias("AD"), entries["DP"].alias("DP")), one)


def samples_where(genotypes: Column, test) -> Column:
    """Set of the sample ids whose genotype passes."""
    return sorted_set(F.filter(genotypes, test)["sample_id"])


def no_call(genotypes: Column) -> Column:
    return samples_where(genotypes, lambda g: g["num_alt"] == -1)


def _num_alt_is(i: int):
    return lambda g: g["num_alt"] == i


def _gq_in(a: int, b: int):
    return lambda g: (g["gq"] >= a) & (g["gq"] < b)


def _ab_in(a: int, b: int):
    return lambda g: (g["num_alt"] == 1) & (g["ab"] * 100 >= a) & (g["ab"] * 100 < b)


def by_num_alt(genotypes: Column) -> Column:
    return F.struct(*[samples_where(genotypes, _num_alt_is(i)).alias(str(i)) for i in (1, 2)])


def by_gq(genotypes: Column) -> Column:
    """Half-open bins of five up to 95; higher values are in none."""
    return F.struct(*[samples_where(genotypes, _gq_in(a, b)).alias(f"{a}_to_{b}") for a, b in GQ_BINS])


def by_ab(genotypes: Column) -> Column:
    """Percent of allele balance of genotypes with one alternate allele, in half-open bins of five up to 45."""
    return F.struct(*[samples_where(genotypes, _ab_in(a, b)).alias(f"{a}_to_{b}") for a, b in AB_BINS])


def annotate_dataset(matrix, listed: bool = False):
    """A matrix's rows with genotypes and the sample sets that a search index filters by. A column without a cell is a missing
    call, so all columns are in each row; listed: only those with a cell, so rows are as long as what the matrix holds."""
    if listed:
        matrix = matrix.cells()
        made = matrix.annotate_rows(genotypes=F.transform(CELLS, lambda c: genotype(c["e"], c["s"])))
    else:
        made = matrix.annotate_rows(genotypes=genotype_list(F.col("entries"), matrix.sample_ids()))
    g = F.col("genotypes")
    return made.annotate_rows(samples_no_call=no_call(g), samples_num_alt=by_num_alt(g), samples_gq=by_gq(g), samples_ab=by_ab(g))


def variant_qc(cells: DataFrame, keys: list[str], gt: Column, gq: Column, n_alleles: int = 2) -> DataFrame:
    """AC and AF per allele, AN, and mean GQ, from one row per cell. AF is missing where AN is 0."""
    counts = F.array(*[F.coalesce(F.sum(count_allele(gt, a)), F.lit(0)).cast("int") for a in range(n_alleles)])
    ploidy = F.when(gt.isNotNull(), F.when(gt["a1"].isNull(), 1).otherwise(2))
    out = cells.groupBy(*keys).agg(counts.alias("AC"), F.coalesce(F.sum(ploidy), F.lit(0)).cast("int").alias("AN"), F.avg(gq).alias("gq_mean"))
    return out.withColumn("AF", F.transform("AC", lambda c: or_missing(F.col("AN") > 0, c / F.col("AN"))))


def alt_only(qc: DataFrame) -> DataFrame:
    """Of a split site's statistics only the alternate allele's, as scalars."""
    return qc.withColumns({"AC": F.col("AC")[1], "AF": F.col("AF")[1]})


def variants_of_interest(rows: DataFrame, genes: list[str], terms: list[str], callset_af: float = 0.01, population_af: float = 0.01, gq: float = 35) -> DataFrame:
    """Distinct CHROM, POS, REF, ALT and the terms that let it in, of rare, well-called variants of the genes.

    rows: contig, position, ref, alt, gene_ids, AF, population_AF, gq_mean (to be above gq), transcript_consequences.
    Missing frequencies don't pass. Without genes there is nothing to look for, which is an error."""
    if not genes:
        raise ValueError("no genes are given")
    wanted = F.array(*[F.lit(t) for t in terms])
    kept = rows.filter(F.arrays_overlap("gene_ids", F.array(*[F.lit(g) for g in genes])) & (F.col("AF") < callset_af) & (F.col("population_AF") < population_af) & (F.col("gq_mean") > gq))
    each = kept.select("contig", "position", "ref", "alt", F.explode("transcript_consequences").alias("c"))
    each = each.filter(F.arrays_overlap(F.col("c.consequence_terms"), wanted))
    return each.select(F.col("contig").alias("CHROM"), F.col("position").alias("POS"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"), F.array_join(sorted_set(F.array_intersect(F.col("c.consequence_terms"), wanted)), ",").alias("FILTER_CRITERIA")).distinct()
