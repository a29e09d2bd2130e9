"""Genotype calls, as struct<a0 int, a1 int, phased boolean>; a haploid call has no a1, a missing call is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from varloom.functions.nulls import at_least, fdiv, strict_case, strict_if


def call(a0: Column, a1: Column | None = None, phased: bool = False) -> Column:
    return F.when(a0.isNotNull(), F.struct(a0.cast("int").alias("a0"), (F.lit(None) if a1 is None else a1).cast("int").alias("a1"), F.lit(phased).alias("phased")))


def diploid(n_alt: Column) -> Column:
    """The call that carries an alternate allele n_alt times."""
    return call(F.when(n_alt.isNotNull(), (n_alt > 1).cast("int")), (n_alt > 0).cast("int"))


def is_haploid(gt: Column) -> Column:
    return F.when(gt.isNotNull(), gt["a1"].isNull())


def n_alt_alleles(gt: Column) -> Column:
    return (gt["a0"] > 0).cast("int") + F.coalesce((gt["a1"] > 0).cast("int"), F.lit(0))


def is_non_ref(gt: Column) -> Column:
    return n_alt_alleles(gt) > 0


def is_het(gt: Column) -> Column:
    return F.when(gt.isNotNull(), F.coalesce(gt["a0"] != gt["a1"], F.lit(False)))


def is_het_ref(gt: Column) -> Column:
    return is_het(gt) & (F.least(gt["a0"], gt["a1"]) == 0)


def count_allele(gt: Column, allele) -> Column:
    return (gt["a0"] == allele).cast("int") + F.coalesce((gt["a1"] == allele).cast("int"), F.lit(0))


def num_alt(gt: Column) -> Column:
    """Alternate alleles; -1 for a missing call."""
    return F.when(gt.isNull(), -1).otherwise(n_alt_alleles(gt))


def called(gt: Column, value: Column) -> Column:
    return F.when(gt.isNotNull(), value)


def total(ad: Column) -> Column:
    return F.aggregate(ad, F.lit(0), lambda s, x: s + x)


def allele_balance(gt: Column, ad: Column) -> Column:
    """Share of reads of the second allele, where the call is there and has reads of two alleles."""
    return F.when(gt.isNotNull() & (total(ad) != 0) & (F.size(ad) > 1), (F.get(ad, F.lit(1)) / total(ad)).cast("float"))


def capped_depth(gt: Column, dp: Column, cap: int = 32_000) -> Column:
    """The smaller of depth and cap; a call without depth has the cap, since missing numbers are skipped."""
    return called(gt, F.least(dp, F.lit(cap)).cast("int"))


def adj(gt: Column, gq: Column, dp: Column, ad: Column, min_gq: int = 20, min_dp: int = 10, min_ab: float = 0.2, min_dp_haploid: int = 5) -> Column:
    """Whether a genotype is of high quality; missing where what it needs is missing."""
    share = lambda allele: at_least(fdiv(F.get(ad, allele), dp), min_ab)
    balance = strict_case([(~is_het(gt), F.lit(True)), (is_het_ref(gt), share(gt["a1"]))], share(gt["a0"]) & share(gt["a1"]))
    return (gq >= min_gq) & strict_if(is_haploid(gt), dp >= min_dp_haploid, dp >= min_dp) & balance


def global_call(lgt: Column, la: Column) -> Column:
    """A call of local alleles as one of the site's alleles."""
    return F.when(lgt.isNotNull(), F.struct(F.get(la, lgt["a0"]).alias("a0"), F.get(la, lgt["a1"]).alias("a1"), lgt["phased"].alias("phased")))


def global_array(values: Column, la: Column, n_alleles: Column, fill=0) -> Column:
    """A value for each of the site's alleles from one for each local allele."""
    at = lambda i: F.array_position(la, i.cast("int"))
    return F.when(values.isNotNull(), F.transform(F.sequence(F.lit(0), n_alleles - 1), lambda i: F.when(at(i) > 0, F.get(values, (at(i) - 1).cast("int"))).otherwise(fill)))


def downcode(gt: Column, allele: Column) -> Column:
    """The call with this allele as 1 and all others as 0."""
    one = lambda a: (a == allele).cast("int")
    low, high = F.least(one(gt["a0"]), one(gt["a1"])), F.greatest(one(gt["a0"]), one(gt["a1"]))
    return F.when(gt["a1"].isNull(), call(one(gt["a0"]))).otherwise(F.when(gt["phased"], call(one(gt["a0"]), one(gt["a1"]), True)).otherwise(call(low, high)))


def genotype_number(a: Column, b: Column) -> Column:
    """Place of the genotype of two alleles among likelihoods: 0/0, 0/1, 1/1, 0/2, 1/2, 2/2, ..."""
    low, high = F.least(a, b), F.greatest(a, b)
    return (high * (high + 1) / 2).cast("int") + low


def genotype_pairs(alleles: Column, pair) -> Column:
    """pair(a, b) for each genotype of these alleles, in the order of likelihoods."""
    return F.flatten(F.transform(alleles, lambda b, n: F.transform(F.slice(alleles, F.lit(1), n + 1), lambda a: pair(a, b))))


def subset_likelihoods(pl: Column, kept: Column) -> Column:
    """Likelihoods of the genotypes of the kept alleles (their places), which take their order."""
    return F.when(pl.isNotNull(), F.transform(genotype_pairs(kept, genotype_number), lambda g: F.get(pl, g)))


def global_likelihoods(lpl: Column, la: Column, n_alleles: Column) -> Column:
    """Likelihoods of all genotypes of the site from those of local alleles; missing for a genotype of an unlisted allele."""
    place = lambda a: (F.array_position(la, a) - 1).cast("int")
    one = lambda a, b: F.when((place(a) >= 0) & (place(b) >= 0), F.get(lpl, genotype_number(place(a), place(b))))
    return F.when(lpl.isNotNull(), genotype_pairs(F.sequence(F.lit(0), n_alleles - 1), one))
