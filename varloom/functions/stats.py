"""Site statistics as JVM expressions: phred, strand bias, exact tests, quality flags."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from varloom.functions.nulls import let, or_missing, strict_case, strict_if
from varloom.functions.variants import is_indel, is_snp

_TABLE = 64


def phred(p: Column) -> Column:
    return F.log10(p) * -10


def log_factorial(n: Column) -> Column:
    """ln n!: from a small table, then Stirling's series, good to about 1e-13."""
    table = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(_TABLE)])
    x = n.cast("double")
    series = x * F.ln(x) - x + 0.5 * F.ln(x * (2 * math.pi)) + 1 / (x * 12) - 1 / (x * x * x * 360) + 1 / (x * x * x * x * x * 1260)
    return F.when(n < _TABLE, F.get(table, n.cast("int"))).otherwise(series)


def fisher_p(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided Fisher exact test of [[a, b], [c, d]]: the sum over tables that aren't likelier."""
    a, b, c, d = (x.cast("int") for x in (a, b, c, d))
    margins = F.struct(a.alias("a"), (a + b).alias("row"), (a + c).alias("col"), (a + b + c + d).alias("n"))

    def test(m):
        row, col, n = m["row"], m["col"], m["n"]
        fixed = log_factorial(row) + log_factorial(n - row) + log_factorial(col) + log_factorial(n - col) - log_factorial(n)
        at = lambda x: -log_factorial(x) - log_factorial(row - x) - log_factorial(col - x) - log_factorial(n - row - col + x)
        tables = F.sequence(F.greatest(F.lit(0), row + col - n), F.least(row, col))
        return let(
            F.struct(fixed.alias("fixed"), (at(m["a"]) + 1e-7).alias("seen")),
            lambda k: F.least(F.lit(1.0), F.aggregate(F.transform(tables, at), F.lit(0.0), lambda s, x: s + F.when(x <= k["seen"], F.exp(k["fixed"] + x)).otherwise(0.0))),
        )

    return let(margins, test)


def _four(sb: Column) -> list[Column]:
    return [sb[i] for i in range(4)]


def fisher_strand(sb: Column, normalise: bool = True, cell: int = 200, above: int = 4, floor: float = 1e-320) -> Column:
    """Phred of the strand test of [ref +, ref -, alt +, alt -]; missing unless the counts sum to more than `above`.

    Counts that sum to more than twice `cell` are scaled to about `cell`, cut to integers; not normalised, they get a
    chi-squared test instead."""
    return let(sb, lambda x: _fisher_strand(x, normalise, cell, above, floor))


def _fisher_strand(sb: Column, normalise: bool, cell: int, above: int, floor: float) -> Column:
    v = [x.cast("double") for x in _four(sb)]
    s = v[0] + v[1] + v[2] + v[3]
    if normalise:
        p = fisher_p(*[F.when(s <= 2 * cell, x).otherwise(x / (s / cell)).cast("int") for x in v])
    else:
        large = (v[0] >= cell) & (v[1] >= cell) & (v[2] >= cell) & (v[3] >= cell)
        a, b, c, d = v
        chi = F.try_divide(s * F.pow(a * d - b * c, F.lit(2)), (a + b) * (c + d) * (a + c) * (b + d))
        p = F.when(large, erfc(F.sqrt(chi / 2))).otherwise(fisher_p(*_four(sb)))
    return or_missing(s > above, F.greatest(F.lit(0.0), phred(F.greatest(p, F.lit(floor)))))


def erfc(x: Column) -> Column:
    """Complementary error function of x >= 0, by Lentz-free continued steps of a fixed rational form (error under 1.2e-7)."""
    t = 1 / (1 + x * 0.5)
    poly = F.lit(0.0)
    for k in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368):
        poly = poly * t + k
    return t * F.exp(-x * x - 1.26551223 + t * poly)


def strand_odds(sb: Column) -> Column:
    """Symmetric odds ratio of [ref +, ref -, alt +, alt -], one added to each count."""
    rf, rr, af, ar = (x.cast("double") + 1 for x in _four(sb))
    ratio = (rf * ar) / (af * rr)
    return F.ln(ratio + 1 / ratio) + F.ln(F.least(rr, rf) / F.greatest(rr, rf)) - F.ln(F.least(af, ar) / F.greatest(af, ar))


def binomial_p(k: Column, n: Column) -> Column:
    """Two-sided test of k successes in n at one half; the distribution is symmetric, so twice the lower tail."""
    m = F.least(k, n - k).cast("int")
    tail = F.aggregate(F.sequence(F.lit(0), m), F.lit(0.0), lambda s, i: s + F.exp(log_factorial(n) - log_factorial(i) - log_factorial(n - i) - n.cast("double") * math.log(2)))
    return F.when(k * 2 == n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * tail))


def lowqual(alleles: Column, qual: Column, snv: int = 60, indel: int = 69) -> Column:
    """Site flag: below the threshold of its kind of variant; mixed sites take the higher one."""
    alts = F.slice(alleles, 2, F.greatest(F.size(alleles) - 1, F.lit(0)))
    every = lambda test: F.forall(alts, lambda alt: test(alleles[0], alt))
    return strict_case([(every(is_snp), qual < snv), (every(is_indel), qual < indel)], qual < max(snv, indel))


def lowqual_by_allele(alleles: Column, quals: Column, snv: int = 60, indel: int = 69) -> Column:
    one = lambda i: strict_if(is_snp(alleles[0], F.get(alleles, i)), F.get(quals, i - 1) < snv, F.get(quals, i - 1) < indel)
    return F.transform(F.sequence(F.lit(1), F.size(alleles) - 1), one)
