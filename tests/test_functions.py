"""Semantics of missing values, calls, identity, statistics and consequences on hand-made rows."""

import math
from itertools import product

import pytest
from pyspark.sql import functions as F

from varloom.functions import calls, consequences, stats, variants
from varloom.functions.nulls import at_least, cap_int32, fdiv, strict_case, strict_if



def sql(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_missing_conditions_give_missing(spark):
    null = F.lit(None).cast("boolean")
    assert sql(spark, strict_if(null, F.lit(1), F.lit(2))) is None
    assert sql(spark, strict_if(F.lit(False), F.lit(1), F.lit(2))) == 2
    assert sql(spark, strict_case([(F.lit(False), F.lit("a")), (null, F.lit("b"))], F.lit("c"))) is None
    assert sql(spark, strict_case([(F.lit(True), F.lit("a")), (null, F.lit("b"))], F.lit("c"))) == "a"


def test_float_division(spark):
    d = lambda a, b: sql(spark, fdiv(F.lit(a).cast("double"), F.lit(b).cast("double")))
    assert d(1, 0) == math.inf and d(-1, 0) == -math.inf and math.isnan(d(0, 0)) and d(1, 4) == 0.25 and d(None, 1) is None and d(1, None) is None
    assert sql(spark, at_least(F.lit(math.nan), 0.2)) is False


def test_int_cap(spark):
    assert sql(spark, cap_int32(F.lit(2**40))) == 2**31 - 1 and sql(spark, cap_int32(F.lit(-5))) == -5
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        sql(spark, cap_int32(F.lit(-(2**40))))


def gt(a, b=None, phased=False):
    return calls.call(F.lit(a), F.lit(b).cast("int") if b is not None else None, phased)


def none():
    return F.lit(None).cast("struct<a0:int,a1:int,phased:boolean>")


def ints(*x):
    return F.array(*[F.lit(v).cast("int") for v in x])


def test_calls(spark):
    n = lambda c: sql(spark, calls.num_alt(c))
    assert [n(none()), n(gt(0, 0)), n(gt(0, 1)), n(gt(1, 2)), n(gt(1, 1)), n(gt(1)), n(gt(0))] == [-1, 0, 1, 2, 2, 1, 0]
    assert [sql(spark, calls.is_het(x)) for x in (none(), gt(0, 0), gt(0, 1), gt(1, 2), gt(1))] == [None, False, True, True, False]
    assert [sql(spark, calls.is_het_ref(x)) for x in (gt(0, 1), gt(1, 2), gt(1, 1))] == [True, False, False]
    ab = lambda c, *ad: sql(spark, calls.allele_balance(c, ints(*ad)))
    assert ab(gt(0, 1), 6, 2) == 0.25 and ab(gt(0, 1), 6) is None and ab(gt(0, 1), 0, 0) is None and ab(none(), 6, 2) is None
    dp = lambda c, d: sql(spark, calls.capped_depth(c, F.lit(d).cast("int")))
    assert dp(gt(0, 1), 40_000) == 32_000 and dp(gt(0, 1), None) == 32_000 and dp(none(), 3) is None and dp(gt(0, 0), 7) == 7


def test_adj(spark):
    a = lambda c, gq, d, *ad: sql(spark, calls.adj(c, F.lit(gq).cast("int"), F.lit(d).cast("int"), ints(*ad)))
    assert a(gt(0, 1), 20, 10, 8, 2) is True and a(gt(0, 1), 20, 10, 9, 1) is False and a(gt(0, 1), 19, 10, 5, 5) is False and a(gt(0, 1), 20, 9, 5, 5) is False
    assert a(gt(1), 20, 5, 0, 5) is True and a(gt(1, 2), 30, 10, 0, 8, 2) is True and a(gt(1, 2), 30, 10, 0, 9, 1) is False
    assert a(gt(0, 0), 30, 10, 10, 0) is True and a(gt(0, 1), None, 10, 5, 5) is None and a(gt(0, 1), None, 5, 5, 5) is False
    assert a(gt(0, 1), 30, 0, 0, 0) is False


def test_local_to_global(spark):
    g = sql(spark, calls.global_call(gt(0, 1), ints(0, 3)))
    assert (g.a0, g.a1) == (0, 3)
    assert sql(spark, calls.global_array(ints(5, 6), ints(0, 2), F.lit(4))) == [5, 0, 6, 0]
    down = lambda c, i: tuple(sql(spark, calls.downcode(c, F.lit(i))))[:2]
    assert down(gt(1, 2), 1) == (0, 1) and down(gt(1, 2), 2) == (0, 1) and down(gt(2, 2), 2) == (1, 1) and down(gt(2), 2) == (1, None) and down(gt(0, 3), 1) == (0, 0)


def test_identity(spark):
    num = lambda c: sql(spark, variants.contig_number(F.lit(c)))
    assert [num(c) for c in ("chr1", "22", "chrX", "Y", "chrM", "MT")] == [1, 22, 23, 24, 25, 25]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        num("chrUn_1")
    assert sql(spark, variants.contig_number(F.lit("chrUn_1"), strict=False)) is None
    assert sql(spark, variants.variant_id(F.lit("chr1"), F.lit(5), F.lit("A"), F.lit("T"))) == "1-5-A-T"
    assert sql(spark, variants.variant_ids(F.lit("chr1"), F.lit(5), F.array(*map(F.lit, "ATG")))) == ["chr1-5-A-T", "chr1-5-A-G"]
    assert sql(spark, variants.variant_ids(F.lit("chr1"), F.lit(5), F.array(F.lit("A")))) == []
    assert [sql(spark, variants.variant_type(F.lit(r), F.lit(a))) for r, a in (("A", "AT"), ("AT", "A"), ("AT", "GC"), ("A", "C"))] == ["I", "D", "M", "S"]
    assert sql(spark, variants.xpos(F.lit("chr2"), F.lit(7))) == 2_000_000_007
    snp = lambda r, a: sql(spark, variants.is_snp(F.lit(r), F.lit(a)))
    assert snp("A", "C") and snp("AT", "AC") and not snp("AT", "GC") and not snp("A", "*") and not snp("A", "AT") and not sql(spark, variants.is_indel(F.lit("A"), F.lit("*")))


def trim(pos, ref, alt):
    while len(ref) > 1 and len(alt) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    return pos, ref, alt


def test_minimal_alleles(spark):
    alleles = ["".join(x) for n in (1, 2, 3) for x in product("AC", repeat=n)] + ["ACGTAC", "ACAC"]
    rows = [(r, a) for r in alleles for a in alleles if r != a]
    df = spark.createDataFrame(rows, "ref string, alt string")
    got = df.select("ref", "alt", variants.min_rep(F.lit(10), F.col("ref"), F.col("alt")).alias("m")).collect()
    assert all(tuple(x.m) == trim(10, x.ref, x.alt) for x in got)
    assert tuple(sql(spark, variants.min_rep(F.lit(3), F.lit("AT"), F.lit("*")))) == (3, "AT", "*")


def fisher(a, b, c, d):
    lf = lambda n: math.lgamma(n + 1)
    r, k, n = a + b, a + c, a + b + c + d
    p = lambda x: math.exp(lf(r) + lf(n - r) + lf(k) + lf(n - k) - lf(n) - lf(x) - lf(r - x) - lf(k - x) - lf(n - r - k + x))
    return min(1, sum(p(x) for x in range(max(0, r + k - n), min(r, k) + 1) if p(x) <= p(a) * (1 + 1e-7)))


def test_exact_tests(spark):
    import random

    rng = random.Random(1)
    rows = [tuple(rng.randrange(0, 60) for _ in range(4)) for _ in range(200)] + [(0, 0, 0, 0), (100, 100, 100, 100), (200, 0, 0, 200)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    for r in df.select("*", stats.fisher_p(*map(F.col, "abcd")).alias("p")).collect():
        assert r.p == pytest.approx(fisher(r.a, r.b, r.c, r.d), rel=1e-6, abs=1e-12)
    pairs = [(k, n) for n in (1, 2, 7, 64, 65, 130, 2000) for k in (0, n // 3, n // 2, n)]
    for r in spark.createDataFrame(pairs, "k int, n int").select("*", stats.binomial_p(F.col("k"), F.col("n")).alias("p")).collect():
        m = min(r.k, r.n - r.k)
        want = 1 if 2 * r.k == r.n else min(1, 2 * sum(math.comb(r.n, i) for i in range(m + 1)) / 2**r.n)
        assert r.p == pytest.approx(want, rel=1e-8, abs=1e-300)


def test_strand(spark):
    fs = lambda *x, **k: sql(spark, stats.fisher_strand(ints(*x), **k))
    assert fs(1, 1, 1, 1) is None and fs(1, 1, 1, 2) == pytest.approx(0, abs=1e-9) and fs(10, 0, 0, 10) == pytest.approx(-10 * math.log10(fisher(10, 0, 0, 10)))
    scaled = [int(x / (1200 / 200)) for x in (500, 100, 100, 500)]
    assert fs(500, 100, 100, 500) == pytest.approx(-10 * math.log10(fisher(*scaled)), rel=1e-6)
    assert fs(300, 310, 305, 290, normalise=False) == pytest.approx(-10 * math.log10(math.erfc(math.sqrt(1205 * (300 * 290 - 310 * 305) ** 2 / (610 * 595 * 605 * 600) / 2))), rel=1e-4)
    assert sql(spark, stats.strand_odds(ints(0, 0, 0, 0))) == pytest.approx(math.log(2))
    assert sql(spark, stats.phred(F.lit(1e-320))) == pytest.approx(3200, abs=1e-3)


def test_lowqual(spark):
    q = lambda alleles, x: sql(spark, stats.lowqual(F.array(*map(F.lit, alleles)), F.lit(x), 60, 70))
    assert q(["A", "C"], 59) and not q(["A", "C"], 60) and q(["A", "AT"], 69) and q(["A", "C", "AT"], 69) and not q(["A", "C", "AT"], 70)
    assert sql(spark, stats.lowqual_by_allele(F.array(F.lit("A"), F.lit("C"), F.lit("AT")), ints(65, 65), 60, 70)) == [False, True]


TRANSCRIPT = "transcript_id string, gene_id string, biotype string, canonical int, hgvsc string, hgvsp string, consequence_terms array<string>, domains array<struct<db:string,name:string>>"


def test_consequences(spark):
    rows = [
        ("t1", "g1", None, None, "c:1", None, ["upstream_gene_variant"], []),
        ("t2", "g1", "protein_coding", 1, "c:2", "p:2", ["missense_variant", "splice_region_variant"], [{"db": "D", "name": "x"}, {"db": "D", "name": "x"}]),
        ("t3", "g2", "lncRNA", 1, "c:3", "p:3", ["stop_gained", "downstream_gene_variant"], []),
        ("t4", "g2", "protein_coding", None, "c:4", "p:4", ["unknown_term"], None),
        ("t5", "g3", "protein_coding", 1, "c:5", "p:5%3D", ["synonymous_variant"], []),
    ]
    df = spark.createDataFrame([(rows,)], f"t array<struct<{TRANSCRIPT}>>")
    s = df.select(consequences.sorted_transcripts(F.col("t"), F.lit("missense_variant"), ["transcript_id", "gene_id", "biotype", "canonical", "hgvsc", "hgvsp", "domains"]).alias("s"))
    got = s.first().s
    assert [(x.transcript_id, x.category, x.major_consequence, x.transcript_rank) for x in got] == [
        ("t2", "missense", "missense_variant", 0), ("t5", "synonymous", "synonymous_variant", 1), ("t4", None, "unknown_term", 2), ("t3", "lof", "stop_gained", 3),
    ]
    assert [x.hgvs for x in got] == ["2", None, "4", "3"]
    m = s.select(consequences.main_transcript(F.col("s"), ["transcript_id", "domains"]).alias("m")).first().m
    assert tuple(m) == ("t2", "D:x")
    empty = df.select(consequences.main_transcript(consequences.sorted_transcripts(F.array().cast(df.schema["t"].dataType), F.lit("x"), ["transcript_id", "hgvsc", "domains"]), ["transcript_id", "hgvsc"]).alias("m")).first().m
    assert tuple(empty) == (None, None)
    sets = df.select(consequences.terms_set(F.col("t")).alias("a"), consequences.gene_set(F.col("t"), True).alias("b"), consequences.domain_set(F.filter("t", lambda x: x["domains"].isNotNull())).alias("c")).first()
    assert sets.b == ["g1", "g2", "g3"] and sets.c == ["D:x"] and "stop_gained" in sets.a
    text = s.select(consequences.gene_consequences(F.col("s"), F.array(F.lit("g1"), F.lit("g3"))).alias("x")).first().x
    assert text == '{"g1":"missense_variant","g3":"synonymous_variant"}'


def test_hgvs(spark):
    h = lambda c, p, major, aa=None, start=None: sql(spark, consequences.hgvs(*[F.lit(x).cast("string") for x in (c, p, major, aa, start)]))
    assert h("E:c.1A>T", None, "missense_variant") == "c.1A>T" and h("E:c.1A>T", "P:p.Arg5Lys", "splice_donor_variant") == "c.1A>T"
    assert h("E:c.1", "P:p.Arg5Lys", "missense_variant") == "p.Arg5Lys" and h("E:c.1", "P:p.Arg5%3D", "synonymous_variant", "R", "5") == "p.Arg5Arg"
