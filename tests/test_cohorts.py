"""Block gzip, sample files, merge trees, likelihoods, and the plans of site statistics."""

import gzip
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from varloom.functions import calls
from varloom.operators import info, joins, split
from varloom.operators.sparse import SparseFrame
from varloom.sources import blockgzip, gvcf, readers


def many_lines():
    rng = random.Random(4)
    lines = [f"ü{i}\t" + "".join(rng.choice("ACGT0123xyz") for _ in range(rng.choice([0, 3, 60, 400]))) for i in range(6_000)]
    return [*lines, "", "z" * 300_000, "", "last"]


def written(spark, path, lines, parts=2, **options):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").repartitionByRange(parts, "i").sortWithinPartitions("i")
    return blockgzip.write_lines(df, path, **options)


def test_block_gzip_is_read_in_many_tasks(spark, tmp_path):
    lines, path = many_lines(), f"file://{tmp_path}/out"
    names = written(spark, path, lines, head=["#h"])
    assert len(names) == 2
    whole = b"".join((tmp_path / "out" / n).read_bytes() for n in names)
    assert Counter(gzip.decompress(whole).decode()[:-1].split("\n")) == Counter(lines + ["#h"] * 2)
    (tmp_path / "one.vcf.gz").write_bytes(whole)  # files laid end to end are a file, and .gz isn't taken for plain gzip
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20k", "70k", "10m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for p in (path, f"file://{tmp_path}/one.vcf.gz"):
                got = blockgzip.read_lines(spark, p)
                assert Counter(r.value for r in got.collect()) == Counter(lines + ["#h"] * 2)
            if size == "20k":
                assert got.rdd.getNumPartitions() > 10
                assert {r.file for r in got.select("file").distinct().collect()} == {f"file:{tmp_path}/one.vcf.gz"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_block_gzip_edges(spark, tmp_path):
    for k, lines in enumerate((["no line end in the only block"], ["", "", ""], ["a" * 200_000])):
        written(spark, f"file://{tmp_path}/{k}", lines, 1)
        assert sorted(r.value for r in blockgzip.read_lines(spark, f"file://{tmp_path}/{k}").collect()) == sorted(lines)
    (tmp_path / "bare.bgz").write_bytes(blockgzip.deflate(b"a\nb") + blockgzip.deflate(b"c") + blockgzip.END)  # no line end at the end
    assert sorted(r.value for r in blockgzip.read_lines(spark, f"file://{tmp_path}/bare.bgz").collect()) == ["a", "bc"]
    (tmp_path / "plain.gz").write_bytes(gzip.compress(b"a\nb\n"))
    with pytest.raises(Exception, match="not block gzip"):
        blockgzip.read_lines(spark, f"file://{tmp_path}/plain.gz").collect()
    broken = bytearray(blockgzip.deflate(b"some text here"))
    broken[-6] ^= 1
    (tmp_path / "broken.bgz").write_bytes(bytes(broken) + blockgzip.END)
    with pytest.raises(Exception, match="length and checksum"):
        blockgzip.read_lines(spark, f"file://{tmp_path}/broken.bgz").collect()
    with pytest.raises(ValueError, match="no such file"):
        blockgzip.read_lines(spark, f"file://{tmp_path}/nowhere")


GVCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{s}
chr1\t10\t.\tA\t<NON_REF>\t.\t.\tEND=19\tGT:DP:GQ:MIN_DP\t0/0:30:50:20
chr1\t20\t.\tA\t{alt},<NON_REF>\t50\t.\tQUALapprox=70;MQ=x\tGT:AD:DP:GQ:PL\t0/1:10,5,0:15:40:40,0,60,70,80,90
chr1\t30\t.\tAC\t<NON_REF>\t.\t.\t.\tGT:GQ\t0/0:.
chr1\t40\t.\tA\tC,G,<NON_REF>\t.\t.\tQUALapprox=.\tGT:AD:GQ:PL\t1/3:.:9:1,2,3,4,5,6,7,8,9,10
chr2\t5\t.\tA\tT,<NON_REF>\t.\t.\t.\tGT:PL\t1:.
"""


def test_gvcf_lines_become_entries_and_blocks(spark, tmp_path):
    for s, alt in (("S1", "C"), ("S2", "T")):
        (tmp_path / f"{s}.g.vcf").write_text(GVCF.format(s=s, alt=alt))
    for names in (None, spark.createDataFrame([(f"file:{tmp_path}/{s}.g.vcf", s) for s in ("S1", "S2")], "file string, s string")):
        c = gvcf.read_gvcf(spark, [f"file://{tmp_path}/S1.g.vcf", f"file://{tmp_path}/S2.g.vcf"], names, info={"QUALapprox": "long", "MQ": "double"})
        blocks = sorted((r.s, r.contig, r.start, r.end, r.GQ, r.DP, r.MIN_DP) for r in c.blocks.collect())
        assert blocks == [(s, "chr1", a, b, gq, dp, mdp) for s in ("S1", "S2") for a, b, gq, dp, mdp in ((10, 19, 50, 30, 20), (30, 31, None, None, None))]
        at = {(r.s, r.contig, r.position): r for r in c.variants.collect()}
        assert len(at) == 6 and [tuple(r) for r in c.cols.orderBy("col_idx").collect()] == [(0, "S1"), (1, "S2")]
        r = at["S2", "chr1", 20]  # the site has both samples' alleles
        assert (r.alleles, r.LA, r.LGT.a0, r.LGT.a1, r.LAD, r.LPL, r.GQ, r.gvcf_info.QUALapprox, r.gvcf_info.MQ) == (["A", "C", "T"], [0, 2], 0, 1, [10, 5], [40, 0, 60], 40, 70, None)
        r = at["S1", "chr1", 40]
        assert (r.LGT, r.LA, r.LAD, r.LPL, r.DP, r.gvcf_info.QUALapprox) == (None, [0, 1, 2], None, [1, 2, 3, 4, 5, 6], None, None)
        r = at["S1", "chr2", 5]
        assert (r.LGT.a0, r.LGT.a1, r.LAD, r.LPL, r.GQ) == (1, None, None, None, None)


def test_gvcf_round_trip_keeps_haploid_phased_and_missing(spark, tmp_path):
    ddl = "contig string, position int, alleles array<string>, s string, LA array<int>, LGT struct<a0:int,a1:int,phased:boolean>, LAD array<int>, GQ int, DP int, LPL array<int>"
    rows = [("chr1", 5, ["A", "C", "G"], "a", [0, 2], (0, 1, True), [3, 4], 20, None, [1, 2, 3]), ("chr1", 5, ["A", "C", "G"], "b", [0, 1], None, None, None, 8, None), ("chrX", 9, ["A", "T"], "a", [0, 1], (1, None, False), [0, 9], 3, 9, [5, 6, 7]),
            ("chr1", 5, ["A", "C", "G"], "c", [0, 2], (1, 1, False), [0, 1], 1, 1, [4, 5, 6])]
    blocks = spark.createDataFrame([("chr1", 50, 99, "b", 30, 7)], "contig string, start int, end int, s string, GQ int, DP int")
    cols = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "none")], "col_idx long, s string")
    gvcf.write_gvcf(SparseFrame(spark.createDataFrame(rows, ddl), blocks, cols), f"file://{tmp_path}/g")
    back = gvcf.read_gvcf(spark, f"file://{tmp_path}/g")
    got = {(r.s, r.position): r for r in back.variants.collect()}
    for r in rows:
        g = got[r[3], r[1]]
        assert (g.alleles, g.LA, g.LGT and tuple(g.LGT), g.LAD, g.GQ, g.DP, g.LPL) == (r[2], r[4], r[5], r[6], r[7], r[8], r[9])
    assert [(r.contig, r.start, r.end, r.s, r.GQ, r.DP) for r in back.blocks.collect()] == [("chr1", 50, 99, "b", 30, 7)]
    assert sorted(r.s for r in back.cols.collect()) == ["a", "b", "c", "none"]


def order(n):
    return [(a, b) for b in range(n) for a in range(b + 1)]


def test_likelihoods_follow_their_alleles(spark):
    """Every subset of up to five alleles, and every placement of three local ones among the site's, by brute force."""
    rng = random.Random(1)
    rows = []
    for n in range(1, 6):
        pl = [rng.randrange(100) for _ in order(n)]
        for kept in (sorted(rng.sample(range(n), k)) for k in range(1, n + 1)):
            rows.append((pl, kept, [pl[order(n).index((kept[a], kept[b]))] for a, b in order(len(kept))]))
    df = spark.createDataFrame(rows, "pl array<int>, kept array<int>, want array<int>")
    assert all(r.got == r.want for r in df.select(calls.subset_likelihoods(F.col("pl"), F.col("kept")).alias("got"), "want").collect())
    rows = []
    for la in ([0], [0, 2], [0, 3, 1], [0, 1, 2, 3]):
        lpl = [rng.randrange(100) for _ in order(len(la))]
        of = {tuple(sorted((la[a], la[b]))): x for (a, b), x in zip(order(len(la)), lpl)}
        rows.append((lpl, la, [of.get(p) for p in order(4)]))
    df = spark.createDataFrame([*rows, (None, [0, 1], None)], "lpl array<int>, la array<int>, want array<int>")
    assert all(r.got == r.want for r in df.select(calls.global_likelihoods(F.col("lpl"), F.col("la"), F.lit(4)).alias("got"), "want").collect())


def frame(spark, k, extra=True):
    ddl = "contig string, position int, alleles array<string>, s string, LA array<int>, LGT struct<a0:int,a1:int,phased:boolean>, LAD array<int>" + (", GQ int" if extra else "")
    rows = [("chr1", p, ["A", "CGT"[k % 3]], f"s{k}", [0, 1], (0, 1, False), [5, k]) + ((k,) if extra else ()) for p in range(1, 6 + k)]
    blocks = spark.createDataFrame([("chr1", 100 * k + 1, 100 * k + 50, f"s{k}", k) + ((7,) if extra else ())], "contig string, start int, end int, s string, GQ int" + (", DP int" if extra else ""))
    return SparseFrame(spark.createDataFrame(rows, ddl), blocks, spark.createDataFrame([(0, f"s{k}")], "col_idx long, s string"))


def test_merge_tree_goes_on_after_whole_merges(spark, tmp_path, monkeypatch):
    frames, path = [frame(spark, k, extra=k % 2 == 0) for k in range(5)], f"file://{tmp_path}/m"
    m = SparseFrame.merge_tree(frames, path, branch=2, target_records=4)
    at = {(r.position, r.s): r for r in m.variants.collect()}
    assert at[1, "s4"].alleles == ["A", "C", "G", "T"] and at[1, "s4"].LA == [0, 2] and at[1, "s3"].GQ is None and at[9, "s4"].alleles == ["A", "G"]
    assert len(at) == sum(5 + k for k in range(5)) and sorted((r.start, r.DP) for r in m.blocks.collect()) == [(100 * k + 1, 7 if k % 2 == 0 else None) for k in range(5)]
    assert [tuple(r) for r in m.cols.orderBy("col_idx").collect()] == [(k, f"s{k}") for k in range(5)]
    calls_ = []
    monkeypatch.setattr(SparseFrame, "combine", lambda self, *o: calls_.append(1))
    again = SparseFrame.merge_tree(frames, path, branch=2, target_records=4)
    assert not calls_ and again.variants.count() == len(at)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="two cohorts"):
        frames[0].combine(frames[1], frames[0])


def test_removing_samples_reindexes_likelihoods_and_keeps_entries_of_two_alleles(spark):
    ddl = "contig string, position int, alleles array<string>, s string, LA array<int>, LGT struct<a0:int,a1:int,phased:boolean>, LAD array<int>, LPL array<int>"
    rows = [("chr1", 1, ["A", "C", "G"], "stay", [0, 1, 2], (0, 2, False), [1, 2, 3], [10, 11, 12, 13, 14, 15]), ("chr1", 1, ["A", "C", "G"], "go", [0, 1], (0, 1, False), [1, 2], [0, 1, 2])]
    c = SparseFrame(spark.createDataFrame(rows, ddl), frame(spark, 1).blocks, spark.createDataFrame([(0, "stay"), (1, "go")], "col_idx long, s string"))
    r = c.remove(spark.createDataFrame([("go",)], "s string")).variants.first()
    assert (r.alleles, r.LA, tuple(r.LGT), r.LAD, r.LPL) == (["A", "G"], [0, 1], (0, 1, False), [1, 3], [10, 13, 15])
    e = split.split_entries(spark.createDataFrame([r], c.remove(spark.createDataFrame([("go",)], "s string")).variants.schema).withColumn("n_alleles", F.lit(2)), ["contig", "position"]).first()
    assert e.PL == [10, 13, 15]


def info_cells(spark):
    rng = random.Random(9)
    ddl = "locus int, alleles array<string>, n_alleles int, s string, LA array<int>, LGT struct<a0:int,a1:int,phased:boolean>, LAD array<int>, GQ int, DP int, gvcf_info struct<QUALapprox:long,VarDP:int,ReadPosRankSum:double,MQRankSum:double,SB:array<int>,RAW_MQandDP:array<long>>"
    rows = []
    for locus in range(6):
        n = locus % 4 + 1
        for k in range(9):
            la = [0, *sorted(rng.sample(range(1, n), rng.randrange(0, n)))] if n > 1 else [0]
            gt = None if k == 8 else (rng.randrange(len(la)), rng.randrange(len(la)), False)
            ad = None if k == 7 else [rng.randrange(20) for _ in la]
            rows.append((locus, ["A", "C", "G", "TT"][:n], n, f"s{k}", la, gt, ad, rng.randrange(60), rng.randrange(40), (rng.randrange(99), rng.randrange(30), rng.random(), rng.random(), [rng.randrange(9) for _ in range(4)], [900, 9])))
    return spark.createDataFrame(rows, ddl)


def test_one_aggregate_gives_what_the_single_operators_give(spark):
    c, k = info_cells(spark), ["locus"]
    got = {r.locus: r for r in info.compute_info(c, k, site=True, groups={"few": F.col("s") < "s4"}).collect()}
    assert set(got) == set(range(6))
    n = {r.locus: r.n_alleles for r in c.select("locus", "n_alleles").distinct().collect()}
    per = {(r.locus, r.allele): r for r in info.allele_info(c, k).collect()}
    ac = {(r.locus, r.allele): r for r in info.allele_counts(c, k, {"few": F.col("s") < "s4"}).collect()}
    pab = {(r.locus, r.allele): r.AS_pab_max for r in info.balance_p(c, k).collect()}
    site = {r.locus: r for r in info.site_info(c, k).collect()}
    strands = {r.locus: r for r in info.strand_table(info.allele_info(c, k), k).collect()}
    for locus, r in got.items():
        for f in ("QUALapprox", "VarDP", "ReadPosRankSum", "MQ", "QD", "FS", "SOR", "SB", "DP"):
            assert r[f] == site[locus][f], (locus, f)
        if n[locus] == 1:
            assert r.AC is None and r.AS_QD is None and r.AS_SB_TABLE is None
            continue
        for a in range(1, n[locus]):
            p, q = per.get((locus, a)), ac.get((locus, a))
            assert [r[f][a - 1] for f in ("AS_QUALapprox", "AS_VarDP", "AS_QD")] == ([p[f] for f in ("AS_QUALapprox", "AS_VarDP", "AS_QD")] if p else [0, 0, 0])
            assert [r[f][a - 1] for f in ("AS_MQ", "AS_MQRankSum")] == ([p[f] for f in ("AS_MQ", "AS_MQRankSum")] if p else [None, None])
            assert [r[f][a - 1] for f in ("AC", "AC_raw", "AC_few", "AC_few_raw")] == ([q[f] for f in ("AC", "AC_raw", "AC_few", "AC_few_raw")] if q else [0] * 4)
            assert r.AS_pab_max[a - 1] == (None if (locus, a) not in pab else pytest.approx(pab[locus, a]))
        if all((locus, a) in per for a in range(1, n[locus])):
            assert (r.AS_SB_TABLE, r.AS_SOR) == (strands[locus].AS_SB_TABLE, strands[locus].AS_SOR)


def test_info_scans_cells_once_and_shuffles_them_once(spark, tmp_path):
    info_cells(spark).write.parquet(f"{tmp_path}/cells")
    cells = spark.read.parquet(f"{tmp_path}/cells")
    plan = info.compute_info(cells, ["locus"], site=True)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan|Scan parquet", plan)) == 1
    exchanges = [x for x in plan.split("\n") if "Exchange" in x]
    assert len(exchanges) == 2 and sum("_allele" in x for x in exchanges) == 1  # cells by (site, allele), then the few rows by site


def test_densify_spreads_a_bin_over_salts(spark):
    sites = spark.createDataFrame([("chr1", p) for p in range(1, 50)], "contig string, position int")
    blocks = spark.createDataFrame([("chr1", 1, 49, f"s{k}", k) for k in range(200)], "contig string, start int, end int, s string, GQ int")
    got = joins.densify(sites, blocks)
    assert got.count() == 49 * 200 and set(got.columns) == {"contig", "position", "start", "end", "s", "GQ"}
    plan = joins.densify(sites.hint("merge"), blocks)._jdf.queryExecution().executedPlan().toString()
    assert all("_salt" in x for x in plan.split("\n") if "Exchange hashpartitioning" in x) and "Exchange hashpartitioning" in plan


def test_reading_few_intervals_pushes_the_test_of_blocks(spark, tmp_path):
    frame(spark, 3).write(f"file://{tmp_path}/c", target_records=2)
    c = SparseFrame.read(spark, f"file://{tmp_path}/c", [("chr1", 340, 400)])
    assert "LessThanOrEqual(start" in c.blocks._jdf.queryExecution().executedPlan().toString() and c.blocks.count() == 1
    assert SparseFrame.read(spark, f"file://{tmp_path}/c", [("chr1", 360, 400)]).blocks.count() == 0
    assert SparseFrame.read(spark, f"file://{tmp_path}/c", [("chr1", 10 * i + 340, 10 * i + 341) for i in range(150)]).blocks.count() == 1


def test_variant_reader_names_its_files(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("#x\nchr1\t5\t.\tA\tC\t.\tPASS\tAC=1\tGT\t0/1\n")
    r = readers.read_variants(spark, f"file://{tmp_path}/a.vcf", genotypes=True).first()
    assert r.source == f"file:{tmp_path}/a.vcf" and r.samples == ["0/1"] and r.filters == []


def test_many_sample_files_are_read_in_few_tasks(spark, tmp_path):
    for i in range(2_000):
        (tmp_path / f"{i}.g.vcf").write_text(f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS{i}\nchr1\t{i + 1}\t.\tN\t<NON_REF>\t.\t.\tEND={i + 5}\tGT:DP:GQ\t0/0:{i % 50}:9\n")
    lines = readers.variant_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism and lines.count() == 4_000
    back = gvcf.read_gvcf(spark, str(tmp_path))
    assert sorted((r.s, r.start, r.end, r.DP) for r in back.blocks.collect()) == sorted((f"S{i}", i + 1, i + 5, i % 50) for i in range(2_000))
    assert back.cols.count() == 2_000 and readers.variant_lines(spark, f"{tmp_path}/7.g.vcf").count() == 2
