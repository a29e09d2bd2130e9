"""Matrices, lookups, intervals, splitting, combining, aggregation, interest filter on fixtures."""

import pytest
from pyspark.sql import functions as F


from varloom.operators import genotypes, info, intervals, joins, split
from varloom.operators.matrix import CELLS, MatrixFrame, read_any

CALL = "struct<a0:int,a1:int,phased:boolean>"


@pytest.fixture
def matrix(spark):
    cells = spark.createDataFrame([
        (1, "a", (0, 1, False), 20, 10, [6, 4]), (1, "b", None, None, None, None), (1, "c", (1, 1, False), 99, 50_000, [0, 9]),
        (2, "a", (0, 0, False), 4, 3, [3]), (2, "b", (0, 0, False), 95, 3, [0, 0]), (3, "c", (0, 1, False), 94, 7, [11, 9]),
    ], f"site int, s string, GT {CALL}, GQ int, DP int, AD array<int>")
    cols = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "col_idx int, s string")
    return MatrixFrame.from_long(cells, cols, ["site"], ["GT", "GQ", "DP", "AD"])


def test_matrix_round_trips(spark, matrix, tmp_path):
    assert matrix.long().count() == 6
    m = matrix.annotate_globals(index={"x": 1})
    m.write(f"{tmp_path}/x.mt")
    back = read_any(spark, f"{tmp_path}/x.mt")
    assert back.globals == {"index": {"x": 1}} and sorted(back.rows.collect()) == sorted(matrix.rows.collect())
    matrix.rows.write.parquet(f"{tmp_path}/y.ht")
    assert read_any(spark, f"{tmp_path}/y.ht").count() == 3
    with pytest.raises(ValueError):
        read_any(spark, "x.vcf")
    assert matrix.shard_count(4) == 3


def test_subset(matrix):
    sub = matrix.subset_samples(["c", "b"])
    assert sub.sample_ids() == ["b", "c"] and sorted(r.site for r in sub.rows.collect()) == [1, 3]
    assert all(len(r.entries) == 2 for r in sub.rows.collect())
    with pytest.raises(ValueError):
        matrix.subset_samples(["nobody"])


def test_sample_sets(matrix):
    r = {x.site: x for x in genotypes.annotate_dataset(matrix.filter_rows("site < 3")).rows.collect()}
    assert r[1].samples_no_call == ["b"] and r[1].samples_num_alt["1"] == ["a"] and r[1].samples_num_alt["2"] == ["c"]
    assert r[1].samples_gq["20_to_25"] == ["a"] and not any("c" in (v or []) for v in r[1].samples_gq)  # 99 is in no bin
    assert r[1].samples_ab["40_to_45"] == ["a"] and r[1].genotypes[2].dp == 32_000 and r[1].genotypes[0].ad == "6,4"
    assert r[2].samples_gq["0_to_5"] == ["a"] and r[2].genotypes[0].ab is None and r[2].genotypes[1].ab is None


def test_variant_qc(matrix):
    qc = {r.site: r for r in genotypes.variant_qc(matrix.long(), ["site"], F.col("GT"), F.col("GQ")).collect()}
    assert (qc[1].AC, qc[1].AN, qc[1].AF) == ([1, 3], 4, [0.25, 0.75]) and qc[1].gq_mean == 59.5 and qc[2].AC == [4, 0]


def test_lookup_never_multiplies(spark):
    df, right = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1, "b", 2), (1, "a", 1), (3, "c", 1)], "k int, v string, o int")
    got = {r.k: r.hit for r in joins.lookup(df, right, ["k"], "hit", pick=[F.col("o")]).collect()}
    assert got[1].v == "a" and got[2] is None and got[None] is None and len(got) == 3


def test_intervals(spark):
    sites = spark.createDataFrame([("chr1", p) for p in (1, 5, 10, 11, 250_000)] + [("chr2", 5)], "contig string, position int")
    assert sorted(r.position for r in joins.in_intervals(sites, [("chr1", 5, 10)]).collect()) == [5, 10]
    many = [("chr1", i * 10, i * 10) for i in range(1, 100)] + [("chr1", 100_000, 300_000)]
    assert sorted(r.position for r in joins.in_intervals(sites, many).collect()) == [10, 250_000]
    lengths = {"chr1": 100, "chr2": 50, "chr3": 20}
    assert intervals.per_contig([("chr1", 5, "chr1", 60), ("chr1", 61, "chr2", 10), ("chr2", 11, "chr2", 40)], lengths) == [("chr1", 1, 60), ("chr1", 61, 100), ("chr2", 1, 10), ("chr2", 11, 50)]
    groomed = intervals.groom([("chr1", 5, 60), ("chrY", 1, 10), ("chrM", 1, 5)])
    assert groomed[0] == ("chr1", 1, 60) and groomed[-1] == ("chrM", 1, 16569) and groomed[-2] == ("chrY", 1, 57227415)
    assert intervals.overlap((1, 5), (5, 9)) == 0 and intervals.overlap((1, 6), (5, 9)) == 1
    assert intervals.polish([("chr1", 1, 100)], {"chr1": (40, 50)}, [("chr1", 1, 10), ("chr1", 91, 100)]) == [("chr1", 10, 40), ("chr1", 50, 91)]
    pieces = intervals.split_intervals(spark.createDataFrame([("chr1", 1, 10), ("chr1", 20, 20)], "contig string, start int, end int"), 4)
    assert sorted((r.start, r.end) for r in pieces.collect()) == [(1, 4), (4, 7), (7, 10), (20, 20)]


def test_liftover(spark):
    chain = ["chain 1 chr1 1000 + 100 130 chrA 2000 + 500 525 1", "10 5 0", "15", "", "chain 1 chr2 1000 + 0 10 chrB 100 - 20 30 2", "10"]
    df = spark.createDataFrame([("chr1", 101), ("chr1", 110), ("chr1", 112), ("chr1", 116), ("chr2", 1), ("chr2", 11)], "contig string, position int")
    got = {(r.contig, r.position): (r.to_contig, r.to_position) for r in intervals.liftover(df, intervals.read_chain(chain)).collect()}
    assert got == {("chr1", 101): ("chrA", 501), ("chr1", 110): ("chrA", 510), ("chr1", 112): (None, None), ("chr1", 116): ("chrA", 511), ("chr2", 1): ("chrB", 80), ("chr2", 11): (None, None)}


def test_densify_ways_agree(spark):
    blocks = spark.createDataFrame([("a", "chr1", 1, 9_999, 30), ("a", "chr1", 10_000, 25_000, 40), ("b", "chr1", 5, 5, 10), ("b", "chr2", 1, 50, 20)], "s string, contig string, start int, end int, gq int")
    sites = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate([("chr1", 5), ("chr1", 6), ("chr1", 10_000), ("chr1", 25_000), ("chr1", 25_001), ("chr2", 5)])], "site_id long, contig string, position int")
    a = sorted((r.site_id, r.s, r.gq) for r in joins.densify(sites, blocks, by=["contig"]).collect())
    cells = sites.crossJoin(spark.createDataFrame([("a",), ("b",)], "s string"))
    b = sorted((r.site_id, r.s, r.block.gq) for r in joins.fill_forward(cells, blocks, ["contig"]).collect() if r.block)
    assert a == b == [(0, "a", 30), (0, "b", 10), (1, "a", 30), (2, "a", 40), (3, "a", 40), (5, "b", 20)]


def test_cohort_changes(spark):
    ids = lambda x: spark.createDataFrame([(c,) for c in x], "s string")
    remove, add = joins.cohort_changes(ids("abc"), ids("bcd"), ids("c"))
    assert sorted(r.s for r in remove.collect()) == ["a", "c"] and sorted(r.s for r in add.collect()) == ["c", "d"]
    with pytest.raises(ValueError):
        joins.cohort_changes(ids("ab"), ids("b"), ids("z"))
    joins.check_removals(19, False)
    with pytest.raises(ValueError):
        joins.check_removals(20, False)
    a = spark.createDataFrame([("d", "2024-01-02", "x"), ("d", "2024-01-10", "y"), ("e", "2023", "z")], "dataset string, timestamp string, output string")
    assert {r.dataset: r.output for r in joins.latest(a, ["dataset"]).collect()} == {"d": "y", "e": "z"}


def test_split(spark):
    s = spark.createDataFrame([(1, 10, ["AT", "A", "ATT"]), (2, 5, ["A", "C"]), (3, 7, ["AC", "*"])], "id int, position int, alleles array<string>")
    got = sorted((r.id, r.a_index, r.was_split, r.position, r.alleles) for r in split.split_sites(s).collect())
    assert got == [(1, 1, True, 10, ["AT", "A"]), (1, 2, True, 10, ["A", "AT"]), (2, 1, False, 5, ["A", "C"]), (3, 1, False, 7, ["AC", "*"])]


def test_combine_and_remove(spark):
    rows = [("chr1", 5, "a", "A", ["C"], (0, 1, False), [3, 4]), ("chr1", 5, "b", "AT", ["A", "GT"], (1, 2, False), [0, 5, 6]), ("chr1", 5, "c", "A", ["*"], (0, 0, False), [9, 0]), ("chr2", 1, "a", "G", ["T"], (0, 1, False), [1, 1])]
    sites, cells = split.combine(spark.createDataFrame(rows, f"contig string, position int, s string, ref string, alts array<string>, GT {CALL}, AD array<int>"))
    by = {(r.contig, r.position): r.alleles for r in sites.collect()}
    assert by == {("chr1", 5): ["AT", "*", "A", "CT", "GT"], ("chr2", 1): ["G", "T"]}
    la = {(r.contig, r.s): (r.LA, tuple(r.LGT)[:2], r.LAD) for r in cells.collect()}
    assert la[("chr1", "b")] == ([0, 2, 4], (1, 2), [0, 5, 6]) and la[("chr1", "a")][0] == [0, 3] and la[("chr1", "c")][0] == [0, 1]
    left, entries = split.remove_samples(sites, cells, spark.createDataFrame([("b",)], "s string"), ["contig", "position"])
    assert {(r.contig): r.alleles for r in left.collect()} == {"chr1": ["AT", "CT"], "chr2": ["G", "T"]}
    e = {(r.contig, r.s): (r.LA, tuple(r.LGT)[:2], r.LAD) for r in entries.collect()}
    assert e[("chr1", "a")] == ([0, 1], (0, 1), [3, 4]) and e[("chr1", "c")] == ([0], (0, 0), [9])


ENTRY = f"locus int, alleles array<string>, n_alleles int, s string, LA array<int>, LGT {CALL}, LAD array<int>, GQ int, DP int, gvcf_info struct<QUALapprox:bigint,VarDP:int,ReadPosRankSum:double,MQRankSum:double,SB:array<int>,RAW_MQandDP:array<bigint>>"


def entry(s, la, lgt, lad, gq, dp, qual):
    return (1, ["A", "C", "G"], 3, s, la, lgt, lad, gq, dp, (qual, dp, 1.0 * dp, 2.0, [4, 5, 6, 7], [3600 * dp, dp]) if qual is not None else None)


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([entry("a", [0, 1], (0, 1, False), [10, 10], 50, 20, 100), entry("b", [0, 1, 2], (0, 2, False), [6, 0, 6], 50, 12, 300), entry("c", [0, 1], (0, 0, False), [30, 0], 60, 30, 0), entry("d", [0, 2], (1, 1, False), [0, 8], None, 8, 80)], ENTRY)


def test_site_info_counts_non_reference_calls_only(cells):
    r = info.site_info(cells, ["locus"]).first()
    assert (r.QUALapprox, r.VarDP, r.DP, r.ReadPosRankSum, r.SB) == (480, 40, 70, 12.0, [12, 15, 18, 21]) and r.MQ == 60.0 and r.QD == 12.0


def test_allele_info_counts_entries_that_list_the_allele(cells):
    r = {x.allele: x for x in info.allele_info(cells, ["locus"]).collect()}
    assert r[1].AS_VarDP == 62 and r[2].AS_VarDP == 20 and r[1].AS_QUALapprox == 400
    t = info.strand_table(info.allele_info(cells, ["locus"]), ["locus"]).first()
    assert t.AS_SB_TABLE == [[20, 25], [18, 21], [12, 14]] and len(t.AS_FS) == 2


def test_allele_counts_leave_out_unknown_quality(cells):
    r = {x.allele: (x.AC, x.AC_raw) for x in info.allele_counts(cells, ["locus"]).collect()}
    assert r == {1: (1, 1), 2: (1, 3)}  # d has no GQ, but its depth alone makes it low
    deep = info.allele_counts(cells.filter("s = 'd'").withColumn("DP", F.lit(20)), ["locus"]).first()
    assert (deep.AC, deep.AC_raw) == (0, 0)  # of unknown quality: in neither


def test_all_info(cells):
    r = info.compute_info(cells, ["locus"], site=True).first()
    assert r.AC == [1, 1] and r.AS_pab_max == pytest.approx([1.0, 1.0]) and r.AS_lowqual == [False, False] and r.lowqual is False and r.QUALapprox == 480
    assert r.AS_SB_TABLE == [[20, 25], [18, 21], [12, 14]] and "AS_SB" not in r
    only = info.compute_info(cells, ["locus"], site=True, quasi=False).first()
    assert only.AC == [1, 1] and only.AC_raw == [1, 3]
    assert "AS_lowqual" not in info.compute_info(cells, ["locus"], site=True, quasi=False).columns
    with pytest.raises(ValueError):
        info.compute_info(cells, ["locus"], quasi=False)
    with pytest.raises(ValueError):
        info.entry_field(cells, "nothing")


def test_true_allele_info(spark):
    row = (1, [0, 2], (0, 1, False), [5, 7], [0, 90], [0, 25_200], [0, 12], [[0], [3]], [[0], [4]], [[1, 2], [3, 4]])
    c = spark.createDataFrame([row], f"locus int, LA array<int>, LGT {CALL}, LAD array<int>, AS_QUALapprox array<int>, AS_RAW_MQ array<int>, AS_VarDP array<int>, AS_RAW_ReadPosRankSum array<array<int>>, AS_RAW_MQRankSum array<array<int>>, AS_SB_TABLE array<array<int>>")
    r = {x.allele: x for x in info.true_allele_info(c, ["locus"]).collect()}
    assert r[2].AS_MQ == 60.0 and r[2].AS_QD == 7.5 and r[2].AS_ReadPosRankSum == 3 and r[0].AS_SB_TABLE == [1, 2] and r[2].AS_SB_TABLE == [3, 4]


def test_interest(spark):
    t = "array<struct<consequence_terms:array<string>>>"
    rows = [("chr1", 1, "A", "C", ["g1"], 0.001, 0.001, 50.0, [(["stop_gained", "intron_variant"],), (["stop_gained"],), (["intron_variant"],)]), ("chr1", 2, "A", "C", ["g1"], 0.001, None, 50.0, [(["stop_gained"],)]), ("chr1", 3, "A", "C", ["g2"], 0.001, 0.001, 50.0, [(["stop_gained"],)])]
    df = spark.createDataFrame(rows, f"contig string, position int, ref string, alt string, gene_ids array<string>, AF double, population_AF double, gq_mean double, transcript_consequences {t}")
    assert [tuple(r) for r in genotypes.variants_of_interest(df, ["g1"], ["stop_gained"]).collect()] == [("chr1", 1, "A", "C", "stop_gained")]
    with pytest.raises(ValueError):
        genotypes.variants_of_interest(df, [], ["stop_gained"])


def test_split_entries(spark):
    c = spark.createDataFrame([(1, "a", [0, 2], (0, 1, False), [5, 7], 4)], f"locus int, s string, LA array<int>, LGT {CALL}, LAD array<int>, n_alleles int")
    got = {r.a_index: (tuple(r.GT)[:2], r.AD) for r in split.split_entries(c, ["locus"]).collect()}
    assert got == {1: ((0, 0), [12, 0]), 2: ((0, 1), [5, 7]), 3: ((0, 0), [12, 0])}


def test_arrays_have_an_element_for_each_alternate_allele(cells):
    own = cells.filter(F.array_contains("LA", 2) & ~F.array_contains("LA", 1)).withColumns({"LA": F.array(F.lit(0), F.lit(3)), "alleles": F.array(*map(F.lit, "ACGT")), "n_alleles": F.lit(4)})
    if own.count():
        r = info.compute_info(own, ["locus"]).first()
        assert all(len(r[c]) == 3 for c in ("AC", "AC_raw", "AS_QUALapprox", "AS_lowqual", "AS_pab_max", "AS_FS")) and len(r.AS_SB_TABLE) == 4 and r.AS_QUALapprox[:2] == [0, 0] and r.AS_SB_TABLE[1] is None


def test_matrix_from_long_orders_fills_and_takes_repeated_cells_once(spark):
    cells_ = spark.createDataFrame([(1, "c", 3), (1, "a", 1), (1, "a", 2), (2, "d", 4)], "site int, s string, x int")
    cols = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c"), (40, "d")], "col_idx int, s string")
    got = {r.site: [e and e.x for e in r.entries] for r in MatrixFrame.from_long(cells_, cols, ["site"], ["x"]).rows.collect()}
    assert got == {1: [1, None, 3, None], 2: [None, None, None, 4]}


def test_sparse_cohort(spark):
    from varloom.operators.sparse import SparseFrame

    v = [("chr1", 10, ["A", "C"], "a", [0, 1], (0, 1, False), [5, 5], 50, 10), ("chr1", 10, ["AT", "G"], "b", [0, 1], (1, 1, False), [0, 9], 60, 9), ("chr2", 10, ["A", "C"], "a", [0, 1], (0, 0, False), [9, 0], 50, 9)]
    ddl = f"contig string, position int, alleles array<string>, s string, LA array<int>, LGT {CALL}, LAD array<int>, GQ int, DP int"
    blocks = spark.createDataFrame([("chr1", 5, 20, "c", 30, 7), ("chr2", 5, 20, "b", 30, 7)], "contig string, start int, end int, s string, GQ int, DP int")
    cols = spark.createDataFrame([(0, "a"), (1, "c")], "col_idx int, s string")
    frame = lambda rows: spark.createDataFrame(rows, ddl)
    one = SparseFrame(frame([v[0], v[2]]), blocks.filter("s = 'c'"), cols)
    two = SparseFrame(frame([v[1]]), blocks.filter("s = 'b'"), spark.createDataFrame([(0, "b")], "col_idx int, s string"))
    both = one.combine(two)
    got = {(r.contig, r.position, r.s): (r.alleles, r.LA, r.GQ) for r in both.variants.collect()}
    assert got[("chr1", 10, "a")] == (["AT", "CT", "G"], [0, 1], 50) and got[("chr1", 10, "b")] == (["AT", "CT", "G"], [0, 2], 60)
    with pytest.raises(ValueError):
        one.combine(one)
    dense = both.dense().rows.collect()
    assert [(r.contig, r.position, r.site_dp, r.ANS) for r in dense] == [("chr1", 10, 26, 6)]  # nobody carries chr2's
    assert [e and (e.LGT.a0, e.LGT.a1) for e in dense[0].entries] == [(0, 1), (0, 0), (1, 1)]
    left = both.remove(spark.createDataFrame([("b",)], "s string")).variants.collect()
    assert [(r.contig, r.alleles, r.LA) for r in left] == [("chr1", ["AT", "CT"], [0, 1])]


def test_a_matrix_holds_its_cells_alone(spark, tmp_path):
    """Of 20,000 columns each row has a cell or two: they are written, read, cut and annotated without the absent ones."""
    n = 20_000
    cells_ = spark.range(3_000).select(F.col("id").alias("site"), F.concat(F.lit("s"), (F.col("id") * 37 % n).cast("string")).alias("s"), F.expr(f"CAST(named_struct('a0', 0, 'a1', CAST(id % 2 AS INT), 'phased', false) AS {CALL})").alias("GT"), F.lit(21).alias("GQ"), F.lit(9).alias("DP"), F.array(F.lit(5), F.lit(4)).alias("AD"))
    cells_ = cells_.unionByName(cells_.filter("site < 9").withColumn("s", F.lit("s19999")))
    cols = spark.range(n).select(F.col("id").alias("col_idx"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("s"))
    MatrixFrame.from_long(cells_, cols, ["site"], ["GT", "GQ", "DP", "AD"]).write(f"{tmp_path}/w.mt")
    m = read_any(spark, f"{tmp_path}/w.mt")
    assert m.held.agg(F.sum(F.size(CELLS))).first()[0] == m.long().count() == 3_009
    assert m.rows.filter("site = 7").select(F.size("entries"), F.expr("size(filter(entries, x -> x is not null))")).first()[:] == (n, 2)
    wanted = [f"s{i}" for i in range(1, n, 2)]
    sub, some = m.subset_samples(wanted), m.subset_samples(wanted, False)
    assert sorted((r.site, r.s) for r in some.long().collect()) == sorted((r.site, r.s) for r in cells_.collect() if int(r.s[1:]) % 2)
    assert {r.site for r in sub.long().collect()} == {r.site for r in cells_.collect() if int(r.s[1:]) % 2 and r.GT.a1} and sub.n_cols == n // 2
    made = {r.site: r for r in genotypes.annotate_dataset(m, listed=True).held.filter("site < 3").collect()}
    assert made[1].samples_num_alt["1"] == ["s19999", "s37"] and made[1].samples_gq["20_to_25"] == ["s19999", "s37"] and made[2].samples_no_call in (None, []) and len(made[2].genotypes) == 2
    dense = m.filter_rows("site = 1").annotate_rows(n=F.size("entries"), entries=F.col("entries"))
    assert dense.cells().held.select(CELLS).first()[0][0][:2] == (37, "s37") and dense.rows.first().n == n


def test_every_cell_is_filled_without_a_shuffle_of_cells(spark):
    sites = [("chr1", p, p * 10) for p in range(1, 60)] + [("chr2", 5, 7), ("chr2", 90_001, 8)]
    blocks = [("chr1", f"s{k}", a, a + k, k) for k in range(4) for a in range(1 + k, 60, 9)] + [("chr2", "s1", 9_995, 90_001, 50)]
    s = spark.createDataFrame(sites, "contig string, position int, site_id int")
    b = spark.createDataFrame(blocks, "contig string, s string, start int, end int, gq int")
    samples = spark.createDataFrame([(f"s{k}",) for k in range(6)], "s string")  # two of them have no block
    out = joins.fill_every(s, b, samples)
    got = sorted((r.contig, r.position, r.site_id, r.s, -1 if r.gq is None else r.gq) for r in out.collect())
    assert got == sorted((c, p, i, f"s{k}", next((g for bc, bs, x, y, g in blocks if bc == c and bs == f"s{k}" and x <= p <= y), -1)) for c, p, i in sites for k in range(6))
    plan = out._jdf.queryExecution().executedPlan().toString()
    cells = plan[: plan.index("explode(")]  # what stands over the rows of cells
    assert "posexplode" in plan and "Exchange hashpartitioning" not in cells and "Window" not in cells.replace("WindowGroup", "").split("BroadcastExchange")[0]
    assert joins.fill_every(s, b.limit(0), samples).filter("gq is null").count() == len(sites) * 6
