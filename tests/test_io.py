"""Sources, sinks and plans."""

import json

import pytest
from pyspark.sql import functions as F

from varloom.functions.vcf_types import fit_info, fits_info
from varloom.operators.matrix import MatrixFrame
from varloom.plans import compose, recalibrate, stages
from varloom.plans.annotate_cohort import annotate, population_frequencies
from varloom.sinks import search, text
from varloom.sources import readers


def put(path, lines):
    path.write_text("".join(f"{x}\n" for x in lines))
    return str(path)


def test_sites_round_trip(spark, tmp_path):
    rows = [("chr10", 5, ["A", "C"], None, (3, [1, 2], True, "x")), ("chr2", 9, ["AT", "A", "G"], ["b", "a"], (None, [7], False, None)), ("chr2", 1, ["G"], [], (1, None, None, None))]
    df = spark.createDataFrame(rows, "contig string, position int, alleles array<string>, filters array<string>, info struct<AC:int,AD:array<int>,DB:boolean,T:string>")
    for separate in (False, True):
        names = text.write_sites(df, f"{tmp_path}/v{separate}", 2, separate_header=separate)
        assert [a.rsplit("/", 1)[-1] for a, _ in readers.read_manifest(spark, f"{tmp_path}/v{separate}/shard-manifest.txt")] == [n.rsplit("/", 1)[-1] for n in names]
        assert ("00000-header" in names) == separate
        back = readers.read_variants(spark, f"{tmp_path}/v{separate}/parts", {"AC": "int", "AD": "array<int>", "DB": "boolean", "T": "string"})
        got = {(r.contig, r.position): r for r in back.collect()}
        assert got[("chr2", 9)].alleles == ["AT", "A", "G"] and got[("chr2", 9)].filters == ["a", "b"] and got[("chr10", 5)].filters is None and got[("chr2", 1)].filters == []
        assert tuple(got[("chr10", 5)].info) == (3, [1, 2], True, "x") and got[("chr2", 1)].info.AC == 1
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/vFalse/parts").collect()]
    assert sum(x.startswith("#CHROM") for x in lines) >= 1 and "##INFO=<ID=AC,Number=1,Type=Integer,Description=\"\">" in lines


def test_matrix_text_and_calls(spark, tmp_path):
    cells = spark.createDataFrame([("chr1", 5, ["A", "C"], "a", (0, 1, False), 9, 8, [3, 5]), ("chr1", 5, ["A", "C"], "b", None, None, None, None)], "contig string, position int, alleles array<string>, s string, GT struct<a0:int,a1:int,phased:boolean>, GQ int, DP int, AD array<int>")
    m = MatrixFrame.from_long(cells, spark.createDataFrame([(0, "a"), (1, "b")], "col_idx int, s string"), ["contig", "position", "alleles"], ["GT", "GQ", "DP", "AD"])
    text.write_matrix(m, f"{tmp_path}/m.vcf")
    last = [r[0] for r in spark.read.text(f"{tmp_path}/m.vcf").collect()][-1]
    assert last.split("\t")[8:] == ["GT:GQ:DP:AD", "0/1:9:8:3,5", "./.:.:.:."]
    r = readers.read_variants(spark, f"{tmp_path}/m.vcf", genotypes=True).select(F.transform("samples", lambda x: readers.parse_call(F.split(x, ":")[0])).alias("c")).first().c
    assert tuple(r[0]) == (0, 1, False) and r[1] is None
    one = spark.range(1).select(readers.parse_call(F.lit("1")).alias("h"), readers.parse_call(F.lit("1|0")).alias("p")).first()
    assert tuple(one.h) == (1, None, False) and tuple(one.p) == (1, 0, True)


def test_recalibrated_sites_survive_odd_fields(spark, tmp_path):
    p = put(tmp_path / "r.vcf", ["##x", "#CHROM\tPOS", "chr1\t5\t.\tA\tC\t.\tPASS\tAC=2;AS_FilterStatus=VQSR,PASS;SB=1,2|3;DB", "chr1\t6\t.\tA\tC\t3.5\tLow\t."])
    got = {r.position: r for r in readers.read_recalibrated(spark, p).collect()}
    assert got[5].info == {"AC": "2", "DB": None} and got[5].filters == [] and got[6].info == {} and got[6].filters == ["Low"]
    thr = recalibrate.tranche_thresholds(spark.createDataFrame([(float(i), i % 2 == 0) for i in range(1001)], "score double, truth boolean"), [100.0, 90.0])
    assert thr[0][1] == 0.0 and thr[1][1] == pytest.approx(100, abs=2)
    f = recalibrate.apply_filters(spark.createDataFrame([(5.0, True, ["q"]), (1.0, True, ["q"]), (1.0, False, ["q"])], "score double, snp boolean, filters array<string>"), 3.0, F.col("snp"), "Low")
    assert [r.filters for r in f.collect()] == [["PASS"], ["Low"], ["q"]]


def test_sites_without_a_feature_stay_without_a_score(spark):
    rows = [(i, float(i % 13), float(i * 7 % 11), i % 2 == 0) for i in range(60)] + [(60, None, 1.0, True), (61, 2.0, float("nan"), True), (62, None, None, False)]
    schema = "site int, a double, b double, train boolean"
    got = recalibrate.train_scores(spark.createDataFrame(rows, schema), ["a", "b"], gaussians=2)
    whole = recalibrate.train_scores(spark.createDataFrame(rows[:60], schema), ["a", "b"], gaussians=2)
    score = {r.site: r.score for r in got.collect()}
    assert len(score) == 63 and [i for i, x in score.items() if x is None] == [60, 61, 62]
    assert all(r.score == pytest.approx(score[r.site], abs=0.5) for r in whole.collect()) and got.columns == ["site", "a", "b", "train", "score"]


def test_consequence_json_and_cohort(spark, tmp_path):
    doc = {"input": "chr1\t5\t.\tA\tC\t.", "seq_region_name": "chr1", "most_severe_consequence": "stop_gained", "transcript_consequences": [{"transcript_id": "t1", "gene_id": "g", "biotype": "protein_coding", "canonical": 1, "consequence_terms": ["stop_gained"], "hgvsc": "t:c.1", "cdna_start": "oops", "domains": [{"db": "P", "name": "n"}]}]}
    vep = readers.read_consequences(spark, put(tmp_path / "v.json", [json.dumps(doc)]))
    rows = spark.createDataFrame([("chr1", 5, ["A", "C"], 1, 0.5, 2), ("chr1", 6, ["AT", "A"], 1, 0.5, 2)], "contig string, position int, alleles array<string>, AC int, AF double, AN int").withColumn("filters", F.array().cast("array<string>"))
    vqsr = spark.createDataFrame([("chr1", 5, ["A", "C"], {"QD": "3"}, ["PASS", "x"])], "contig string, position int, alleles array<string>, info map<string,string>, filters array<string>")
    clin = spark.createDataFrame([("chr1", 5, ["A", "C"], (7, ["Path", "Likely"]), 2)], "contig string, position int, alleles array<string>, info struct<ALLELEID:int,CLNSIG:array<string>>, gold_stars int")
    freq = spark.createDataFrame([("chr1", 5, ["A", "C"], ([(1, 0.1, 10, 0), (2, 0.2, 10, 1)], (0.3,), (0.4,)))], "contig string, position int, alleles array<string>, joint struct<freq:array<struct<AC:int,AF:double,AN:int,homozygote_count:int>>,fafmax:struct<faf95_max:double>,grpmax:struct<AF:double>>")
    pops = population_frequencies(freq, {"adj": 0, "eur": 1}, {"all": "adj", "eur": "eur"})
    got = {r.position: r for r in annotate(rows, vep, vqsr, clin, None, pops).collect()}
    a, b = got[5], got[6]
    assert a.variantId == "1-5-A-C" and a.xpos == 1_000_000_005 and a.filters == ["x"] and a.clinvar.clinical_significance == "Path,Likely" and a.gnomad.eur.AF == 0.2 and a.mainTranscript.major_consequence == "stop_gained" and a.geneIds == ["g"] and a.domains == ["P:n"]
    assert a.vep.transcript_consequences[0].cdna_start is None and b.clinvar is None and b.vep is None and b.filters == [] and b.end == 7 and len(got) == 2


def test_small_files(spark, tmp_path):
    assert readers.read_bed(spark, put(tmp_path / "a.bed", ["chr1\t0\t10\tx", "", "chr2 5 6"])) == [("chr1", 1, 10), ("chr2", 6, 6)]
    c, t = readers.read_meres(spark, put(tmp_path / "m.list", ["@HD\tx", "@SQ\ty", "chr1\t5\t9\t+\tcentromere", "chr1\t6\t9\t+\tcentromere", "chr1\t1\t2\t+\ttelomere"]))
    assert c == {"chr1": (6, 9)} and t == [("chr1", 1, 2)]
    assert readers.read_ids(spark, put(tmp_path / "ids", [" a ", "", "b"])) == ["a", "b"]
    assert text.bed_lines([("chr1", 1, 10)]) == ["chr1\t0\t10"]
    df = spark.createDataFrame([(1,)], "x int")
    first = readers.checkpoint(df, f"{tmp_path}/ck")
    again = readers.checkpoint(spark.createDataFrame([(2,)], "x int"), f"{tmp_path}/ck", reuse=True)
    assert first.collect() == again.collect() and readers.exists(spark, f"{tmp_path}/ck") and not readers.exists(spark, f"{tmp_path}/no")
    text.write_tsv(df, f"{tmp_path}/t")
    assert spark.read.option("header", True).csv(f"{tmp_path}/t", sep="\t").collect()[0].x == "1"


def test_search_index(spark, tmp_path):
    names = ["a.b", "a,b", "$x", "_x", "-x", "a#*()[]{}", "plain"]
    coded = [search.encode_name(n) for n in names]
    assert coded[:5] == ["a_$dot$_b", "a_$comma$_b", "$$x", "$_x", "$-x"] and len(set(coded)) == len(names)
    df = spark.createDataFrame([((1, ("x",)), [(1,)], [2.0], None)], "a struct<b:int,c:struct<d:string>>, e array<struct<f:bigint>>, g array<double>, h boolean")
    flat = search.index_rows(df, drop=("g",))
    assert flat.columns == ["a_b", "a_c_d", "e", "h"]
    body = search.index_body(flat, 3, {"version": 1})
    assert body["mappings"]["properties"]["e"] == {"type": "nested", "properties": {"f": {"type": "long"}}} and body["mappings"]["_meta"] == {"version": 1} and body["settings"]["index"]["number_of_shards"] == 3
    with pytest.raises(NotImplementedError):
        search.mapping(spark.sql("select map(1, 2) as m").schema)
    search.write_bulk(flat, f"{tmp_path}/bulk", "ix", "a_b")
    lines = [json.loads(r[0]) for r in spark.read.text(f"{tmp_path}/bulk").collect()]
    assert lines[0] == {"index": {"_index": "ix", "_id": "1"}} and lines[1]["h"] is None


def test_vcf_types(spark):
    df = spark.createDataFrame([((2**40, [2**40, 1], [[1, 2], [3, 4]], [[1, 2], [3, 4]], [1, 2]),)], "info struct<L:bigint,A:array<bigint>,SB:array<array<int>>,AS_SB_TABLE:array<array<int>>,P:array<int>>")
    r = fit_info(df, pipe=("P",)).first().info
    assert (r.L, r.A, r.SB, r.AS_SB_TABLE, r.P) == (2**31 - 1, [2**31 - 1, 1], [1, 2, 3, 4], "1,2|3,4", "|1|2")
    t = spark.sql("select 1 as a, array(1) as b, map(1, 2) as c, array(named_struct('x', 1)) as d").schema
    assert [fits_info(f.dataType) for f in t] == [True, True, False, False]


def test_compose_plan():
    for n, steps in ((1, 1), (2, 2), (32, 2), (33, 4), (1025, 37)):
        plan = compose.compose_plan([f"f{i}" for i in range(n)], "out", "tmp")
        assert len(plan) == steps and all(len(s) <= 32 for _, s in plan) and plan[-1][0] == "out" and len(plan[-1][1]) == 1
        held = {}
        for target, sources in plan:
            held[target] = [x for s in sources for x in held.get(s, [s])]
        assert held["out"] == [f"f{i}" for i in range(n)]
    with pytest.raises(ValueError):
        compose.compose_plan([], "out", "tmp")


def test_stages():
    log, done = [], {"b.out"}
    make = lambda n, **k: stages.Stage(n, lambda c: log.append(n), **k)
    all_ = [make("c", requires=["a", "b"]), make("a", wanted=lambda c: c["a"]), make("b", outputs=["b.out"])]
    assert stages.run(all_, ["c"], {"a": True}, done.__contains__) == ["a", "c"] == log
    with pytest.raises(ValueError):
        stages.order([make("x", requires=["x"])], ["x"])
    cfg = stages.load_config("[workflow]\nwrite_vcf = ['d']\n[a.b]\nc = 1")
    assert stages.retrieve(cfg, ["a", "b", "c"]) == 1 and stages.retrieve(cfg, ["no"], 5) == 5 and stages.dataset_wanted("d", cfg) and not stages.dataset_wanted("e", cfg)
    with pytest.raises(KeyError):
        stages.retrieve(cfg, ["no"])
    ids, name = stages.family_ids([("f1", "s2"), ("f1", "s1"), ("f2", "s3")], ["f1"])
    assert ids == ["s1", "s2"] and len(name) == 4
    with pytest.raises(ValueError):
        stages.family_ids([], ["f"])
    with pytest.raises(ValueError):
        stages.require_inputs({"s": None})
    assert stages.combiner_action(True, [], ["a"]) == "remove" and stages.combiner_action(True, ["b"], ["a"]) == "remove_then_add" and stages.combiner_action(False, ["b"], []) == "add"
    with pytest.raises(ValueError):
        stages.combiner_action(True, [], [])


def test_wide_matrix_text_is_dealt_by_its_cells(spark, tmp_path, monkeypatch):
    n, dealt = 5_000, []
    frame = type(spark.range(1))
    held = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, *a: dealt.append(self.columns) or held(self, *a))
    cells = spark.range(300).select(F.concat(F.lit("chr"), (F.col("id") % 3 + 9).cast("string")).alias("contig"), F.col("id").cast("int").alias("position"), F.array(F.lit("A"), F.lit("C")).alias("alleles"), F.concat(F.lit("s"), (F.col("id") * 41 % n).cast("string")).alias("s"),
                                    F.expr("named_struct('a0', 0, 'a1', 1, 'phased', false)").alias("GT"), F.col("id").cast("int").alias("GQ"), F.lit(None).cast("int").alias("DP"), F.array(F.lit(3), F.lit(5)).alias("AD"))
    cols = spark.range(n).select(F.col("id").alias("col_idx"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("s"))
    m = MatrixFrame.from_long(cells, cols, ["contig", "position", "alleles"], ["GT", "GQ", "DP", "AD"])
    names = text.write_matrix(m, f"file://{tmp_path}/w", 3, compression="lz4")
    assert len(dealt) == 1 and "_cells" in dealt[0] and not {"value", "entries"} & set(dealt[0])  # lines are made after the exchange
    lines = [r[0] for x in names for r in spark.read.text(f"file://{tmp_path}/w/{x}").collect()]
    top = next(i for i, x in enumerate(lines) if x.startswith("#CHROM"))
    assert lines[0] == "##fileformat=VCFv4.2" and lines[top].split("\t")[9:] == [f"s{i}" for i in range(n)]
    got = [x.split("\t") for x in lines[top + 1 :]]
    assert [(x[0], int(x[1])) for x in got] == sorted(((f"chr{i % 3 + 9}", i) for i in range(300)), key=lambda x: (int(x[0][3:]), x[1]))
    assert all(len(x) == 9 + n and {i: c for i, c in enumerate(x[9:]) if c != "./.:.:.:."} == {int(x[1]) * 41 % n: f"0/1:{x[1]}:.:3,5"} for x in got)
