"""Keyed tables, cohort annotation, export, recalibration, concatenation, cohort builds."""

import gzip
import json
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators.sparse import SparseFrame
from varloom.plans import annotate_cohort, combine, recalibrate, stages
from varloom.queries import annotation
from varloom.queries.views import Views
from varloom.sinks import search, text
from varloom.sources.keyed import read_keyed, write_keyed, zip_keyed


def test_keyed_tables_join_without_a_shuffle(spark, tmp_path, data_dir):
    """The whole annotation reads bucketed tables with no exchange but those of the liftover's segments."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = {n: write_keyed(df, f"file://{tmp_path}/{n}", annotation.KEY, 4) for n, df in annotation.tables(Views(spark, data_dir)).items()}
        out = annotate_cohort.annotate(t["rows"], t["vep"], t["recalibrated"], t["clinvar"], t["reference"], joint=t["joint"], scores=t["scores"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 6
        assert out.count() == t["rows"].count()
        spark.sql("DROP TABLE " + [x.name for x in spark.catalog.listTables() if x.name.startswith("keyed_")][0])
        again = {n: read_keyed(spark, f"file://{tmp_path}/{n}") for n in t}
        assert all(again[n].schema == t[n].schema and again[n].count() == t[n].count() for n in t)
        zipped = zip_keyed(again["rows"].select(*annotation.KEY, "site_id"), again["joint"], annotation.KEY, "j")
        assert "Exchange" not in zipped._jdf.queryExecution().executedPlan().toString() and zipped.filter("j is not null").count() == again["joint"].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_zip_and_info_edges(spark, tmp_path):
    ddl = "k string, a int"
    left, right = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], ddl), spark.createDataFrame([("y", 5), ("z", 6)], ddl)
    l, r = write_keyed(left, f"file://{tmp_path}/l", ["k"], 2), write_keyed(right, f"file://{tmp_path}/r", ["k"], 2)  # noqa: E741
    got = {(x.k, x.a, x.o and x.o.a) for x in zip_keyed(l, r, ["k"], "o").collect()}
    assert got == {("x", 1, None), ("y", 2, 5), (None, 3, None), ("z", None, 6)}
    empty = write_keyed(left.limit(0), f"file://{tmp_path}/l", ["k"], 2)  # replaced
    assert empty.count() == 0
    df = spark.createDataFrame([((1, 2.0),)], "info struct<AC:int,InbreedingCoeff:double>")
    assert annotate_cohort._without(df, "InbreedingCoeff").select("info.*").columns == ["AC"]
    assert annotate_cohort.cohort_globals("gs", "GRCh38", "exome") == {"sourceFilePath": "gs", "genomeVersion": "38", "sampleType": "WES"}
    assert "sampleType" not in annotate_cohort.cohort_globals("x")
    assert stages.family_suffix(["a", "b"], ["f", "f", "g"]).startswith("2_sgs-2_families-") and len(stages.family_suffix([], [])) == len("0_sgs-0_families-abcd")


class Client:
    """Documents as files; the first requests of each task fail, one after its documents landed."""

    def __init__(self, folder, fail=2):
        self.folder, self.fail, self.calls = folder, fail, 0

    def path(self, *x):
        return os.path.join(self.folder, *x)

    def exists(self, name):
        return os.path.isdir(self.path(name))

    def delete(self, name):
        os.rename(self.path(name), self.path(f"{name}-gone-{random.random()}"))

    def create(self, name, body):
        os.makedirs(self.path(name))
        with open(self.path("bodies"), "a") as f:
            f.write(json.dumps(body) + "\n")

    def bulk(self, name, docs):
        self.calls += 1
        if self.calls == 1:
            raise OSError("not reached")
        for i, d in docs:
            with open(self.path(name, i), "w") as f:
                json.dump(d, f)
        if self.calls <= self.fail:
            raise OSError("the answer was lost")

    def merge(self, name):
        open(self.path("merged"), "a").write("x")

    def shards(self, name):
        with open(self.path("asked"), "a") as f:
            f.write("x")
        return f"{name} 0 {search.LOADING_NODES}" if os.path.getsize(self.path("asked")) < 3 else f"{name} 0 node"


def test_each_document_lands_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search.time, "sleep", lambda s: None)
    client, there = Client(str(tmp_path)), lambda: sorted(json.load(open(tmp_path / "ix" / f))["x"] for f in os.listdir(tmp_path / "ix"))
    df = spark.createDataFrame([(i % 40, "same") for i in range(80)], "x int, t string").repartition(3)  # documents repeat, and each counts
    search.export(df, client, "ix", 2, f"file://{tmp_path}/staged", batch=7, done=f"file://{tmp_path}/done", wait=0.0)
    assert there() == sorted([i % 40 for i in range(80)]) and os.path.getsize(tmp_path / "asked") == 3
    search.export(df, client, "ix", 2, f"file://{tmp_path}/staged", done=f"file://{tmp_path}/done", wait=0.0)
    assert os.path.getsize(tmp_path / "merged") == 1  # the flag says it is done
    search.export(df.limit(0), client, "ix", 50, f"file://{tmp_path}/staged", wait=0.0)  # goes on with what is staged
    assert there() == sorted([i % 40 for i in range(80)]) and len(open(tmp_path / "bodies").readlines()) == 1 and os.path.getsize(tmp_path / "asked") == 3
    search.export(df.limit(5), client, "ix", 50, f"file://{tmp_path}/staged2", wait=0.0)  # a new one drops the index
    assert len(there()) == 5


def test_export_gives_up_when_told(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search.time, "sleep", lambda s: None)
    pauses = []
    monkeypatch.setattr(search.time, "sleep", pauses.append)
    with pytest.raises(OSError):
        search._again(lambda: (_ for _ in ()).throw(OSError()), 3, 30.0)
    assert pauses == [30.0, 60.0, 120.0]
    with pytest.raises(TimeoutError):
        search.wait_for_shards(type("C", (), {"shards": lambda self, n: search.LOADING_NODES})(), "x", attempts=2)


def sites(spark, n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        real = i % 3 != 0
        a, b = (rng.gauss(0, 1), rng.gauss(0, 1)) if real else (rng.gauss(9, 1), rng.gauss(-8, 1))
        rows.append(("chr1" if i % 2 else "chrX", i, ["A", "C"], None if i % 50 == 0 else a, float("nan") if i % 70 == 1 else b, real))
    return spark.createDataFrame(rows, "contig string, position int, alleles array<string>, a double, b double, real boolean")


def test_two_models_score_as_numpy_does(spark):
    df = sites(spark)
    marked = recalibrate.label_resources(df, [recalibrate.Resource(df.filter("real and position % 2 = 0").select("contig", "position", "alleles"), 15, training=True, truth=True), recalibrate.Resource(df.filter("position < 90"), 7, known=True)])
    m = recalibrate.train_model(marked, ["a", "b"], gaussians=2)
    assert m == recalibrate.train_model(marked, ["a", "b"], gaussians=2)
    rows = recalibrate.score_sites(marked, m).collect()
    assert len(rows) == 600 and {r.position for r in rows if r.score is None} == {i for i in range(600) if i % 50 == 0 or i % 70 == 1}

    def density(x, parts):
        return sum(w * np.exp(-0.5 * (x - np.array(mu)) @ np.array(inv) @ (x - np.array(mu)) - 0.5 * (det + len(x) * np.log(2 * np.pi))) for w, mu, inv, det in parts)

    for r in rows:
        if r.score is not None:
            x = (np.array([r.a, r.b]) - m.centre) / m.spread
            wrong = 10 ** (-r.prior / 10)
            good, bad = density(x, m.good), density(x, m.bad)
            if good > 1e-200 and bad > 1e-200:
                assert r.score == pytest.approx(np.log10(good) - np.log10(bad) + np.log10((1 - wrong) / wrong), abs=1e-6)
            assert (r.score > 0) == r.real
            assert r.prior == (15 if r.train else 7 if r.known else 2) and r.truth == r.train
    with pytest.raises(ValueError):
        recalibrate.train_model(marked.withColumn("train", F.lit(False)), ["a", "b"])


def test_every_nth_in_genome_order(spark):
    df = sites(spark)
    want = sorted((r.contig != "chr1", r.position) for r in df.collect())[::7]
    for size in (10, 1_000_000):
        got = recalibrate.every_nth(df, 7, bin_size=size)
        assert sorted((r.contig != "chr1", r.position) for r in got.collect()) == want and got.columns == df.columns


def test_gathered_tranches_are_within_a_step(spark):
    rng = random.Random(3)
    rows = [(f"f{rng.randrange(9)}", rng.gauss(0, 8) if i % 20 else None, i % 3 == 0, i % 4 == 0) for i in range(3_000)] + [("f1", 5_000.0, True, False)]
    df = spark.createDataFrame(rows, "f string, score double, truth boolean, known boolean")
    parts = recalibrate.fragment_tranches(df, "f")
    ts = [100.0, 99.9, 99.0, 90.0, 50.0]
    got = {r.sensitivity: r for r in recalibrate.gather_tranches(parts, ts).collect()}
    truths = sorted((r[1] for r in rows if r[1] is not None and r[2]), reverse=True)
    edges = []
    for t in ts:
        exact = truths[int(np.ceil(t / 100 * len(truths) - 1e-9)) - 1]
        assert exact - recalibrate.STEP - 1e-9 <= got[t].least <= exact + 1e-9
        assert got[t].truths >= t / 100 * len(truths) and got[t].sites == sum(r[1] is not None and r[1] >= got[t].least - 1e-9 for r in rows)
        edges.append(got[t].least)
    assert edges == sorted(edges)
    assert recalibrate.gather_tranches(parts.limit(0), ts).count() == 0


def test_concat_is_one_ordered_file(spark, tmp_path):
    rng = random.Random(1)
    lines = {k: [f"{c}\t{p}\t.\tA\tC\t{k}\t.\t." for c in ("chr2", "chr10", "chrX", "odd") for p in rng.sample(range(1, 400), 60)] for k in range(4)}
    head = ["##fileformat=VCFv4.2", "##x=1", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    for k, body in lines.items():
        (tmp_path / f"{k}.vcf").write_text("\n".join(head + body) + "\n")
    paths = [f"file://{tmp_path}/{k}.vcf" for k in lines]
    names = text.concat_fragments(spark, paths, f"file://{tmp_path}/out", 3)
    whole = gzip.decompress(b"".join((tmp_path / "out" / n).read_bytes() for n in names)).decode().split("\n")[:-1]
    rank = {"chr2": 0, "chr10": 1, "chrX": 2, "odd": 3}
    body = sorted((rank[x.split("\t")[0]], int(x.split("\t")[1]), k, x) for k, b in lines.items() for x in b)
    assert whole == head + [x[-1] for x in body] and len(names) == 3
    (tmp_path / "bad.vcf").write_text(head[-1] + "\tFORMAT\tS1\n")
    with pytest.raises(ValueError, match="several"):
        text.concat_fragments(spark, [*paths, f"file://{tmp_path}/bad.vcf"], f"file://{tmp_path}/out2", 3)
    (tmp_path / "none.vcf").write_text("\n".join(head) + "\n")
    names = text.concat_fragments(spark, [f"file://{tmp_path}/none.vcf"], f"file://{tmp_path}/out3", 2)
    assert gzip.decompress((tmp_path / "out3" / names[0]).read_bytes()).decode().split("\n")[:-1] == head


def test_builds_remove_then_add_and_go_on(spark, tmp_path, monkeypatch):
    ddl = "contig string, position int, alleles array<string>, s string, LA array<int>, LGT struct<a0:int,a1:int,phased:boolean>, LAD array<int>"

    def frame(*names, alt="C"):
        return SparseFrame(
            spark.createDataFrame([("chr1", 5, ["A", alt], n, [0, 1], (0, 1, False), [1, 2]) for n in names], ddl),
            spark.createDataFrame([("chr1", 9, 19, n, 3) for n in names], "contig string, start int, end int, s string, GQ int"), spark.createDataFrame([(i, n) for i, n in enumerate(names)], "col_idx long, s string"),
        )

    p = lambda x: f"file://{tmp_path}/{x}"
    ids = lambda c: sorted(r.s for r in c.cols.collect())
    gone = spark.createDataFrame([("a",)], "s string")
    one = combine.build_cohort(spark, p("one"), p("t1"), new=[frame("a", "b"), frame("c", alt="G")], branch=2)
    assert ids(one) == ["a", "b", "c"] and one.variants.first().alleles == ["A", "C", "G"]
    two = combine.build_cohort(spark, p("two"), p("t2"), previous=p("one"), new=[frame("d", alt="T")], gone=gone)
    assert ids(two) == ["b", "c", "d"] and two.blocks.count() == 3 and two.variants.first().alleles == ["A", "C", "G", "T"]
    monkeypatch.setattr(SparseFrame, "remove", lambda self, g: pytest.fail("removed again"))
    assert ids(combine.build_cohort(spark, p("two"), p("t2"), previous=p("one"), new=[frame("d", alt="T")], gone=gone)) == ["b", "c", "d"]
    monkeypatch.undo()
    assert ids(combine.build_cohort(spark, p("three"), p("t3"), previous=p("two"), gone=spark.createDataFrame([("b",)], "s string"))) == ["c", "d"]
    with pytest.raises(ValueError, match="confirm"):
        combine.build_cohort(spark, p("x"), p("t4"), previous=p("two"), gone=gone, threshold=1)
    with pytest.raises(ValueError, match="nothing"):
        combine.build_cohort(spark, p("x"), p("t4"), previous=p("two"))


def test_no_query_names_a_limit_or_a_modulo_of_ids_in_the_library():
    """Filters that keep checks cheap don't stand in operators, sources or plans."""
    root = os.path.join(os.path.dirname(os.path.dirname(__file__)), "varloom")
    for d in ("operators", "sources", "plans"):
        for name in os.listdir(f"{root}/{d}"):
            if name.endswith(".py"):
                assert not re.search(r"(site_id|doc_id)\W+% ", open(f"{root}/{d}/{name}").read()), name


def test_tranche_thresholds_are_exact(spark):
    """Places on the edges of ties and between distinct scores, of more sites than approximate quantiles hold apart."""
    n, ts = 1_200_000, [100.0, 99.95, 90.0, 50.0, 25.0]
    for score in (F.col("id") % 1000, F.col("id") * 7 % n / 9, F.floor(F.col("id") / (n / 2))):
        df = spark.range(n).select(score.cast("double").alias("score"), (F.col("id") % 2 == 0).alias("truth"))
        held = np.sort(df.filter("truth").toPandas()["score"].to_numpy())
        assert recalibrate.tranche_thresholds(df, ts) == [(t, held[max(1, -(-(10_000 - round(t * 100)) * len(held) // 10_000)) - 1]) for t in ts]
    assert recalibrate.tranche_thresholds(df.filter("not truth"), ts) == []
