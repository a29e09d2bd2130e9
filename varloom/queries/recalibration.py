"""Queries of recalibration models, gathered tranches and joined fragments."""

from __future__ import annotations

from pyspark.sql import functions as F

from varloom.plans import recalibrate
from varloom.queries.catalog import query
from varloom.queries.engine import SITES, scratch, site_rows
from varloom.sinks import text
from varloom.sources import readers


def featured(v):
    """Sites with two features: of every tenth the first is missing, and those with an odd id divided by three stand apart."""
    i = F.col("site_id")
    off = F.when(i % 3 == 1, 6.0).otherwise(0.0)
    rows = v.sites.select("site_id", "contig", "position", F.array("ref", "alt").alias("alleles"), F.when(i % 10 != 0, (i * 37 % 101) / 50.0 + off).alias("a"), ((i * 53 % 97) / 40.0 - off).alias("b"))
    key = rows.select("site_id", "contig", "position", "alleles")
    of = lambda test: key.filter(test).drop("site_id")
    return recalibrate.label_resources(rows, [
        recalibrate.Resource(of("site_id % 3 <> 1 and site_id % 4 = 0"), 15, training=True, truth=True), recalibrate.Resource(of("site_id % 3 <> 1 and site_id % 5 = 0"), 12, training=True),
        recalibrate.Resource(of("site_id % 2 = 0"), 7, known=True),
    ])


@query("""SELECT site_id, site_id % 3 <> 1 AND (site_id % 4 = 0 OR site_id % 5 = 0) AS train, site_id % 3 <> 1 AND site_id % 4 = 0 AS truth, site_id % 2 = 0 AS known,
CASE WHEN site_id % 3 <> 1 AND site_id % 4 = 0 THEN 15.0 WHEN site_id % 3 <> 1 AND site_id % 5 = 0 THEN 12.0 WHEN site_id % 2 = 0 THEN 7.0 ELSE 2.0 END AS prior, site_id % 10 <> 0 AS scored,
CASE WHEN site_id % 10 <> 0 THEN site_id % 3 <> 1 END AS likely FROM v_sites""", "v_sites")
def q_two_model_scores(v):
    """Sites like the training sites score above 0, those that stand apart below. The models see every site: of the smallest table,
    every second one leaves too few to tell its outermost sites from those apart. q_every_nth has the sampling."""
    df = readers.checkpoint(featured(v), scratch(v, "featured"))
    model = recalibrate.train_model(df, ["a", "b"], gaussians=2, bad_gaussians=2)
    out = recalibrate.score_sites(df, model)
    return out.select("site_id", "train", "truth", "known", F.col("prior").cast("double").alias("prior"), F.col("score").isNotNull().alias("scored"), (F.col("score") > 0).alias("likely"))


TRANCHES = [99.9, 99.0, 90.0, 50.0, 1.0]


@query(f""", t AS (SELECT CAST(floor((CAST((site_id * 7919) % 4001 AS DOUBLE) / 100.0 - 20.0) / 0.5) AS BIGINT) AS bin, site_id % 3 = 0 AS truth, site_id % 2 = 0 AS known FROM v_sites WHERE site_id % 11 <> 0),
b AS (SELECT bin, sum(CASE WHEN truth THEN 1 ELSE 0 END) AS truths, sum(CASE WHEN known THEN 1 ELSE 0 END) AS knowns, count(*) AS sites FROM t GROUP BY bin),
c AS (SELECT bin, sum(truths) OVER w AS truths, sum(knowns) OVER w AS knowns, sum(sites) OVER w AS sites FROM b WINDOW w AS (ORDER BY bin DESC)),
n AS (SELECT count(*) AS truth_all FROM t WHERE truth), k AS (SELECT CAST(x AS DOUBLE) AS sensitivity FROM unnest([{', '.join(map(str, TRANCHES))}]) AS u(x)),
m AS (SELECT sensitivity, max(bin) AS bin FROM k, n, c WHERE c.truths >= greatest(1, ceil(sensitivity / 100 * truth_all - 1e-9)) GROUP BY sensitivity)
SELECT sensitivity, bin * 0.5 AS least, CAST(truths AS BIGINT) AS truths, CAST(knowns AS BIGINT) AS knowns, CAST(sites AS BIGINT) AS sites FROM m JOIN c USING (bin)""", "v_sites")
def q_gathered_tranches(v):
    """Thresholds from tables of 25 fragments, a contig each; every eleventh site has no score."""
    i = F.col("site_id")
    scored = v.sites.select("contig", F.when(i % 11 != 0, ((i * 7919) % 4001).cast("double") / 100.0 - 20.0).alias("score"), (i % 3 == 0).alias("truth"), (i % 2 == 0).alias("known"))
    parts = readers.checkpoint(recalibrate.fragment_tranches(scored, "contig", step=0.5), scratch(v, "tranches"))
    out = recalibrate.gather_tranches(parts, TRANCHES, step=0.5)
    return out.select("sensitivity", F.col("least").cast("double").alias("least"), "truths", "knowns", "sites")


@query(", r AS (SELECT *, row_number() OVER (ORDER BY CASE contig WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrM' THEN 25 ELSE CAST(substr(contig, 4) AS INT) END, position) - 1 AS n FROM v_sites) SELECT site_id FROM r WHERE n % 25 = 0", "v_sites")
def q_every_nth(v):
    rows = v.sites.select("site_id", "contig", "position", F.array("ref", "alt").alias("alleles"))
    return recalibrate.every_nth(rows, 25, bin_size=7_000).select("site_id")


@query(SITES, "v_sites")
def q_concat_fragments(v):
    """Five fragments, each over the whole genome, as one file of four parts."""
    path, rows_ = scratch(v, "fragments"), site_rows(v)
    for k in range(5):
        text.write_sites(rows_.filter(F.col("site_id") % 5 == k), f"{path}/{k}", 1, compression="block")
    made = text.concat_fragments(v.spark, [f"{path}/{k}/parts" for k in range(5)], f"{path}/whole", 4, block_gzip=True)
    back = readers.read_variants(v.spark, [f"{path}/whole/{n}" for n in made], {"AC": "int"}, block_gzip=True)
    return back.select("contig", "position", F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"), F.col("info.AC").alias("ac"))
