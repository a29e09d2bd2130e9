"""Queries of cohorts that are read from sample files, merged and reduced, and of site statistics by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from varloom.functions import calls
from varloom.operators import info, split
from varloom.operators.sparse import SparseFrame
from varloom.queries.catalog import AT, SOR, X, joined, query, sparse
from varloom.queries.engine import SITES, X2, cohort, scratch, site_rows, unlisted
from varloom.sinks import text
from varloom.sources import gvcf, readers


@query(SITES, "v_sites")
def q_block_gzip_sites(v):
    """Sites through block gzip shards, which are read in splits."""
    path = scratch(v, "sites")
    names = text.write_sites(site_rows(v), path, 3, compression="block")
    back = readers.read_variants(v.spark, [f"{path}/{n}" for n in names], {"AC": "int"}, block_gzip=True)
    return back.select("contig", "position", F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"), F.col("info.AC").alias("ac"))


@query(SITES + " WHERE contig = 'chr2' AND position + length(ref) > 2000 AND position <= 60000 OR contig = 'chr5' AND position + length(ref) > 1 AND position <= 9000 OR contig = 'chrX'", "v_sites")
def q_region_sites(v):
    """Sites of regions from block gzip shards with position indexes."""
    path = scratch(v, "sites")
    names = text.write_sites(site_rows(v), path, 3, compression="block", index=True)
    back = readers.read_variants(v.spark, [f"{path}/{n}" for n in names], {"AC": "int"}, intervals=[("chr2", 2000, 60000), ("chr5", 1, 9000), ("chrX", 1, 156040895)])
    return back.select("contig", "position", F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"), F.col("info.AC").alias("ac"))


def likelihoods(gq):
    return F.when(gq.isNotNull(), F.array(F.lit(0), gq % 7 + 1, gq % 11 + 2))


def num_alt():
    return F.when(F.col("LGT").isNotNull(), calls.n_alt_alleles(F.col("LGT")))


PL = "'0,' || (gq % 7 + 1) || ',' || (gq % 11 + 2)"


@query(f""", e AS (SELECT contig, position, s, n_alt, gq, dp, ad_ref, ad_alt, (site_id + gq) % 3 = 0 AND n_alt = 0 AS in_block FROM v_entries JOIN v_sites USING (site_id) WHERE n_alt IS NOT NULL)
SELECT in_block, contig, position AS start, CASE WHEN in_block THEN position + 5 ELSE position END AS stop, s, n_alt AS num_alt, gq, dp,
CASE WHEN NOT in_block THEN ad_ref || ',' || ad_alt END AS ad, CASE WHEN NOT in_block THEN {PL} END AS pl FROM e""", "v_entries", "v_sites")
def q_gvcf_files(v):
    """Variants and blocks through one file a sample."""
    path, c = scratch(v, "samples"), cohort(v, once=True)
    gvcf.write_gvcf(SparseFrame(c.variants.withColumn("LPL", likelihoods(F.col("GQ"))), c.blocks, c.cols), path)
    back = gvcf.read_gvcf(v.spark, path)
    list_ = lambda c: joined(F.col(c).cast("array<string>"))
    variants = back.variants.select(F.lit(False).alias("in_block"), "contig", F.col("position").alias("start"), F.col("position").alias("stop"), "s", num_alt().alias("num_alt"), F.col("GQ").alias("gq"), F.col("DP").alias("dp"), list_("LAD").alias("ad"), list_("LPL").alias("pl"))
    none = F.lit(None).cast("string")
    return variants.unionByName(back.blocks.select(F.lit(True).alias("in_block"), "contig", "start", F.col("end").alias("stop"), "s", F.lit(0).alias("num_alt"), F.col("GQ").alias("gq"), F.col("DP").alias("dp"), none.alias("ad"), none.alias("pl")))


@query(f""", x AS (SELECT CAST(floor(site_id / 3) AS BIGINT) + 1 AS position, s, CASE site_id % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'G' ELSE 'TT' END AS alt, n_alt, gq, CASE WHEN dataset_id % 2 = 0 THEN dp END AS dp FROM v_entries JOIN v_samples USING (s) WHERE n_alt IS NOT NULL),
a AS (SELECT position, list_sort(list(DISTINCT alt)) AS alts FROM x WHERE n_alt > 0 GROUP BY position)
SELECT 'variant' AS kind, position, s, 'A/' || array_to_string(alts, '/') AS alleles, '0,' || list_position(alts, alt) AS la, {PL} AS pl, n_alt AS num_alt, dp FROM x JOIN a USING (position) WHERE n_alt > 0
UNION ALL SELECT 'block', position, s, NULL, NULL, NULL, 0, dp FROM x WHERE n_alt = 0""", "v_entries", "v_samples")
def q_merge_tree(v):
    """Eight cohorts, of which every other has no depths, merged three at a time in two levels."""
    e = v.entries.join(v.samples, "s").filter("n_alt is not null")
    alt = F.when(F.col("site_id") % 3 == 0, "C").when(F.col("site_id") % 3 == 1, "G").otherwise("TT")
    e = e.select("s", "dataset_id", "n_alt", F.lit("chr1").alias("contig"), (F.floor(F.col("site_id") / 3) + 1).alias("position"), F.array(F.lit("A"), alt).alias("alleles"), F.array(F.lit(0), F.lit(1)).alias("LA"),
                 calls.diploid(F.col("n_alt")).alias("LGT"), F.array("ad_ref", "ad_alt").alias("LAD"), F.col("gq").alias("GQ"), F.col("dp").alias("DP"), likelihoods(F.col("gq")).alias("LPL"))
    e = readers.checkpoint(e, scratch(v, "entries"))

    def part(k):
        own, lacks = e.filter(F.col("dataset_id") % 8 == k), ["DP"] if k % 2 else []
        blocks = own.filter("n_alt = 0").select("contig", F.col("position").alias("start"), F.col("position").alias("end"), "s", "GQ", "DP").drop(*lacks)
        return SparseFrame(own.filter("n_alt > 0").drop("n_alt", "dataset_id", *lacks), blocks, v.samples.filter(f"dataset_id % 8 = {k}").select("col_idx", "s"))

    m = SparseFrame.merge_tree([part(k) for k in range(8)], scratch(v, "merged"), branch=3)
    list_ = lambda c: joined(F.col(c).cast("array<string>"))
    none = F.lit(None).cast("string")
    variants = m.variants.select(F.lit("variant").alias("kind"), "position", "s", F.array_join("alleles", "/").alias("alleles"), list_("LA").alias("la"), list_("LPL").alias("pl"), num_alt().alias("num_alt"), F.col("DP").alias("dp"))
    return variants.unionByName(m.blocks.select(F.lit("block").alias("kind"), F.col("start").alias("position"), "s", none.alias("alleles"), none.alias("la"), none.alias("pl"), F.lit(0).alias("num_alt"), F.col("DP").alias("dp")))


SIX = ("0", "(gq % 7 + 1)", "(gq % 11 + 2)", "(gq % 5 + 3)", "(gq % 13 + 4)", "(gq % 17 + 5)")


@query(f""", x AS (SELECT CAST(floor(site_id / 3) AS BIGINT) AS locus_id, site_id, s, n_alt, gq, CAST(site_id % 3 + 1 AS INT) AS m, CAST((site_id + 1) % 3 + 1 AS INT) AS m2 FROM v_entries JOIN v_samples USING (s) WHERE dataset_id = 3),
live AS (SELECT DISTINCT locus_id, m AS allele FROM x WHERE n_alt > 0), nth AS (SELECT *, row_number() OVER (PARTITION BY locus_id ORDER BY allele) AS i FROM live)
SELECT x.locus_id, site_id, s, '0' || coalesce(',' || a.i, '') || coalesce(',' || b.i, '') AS la,
CASE WHEN gq IS NULL THEN NULL WHEN a.i IS NOT NULL AND b.i IS NOT NULL THEN {" || ',' || ".join(SIX)} WHEN a.i IS NOT NULL THEN {" || ',' || ".join(SIX[:3])} WHEN b.i IS NOT NULL THEN {" || ',' || ".join((SIX[0], SIX[3], SIX[5]))} ELSE '0' END AS pl
FROM x LEFT JOIN nth a ON a.locus_id = x.locus_id AND a.allele = m LEFT JOIN nth b ON b.locus_id = x.locus_id AND b.allele = m2 WHERE x.locus_id IN (SELECT locus_id FROM live)""", "v_entries", "v_samples")
def q_remove_likelihoods(v):
    """Entries of three local alleles after most samples went: likelihoods follow the alleles that are left."""
    gq, m = F.col("gq"), lambda k: ((F.col("site_id") + k) % 3 + 1).cast("int")
    six = F.when(gq.isNotNull(), F.array(F.lit(0), gq % 7 + 1, gq % 11 + 2, gq % 5 + 3, gq % 13 + 4, gq % 17 + 5))
    e = v.entries.select(F.floor(F.col("site_id") / 3).alias("locus_id"), "site_id", "s", F.array(F.lit(0), m(0), m(1)).alias("LA"), calls.diploid(F.col("n_alt")).alias("LGT"), F.array("ad_ref", "ad_alt", F.lit(0)).alias("LAD"), six.alias("LPL"))
    sites = e.select("locus_id").distinct().withColumn("alleles", F.array(*[F.lit(x) for x in ("A", "C", "G", "T")]))
    _, left = split.remove_samples(sites, e, v.samples.filter("dataset_id <> 3"), ["locus_id"])
    return left.select("locus_id", "site_id", "s", joined(F.col("LA").cast("array<string>")).alias("la"), joined(F.col("LPL").cast("array<string>")).alias("pl"))


@query(f""", {X} SELECT site_id, s, CASE WHEN gq IS NOT NULL THEN array_to_string(list_transform(range(10), lambda g: CASE WHEN g = 0 THEN '0' WHEN g = allele * (allele + 1) // 2 THEN CAST(gq % 7 + 1 AS VARCHAR)
WHEN g = allele * (allele + 1) // 2 + allele THEN CAST(gq % 11 + 2 AS VARCHAR) ELSE 'NA' END), ',') END AS pl FROM x""", "v_entries")
def q_global_likelihoods(v):
    pl = calls.global_likelihoods(likelihoods(F.col("GQ")), F.col("LA"), F.col("n_alleles"))
    return sparse(v).select("site_id", "s", F.array_join(pl.cast("array<string>"), ",", "NA").alias("pl"))


RATIO = "CASE WHEN {d} > 0 THEN {f} WHEN {d} IS NOT NULL THEN 0.0 END"


@query(f""", {X2}, q AS (SELECT locus_id, allele, CAST(sum(ad_alt * 900) AS DOUBLE) AS raw, sum(dp) AS mdp FROM y GROUP BY locus_id, allele),
w AS (SELECT locus_id, CAST(sum(gq * 10) AS BIGINT) AS qual, CAST(sum(ad_alt * 900) AS DOUBLE) AS raw, sum(dp) AS mdp FROM y WHERE n_alt > 0 GROUP BY locus_id)
SELECT la.locus_id, min(w.qual) AS qual, min(round({RATIO.format(d='w.mdp', f='sqrt(w.raw / w.mdp)')}, 6)) AS mq,
string_agg(coalesce(CAST(CAST(round(1000 * {RATIO.format(d='q.mdp', f='sqrt(q.raw / q.mdp)')}) AS BIGINT) AS VARCHAR), 'NA'), ',' ORDER BY la.allele) AS as_mq
FROM la LEFT JOIN w ON w.locus_id = la.locus_id LEFT JOIN q ON q.locus_id = la.locus_id AND q.allele = la.allele GROUP BY la.locus_id""", "v_entries")
def q_info_fields(v):
    """Statistics of fields that the caller names, mapping quality from RAW_MQ and MQ_DP."""
    e = unlisted(v).withColumn("gvcf_info", F.struct(F.col("gvcf_info.QUALapprox").alias("QUALapprox"), (F.col("LAD")[1] * 900).alias("RAW_MQ"), F.col("DP").alias("MQ_DP")))
    i = info.compute_info(e, ["locus_id"], site=True, fields=info.Fields(["QUALapprox", "RAW_MQ", "MQ_DP"], [], [], {}))
    whole = F.transform("AS_MQ", lambda x: F.round(x * 1000).cast("long"))
    return i.select("locus_id", F.col("QUALapprox").alias("qual"), F.round("MQ", 6).alias("mq"), F.array_join(whole.cast("array<string>"), ",", "NA").alias("as_mq"))


@query(f""", {X2}, q AS (SELECT locus_id, allele, sum(gq) AS qual, sum(dp) AS dp, sum(ad_alt) AS sb2, sum(ad_alt + 1) AS sb3 FROM y GROUP BY locus_id, allele),
z AS (SELECT locus_id, sum(ad_ref) AS sb0, sum(ad_ref + 2) AS sb1 FROM y GROUP BY locus_id), b AS (SELECT * FROM q JOIN z USING (locus_id)),
u AS (SELECT locus_id, allele, sb0 + sb1 + sb2 + sb3 AS s, CAST(sb0 AS DOUBLE) AS a, CAST(sb1 AS DOUBLE) AS b, CAST(sb2 AS DOUBLE) AS c, CAST(sb3 AS DOUBLE) AS d FROM b),
k AS (SELECT locus_id, allele, s, CAST(trunc(CASE WHEN s <= 400 THEN a ELSE a / (s / 200.0) END) AS INT) AS sb0, CAST(trunc(CASE WHEN s <= 400 THEN b ELSE b / (s / 200.0) END) AS INT) AS sb1,
      CAST(trunc(CASE WHEN s <= 400 THEN c ELSE c / (s / 200.0) END) AS INT) AS sb2, CAST(trunc(CASE WHEN s <= 400 THEN d ELSE d / (s / 200.0) END) AS INT) AS sb3 FROM u),
t AS (SELECT *, sb0 + sb1 AS r, sb0 + sb2 AS c, sb0 + sb1 + sb2 + sb3 AS n FROM k),
p AS (SELECT locus_id, allele, any_value(s) AS s, sum(CASE WHEN {AT.format('x')} <= {AT.format('sb0')} + 1e-7 THEN exp({AT.format('x')}) ELSE 0 END) AS p FROM t, unnest(range(greatest(0, r + c - n), least(r, c) + 1)) AS w(x) GROUP BY locus_id, allele)
SELECT locus_id, allele, round(sqrt(CAST(dp AS DOUBLE) / sb2), 6) AS mq, round({RATIO.format(d='dp', f='CAST(qual AS DOUBLE) / dp')}, 6) AS qd, {SOR}, CASE WHEN s > 4 THEN round(greatest(0, -10 * log10(least(1, p))), 5) END AS fs
FROM b JOIN p USING (locus_id, allele)""", "v_entries")
def q_true_as_values(v):
    """True allele statistics of the alleles that entries list, by value."""
    pair = lambda n: F.array(*[F.array(F.lit(float(x))) for x in range(n)])
    ad = F.col("LAD")
    g = {"AS_QUALapprox": F.array(F.lit(0).cast("long"), F.col("GQ").cast("long")), "AS_RAW_MQ": F.array(F.lit(0), F.col("DP")), "AS_VarDP": F.array(F.lit(0), F.col("DP")), "AS_RAW_ReadPosRankSum": pair(2),
         "AS_RAW_MQRankSum": pair(2), "AS_SB_TABLE": F.array(F.array(ad[0], ad[0] + 2), F.array(ad[1], ad[1] + 1))}
    e = unlisted(v).withColumn("gvcf_info", F.struct(*[c.alias(k) for k, c in g.items()]))
    i = info.compute_info(e, ["locus_id"], allele_specific=True, quasi=False)
    each = i.select("locus_id", F.posexplode(F.arrays_zip("AS_MQ", "AS_QD", "AS_SOR", "AS_FS")).alias("k", "z"))
    return each.filter("z.AS_SOR IS NOT NULL").select("locus_id", (F.col("k") + 1).alias("allele"), F.round("z.AS_MQ", 6).alias("mq"), F.round("z.AS_QD", 6).alias("qd"), F.round("z.AS_SOR", 5).alias("sor"), F.round("z.AS_FS", 5).alias("fs"))
