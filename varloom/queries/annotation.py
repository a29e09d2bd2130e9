"""Queries of the cohort annotation by value, through keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from varloom.plans import annotate_cohort
from varloom.queries.catalog import joined, query
from varloom.queries.engine import scratch
from varloom.sources.keyed import write_keyed, zip_keyed

KEY = annotate_cohort.KEY
#: contig, start, end, to_contig, to_start, reverse, to_size
SEGMENTS = [("chr1", 1, 40_000, "chr1", 101, False, 249_250_621), ("chr2", 1, 60_000, "chr9", 1_001, True, 141_213_431), ("chrX", 30_000, 50_000, "chrX", 5, False, 155_270_560)]


def keys(v):
    return v.sites.select("site_id", "contig", "position", F.array("ref", "alt").alias("alleles"))


def tables(v):
    """Rows and lookup tables by key."""
    site, key = F.col("site_id"), keys(v)
    one = F.struct("transcript_id", "gene_id", "biotype", "canonical", F.array("term1").alias("consequence_terms"))
    t = v.csq.groupBy("site_id").agg(F.collect_list(one).alias("transcript_consequences"))
    freq = lambda k: F.struct((site * k).alias("AC"), (site / (100 * k)).alias("AF"), (site + k).alias("AN"), (site % k).alias("homozygote_count"))
    joint = F.struct(F.array(freq(3), freq(2), freq(5)).alias("freq"), F.struct((site * 0.5).alias("faf95_max")).alias("fafmax"), F.struct((site * 0.25).alias("AF")).alias("grpmax"))
    filters = F.when(site % 2 == 0, F.array(F.lit("PASS"))).otherwise(F.array(F.lit("PASS"), F.lit("low")))
    gnomad = key.filter("site_id % 7 = 0").select(*KEY, joint.alias("joint"))
    return {
        "rows": key.withColumns({"a_index": (site % 3 + 1).cast("int"), "was_split": site % 2 == 0, "AC": site % 11}),
        "vep": key.join(t, "site_id").select(*KEY, F.struct(F.lit("missense_variant").alias("most_severe_consequence"), "transcript_consequences").alias("vep")),
        "recalibrated": key.filter("site_id % 5 <> 0").select(*KEY, F.create_map(F.lit("AC"), site.cast("string"), F.lit("InbreedingCoeff"), F.lit("0.5")).alias("info"), filters.alias("filters")),
        "clinvar": key.filter("site_id % 3 = 0").select(*KEY, F.struct((site + 9).alias("ALLELEID"), F.array(F.lit("Benign"), F.concat(F.lit("c"), site % 4)).alias("CLNSIG")).alias("info"), (site % 5).cast("int").alias("gold_stars")),
        "reference": key.filter("site_id % 4 = 0").select(*KEY, F.struct((site * 2).alias("PHRED")).alias("cadd"), F.struct((site / 8).alias("AF")).alias("gnomad_genomes"), site.alias("eigen")),
        "joint": annotate_cohort.joint_frequencies(gnomad, {"all": 0, "adj": 1, "XY_adj": 2}),
        "scores": key.filter("site_id % 6 = 0").select(*KEY, (site / 4).alias("normalised_avis"), (site / 2).alias("phred")),
    }


def lifted(field: str) -> str:
    cases = []
    for c, a, b, to, first, reverse, size in SEGMENTS:
        place = f"{first} + s.position - {a}"
        cases.append(f"WHEN s.contig = '{c}' AND s.position BETWEEN {a} AND {b} THEN " + (f"'{to}'" if field == "contig" else f"{size} - ({place}) + 1" if reverse else place))
    return f"CASE {' '.join(cases)} END"


@query(f""", a AS (SELECT site_id, gene_id, transcript_id, biotype, term1 FROM v_csq WHERE term1 <> 'upstream_gene_variant'),
g AS (SELECT site_id, string_agg(DISTINCT gene_id, ',' ORDER BY gene_id) AS genes, string_agg(DISTINCT CASE WHEN biotype = 'protein_coding' THEN gene_id END, ',' ORDER BY CASE WHEN biotype = 'protein_coding' THEN gene_id END) AS coding,
      string_agg(DISTINCT term1, ',' ORDER BY term1) AS terms, count(DISTINCT transcript_id) AS transcripts FROM a GROUP BY site_id),
x AS (SELECT site_id, CASE contig WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrM' THEN 25 ELSE CAST(substr(contig, 4) AS BIGINT) END * 1000000000 + position AS xpos FROM v_sites)
SELECT s.site_id, substr(s.contig, 4) || '-' || position || '-' || ref || '-' || alt AS variant_id, substr(s.contig, 4) AS contig, x.xpos, x.xpos + length(ref) - 1 AS xstop, position + length(ref) - 1 AS stop, ref, alt,
CAST(s.site_id % 3 + 1 AS INT) AS a_index, s.site_id % 2 = 0 AS was_split, CASE WHEN s.site_id % 5 <> 0 THEN CAST(s.site_id AS VARCHAR) END AS ac, CASE WHEN s.site_id % 5 <> 0 AND s.site_id % 2 = 1 THEN 'low' ELSE '' END AS filters,
CASE WHEN s.site_id % 3 = 0 THEN s.site_id + 9 END AS allele_id, CASE WHEN s.site_id % 3 = 0 THEN 'Benign,c' || (s.site_id % 4) END AS significance, CASE WHEN s.site_id % 3 = 0 THEN CAST(s.site_id % 5 AS INT) END AS stars,
CASE WHEN s.site_id % 4 = 0 THEN s.site_id * 2 END AS cadd, CASE WHEN s.site_id % 4 = 0 THEN s.site_id / 8.0 END AS genomes_af, CASE WHEN s.site_id % 4 = 0 THEN s.site_id END AS eigen,
CASE WHEN s.site_id % 7 = 0 THEN s.site_id * 2 END AS joint_ac, CASE WHEN s.site_id % 7 = 0 THEN s.site_id + 2 END AS joint_an, CASE WHEN s.site_id % 7 = 0 THEN s.site_id % 2 END AS joint_hom, CASE WHEN s.site_id % 7 = 0 THEN s.site_id * 5 END AS hemi,
CASE WHEN s.site_id % 7 = 0 THEN CAST(s.site_id AS DOUBLE) * 0.5 END AS faf, CASE WHEN s.site_id % 7 = 0 THEN CAST(s.site_id AS DOUBLE) * 0.25 END AS popmax, CASE WHEN s.site_id % 6 = 0 THEN s.site_id / 4.0 END AS avis, CASE WHEN s.site_id % 6 = 0 THEN s.site_id / 2.0 END AS avis_phred,
{lifted('contig')} AS old_contig, {lifted('position')} AS old_position, coalesce(genes, '') AS genes, coalesce(coding, '') AS coding, coalesce(terms, '') AS terms, coalesce(transcripts, 0) AS transcripts
FROM v_sites s JOIN x USING (site_id) LEFT JOIN g ON g.site_id = s.site_id""", "v_sites", "v_csq")
def q_annotate_cohort_fields(v):
    """Every derived field of the annotated cohort but the sorted transcripts, from bucketed tables."""
    t = {name: write_keyed(df, scratch(v, name), KEY, 8) for name, df in tables(v).items()}
    out = annotate_cohort.annotate(t["rows"], t["vep"], t["recalibrated"], t["clinvar"], t["reference"], joint=t["joint"], scores=t["scores"], segments=SEGMENTS)
    out = annotate_cohort.index_documents(out)
    set_ = lambda c: F.coalesce(joined(F.array_sort(c)), F.lit(""))
    return out.select(
        "site_id", F.col("variantId").alias("variant_id"), "contig", "xpos", "xstop", F.col("end").alias("stop"), "ref", "alt", F.col("aIndex").alias("a_index"), F.col("wasSplit").alias("was_split"), F.when(~F.map_contains_key("info", "InbreedingCoeff"), F.col("info")["AC"]).alias("ac"),
        joined(F.col("filters")).alias("filters"), F.col("clinvar.allele_id").alias("allele_id"), F.col("clinvar.clinical_significance").alias("significance"), F.col("clinvar.gold_stars").alias("stars"), F.col("cadd.PHRED").alias("cadd"), F.col("gnomad_genomes.AF").alias("genomes_af"), "eigen",
        F.col("gnomad_joint.AC").alias("joint_ac"), F.col("gnomad_joint.AN").alias("joint_an"), F.col("gnomad_joint.Hom").alias("joint_hom"), F.col("gnomad_joint.Hemi").alias("hemi"), F.col("gnomad_joint.FAF_AF").alias("faf"), F.col("gnomad_joint.AF_POPMAX_OR_GLOBAL").alias("popmax"), "avis", "avis_phred",
        F.col("rg37_locus.contig").alias("old_contig"), F.col("rg37_locus.position").cast("int").alias("old_position"), set_("geneIds").alias("genes"), set_("codingGeneIds").alias("coding"), set_("transcriptConsequenceTerms").alias("terms"), F.coalesce(F.size("transcriptIds"), F.lit(0)).cast("long").alias("transcripts"),
    )


@query(""", a AS (SELECT site_id, gq FROM v_entries WHERE s IN (SELECT s FROM v_samples WHERE dataset_id = 1)), l AS (SELECT site_id, max(gq) AS best FROM a GROUP BY site_id), r AS (SELECT site_id, min(pick_order) AS pick FROM v_ref_lookup GROUP BY site_id)
SELECT coalesce(l.site_id, r.site_id) AS site_id, best, pick FROM l FULL JOIN r ON l.site_id = r.site_id""", "v_entries", "v_samples", "v_ref_lookup")
def q_zip_fragments(v):
    """Two fragments of rows zipped by key, without a shuffle of either."""
    best = v.entries.join(v.samples.filter("dataset_id = 1"), "s").groupBy("site_id").agg(F.max("gq").alias("best"))
    pick = v.ref_lookup.groupBy("site_id").agg(F.min("pick_order").alias("pick"))
    left, right = (write_keyed(df, scratch(v, name), ["site_id"], 8) for df, name in ((best, "left"), (pick, "right")))
    return zip_keyed(left, right, ["site_id"], "other").select("site_id", "best", "other.pick")
