"""The cohort annotation plan: lookups by variant key, derived fields, one row per variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions import consequences as csq
from varloom.functions import variants as va
from varloom.operators.intervals import liftover
from varloom.operators.joins import lookup
from varloom.plans.recalibrate import without_pass

KEY = ["contig", "position", "alleles"]


def population_frequencies(gnomad: DataFrame, index: dict[str, int], populations: dict[str, str]) -> DataFrame:
    """Key and one struct per population (AC, AF, AN, hom) picked from the frequency array by the globals' index, with the
    filtering frequency and the greatest population frequency. populations: field name to index name."""
    freq = F.col("joint.freq")
    pick = lambda i: F.struct(freq[i]["AC"].alias("AC"), freq[i]["AF"].alias("AF"), freq[i]["AN"].alias("AN"), freq[i]["homozygote_count"].alias("hom"))
    return gnomad.select(*KEY, *[pick(index[p]).alias(name) for name, p in populations.items()], F.col("joint.fafmax.faf95_max").alias("faf95_max"), F.col("joint.grpmax.AF").alias("grpmax_AF"))


# Names of the joint frequencies' groups, and fields that the combined reference gives.
ADJUSTED, ADJUSTED_XY = "adj", "XY_adj"
REFERENCE_FIELDS = ["cadd", "dbnsfp", "geno2mp", "gnomad_exomes", "gnomad_exome_coverage", "gnomad_genomes", "gnomad_genome_coverage", "eigen", "exac", "g1k", "mpc", "primate_ai", "splice_ai"]
SAMPLE_TYPES = {"genome": "WGS", "exome": "WES", "single_cell": "RNA"}


def joint_frequencies(gnomad: DataFrame, index: dict[str, int]) -> DataFrame:
    """Key and the fields of gnomad_joint: counts of the adjusted group by the globals' index, the hemizygous count from its XY
    part, and the greatest frequencies."""
    at = lambda name: F.get("joint.freq", F.lit(index[name]))
    one, xy = at(ADJUSTED), at(ADJUSTED_XY)
    return gnomad.select(
        *KEY, one["AC"].alias("AC"), one["AN"].alias("AN"), one["AF"].alias("AF"), one["homozygote_count"].alias("Hom"),
        F.col("joint.fafmax.faf95_max").alias("FAF_AF"), F.col("joint.grpmax.AF").alias("AF_POPMAX_OR_GLOBAL"), xy["AC"].alias("Hemi"),
    )


def cohort_globals(source: str, build: str = "GRCh38", sequencing_type: str | None = None) -> dict:
    """What the annotated matrix says of itself."""
    out = {"sourceFilePath": source, "genomeVersion": build.replace("GRCh", "")}
    return out | ({"sampleType": SAMPLE_TYPES.get(sequencing_type, "")} if sequencing_type else {})


def _without(df: DataFrame, field: str) -> DataFrame:
    """df without this field of info, a struct or a map."""
    if "info" not in df.columns:
        return df
    t = df.schema["info"].dataType
    if isinstance(t, T.StructType):
        return df.withColumn("info", F.col("info").dropFields(field)) if field in t.names and len(t.names) > 1 else df
    return df.withColumn("info", F.map_filter("info", lambda k, _: k != field)) if isinstance(t, T.MapType) else df


def annotate(rows: DataFrame, vep: DataFrame, recalibrated: DataFrame | None = None, clinvar: DataFrame | None = None, reference: DataFrame | None = None, gnomad: DataFrame | None = None, joint: DataFrame | None = None, scores: DataFrame | None = None, segments: list[tuple] | None = None) -> DataFrame:
    """rows: KEY and, if there, info, filters, AC, AF, AN, a_index, was_split. Each table is projected to what is used before
    its join, and no lookup makes rows. Recalibrated info replaces the row's info whole, and its InbreedingCoeff goes; of
    repeated recalibrated rows one is taken, always the same (by a hash of its fields), as their order says nothing.

    gnomad, reference: become the columns gnomad and ref_data; ref_data's known fields become columns too. joint: as
    joint_frequencies() makes it. scores: normalised_avis and phred. segments: of liftover(), for rg37_locus. Where rows and
    tables are keyed tables of one number of buckets (sources/keyed.py), nothing is shuffled but for the liftover."""
    out = lookup(rows, vep.select(*KEY, "vep"), KEY, "_vep").withColumn("vep", F.col("_vep.vep")).drop("_vep")
    if recalibrated is not None:
        out = lookup(out, recalibrated, KEY, "_site", pick=[F.xxhash64("filters"), F.xxhash64(F.map_entries("info"))])
        out = out.withColumns({"info": F.col("_site.info"), "filters": without_pass(F.coalesce("_site.filters", F.array().cast("array<string>")))}).drop("_site")
    if clinvar is not None:
        out = lookup(out, clinvar.select(*KEY, F.col("info.ALLELEID").alias("allele_id"), F.array_join("info.CLNSIG", ",").alias("clinical_significance"), "gold_stars"), KEY, "clinvar")
    if reference is not None:
        out = lookup(out, reference, KEY, "ref_data")
    if gnomad is not None:
        out = lookup(out, gnomad, KEY, "gnomad")
    if joint is not None:
        out = lookup(out, joint, KEY, "gnomad_joint")
    if scores is not None:
        out = lookup(out, scores.select(*KEY, "normalised_avis", "phred"), KEY, "_score")
        out = out.withColumns({"avis": F.col("_score.normalised_avis"), "avis_phred": F.col("_score.phred")}).drop("_score")
    if reference is not None:
        known = set(out.schema["ref_data"].dataType.names)
        out = out.withColumns({f: F.col(f"ref_data.{f}") for f in REFERENCE_FIELDS if f in known})
    if segments is not None:
        to = F.when(F.col("to_contig").isNotNull(), F.struct(F.col("to_contig").alias("contig"), F.col("to_position").alias("position")))
        out = liftover(out, segments).withColumn("rg37_locus", to).drop("to_contig", "to_position", "to_reverse")
    out = _without(out, "InbreedingCoeff")
    out = out.withColumnsRenamed({k: v for k, v in (("a_index", "aIndex"), ("was_split", "wasSplit")) if k in out.columns})
    ref, alt = F.col("alleles")[0], F.col("alleles")[1]
    contig, pos = F.col("contig"), F.col("position")
    xpos = va.xpos(contig, pos)
    names = {f.name for f in vep.schema["vep"].dataType["transcript_consequences"].dataType.elementType.fields}
    fields = [f for f in csq.SELECTED + csq.SELECTED_CODING + ["domains"] if f in names]
    tc = F.col("vep.transcript_consequences")
    out = out.withColumns({
        "sortedTranscriptConsequences": csq.sorted_transcripts(tc, F.col("vep.most_severe_consequence"), fields),
        "variantId": va.variant_id(contig, pos, ref, alt), "pos": pos, "start": pos, "end": va.end_position(pos, ref), "ref": ref, "alt": alt, "xpos": xpos, "xstart": xpos, "xstop": xpos + F.length(ref) - 1,
    })
    s = F.col("sortedTranscriptConsequences")
    main = [f for f in csq.MAIN + csq.MAIN_CODING if f in {x.name for x in out.schema["sortedTranscriptConsequences"].dataType.elementType.fields}]
    derived = {"transcriptConsequenceTerms": csq.terms_set(s), "transcriptIds": csq.transcript_set(s), "mainTranscript": csq.main_transcript(s, main), "geneIds": csq.gene_set(s), "codingGeneIds": csq.gene_set(s, coding_only=True)}
    if "domains" in fields:
        derived["domains"] = csq.domain_set_of_sorted(s)
    return out.withColumns(derived)


def index_documents(annotated: DataFrame, drop: tuple[str, ...] = ("vep", "ref_data", "position", "alleles")) -> DataFrame:
    """The annotated rows as documents: contig without its prefix, and neither keys nor what was only looked up."""
    return annotated.withColumn("contig", va.short_contig(F.col("contig"))).drop(*drop)
