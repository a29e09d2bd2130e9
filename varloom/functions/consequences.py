"""Transcript consequences: ranking, categories, protein change text, sorted arrays and sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from varloom.functions.nulls import sorted_set, strict_case, strict_if

# Consequence terms of the public sequence ontology as annotators order them, most severe first.
TERMS = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "stop_lost", "start_lost",
    "initiator_codon_variant", "transcript_amplification", "inframe_insertion", "inframe_deletion", "missense_variant", "protein_altering_variant",
    "splice_region_variant", "incomplete_terminal_codon_variant", "start_retained_variant", "stop_retained_variant", "synonymous_variant",
    "coding_sequence_variant", "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant",
    "non_coding_exon_variant", "intron_variant", "NMD_transcript_variant", "non_coding_transcript_variant", "nc_transcript_variant",
    "upstream_gene_variant", "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification", "TF_binding_site_variant",
    "regulatory_region_ablation", "regulatory_region_amplification", "feature_elongation", "regulatory_region_variant", "feature_truncation",
    "intergenic_variant",
]
OMITTED = ["upstream_gene_variant", "downstream_gene_variant"]
SPLICE = ["splice_donor_variant", "splice_acceptor_variant", "splice_region_variant"]
AMINO_ACIDS = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu", "M": "Met", "N": "Asn",
    "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "X": "Ter", "*": "Ter", "U": "Sec",
}
SELECTED = ["biotype", "canonical", "cdna_start", "cdna_end", "codons", "gene_id", "gene_symbol", "hgvsc", "hgvsp", "transcript_id"]
SELECTED_CODING = ["amino_acids", "lof", "lof_filter", "lof_flags", "lof_info", "polyphen_prediction", "protein_id", "protein_start", "sift_prediction"]
MAIN = ["biotype", "canonical", "category", "cdna_start", "cdna_end", "codons", "gene_id", "gene_symbol", "hgvs", "hgvsc", "major_consequence", "major_consequence_rank", "transcript_id"]
MAIN_CODING = ["amino_acids", "domains", "hgvsp", "lof", "lof_flags", "lof_filter", "lof_info", "polyphen_prediction", "protein_id", "sift_prediction"]


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def rank(term: Column) -> Column:
    """Severity of a term, 0 worst; NULL for unknown terms."""
    return _map({t: i for i, t in enumerate(TERMS)})[term]


def worst(terms: Column) -> Column:
    """The most severe term; unknown ones come last and ties keep their order."""
    keyed = F.transform(terms, lambda t, i: F.struct(F.coalesce(rank(t), F.lit(len(TERMS))).alias("r"), i.alias("i"), t.alias("t")))
    return F.get(F.array_sort(keyed), F.lit(0))["t"]


def category(major: Column) -> Column:
    """lof, missense, synonymous or other; NULL for an unknown term."""
    r = rank(major)
    upto = lambda t: r <= TERMS.index(t)
    return strict_case([(upto("frameshift_variant"), F.lit("lof")), (upto("missense_variant"), F.lit("missense")), (upto("synonymous_variant"), F.lit("synonymous"))], F.lit("other"))


def hgvs(hgvsc: Column, hgvsp: Column, major: Column, amino_acids: Column, protein_start: Column) -> Column:
    """The change as text: of the transcript at splice sites or without a protein change, else of the protein."""
    last = lambda x: F.element_at(F.split(x, ":"), -1)
    letters = F.array_join(F.transform(F.split(amino_acids, ""), lambda x: _map(AMINO_ACIDS)[x]), "")
    same = F.concat(F.lit("p."), letters, protein_start.cast("string"), letters)
    protein = strict_if(hgvsp.contains("=") | hgvsp.contains("%3D"), same, last(hgvsp))
    return strict_if(hgvsp.isNull() | F.coalesce(major.isin(SPLICE), F.lit(False)), last(hgvsc), protein)


def terms_set(transcripts: Column) -> Column:
    return sorted_set(F.flatten(transcripts["consequence_terms"]))


def gene_set(transcripts: Column, coding_only: bool = False) -> Column:
    t = F.filter(transcripts, lambda c: F.coalesce(c["biotype"], F.lit("")) == "protein_coding") if coding_only else transcripts
    return sorted_set(t["gene_id"])


def transcript_set(transcripts: Column) -> Column:
    return sorted_set(transcripts["transcript_id"])


def domain_set(transcripts: Column) -> Column:
    """db:name of every domain, from raw transcripts."""
    return sorted_set(F.flatten(F.transform(transcripts["domains"], lambda ds: F.transform(ds, lambda d: F.concat(d["db"], F.lit(":"), d["name"])))))


def domain_set_of_sorted(sorted_: Column) -> Column:
    return sorted_set(F.flatten(sorted_["domains"]))


def sorted_transcripts(transcripts: Column, most_severe: Column, fields: list[str] | None = None, coding: bool = True, omitted: list[str] | None = None) -> Column:
    """Transcripts with something left after the omitted terms go: coding first, then with the site's most severe term,
    then canonical; ties keep their order. fields: those of the transcripts that are there to be kept."""
    fields = fields if fields is not None else SELECTED + (SELECTED_CODING if coding else [])
    omitted = OMITTED if omitted is None else omitted
    has = lambda f: f in fields

    def shape(c, i):
        left = F.filter(c["consequence_terms"], lambda t: ~t.isin(omitted)) if omitted else c["consequence_terms"]
        major = worst(c["consequence_terms"])
        place = F.when(F.coalesce(c["biotype"], F.lit("")) == "protein_coding", 0).otherwise(4) + F.when(F.array_contains(left, most_severe), 0).otherwise(2) + F.when(F.coalesce(c["canonical"], F.lit(0)) == 1, 1).otherwise(2)
        extra = [left.alias("consequence_terms"), major.alias("major_consequence"), category(major).alias("category"), rank(major).alias("major_consequence_rank")]
        if coding and has("domains"):
            extra.append(F.transform(c["domains"], lambda d: F.concat(d["db"], F.lit(":"), d["name"])).alias("domains"))
        if has("hgvsc") and has("hgvsp"):
            null = F.lit(None).cast("string")
            extra.append(hgvs(c["hgvsc"], c["hgvsp"], major, c["amino_acids"] if has("amino_acids") else null, c["protein_start"] if has("protein_start") else null).alias("hgvs"))
        kept = [c[f].alias(f) for f in fields if f != "domains" and (coding or f != "hgvsp")]
        return F.struct(place.alias("place"), i.alias("at"), F.struct(*kept, *extra).alias("c"))

    shaped = F.filter(F.transform(transcripts, shape), lambda x: F.size(x["c"]["consequence_terms"]) > 0)
    ordered = F.array_sort(shaped, lambda x, y: F.when(F.struct(x["place"], x["at"]) < F.struct(y["place"], y["at"]), -1).otherwise(1))
    return F.transform(ordered, lambda x, i: x["c"].withField("transcript_rank", i.cast("int")))


def main_transcript(sorted_: Column, fields: list[str]) -> Column:
    """The first transcript's fields; all NULL where there is none. domains become one text."""
    first = F.get(sorted_, F.lit(0))
    pick = lambda f: F.array_join(sorted_set(first["domains"]), ",") if f == "domains" else first[f]
    return F.struct(*[pick(f).alias(f) for f in fields])


def gene_consequences(sorted_: Column, genes: Column) -> Column:
    """Text of a JSON object: each gene's worst consequence, that of its first transcript."""
    one = lambda g: F.concat(F.lit('"'), g, F.lit('":"'), F.get(F.filter(sorted_, lambda c: c["gene_id"] == g), F.lit(0))["major_consequence"], F.lit('"'))
    return F.concat(F.lit("{"), F.array_join(F.transform(genes, one), ","), F.lit("}"))


def transcript_consequences(transcripts: Column) -> Column:
    one = lambda c: F.concat(F.lit('"'), c["transcript_id"], F.lit('": "'), c["major_consequence"], F.lit('"'))
    return F.concat(F.lit("{"), F.array_join(F.transform(transcripts, one), ","), F.lit("}"))
