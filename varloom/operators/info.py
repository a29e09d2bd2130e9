"""Site and allele statistics from sparse entries, as grouped aggregates over one row per (site, sample).

Entries have local alleles: LA lists the site's alleles that the sample's call (LGT) and depths (LAD) speak of."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions.calls import adj, count_allele, global_array, global_call, is_het, is_non_ref, total
from varloom.functions.nulls import strict_if
from varloom.functions.stats import binomial_p, fisher_strand, lowqual, lowqual_by_allele, strand_odds


class Fields(NamedTuple):
    """Fields of entries (or of their gvcf_info) by what is made of them: sums, sums as int, medians, element-wise sums of
    arrays of so many elements."""

    sums: list[str]
    int_sums: list[str]
    medians: list[str]
    arrays: dict[str, int]


SITE_FIELDS = Fields(["QUALapprox"], ["VarDP"], ["ReadPosRankSum", "MQRankSum"], {"SB": 4, "RAW_MQandDP": 2})
#: The same from entries with a value for each local allele.
ALLELE_FIELDS = Fields(["AS_QUALapprox", "AS_RAW_MQ"], ["AS_VarDP"], ["AS_RAW_ReadPosRankSum", "AS_RAW_MQRankSum"], {"AS_SB_TABLE": 2})


def entry_field(cells: DataFrame, name: str) -> Column:
    """A field of the entry, else of its gvcf_info; an error if neither has it."""
    if name in cells.columns:
        return F.col(name)
    if "gvcf_info" in cells.columns and name in cells.schema["gvcf_info"].dataType.names:
        return F.col(f"gvcf_info.{name}")
    raise ValueError(f"entries have no field {name}")


def median(x: Column, exact: bool = False) -> Column:
    """The lower middle value; approximate for groups over 10,000 unless exact."""
    return F.expr(f"percentile_disc(0.5) within group (order by {x._jc.toString()})") if exact else F.percentile_approx(x, 0.5, 10_000)


def ratio(n: Column, d: Column, root: bool = False) -> Column:
    """n / d, or its square root; 0 where d is not above 0, missing where it is missing."""
    q = F.try_divide(n, d)
    return strict_if(d > 0, F.sqrt(q) if root else q, F.lit(0.0))


def _aggregates(cells: DataFrame, prefix: str, test: Column | None, fields: Fields = SITE_FIELDS) -> list[Column]:
    pick = lambda f: entry_field(cells, f) if test is None else F.when(test, entry_field(cells, f))
    out = [F.sum(pick(f)).alias(prefix + f) for f in fields.sums]
    out += [F.sum(pick(f)).cast("int").alias(prefix + f) for f in fields.int_sums]
    out += [median(pick(f)).alias(prefix + f) for f in fields.medians]
    out += [F.array(*[F.sum(F.get(pick(f), F.lit(i))) for i in range(n)]).alias(prefix + f) for f, n in fields.arrays.items()]
    return out


def _finish(df: DataFrame, prefix: str) -> DataFrame:
    """With MQ, of RAW_MQandDP or else of RAW_MQ and MQ_DP, which go; with QD where both its parts are there; SB as int."""
    has, col = set(df.columns), lambda f: F.col(prefix + f)
    if f"{prefix}RAW_MQandDP" in has:
        df = df.withColumn(f"{prefix}MQ", ratio(col("RAW_MQandDP")[0], col("RAW_MQandDP")[1], root=True)).drop(f"{prefix}RAW_MQandDP")
    elif {f"{prefix}RAW_MQ", f"{prefix}MQ_DP"} <= has:
        df = df.withColumn(f"{prefix}MQ", ratio(col("RAW_MQ"), col("MQ_DP"), root=True)).drop(f"{prefix}RAW_MQ", f"{prefix}MQ_DP")
    if {f"{prefix}QUALapprox", f"{prefix}VarDP"} <= has:
        df = df.withColumn(f"{prefix}QD", ratio(col("QUALapprox"), col("VarDP")))
    return df.withColumn(f"{prefix}SB", col("SB").cast("array<int>")) if f"{prefix}SB" in has else df


def site_info(cells: DataFrame, keys: list[str], fields: Fields = SITE_FIELDS) -> DataFrame:
    """Statistics of a site over its non-reference calls; DP, if there, over all entries; FS and SOR where SB is asked for."""
    dp = [F.sum("DP").alias("DP")] if "DP" in cells.columns else []
    out = _finish(cells.groupBy(*keys).agg(*_aggregates(cells, "", is_non_ref(F.col("LGT")), fields), *dp), "")
    return out.withColumns({"FS": fisher_strand(F.col("SB")), "SOR": strand_odds(F.col("SB"))}) if "SB" in fields.arrays else out


def by_allele(cells: DataFrame) -> DataFrame:
    """One row per entry and alternate allele that it lists."""
    return cells.withColumn("allele", F.explode(F.filter("LA", lambda a: a > 0)))


def allele_info(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The site statistics again for each alternate allele, over the entries that list it, whatever they call.

    One row per (keys, allele), allele from 1; compute_info() makes arrays of the same."""
    each = by_allele(cells)
    return _finish(each.groupBy(*keys, "allele").agg(*_aggregates(each, "AS_", None)), "AS_")


def strand_table(per_allele: DataFrame, keys: list[str]) -> DataFrame:
    """AS_SB_TABLE: the reference counts summed over alternate alleles, then each allele's own; with AS_FS and AS_SOR."""
    rows = F.sort_array(F.collect_list(F.struct("allele", F.col("AS_SB").alias("sb"))))
    known = F.filter(F.col("rows.sb"), lambda x: x.isNotNull())
    add = lambda i: lambda s, x: s + F.coalesce(x[i], F.lit(0))
    ref = F.array(*[F.aggregate(known, F.lit(0), add(i)) for i in (0, 1)])
    table = F.concat(F.array(ref), F.transform(F.col("rows.sb"), lambda x: F.slice(x, 3, 2)))
    t = per_allele.groupBy(*keys).agg(rows.alias("rows")).withColumn("AS_SB_TABLE", table)
    return _strand_statistics(t).drop("rows")


def _strands(table: str) -> list[Column]:
    """The table, and over its alternate alleles AS_FS and AS_SOR."""
    over = lambda f: F.transform(F.slice(table, F.lit(2), F.size(table) - 1), lambda x: f(F.concat(F.col(table)[0], x)))
    return [F.col(table), over(fisher_strand), over(strand_odds)]


def _strand_statistics(t: DataFrame) -> DataFrame:
    return t.withColumns(dict(zip(("AS_SB_TABLE", "AS_FS", "AS_SOR"), _strands("AS_SB_TABLE"))))


def allele_counts(cells: DataFrame, keys: list[str], groups: dict[str, Column] | None = None) -> DataFrame:
    """AC (of high-quality genotypes) and AC_raw (of those whose quality is known) per (keys, allele), per sample group."""
    each = by_allele(cells).withColumn("_adj", adj(F.col("LGT"), F.col("GQ"), F.col("DP"), F.col("LAD")))
    n = count_allele(global_call(F.col("LGT"), F.col("LA")), F.col("allele"))
    aggs = []
    for name, test in {"": F.lit(True), **(groups or {})}.items():
        tail = f"_{name}" if name else ""
        aggs += [F.coalesce(F.sum(F.when(test & F.col("_adj"), n)), F.lit(0)).cast("int").alias(f"AC{tail}"), F.coalesce(F.sum(F.when(test & F.col("_adj").isNotNull(), n)), F.lit(0)).cast("int").alias(f"AC{tail}_raw")]
    return each.groupBy(*keys, "allele").agg(*aggs)


def balance_p(cells: DataFrame, keys: list[str]) -> DataFrame:
    """AS_pab_max per (keys, allele): the greatest two-sided binomial p of an allele's depth among heterozygous calls."""
    depths = global_array(F.col("LAD"), F.col("LA"), F.col("n_alleles"))
    each = cells.filter(is_het(global_call(F.col("LGT"), F.col("LA")))).withColumn("_d", depths)
    each = each.select(*keys, total(F.col("_d")).alias("_n"), F.posexplode("_d").alias("allele", "_k")).filter("allele > 0")
    return each.groupBy(*keys, "allele").agg(F.max(binomial_p(F.col("_k"), F.col("_n"))).alias("AS_pab_max"))


def _true_aggregates(cells: DataFrame, local, fields: Fields) -> list[Column]:
    """Of fields with a value for each local allele. Rank sums come as arrays whose first element counts."""
    own = lambda f: local(entry_field(cells, f))
    out = [F.sum(own(f)).alias(f"t_{f}") for f in fields.sums] + [F.sum(own(f)).cast("int").alias(f"t_{f}") for f in fields.int_sums]
    out += [median(F.get(own(f), F.lit(0))).alias(f"t_{f.replace('_RAW', '')}") for f in fields.medians]
    out += [F.array(*[F.sum(F.get(own(f), F.lit(i))) for i in range(n)]).cast("array<int>").alias(f"t_{f}") for f, n in fields.arrays.items()]
    return [*out, F.sum(local(F.col("LAD"))).alias("t_depth")]


def _true_finish(rows: DataFrame) -> DataFrame:
    """With AS_MQ, which divides by the allele's own depth, and AS_QD where their parts are there."""
    if "t_AS_RAW_MQ" in rows.columns:
        rows = rows.withColumn("t_AS_MQ", ratio(F.col("t_AS_RAW_MQ"), F.col("t_depth"), root=True)).drop("t_AS_RAW_MQ")
    if {"t_AS_QUALapprox", "t_AS_VarDP"} <= set(rows.columns):
        rows = rows.withColumn("t_AS_QD", ratio(F.col("t_AS_QUALapprox"), F.col("t_AS_VarDP")))
    return rows


def true_allele_info(cells: DataFrame, keys: list[str], fields: Fields = ALLELE_FIELDS) -> DataFrame:
    """From entries with one value per local allele: each value goes to its allele of the site. One row per (keys, allele);
    allele 0 has the reference's strands."""
    each = cells.select("*", F.posexplode("LA").alias("_i", "allele"))
    out = _true_finish(each.groupBy(*keys, "allele").agg(*_true_aggregates(each, lambda x: F.get(x, F.col("_i")), fields)))
    return out.drop("t_depth").withColumnsRenamed({c: c[2:] for c in out.columns if c.startswith("t_")})


def compute_info(
    cells: DataFrame, keys: list[str], site: bool = False, allele_specific: bool = False, quasi: bool = True, indel_prior: int = 40, partitions: int | None = None,
    groups: dict[str, Column] | None = None, fields: Fields = SITE_FIELDS, allele_fields: Fields = ALLELE_FIELDS,
) -> DataFrame:
    """All statistics of a site: cells have keys, alleles, n_alleles and the entry fields. One row per site.

    Arrays have an element for each alternate allele, listed or not. With true allele statistics, quasi ones go to a
    struct quasi_info. AC and AC_raw are always made, for each group of samples (name: test) too; the site flag comes with
    site statistics, the allele flags with allele statistics, as without them there is no quality to judge by. fields: those
    of site and quasi statistics; allele_fields: those of true ones; RAW_MQ and MQ_DP may stand for RAW_MQandDP.

    Plan: a cell becomes a row for the site (allele -1) and one for each allele it lists; one aggregate by (keys, allele)
    makes every statistic, added up in each task before the only exchange of cells. What a site's few rows hold then meets."""
    if not (site or allele_specific or quasi):
        raise ValueError("ask for one kind of statistics at least")
    tests = {"": F.lit(True), **(groups or {})}
    gt = global_call(F.col("LGT"), F.col("LA"))
    each = cells.withColumns({"_adj": adj(F.col("LGT"), F.col("GQ"), F.col("DP"), F.col("LAD")), "_gt": gt, "_reads": F.when(is_het(gt), total(F.col("LAD"))), **{f"_in_{g}": t for g, t in tests.items()}})
    each = each.select("*", F.posexplode(F.concat(F.array(F.lit(-1)), "LA")).alias("_i", "_allele"))
    local = lambda x: F.get(x, F.col("_i") - 1)
    whole, alt = F.col("_allele") < 0, F.col("_allele") > 0
    carried = count_allele(F.col("_gt"), F.col("_allele"))
    aggs = [F.first(F.when(whole, F.struct("alleles", "n_alleles")), ignorenulls=True).alias("of"), F.min(F.when(whole, F.col("_reads"))).alias("reads")]
    aggs += [F.max(F.when(alt & F.col("_reads").isNotNull(), binomial_p(local(F.col("LAD")), F.col("_reads")))).alias("pab")]
    for g in tests:
        aggs += [F.coalesce(F.sum(F.when(alt & F.col(f"_in_{g}") & known, carried)), F.lit(0)).cast("int").alias(f"n{tail}_{g}") for tail, known in (("", F.col("_adj")), ("raw", F.col("_adj").isNotNull()))]
    if site or quasi:
        aggs += _aggregates(each, "AS_", alt | (whole & is_non_ref(F.col("LGT"))), fields)
    if site and "DP" in cells.columns:
        aggs += [F.sum(F.when(whole, F.col("DP"))).alias("DP")]
    if allele_specific:
        aggs += _true_aggregates(each, local, allele_fields)
    rows = each.groupBy(*keys, "_allele").agg(*aggs)
    rows = _finish(rows, "AS_") if site or quasi else rows
    rows = _true_finish(rows) if allele_specific else rows
    stats = [c for c in rows.columns if c not in (*keys, "_allele")]
    met = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_allele", F.struct(*stats)))).alias("_m"))
    met = met.select(*keys, F.col("_m")[-1].alias("_site"), "_m").withColumns({"alleles": F.col("_site.of.alleles"), "_n": F.col("_site.of.n_alleles")})
    met = met.withColumn("_alts", F.when(F.col("_n") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.col("_n") - 1, F.lit(1))), lambda a: F.try_element_at("_m", a))))

    def array(f: str, zero: bool = False) -> Column:
        x = F.col(f"_alts.{f}")
        return F.transform(x, lambda y: F.coalesce(y, F.lit(0).cast(rows.schema[f].dataType))) if zero else x

    made = {}
    if quasi:
        mine = {f: array(f, f in ("AS_QUALapprox", "AS_VarDP", "AS_QD")).alias(f) for f in rows.columns if f.startswith("AS_") and f != "AS_SB"}
        if "SB" in fields.arrays:
            ref = lambda i: F.aggregate(F.filter("_alts.AS_SB", lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + F.coalesce(x[i], F.lit(0)))
            table = F.when(F.col("_alts").isNotNull(), F.concat(F.array(F.array(ref(0), ref(1))), F.transform("_alts.AS_SB", lambda x: F.slice(x, 3, 2))))
            met = met.withColumn("_quasi_table", table)
            mine |= dict(zip(("AS_SB_TABLE", "AS_FS", "AS_SOR"), _strands("_quasi_table")))
        made = {"quasi_info": F.struct(*[x.alias(f) for f, x in mine.items()])} if allele_specific else mine
    if allele_specific:
        made |= {f[2:]: array(f, f in ("t_AS_QUALapprox", "t_AS_VarDP", "t_AS_QD")) for f in rows.columns if f.startswith("t_AS_") and f != "t_AS_SB_TABLE"}
        if "AS_SB_TABLE" in allele_fields.arrays:
            met = met.withColumn("_true_table", F.concat(F.array(F.try_element_at("_m", F.lit(0))["t_AS_SB_TABLE"]), F.coalesce("_alts.t_AS_SB_TABLE", F.array())))
            made |= dict(zip(("AS_SB_TABLE", "AS_FS", "AS_SOR"), _strands("_true_table")))
    if quasi or allele_specific:
        # a cell that doesn't list an allele has no reads of it, which is likeliest for the least number of reads
        made["AS_pab_max"] = F.transform(array("pab"), lambda p: F.greatest(p, F.col("_none")))
        met = met.withColumn("_none", binomial_p(F.lit(0), F.col("_site.reads")))
    if site:
        made |= {f[3:]: F.col(f"_site.{f}") for f in rows.columns if f.startswith("AS_")} | ({"DP": F.col("_site.DP")} if "DP" in rows.columns else {})
        if "SB" in fields.arrays:
            made |= {"FS": fisher_strand(F.col("_site.AS_SB")), "SOR": strand_odds(F.col("_site.AS_SB"))}
    for g in tests:
        tail = f"_{g}" if g else ""
        made |= {f"AC{tail}": array(f"n_{g}", True), f"AC{tail}_raw": array(f"nraw_{g}", True)}
    info = met.select(*keys, "alleles", *[x.alias(f) for f, x in made.items()])
    snv, indel = 60, 30 + indel_prior
    if "AS_QUALapprox" in info.columns:
        info = info.withColumn("AS_lowqual", lowqual_by_allele(F.col("alleles"), F.col("AS_QUALapprox"), snv, indel))
    if "QUALapprox" in info.columns:
        info = info.withColumn("lowqual", lowqual(F.col("alleles"), F.col("QUALapprox"), snv, indel))
    return info.coalesce(partitions) if partitions else info
