"""Splitting sites of several alternate alleles, merging samples' alleles, taking samples out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.calls import downcode, global_call, subset_likelihoods, total
from varloom.functions.variants import min_rep


def split_sites(sites: DataFrame) -> DataFrame:
    """One row per alternate allele: a_index, was_split, alleles cut to their minimal form. Other fields aren't subset."""
    rest = [c for c in sites.columns if c not in ("position", "alleles")]
    each = sites.select("*", F.posexplode(F.slice("alleles", 2, F.size("alleles") - 1)).alias("_i", "_alt"))
    each = each.withColumn("_m", min_rep(F.col("position"), F.col("alleles")[0], F.col("_alt")))
    return each.select(*rest, (F.col("_i") + 1).alias("a_index"), (F.size("alleles") > 2).alias("was_split"), F.col("_m.position").alias("position"), F.array("_m.ref", "_m.alt").alias("alleles"))


def split_entries(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Entries for each allele of the site: GT with this allele as 1, AD as [all others, this]. A sample that doesn't list
    the allele has no depth for it and keeps its other calls as reference. Likelihoods LPL of local genotypes, if there,
    become PL of 0/0, 0/1 and 1/1: the least of the genotypes that turn into each, missing where the allele isn't listed."""
    each = cells.withColumn("a_index", F.explode(F.sequence(F.lit(1), F.col("n_alleles") - 1)))
    place = F.array_position("LA", F.col("a_index"))
    own = F.when(place > 0, F.get("LAD", (place - 1).cast("int"))).otherwise(F.lit(0))
    ad = F.when(F.col("LAD").isNotNull(), F.array(total(F.col("LAD")) - own, own))
    rest = [c for c in cells.columns if c not in ("LA", "LGT", "LAD", "LPL", "n_alleles", *keys)]
    if "LPL" in cells.columns:
        n = F.size("LA")
        high = lambda g: F.floor((F.sqrt(g * 8 + 1) - 1) / 2)  # noqa: E731  of genotype number g the greater allele
        low = lambda g: g - high(g) * (high(g) + 1) / 2
        turns = lambda g: (high(g) == place - 1).cast("int") + (low(g) == place - 1).cast("int")
        least = lambda k: F.array_min(F.transform(F.filter(F.sequence(F.lit(0), (n * (n + 1) / 2 - 1).cast("int")), lambda g: turns(g) == k), lambda g: F.get("LPL", g)))
        rest = [*rest, F.when((place > 0) & F.col("LPL").isNotNull(), F.array(least(0), least(1), least(2))).alias("PL")]
    return each.select(*keys, "a_index", downcode(global_call(F.col("LGT"), F.col("LA")), F.col("a_index")).alias("GT"), ad.alias("AD"), *rest)


def combine(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sites, entries) from one row per (contig, position, s, ref, alts, GT, AD): the site's alleles are the longest
    reference and all alternates in order, and each sample keeps only its own alleles, by index, and its other fields: local
    alleles keep their order, so values for each of them, and likelihoods LPL, stay as they are. Entries have the site's alleles
    too. One shuffle by site, whatever the number of samples; alleles are gathered, samples aren't."""
    key = ["contig", "position"]
    one = samples.select(*key, "ref", F.explode_outer("alts").alias("alt")).groupBy(*key).agg(F.collect_set(F.struct("ref", "alt")).alias("_a"))  # the site's alleles, whoever has them
    longest = F.array_min(F.transform("_a", lambda x: F.struct((-F.length(x["ref"])).alias("n"), x["ref"].alias("ref"))))["ref"]
    padded = lambda alt, ref, whole: F.when(alt == "*", alt).otherwise(F.concat(alt, F.substr(whole, F.length(ref) + 1)))
    alts = F.array_sort(F.array_distinct(F.transform(F.filter("_a", lambda x: x["alt"].isNotNull()), lambda x: padded(x["alt"], x["ref"], F.col("_ref")))))
    sites = one.withColumn("_ref", longest).select(*key, F.concat(F.array("_ref"), alts).alias("alleles"))
    cells = samples.join(sites, key)
    la = F.concat(F.array(F.lit(0)), F.transform("alts", lambda a: (F.array_position("alleles", padded(a, F.col("ref"), F.col("alleles")[0])) - 1).cast("int")))
    rest = [c for c in samples.columns if c not in (*key, "s", "ref", "alts", "GT", "AD")]
    return sites, cells.select(*key, "s", "alleles", la.alias("LA"), F.col("GT").alias("LGT"), F.col("AD").alias("LAD"), *rest)


def remove_samples(sites: DataFrame, entries: DataFrame, gone: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(sites, entries) without these samples and without alternate alleles that no call of the rest carries; sites
    without such alleles go. Likelihoods LPL, if there, keep those of the genotypes that are left, in their new order."""
    left = entries.join(gone.select("s").distinct(), "s", "left_anti")
    called = left.select(*key, F.explode(F.array("LGT.a0", "LGT.a1")).alias("_l"), "LA").select(*key, F.get("LA", F.col("_l")).alias("allele")).filter("allele > 0").distinct()
    live = called.groupBy(*key).agg(F.array_sort(F.collect_set("allele")).alias("live"))
    kept = sites.join(live, key)
    new_sites = kept.select(*key, F.concat(F.array(F.col("alleles")[0]), F.transform("live", lambda a: F.get("alleles", a))).alias("alleles"))
    e = left.join(live, key)
    index = lambda a: F.when(a == 0, F.lit(0)).otherwise(F.array_position("live", a).cast("int"))
    keep = F.filter(F.transform("LA", lambda a, i: F.struct(i.alias("i"), a.alias("a"))), lambda x: (x["a"] == 0) | F.array_contains("live", x["a"]))
    e = e.withColumn("_k", keep)
    place = lambda a: (F.array_position(F.col("_k.i"), a) - 1).cast("int")
    lgt = F.when(F.col("LGT").isNotNull(), F.struct(place(F.col("LGT.a0")).alias("a0"), place(F.col("LGT.a1")).alias("a1"), F.col("LGT.phased").alias("phased")))
    rest = [c for c in left.columns if c not in ("LA", "LGT", "LAD", "LPL", *key)]
    lpl = [subset_likelihoods(F.col("LPL"), F.col("_k.i")).alias("LPL")] if "LPL" in left.columns else []
    return new_sites, e.select(*key, *rest, F.transform("_k", lambda x: index(x["a"])).alias("LA"), lgt.alias("LGT"), F.transform("_k", lambda x: F.get("LAD", x["i"])).alias("LAD"), *lpl)
