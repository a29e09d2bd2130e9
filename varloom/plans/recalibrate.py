"""Score thresholds by tranche, and filters from them.

A site's score comes from mixture models over strand, position, mapping and depth statistics: train_model() fits one to
training sites and one to the sites that it fits worst, and the score is the log ratio of both with the site's prior
(an approximation of the external tool's model; train_scores() has the first alone). A tranche's threshold is the score that
keeps its share of truth sites, counted exactly or gathered from tables of fragments."""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.variants import contig_index

# Sensitivities, in percent of truth sites, by kind of variant, and features of the models.
SNP_TRANCHES = [100.0, 99.95, 99.9, 99.8, 99.6, 99.5, 99.4, 99.3, 99.0, 98.0, 97.0, 90.0]
INDEL_TRANCHES = [100.0, 99.95, 99.9, 99.5, 99.0, 97.0, 96.0, 95.0, 94.0, 93.5, 93.0, 92.0, 91.0, 90.0]
INDEL_FEATURES = ["AS_ReadPosRankSum", "AS_MQRankSum", "AS_QD", "AS_FS", "AS_SOR"]
SNP_FEATURES = [*INDEL_FEATURES, "AS_MQ"]
SNP_SENSITIVITY, INDEL_SENSITIVITY = 99.7, 99.0
#: Share of the sites on each side of a tranche's place that a round of tranche_thresholds() leaves.
NEAR = 0.0002


def tranche_thresholds(scored: DataFrame, tranches: list[float], truth: str = "truth", score: str = "score") -> list[tuple[float, float]]:
    """(sensitivity, least score kept) over all truth sites with a score, exactly: of n such sites the score at place
    ceil((1 - share) * n) from the least. Approximate quantiles give scores on both sides of a place; counts of what is below
    them and equal to them say which of them it is, or between which two it lies, where the next round looks. A round has two
    aggregates for all tranches and leaves some ten-thousandths of the sites, so there are few; write scored to a table first if
    it is costly."""
    of = scored.filter(F.col(truth) & F.col(score).isNotNull()).select(F.col(score).alias("_s"))
    n = of.count()
    if not n:
        return []
    found, left = {}, {i: (None, None, 0, n, max(1, math.ceil((1 - Fraction(str(t)) / 100) * n))) for i, t in enumerate(tranches)}
    while left:
        inside = {i: reduce(lambda a, b: a & b, [F.col("_s") > low] * (low is not None) + [F.col("_s") < high] * (high is not None), F.lit(True)) for i, (low, high, *_) in left.items()}
        rows = of.filter(reduce(lambda a, b: a | b, inside.values()))
        near = lambda below, size, place: [min(1.0, max(0.0, (place - below) / size + d)) for d in (-NEAR, 0.0, NEAR)]
        got = rows.agg(*[F.percentile_approx(F.when(inside[i], F.col("_s")), near(*left[i][2:]), round(2 / NEAR)) for i in left]).first()
        tried = {i: sorted(set(x)) for i, x in zip(left, got)}
        counts = iter(of.agg(*[f for x in tried.values() for v in x for f in (F.count_if(F.col("_s") < v), F.count_if(F.col("_s") <= v))]).first())
        for i, values in tried.items():
            low, high, below, size, place = left.pop(i)
            over = below + size  # sites below and over the open range that is left
            for v in values:
                less, upto = next(counts), next(counts)
                if upto < place:
                    low, below = v, upto
                elif less < place:
                    found[i] = v
                elif less < over:
                    high, over = v, less
            if i not in found:
                left[i] = (low, high, below, over - below, place)
    return [(t, found[i]) for i, t in enumerate(tranches)]


def apply_filters(df: DataFrame, threshold: float, kind: Column, label: str, score: str = "score") -> DataFrame:
    """Sites of the kind get PASS or the label; others keep the filters that they have."""
    got = F.when(F.col(score) >= threshold, F.array(F.lit("PASS"))).otherwise(F.array(F.lit(label)))
    return df.withColumn("filters", F.when(kind, got).otherwise(F.col("filters")))


def without_pass(filters: Column) -> Column:
    return F.filter(filters, lambda f: f != "PASS")


def train_scores(df: DataFrame, features: list[str], train: str = "train", gaussians: int = 4, seed: int = 1, score: str = "score") -> DataFrame:
    """df with the log density of each site under a mixture fitted to the training sites; sites without a feature get NULL."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    # Invalid values are kept as NaN, so every row stays; the models see complete rows alone.
    whole = VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="keep").transform(df)
    complete = ~F.exists(vector_to_array("_raw"), F.isnan)
    scaler = StandardScaler(inputCol="_raw", outputCol="_x", withMean=True).fit(whole.filter(F.col(train) & complete))
    x = scaler.transform(whole)
    mix = GaussianMixture(k=gaussians, featuresCol="_x", seed=seed, maxIter=50).fit(x.filter(F.col(train) & complete))
    v, density = vector_to_array(F.col("_x")), F.lit(0.0)
    import numpy as np

    for w, g in zip(mix.weights, mix.gaussians):
        mean, cov = g.mean.toArray(), np.asarray(g.cov.toArray()) + 1e-6 * np.eye(len(features))
        inv, det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
        d = [v[i] - float(mean[i]) for i in range(len(features))]
        form = sum((d[i] * d[j] * float(inv[i, j]) for i in range(len(d)) for j in range(len(d))), F.lit(0.0))
        density = density + float(w) * F.exp(form * -0.5 - 0.5 * float(det + len(d) * np.log(2 * np.pi)))
    return x.withColumn(score, F.when(complete, F.ln(F.greatest(density, F.lit(1e-300))))).drop("_raw", "_x")


# ---- two models ------------------------------------------------------------------------------------------------------


@dataclass
class Resource:
    """Sites (contig, position, alleles) of a known set; prior: phred-scaled odds that a site of it is real."""

    sites: DataFrame
    prior: float
    training: bool = False
    truth: bool = False
    known: bool = False


def label_resources(df: DataFrame, resources: list[Resource], default_prior: float = 2.0) -> DataFrame:
    """df with train, truth, known and prior (the greatest of the resources that hold the site). One lookup for all of them."""
    key = ["contig", "position", "alleles"]
    parts = [r.sites.select(*key, F.lit(i).alias("_r")) for i, r in enumerate(resources)]
    held = reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.collect_set("_r").alias("_in"))  # at most one element a resource
    of = lambda test: [i for i, r in enumerate(resources) if test(r)]
    any_ = lambda which: F.coalesce(F.arrays_overlap("_in", F.array(*map(F.lit, which))), F.lit(False)) if which else F.lit(False)
    prior = F.greatest(*[F.when(F.array_contains("_in", i), F.lit(float(r.prior))) for i, r in enumerate(resources)], F.lit(None).cast("double"))
    flags = {"train": any_(of(lambda r: r.training)), "truth": any_(of(lambda r: r.truth)), "known": any_(of(lambda r: r.known)), "prior": F.coalesce(prior, F.lit(float(default_prior)))}
    return df.join(held, key, "left").withColumns(flags).drop("_in")


def every_nth(df: DataFrame, n: int, bin_size: int = 1_000_000) -> DataFrame:
    """Each n-th row in genome order (contig, position, then alleles), the first one first. Ranks come from counts of bins, so no
    task sorts the genome."""
    d = df.withColumns({"_ci": contig_index(F.col("contig")), "_b": F.floor(F.col("position") / bin_size)})
    before = Window.orderBy("_ci", "contig", "_b").rowsBetween(Window.unboundedPreceding, -1)  # over bins
    bins = d.groupBy("_ci", "contig", "_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n", "_ci")
    inside = Window.partitionBy("contig", "_b").orderBy("position", "alleles")
    ranked = d.withColumn("_k", F.row_number().over(inside) - 1).join(bins, ["contig", "_b"])
    return ranked.filter((F.col("_o") + F.col("_k")) % n == 0).select(*df.columns)


@dataclass
class Model:
    """Mixtures over standardised features: (weight, mean, inverse covariance, log of its determinant) of each part."""

    features: list[str]
    centre: list[float]
    spread: list[float]
    good: list[tuple]
    bad: list[tuple]


def _standard(features: list[str], centre: list[float], spread: list[float]) -> list[Column]:
    return [(F.col(f).cast("double") - c) / s for f, c, s in zip(features, centre, spread)]


def _complete(features: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")) for f in features])


def log_density(x: list[Column], parts: list[tuple]) -> Column:
    """Natural logarithm of a mixture's density, by its greatest part, so that far sites don't come to zero."""
    logs = []
    for w, mean, inverse, log_det in parts:
        d = [v - float(m) for v, m in zip(x, mean)]
        form = reduce(lambda a, b: a + b, [d[i] * d[j] * float(inverse[i][j]) for i in range(len(d)) for j in range(len(d))])
        logs.append(form * -0.5 + float(math.log(max(w, 1e-300)) - 0.5 * (log_det + len(d) * math.log(2 * math.pi))))
    return F.get(F.transform(F.array(F.array(*logs)), lambda a: F.array_max(a) + F.ln(F.aggregate(a, F.lit(0.0), lambda s, v: s + F.exp(v - F.array_max(a))))), F.lit(0))


def _fit(rows: DataFrame, k: int, seed: int) -> list[tuple]:
    """rows: column _v, an array of doubles."""
    import numpy as np
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    mix = GaussianMixture(k=k, featuresCol="_x", seed=seed, maxIter=50).fit(rows.select(array_to_vector("_v").alias("_x")))
    out = []
    for w, g in zip(mix.weights, mix.gaussians):
        cov = np.asarray(g.cov.toArray()) + 1e-6 * np.eye(g.cov.numRows)
        out.append((float(w), g.mean.toArray().tolist(), np.linalg.inv(cov).tolist(), float(np.linalg.slogdet(cov)[1])))
    return out


def train_model(df: DataFrame, features: list[str], train: str = "train", gaussians: int = 6, bad_gaussians: int = 2, every: int = 1, far: float = 10.0, bad_below: float = -5.0, bad_share: float = 0.05, seed: int = 1) -> Model:
    """Both mixtures from rows with all features: the first from training sites within `far` standard deviations; the second from
    sites whose log10 density under the first is below bad_below, or, where these are less than bad_share of all, from that share
    of the worst (by an approximate quantile). every: of all rows, only each n-th in genome order is looked at. Rows are scanned
    a few times, never gathered; write df to a table first if it is costly."""
    rows = (every_nth(df, every) if every > 1 else df).filter(_complete(features))
    stats = rows.filter(F.col(train)).agg(*[f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)]).first()
    if stats is None or stats[0] is None:
        raise ValueError("no training site has all features")
    centre, spread = [float(x) for x in stats[::2]], [float(x) or 1.0 for x in stats[1::2]]
    x = rows.withColumn("_v", F.array(*_standard(features, centre, spread)))
    good = _fit(x.filter(F.col(train) & F.forall("_v", lambda v: F.abs(v) <= far)), gaussians, seed)
    lod = log_density([F.col("_v")[i] for i in range(len(features))], good) / math.log(10)
    x = x.withColumn("_lod", lod)
    n, low, cut = x.agg(F.count(F.lit(1)), F.count_if(F.col("_lod") < bad_below), F.percentile_approx("_lod", bad_share, 10_000)).first()
    bad = _fit(x.filter(F.col("_lod") <= (bad_below if low >= bad_share * n else cut)), bad_gaussians, seed)
    return Model(features, centre, spread, good, bad)


def score_sites(df: DataFrame, model: Model, prior: str | None = "prior", score: str = "score") -> DataFrame:
    """df with the log10 ratio of both densities plus the log10 odds of the prior; NULL where a feature is missing. No shuffle."""
    x = _standard(model.features, model.centre, model.spread)
    ratio = (log_density(x, model.good) - log_density(x, model.bad)) / math.log(10)
    if prior:
        wrong = F.pow(F.lit(10.0), F.col(prior) / -10)
        ratio = ratio + F.log10((1 - wrong) / wrong)
    return df.withColumn(score, F.when(_complete(model.features), ratio))


# ---- tranches from fragments -----------------------------------------------------------------------------------------

#: Width of a bin of scores, and the greatest score that has one of its own.
STEP, MOST = 0.1, 1_000.0


def fragment_tranches(scored: DataFrame, fragment: str, step: float = STEP, truth: str = "truth", known: str = "known", score: str = "score") -> DataFrame:
    """(fragment, bin, truths, knowns, sites): how many sites each fragment has in each bin of scores. Sites without a score are
    in no bin. Tables of any number of fragments add up."""
    bin_ = F.floor(F.least(F.greatest(F.col(score), F.lit(-MOST)), F.lit(MOST)) / step)
    flag = lambda c: F.sum(F.coalesce(F.col(c), F.lit(False)).cast("long"))
    return scored.filter(F.col(score).isNotNull()).groupBy(fragment, bin_.alias("bin")).agg(flag(truth).alias("truths"), flag(known).alias("knowns"), F.count(F.lit(1)).alias("sites"))


def gather_tranches(tables: DataFrame, tranches: list[float], step: float = STEP) -> DataFrame:
    """(sensitivity, least, truths, knowns, sites): for each tranche the greatest bin edge at or above which its share of truth
    sites stands, and what else stands there. The edge is at most one step below the exact threshold; a greater sensitivity
    never has a greater one. The bins are few, whatever the number of sites."""
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    bins = tables.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("truths", "knowns", "sites")])
    above = bins.select("bin", *[F.sum(c).over(down).alias(c) for c in ("truths", "knowns", "sites")])
    total = above.agg(F.max("truths").alias("_all"))
    wanted = tables.sparkSession.createDataFrame([(float(t),) for t in tranches], "sensitivity double")
    need = F.greatest(F.lit(1), F.ceil(F.col("sensitivity") / 100 * F.col("_all") - 1e-9))
    met = wanted.join(F.broadcast(total)).join(F.broadcast(above), F.col("truths") >= need)  # tranches by bins, both bounded
    best = met.groupBy("sensitivity").agg(F.max_by(F.struct("bin", "truths", "knowns", "sites"), "bin").alias("_b"))
    return best.select("sensitivity", (F.col("_b.bin") * step).alias("least"), "_b.truths", "_b.knowns", "_b.sites")
