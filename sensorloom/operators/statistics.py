"""Covariance, sign alignment, parcel time courses and group statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..plans.blocks import BLOCK, neighbours
from ..plans.gram import covariance, pair_sums
from ..plans.quantiles import select_ranks
from ..session import materialize
from .detectors import spectrum_blocks

CHANNEL = ["recording_id", "ch_name"]


# ------------------------------------------------------------------- covariance

def empirical_covariance(samples: DataFrame, key: str = "recording_id") -> DataFrame:
    """Channel covariance (n - 1) from blocked cross-products: (key, ci, cj, cov, n) with ci <= cj."""
    return covariance(pair_sums(samples, key)).select(key, "ci", "cj", "cov", "n")


def time_embed(samples: DataFrame, n: int, size: int = BLOCK) -> DataFrame:
    """`n` (odd) lagged copies of every channel; positions without all lags are dropped."""
    if n % 2 == 0:
        raise ValueError("the number of embeddings must be odd")
    half = n // 2
    lags = list(range(-half, half + 1))
    names = {f"_e{i}": ("value", k) for i, k in enumerate(lags) if k != 0}
    wide = neighbours(samples.select(*CHANNEL, "t", "value"), CHANNEL, names, size=size)
    for name in names:
        wide = wide.where(F.col(name).isNotNull())
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col("value") if k == 0 else F.col(f"_e{i}")).alias("v")) for i, k in enumerate(lags)])
    return wide.select(*CHANNEL, "t", F.inline(rows)).withColumnRenamed("v", "value")


def standardize(samples: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per-channel z with the population deviation; statistics are aggregated and joined back."""
    keys = keys or CHANNEL
    stats = samples.groupBy(*keys).agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    return samples.join(stats, keys).withColumn("value", F.when(F.col("_s") > 0, (F.col("value") - F.col("_m")) / F.col("_s"))).drop("_m", "_s")


def _mode(c: Column, mode: str | None) -> Column:
    return F.abs(c) if mode == "abs" else F.signum(c) if mode == "sign" else c


def covariance_similarity(cov: DataFrame, template: DataFrame, offset: int = 0, mode: str | None = None) -> DataFrame:
    """Pearson correlation of each upper triangle with the template's; `i`, `j` are channel positions."""
    t = template.select("i", "j", _mode(F.col("cov"), mode).alias("_t"))
    j = cov.where(F.col("j") - F.col("i") >= offset).join(t, ["i", "j"])
    return j.groupBy("recording_id").agg(F.corr(_mode(F.col("cov"), mode), "_t").alias("similarity"))


def summed_similarity(cov: DataFrame, offset: int = 0, mode: str | None = "abs") -> DataFrame:
    """Sum of each recording's similarity to all others.

    Correlations are dot products of standardised triangles, so the sum over all partners is
    one dot product with the summed triangle: linear in the number of recordings, no pairs.
    """
    x = cov.where(F.col("j") - F.col("i") >= offset).select("recording_id", "i", "j", _mode(F.col("cov"), mode).alias("v"))
    stats = x.groupBy("recording_id").agg(F.avg("v").alias("_m"), F.stddev_pop("v").alias("_s"), F.count("*").alias("_n"))
    z = x.join(stats, "recording_id").withColumn(
        "z", F.when(F.col("_s") > 0, (F.col("v") - F.col("_m")) / (F.col("_s") * F.sqrt(F.col("_n")))).otherwise(0e0))
    total = z.groupBy("i", "j").agg(F.sum("z").alias("_sum"))
    return z.join(total, ["i", "j"]).groupBy("recording_id").agg(
        (F.sum(F.col("z") * F.col("_sum")) - F.sum(F.col("z") * F.col("z"))).alias("similarity_sum"))


def template_subject(cov: DataFrame, offset: int = 0, mode: str | None = "abs") -> DataFrame:
    """The recording in the middle of the order by summed similarity; equal sums are in order of their ids.

    The middle value comes from histograms over all recordings, which are summed within tasks; only the recordings of that value are ranked.
    """
    s = materialize(summed_similarity(cov, offset, mode)).withColumn("_all", F.lit(1))
    middle = F.floor(F.col("_n") / 2)
    found = select_ranks(s, ["_all"], "similarity_sum", lambda n: [F.floor(n / 2)]).select(
        F.col("_key._all").alias("_all"), F.col("_at")[middle.cast("bigint")].alias("_value"), middle.alias("_middle"))
    near = s.join(found, "_all")
    below = near.groupBy("_all").agg(F.count_if(F.col("similarity_sum") < F.col("_value")).alias("_below"))
    place = F.row_number().over(Window.partitionBy("_all").orderBy("recording_id"))  # recordings of one value
    return near.where(F.col("similarity_sum") == F.col("_value")).join(below, "_all").withColumn("_place", place).where(
        F.col("_place") - 1 == F.col("_middle") - F.col("_below")).select("recording_id", "similarity_sum")


def find_flips(cov: DataFrame, template: DataFrame, n_init: int = 3, n_iter: int = 500, max_flips: int = 4, seed: int = 0) -> DataFrame:
    """Seeded random search for channel signs per recording; a group holds one covariance matrix."""
    t = template.select("ci", "cj", F.col("cov").alias("template_cov"))
    types = dict(cov.dtypes)
    schema = f"recording_id {types['recording_id']}, ch_name {types['ci']}, flip int, metric_before double, metric_after double"
    return cov.select("recording_id", "ci", "cj", "cov").join(t, ["ci", "cj"]).groupBy("recording_id").applyInPandas(
        kernels.flip_search("recording_id", n_init, n_iter, max_flips, seed), schema)


def apply_flips(samples: DataFrame, flips: DataFrame) -> DataFrame:
    j = samples.join(flips.select(*CHANNEL, "flip"), CHANNEL, "left")
    return j.withColumn("value", F.col("value") * F.coalesce("flip", F.lit(1))).drop("flip")


# ---------------------------------------------------------------------- parcels

def parcel_timecourse(voxels: DataFrame, parcels: DataFrame) -> DataFrame:
    """First principal component of each parcel's voxels, scaled by their weighted deviation, signed by the mean loading.

    `voxels(recording_id, voxel, t, value)`, `parcels(voxel, parcel)`. Cross-products are summed
    in blocks; one task sees the voxel matrix of one parcel; the projection is a join and a sum.
    """
    v = voxels.join(parcels, "voxel").withColumn("_g", F.concat_ws("|", "recording_id", "parcel"))
    sums = pair_sums(v, "_g", "voxel")
    cross = sums.select("_g", "ci", "cj", (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")).alias("cross"))
    vt = dict(voxels.dtypes)["voxel"]
    load = cross.groupBy("_g").applyInPandas(kernels.first_component(["_g"]), f"_g string, voxel {vt}, loading double, eigenvalue double")
    stats = v.groupBy("_g", "voxel").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"), F.count("*").alias("_n"))
    w = load.join(stats, ["_g", "voxel"])
    scale = w.groupBy("_g").agg(
        F.signum(F.avg("loading")).alias("_sign"), (F.sum(F.abs("loading") * F.col("_s")) / F.sum(F.abs("loading"))).alias("_scale"),
        F.max(F.sqrt(F.greatest(F.col("eigenvalue"), F.lit(0e0)) / F.col("_n"))).alias("_sd"))
    scores = v.join(w, ["_g", "voxel"]).groupBy("_g", "recording_id", "parcel", "t").agg(
        F.sum(F.col("loading") * (F.col("value") - F.col("_m"))).alias("_score"))
    gain = F.col("_sign") * F.col("_scale") / F.greatest(F.col("_sd"), F.lit(2.220446049250313e-16))
    return scores.join(scale, "_g").select("recording_id", "parcel", "t", (F.col("_score") * gain).alias("value"))


# ----------------------------------------------------------------- linear models

def _fit(contrasts: dict[str, list[float]], keys: list[str]):
    names, c = list(contrasts), np.array(list(contrasts.values()), float)

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            xtx = np.stack(pdf["xtx"].to_numpy()).astype(float)
            p = int(round(xtx.shape[1] ** 0.5))
            xtx, xty = xtx.reshape(-1, p, p), np.stack(pdf["xty"].to_numpy()).astype(float)
            n, yty = pdf["n"].to_numpy(float), pdf["yty"].to_numpy(float)
            inv = np.linalg.pinv(xtx)
            beta = np.einsum("nij,nj->ni", inv, xty)
            rss = np.maximum(yty - np.einsum("ni,ni->n", beta, xty), 0.0)
            cope = beta @ c.T
            var = np.einsum("ki,nij,kj->nk", c, inv, c) * (rss / np.maximum(n - p, 1))[:, None]
            with np.errstate(all="ignore"):
                t = np.where(var > 0, cope / np.sqrt(var), 0.0)
            for k, name in enumerate(names):
                out = pdf[keys].copy()
                out["contrast"], out["cope"], out["t"] = name, cope[:, k], t[:, k]
                yield out

    return run


def linear_model(rows: DataFrame, keys: list[str], y: str, design: list[Column], contrasts: dict[str, list[float]]) -> DataFrame:
    """Least squares per cell from normal equations.

    The sums of products are native hash aggregates (map-side combined, any number of rows per
    cell); only the small solve runs on Arrow batches.
    """
    d = [F.col(f"_x{i}") for i in range(len(design))]
    x = rows.select(*keys, F.col(y).cast("double").alias("_y"), *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(design)])
    x = x.where("_y is not null and not isnan(_y)")
    sums = x.groupBy(*keys).agg(
        F.array(*[F.sum(a * b) for a in d for b in d]).alias("xtx"), F.array(*[F.sum(a * F.col("_y")) for a in d]).alias("xty"),
        F.count("*").cast("double").alias("n"), F.sum(F.col("_y") * F.col("_y")).alias("yty"))
    types = dict(sums.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", contrast string, cope double, t double"
    return sums.mapInPandas(_fit(contrasts, keys), schema)


def glm_epochs(epochs: DataFrame, design: list[Column], contrasts: dict[str, list[float]]) -> DataFrame:
    """Trials regressed on the design per recording, channel and time."""
    return linear_model(epochs, ["recording_id", "ch_name", "k"], "value", design, contrasts)


def group_glm(first_level: DataFrame, cell: list[str], value: str = "cope") -> DataFrame:
    """Default mean design over subjects: mean, standard error and t per cell."""
    g = first_level.groupBy(*cell).agg(F.avg(value).alias("cope"), F.stddev_samp(value).alias("_s"), F.count(value).alias("n"))
    se = F.col("_s") / F.sqrt(F.col("n"))
    return g.select(*cell, "cope", "n", F.when(se > 0, F.col("cope") / se).otherwise(0e0).alias("t"))


def glm_spectrum(samples: DataFrame, covariates: DataFrame, sfreq: float, nperseg: int, contrasts: dict[str, list[float]],
                 regressors: list[str]) -> DataFrame:
    """Half-overlapping window periodograms regressed on window covariates, per channel and frequency.

    `covariates(recording_id, win, <regressors>)`; the design is a constant followed by the regressors.
    """
    types = dict(samples.dtypes)
    blocked, length = spectrum_blocks(samples, nperseg, CHANNEL)
    schema = ", ".join(f"{c} {types[c]}" for c in CHANNEL) + ", win bigint, freq double, power double"
    windows = blocked.groupBy(*CHANNEL, "_block").applyInPandas(kernels.periodograms(CHANNEL, length, nperseg, sfreq), schema)
    return linear_model(windows.join(covariates, ["recording_id", "win"]), [*CHANNEL, "freq"], "power",
                        [F.lit(1e0), *[F.col(r) for r in regressors]], contrasts)


def max_stat_permutation(first_level: DataFrame, cell: list[str], n_perms: int, seed: int = 0, subject: str = "subject",
                         value: str = "cope", block: int = 256) -> DataFrame:
    """Null distribution of the largest |t| over the pooled cells, one row per permutation (0 = observed signs).

    Tasks multiply their rows by the sign matrix of their subjects and shuffle one row for each cell and block of permutations, however many
    subjects there are; the sums of a cell meet as arrays.
    """
    x = first_level.select(*cell, F.coalesce(F.col(subject).cast("string"), F.lit("")).alias("_s"), F.col(value).cast("double").alias("_y"))
    types = dict(x.dtypes)
    schema = "".join(f"`{c}` {types[c]}, " for c in cell) + "block int, sums array<double>, sq double, n bigint"
    parts = x.mapInArrow(kernels.signed_sums(cell, n_perms, seed, block), schema)
    g = parts.groupBy(*cell, "block").agg(F.collect_list("sums").alias("_parts"), F.sum("sq").alias("_sq"), F.sum("n").alias("_n"))  # one part for each task that read the cell
    total = F.reduce(F.slice("_parts", 2, F.size("_parts")), F.col("_parts")[0], lambda a, b: F.zip_with(a, b, lambda p, q: p + q))

    def statistic(s: Column) -> Column:
        mean = s / F.col("_n")
        var = F.try_divide(F.col("_sq") - F.col("_n") * mean * mean, F.col("_n") - 1)
        return F.abs(F.when((F.col("_n") > 1) & (var > 0), mean / F.sqrt(var / F.col("_n"))).otherwise(0e0))

    g = g.withColumn("_total", total).select("block", "_sq", "_n", F.posexplode("_total").alias("_i", "_sum"))
    return g.select((F.col("block") * block + F.col("_i")).alias("perm"), statistic(F.col("_sum")).alias("_t")).groupBy("perm").agg(F.max("_t").alias("max_stat"))


def permutation_threshold(null: DataFrame, percent: float = 95) -> DataFrame:
    """Threshold statistic: percentile of the permutation maxima (one row per permutation)."""
    return null.agg(F.percentile("max_stat", F.lit(percent / 100)).alias("threshold"))
