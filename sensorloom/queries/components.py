"""Component labelling on the embedding vectors (64-channel topographies)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import components as op
from ..sources.bindings import with_views
from . import query

KIND = "CASE WHEN label < 5 THEN 'ECG' ELSE 'EOG' END"
SIM = f""", tm AS (SELECT label AS template, {KIND} AS kind, ch, avg(CAST(weight AS DOUBLE)) AS tw FROM topo GROUP BY 1, 2, 3),
c AS (SELECT component, label % 2 AS dev, ch, CAST(weight AS DOUBLE) AS w, rank() OVER p + (count(*) OVER (PARTITION BY component, weight) - 1) / 2e0 AS rk,
  (weight::DOUBLE - min(weight::DOUBLE) OVER q) / (max(weight::DOUBLE) OVER q - min(weight::DOUBLE) OVER q + 1e-10) AS sw
  FROM topo WINDOW p AS (PARTITION BY component ORDER BY weight), q AS (PARTITION BY component)),
t2 AS (SELECT template, kind, ch, tw, rank() OVER (PARTITION BY template ORDER BY tw) + (count(*) OVER (PARTITION BY template, tw) - 1) / 2e0 AS trk,
  (tw - min(tw) OVER (PARTITION BY template)) / (max(tw) OVER (PARTITION BY template) - min(tw) OVER (PARTITION BY template) + 1e-10) AS stw FROM tm),
s0 AS (SELECT component, template, kind, abs(corr(w, tw)) AS pearson, abs(corr(rk, trk)) AS spearman,
  sum(w * tw) / (sqrt(sum(w * w)) * sqrt(sum(tw * tw))) AS cosine, 1 - sqrt(sum((sw - stw) * (sw - stw))) / 8e0 AS euclidean
  FROM c JOIN t2 ON c.ch = t2.ch AND c.dev = t2.template % 2 GROUP BY 1, 2, 3),
sim AS (SELECT *, (pearson + spearman + cosine + euclidean) / 4 AS "mean" FROM s0) """
SIMS = ("pearson", "spearman", "cosine", "euclidean", "mean")


def device():
    return F.concat(F.lit("dev"), F.col("label") % 2).alias("device_type")


def labelled(t):
    return t.topo().select(
        device(), F.when(F.col("label") < 5, "ECG").otherwise("EOG").alias("kind"),
        F.col("label").alias("template"), F.col("ch").alias("position"), F.col("weight").cast("double").alias("weight"))


def library(t):
    return op.build_template_library(labelled(t), ["device_type", "kind", "template"])


def similarity(t):
    comps = t.table("embeddings").select(F.col("vec_id").alias("component"), device(),
                                         F.col("embedding").cast("array<double>").alias("topo"))
    return op.topo_similarity(comps, library(t))


@query("topo_similarity", with_views(SIM + "SELECT component, template, kind, " + ", ".join(f'round("{s}", 6) AS "{s}"' for s in SIMS) + " FROM sim", "topo"))
def _(t):
    return similarity(t).select("component", "template", "kind", *[r6(s).alias(s) for s in SIMS])


@query("align_channels", with_views(""", tc AS (SELECT ch, row_number() OVER (ORDER BY ch DESC) AS position FROM (SELECT ch FROM topo GROUP BY ch HAVING avg(weight) > 0))
SELECT label AS recording_id, component, topo.ch AS ch_name, position FROM topo JOIN tc USING (ch)""", "topo"))
def _(t):
    weights = t.topo().select(F.col("label").alias("recording_id"), "component", F.col("ch").alias("ch_name"), "weight")
    known = weights.groupBy("ch_name").agg(F.avg("weight").alias("m")).where("m > 0")
    ordered = known.select("ch_name", F.row_number().over(Window.orderBy(F.desc("ch_name"))).cast("bigint").alias("position"))
    return op.align_channels(weights, ordered).select("recording_id", "component", F.col("ch_name").cast("bigint").alias("ch_name"), "position")


@query("classify_by_template", with_views(SIM + """, b AS (SELECT component, greatest(max(pearson) FILTER (kind = 'ECG'), 0) AS ecg_max, greatest(max(pearson) FILTER (kind = 'EOG'), 0) AS eog_max FROM sim GROUP BY 1)
SELECT component, round(ecg_max, 6) AS ecg_max, round(eog_max, 6) AS eog_max, CASE WHEN ecg_max > 0.4e0 AND ecg_max > eog_max THEN 'ECG' WHEN eog_max > 0.4e0 THEN 'EOG' ELSE 'Brain' END AS label,
 round(CASE WHEN ecg_max > 0.4e0 AND ecg_max > eog_max THEN ecg_max WHEN eog_max > 0.4e0 THEN eog_max ELSE greatest(ecg_max, eog_max) END, 6) AS similarity FROM b""", "topo"))
def _(t):
    out = op.classify_by_template(similarity(t), ["component"], "pearson", 0.4)
    return out.withColumns({c: r6(c) for c in ("ecg_max", "eog_max", "similarity")})


VOTES = SIM + """, m AS (SELECT component, kind, u.m AS method, max(u.v) AS v FROM sim, unnest([{'m': 'pearson', 'v': pearson}, {'m': 'spearman', 'v': spearman}, {'m': 'cosine', 'v': cosine}, {'m': 'mean', 'v': "mean"}]) z(u) GROUP BY 1, 2, 3),
b AS (SELECT component, method, greatest(max(v) FILTER (kind = 'ECG'), 0) AS e, greatest(max(v) FILTER (kind = 'EOG'), 0) AS o FROM m GROUP BY 1, 2),
l AS (SELECT component, CASE WHEN e > 0.4e0 AND e > o THEN 'ecg' WHEN o > 0.4e0 THEN 'eog' END AS k FROM b),
vt AS (SELECT component, count(k) AS votes, CASE WHEN count(*) FILTER (k = 'ecg') > 0 THEN 'ecg' ELSE 'eog' END AS kind FROM l GROUP BY 1 HAVING count(k) >= 2) """


@query("vote", with_views(VOTES + "SELECT component, CAST(votes AS INTEGER) AS votes, kind FROM vt", "topo"))
def _(t):
    return op.vote(similarity(t), ["component"], 0.4)


@query("build_template_library", with_views(f"SELECT 'dev' || (label % 2) AS device_type, {KIND} AS kind, label AS template, ch AS position, round(avg(CAST(weight AS DOUBLE)), 6) AS weight FROM topo GROUP BY ALL", "topo"))
def _(t):
    return library(t).select("device_type", "kind", "template", F.posexplode("topo").alias("position", "weight")).select(
        "device_type", "kind", "template", F.col("position").cast("bigint").alias("position"), r6("weight").alias("weight"))


@query("template_inventory", f"""
SELECT 'dev' || (vec_id % 3) AS device_type, count(*) FILTER (label < 5) AS n_ecg, count(*) FILTER (label >= 5) AS n_eog,
 string_agg(DISTINCT 'ds' || (vec_id % 4), ',' ORDER BY 'ds' || (vec_id % 4)) AS datasets FROM embeddings GROUP BY 1""")
def _(t):
    lab = t.table("embeddings").select(
        F.concat(F.lit("dev"), F.col("vec_id") % 3).alias("device_type"), F.when(F.col("label") < 5, "ECG").otherwise("EOG").alias("kind"),
        F.concat(F.lit("ds"), F.col("vec_id") % 4).alias("dataset"))
    return op.template_inventory(lab).withColumn("datasets", F.array_join("datasets", ","))


# duplicate (kind, component) scores of recordings, from orders
SCORES = """ sx AS (SELECT o_custkey % 40 AS recording_id, CASE o_orderstatus WHEN 'F' THEN 'ecg' WHEN 'O' THEN 'eog' ELSE 'outlier' END AS kind,
 o_orderkey % 30 - 2 AS component, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice / 500000 END AS score FROM orders) """


def component_scores(t):
    s = F.col("o_orderstatus")
    return t.table("orders").select(
        (F.col("o_custkey") % 40).alias("recording_id"), F.when(s == "F", "ecg").when(s == "O", "eog").otherwise("outlier").alias("kind"),
        (F.col("o_orderkey") % 30 - 2).alias("component"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") / 500000).alias("score"))


@query("merge_scores_max", "WITH" + SCORES + "SELECT recording_id, kind, component, round(max(coalesce(score, 0.5e0)), 6) AS score FROM sx WHERE component >= 0 AND component < 25 GROUP BY 1, 2, 3")
def _(t):
    s = component_scores(t)
    sizes = s.select("recording_id").distinct().withColumn("n_components", F.lit(25))
    return op.merge_scores_max(s, sizes).withColumn("score", r6("score"))


@query("category_gate", "WITH" + SCORES + "SELECT recording_id, kind, component FROM sx WHERE kind IN ('ecg', 'eog')")
def _(t):
    return op.category_gate(component_scores(t)).select("recording_id", "kind", "component")


@query("finalize_labels", "WITH" + SCORES + """, g AS (SELECT recording_id, kind, component, max(coalesce(score, 0.5e0)) AS score FROM sx WHERE component >= 0 GROUP BY 1, 2, 3),
a AS (SELECT recording_id, coalesce(string_agg(CASE WHEN kind = 'ecg' THEN component END, ',' ORDER BY component), '') AS ecg,
 coalesce(string_agg(CASE WHEN kind = 'eog' THEN component END, ',' ORDER BY component), '') AS eog,
 coalesce(string_agg(DISTINCT component, ',' ORDER BY component), '') AS auto_indices, round(sum(score) FILTER (kind = 'ecg') + 1e-9, 6) AS ecg_score FROM g WHERE score >= 0.7e0 GROUP BY 1),
w AS (SELECT recording_id, string_agg(DISTINCT component, ',' ORDER BY component) AS written_indices FROM sx WHERE component >= 0 AND score >= 0.9e0 GROUP BY 1)
SELECT recording_id, ecg, eog, auto_indices, coalesce(written_indices, '') AS written_indices, ecg_score FROM a FULL JOIN w USING (recording_id)""")
def _(t):
    s = component_scores(t)
    merged = op.merge_scores_max(s)
    out = op.finalize_labels(merged.where("score >= 0.7").drop("score"), s.where("component >= 0 and score >= 0.9"), s)

    def ids(c):
        return F.array_join(F.transform(c, lambda x: x["component"].cast("string")), ",")

    total = F.aggregate("ecg", F.lit(0e0), lambda a, x: a + x["score"])
    return out.select("recording_id", ids("ecg").alias("ecg"), ids("eog").alias("eog"),
                      F.array_join("marked_components.auto_indices", ",").alias("auto_indices"),
                      F.array_join("marked_components.written_indices", ",").alias("written_indices"),
                      r6_off_ties(F.when(F.size("ecg") > 0, total)).alias("ecg_score"))


@query("explained_variance_outliers", "SELECT vec_id AS component, label FROM embeddings WHERE abs(embedding[3]) > 0.2e0")
def _(t):
    c = t.table("embeddings").select(F.col("vec_id").alias("component"), "label", F.abs(F.col("embedding")[2]).cast("double").alias("explained_var"))
    return op.explained_variance_outliers(c, 0.2).select("component", "label")


PSD = ", psd AS (SELECT component, CAST(ch AS DOUBLE) AS freq, CAST(weight AS DOUBLE) * weight AS power FROM topo) "


def psd(t):
    w = F.col("weight").cast("double")
    return t.topo().select("component", F.col("ch").cast("double").alias("freq"), (w * w).alias("power"))


LOW = PSD + """, lr AS (SELECT component, sum(power) FILTER (freq < 20) / sum(power) AS low_ratio, sum(power) FILTER (freq > 40) / sum(power) AS high_ratio FROM psd GROUP BY 1) """


@query("low_high_band_ratio", with_views(LOW + "SELECT component, round(low_ratio, 6) AS low_ratio, round(high_ratio, 6) AS high_ratio, low_ratio >= 0.35e0 AS is_low_freq FROM lr", "topo"))
def _(t):
    return op.low_high_band_ratio(psd(t), ["component"], 20, 40, 0.35).withColumns({c: r6(c) for c in ("low_ratio", "high_ratio")})


@query("psd_shape_flags", with_views(PSD + """, mx AS (SELECT component, max(power) AS top FROM psd WHERE freq BETWEEN 0 AND 5 GROUP BY 1),
sg AS (SELECT component, floor(freq / 21) AS seg, regr_slope(power, freq) AS s FROM psd WHERE freq < 63 GROUP BY 1, 2),
rs AS (SELECT component, count(*) FILTER (s > 0) AS n_rising_segments FROM sg GROUP BY 1)
SELECT component, round(regr_slope(power, freq), 6) + 0e0 AS slope, any_value(n_rising_segments) AS n_rising_segments, count(*) FILTER (power > top) AS n_exceeding,
 any_value(n_rising_segments) > 0 OR count(*) FILTER (power > top) > 0 AS is_abnormal FROM psd JOIN mx USING (component) JOIN rs USING (component) GROUP BY 1""", "topo"))
def _(t):
    return op.psd_shape_flags(psd(t), ["component"]).withColumn("slope", r6("slope"))


REGION = "CASE WHEN ch < 12 THEN 'Left-frontal' WHEN ch < 24 THEN 'Right-temporal' WHEN ch < 34 THEN 'Left-occipital' WHEN ch < 44 THEN 'Right-parietal' END"
ENERGY = f", en AS (SELECT component, coalesce({REGION}, 'Remaining') AS region, sum(CAST(weight AS DOUBLE) * weight) AS energy FROM topo GROUP BY 1, 2) "


def energies(t):
    topo = t.topo()
    regions = topo.select("ch").distinct().withColumn("region", F.expr(REGION)).where("region is not null")
    w = F.col("weight").cast("double")
    return op.region_energy(topo.select("component", "ch", (w * w).alias("energy")), regions, ["component"])


@query("region_energy", with_views(ENERGY + "SELECT component, region, round(energy, 6) AS energy FROM en", "topo"))
def _(t):
    return energies(t).withColumn("energy", r6("energy"))


RULES = ENERGY + """, rg AS (SELECT component, coalesce(sum(energy) FILTER (region LIKE '%frontal'), 0) AS fr, coalesce(sum(energy) FILTER (region LIKE '%temporal'), 0) AS te,
 coalesce(sum(energy) FILTER (region LIKE '%occipital'), 0) AS oc, coalesce(sum(energy) FILTER (region LIKE '%parietal'), 0) AS pa, coalesce(sum(energy) FILTER (region = 'Remaining'), 0) AS re FROM en GROUP BY 1) """


@query("ecg_region_rule", with_views(RULES + "SELECT component FROM rg WHERE te + oc > re OR oc + fr > re", "topo"))
def _(t):
    return op.ecg_region_rule(energies(t), ["component"])


@query("eog_region_rule", with_views(LOW + RULES + "SELECT component FROM rg JOIN lr USING (component) WHERE low_ratio >= 0.35e0 AND fr + te > oc + pa + re", "topo"))
def _(t):
    low = op.low_high_band_ratio(psd(t), ["component"], 20, 40, 0.35).where("is_low_freq")
    return op.eog_region_rule(energies(t), low, ["component"])


@query("heart_rate", with_views("""SELECT recording_id, event_id, count(*) AS n_peaks,
 CASE WHEN count(*) > 1 AND max(sample) > min(sample) THEN round(60 / ((max(sample) - min(sample)) / 1e0 / (count(*) - 1)), 2) ELSE 0e0 END AS bpm FROM triggers GROUP BY 1, 2""", "triggers"))
def _(t):
    return op.heart_rate(t.triggers(), ["recording_id", "event_id"], 1.0)


@query("outlier_removal", with_views(""",
q AS (SELECT recording_id, ch_name, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m, stddev_pop(value) AS s FROM samples GROUP BY 1, 2)
SELECT 'iqr' AS method, recording_id, ch_name, t FROM samples JOIN q USING (recording_id, ch_name) WHERE value BETWEEN a - 1.5e0 * (b - a) AND b + 1.5e0 * (b - a)
UNION ALL SELECT 'zscore', recording_id, ch_name, t FROM samples JOIN q USING (recording_id, ch_name) WHERE abs((value - m) / s) < 2""", "samples"))
def _(t):
    keys = ["recording_id", "ch_name"]
    s = t.samples().select(*keys, "t", "value")
    a = op.outlier_removal(s, keys, "value").select(F.lit("iqr").alias("method"), *keys, "t")
    return a.unionByName(op.outlier_removal(s, keys, "value", "zscore", 2.0).select(F.lit("zscore").alias("method"), *keys, "t"))


@query("replace_outliers", with_views(""",
g AS (SELECT *, abs((value - avg(value) OVER p) / stddev_pop(value) OVER p) >= 1.5e0 AS bad FROM samples WINDOW p AS (PARTITION BY recording_id, ch_name)),
x AS (SELECT *, avg(value) FILTER (NOT bad) OVER (PARTITION BY recording_id, ch_name ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
 avg(value) FILTER (NOT bad) OVER (PARTITION BY recording_id, ch_name ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM g)
SELECT recording_id, ch_name, t, round(CASE WHEN bad THEN coalesce((l + r) / 2, l, r) ELSE value END + 1e-9, 6) AS value FROM x""", "samples"))
def _(t):
    keys = ["recording_id", "ch_name"]
    s = t.samples().select(*keys, "t", "value")
    out = op.replace_outliers(s, keys, "value", "t", F.floor(F.col("t") / 65536).cast("bigint"), 1.5, "neighbor")
    return out.withColumn("value", r6_off_ties("value"))


@query("ecg_periodicity_rule", with_views(""",
d AS (SELECT recording_id, event_id, sample, CAST(sample - lag(sample) OVER (PARTITION BY recording_id, event_id ORDER BY sample) AS DOUBLE) AS d FROM triggers),
q AS (SELECT recording_id, event_id, quantile_cont(d, 0.25) AS a, quantile_cont(d, 0.75) AS b FROM d GROUP BY 1, 2),
k AS (SELECT recording_id, event_id, avg(d) AS m, stddev_pop(d) AS s FROM d JOIN q USING (recording_id, event_id) WHERE d BETWEEN a - 1.5e0 * (b - a) AND b + 1.5e0 * (b - a) GROUP BY 1, 2),
n AS (SELECT recording_id, event_id, count(*) AS n FROM triggers GROUP BY 1, 2),
j AS (SELECT recording_id, p.n AS pn, c.n AS cn, pk.m AS pm, pk.s AS ps, ck.m AS cm, ck.s AS cs FROM n p JOIN n c USING (recording_id)
 LEFT JOIN k pk ON pk.recording_id = p.recording_id AND pk.event_id = 1 LEFT JOIN k ck ON ck.recording_id = p.recording_id AND ck.event_id = 2 WHERE p.event_id = 1 AND c.event_id = 2)
SELECT recording_id, pn AS sig_n, cn AS cor_n, coalesce(CASE WHEN pn = 1 OR cn = 1 THEN false ELSE pn >= 2.7e0 AND pn <= 400 AND cn >= 2.7e0 AND pm >= 0.4e0 * 100 AND cm >= 0.4e0 * 100 AND (cs <= 2400 OR ps <= 2400) END, false) AS is_periodic FROM j""", "triggers"))
def _(t):
    tr = t.triggers()
    out = op.ecg_periodicity_rule(tr.where("event_id = 1"), tr.where("event_id = 2"), ["recording_id"], 100.0, 3.0, 400, std_coef=24.0)
    return out.select("recording_id", "sig_n", "cor_n", "is_periodic")
