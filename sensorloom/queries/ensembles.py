"""Model probabilities and labelings."""

from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import ensembles as op
from ..operators.events import channel_type_from_name
from ..sources.bindings import with_views
from . import query


@query("ensemble_mean", with_views("SELECT recording_id, win, round(avg(prob) + 1e-9, 6) AS prob, count(*) AS n FROM probs GROUP BY 1, 2", "probs"))
def _(t):
    return op.ensemble_mean(t.probs(), ["recording_id"], "win").withColumn("prob", r6_off_ties("prob"))


@query("ensemble_chunk_max", with_views(""",
d AS (SELECT recording_id, fold, win // 24 AS day, max(prob) AS prob FROM probs GROUP BY 1, 2, 3)
SELECT recording_id, day, round(avg(prob) + 1e-9, 6) AS prob, count(*) AS n FROM d GROUP BY 1, 2""", "probs"))
def _(t):
    daily = t.probs().withColumn("day", F.floor(F.col("win") / 24).cast("bigint"))
    return op.ensemble_mean(daily, ["recording_id"], "day", "fold", "max").withColumn("prob", r6_off_ties("prob"))


LCB = """, ch AS (SELECT recording_id, 'MEG' || lpad(win::VARCHAR, 4, '0') AS ch_name, prob FROM probs),
ty AS (SELECT *, CASE WHEN ch_name[-1] = '1' THEN 'mag' WHEN ch_name[-1] IN ('2', '3') THEN 'grad' ELSE 'x' END AS ch_type FROM ch),
sc AS (SELECT recording_id, ch_type, ch_name, avg(prob) - 0.5e0 * stddev_pop(prob) AS lcb FROM ty GROUP BY 1, 2, 3),
mt AS (SELECT recording_id, ch_type, count(*) AS n, quantile_cont(lcb, 0.5) AS med FROM sc GROUP BY 1, 2),
ma AS (SELECT recording_id, quantile_cont(lcb, 0.5) AS med FROM sc GROUP BY 1),
dt AS (SELECT recording_id, ch_type, any_value(n) AS n, greatest(0.3e0, any_value(med) + 2e0 * 1.4826e0 * quantile_cont(abs(lcb - med), 0.5)) AS th FROM sc JOIN mt USING (recording_id, ch_type) GROUP BY 1, 2),
da AS (SELECT recording_id, greatest(0.3e0, any_value(med) + 2e0 * 1.4826e0 * quantile_cont(abs(lcb - med), 0.5)) AS ath FROM sc JOIN ma USING (recording_id) GROUP BY 1),
fb AS (SELECT recording_id, ch_type, ch_name, lcb, CASE WHEN n >= 100 THEN th ELSE ath END AS threshold FROM sc JOIN dt USING (recording_id, ch_type) JOIN da USING (recording_id)) """


def lcb(t):
    p = t.probs().withColumn("ch_name", F.concat(F.lit("MEG"), F.lpad(F.col("win").cast("string"), 4, "0")))
    return op.lcb_mad_bad_channels(p.withColumn("ch_type", channel_type_from_name(F.col("ch_name"))), lam=0.5, floor=0.3,
                                   z=2.0, min_type_channels=100)


@query("lcb_mad_bad_channels", with_views(LCB + """
SELECT recording_id, ch_name, round(lcb + 1e-9, 6) AS lcb, round(threshold, 6) AS threshold, lcb >= threshold AS is_bad FROM fb""", "probs"))
def _(t):
    return lcb(t).select("recording_id", "ch_name", r6_off_ties("lcb").alias("lcb"), r6("threshold").alias("threshold"), "is_bad")


@query("mask_channels", with_views(LCB + """
SELECT recording_id, ch_name, CASE WHEN lcb >= threshold THEN 0 ELSE CASE WHEN ch_type = 'x' THEN 0 ELSE 1 END END AS node_valid, lcb >= threshold AS is_masked FROM fb""", "probs"))
def _(t):
    scored = lcb(t)
    channels = scored.select("recording_id", "ch_name", (F.col("ch_type") != "x").cast("int").alias("node_valid"))
    return op.mask_channels(channels, scored.where("is_bad"))


@query("argmax_label", """
WITH p AS (SELECT vec_id, list_transform(embedding[1:4], lambda v: abs(v)) AS p FROM embeddings),
l AS (SELECT vec_id, (['brain_or_other', 'heart_beat', 'eye_blink', 'eye_movement'])[list_position(p, list_max(p))] AS label FROM p)
SELECT vec_id, label, CASE label WHEN 'heart_beat' THEN 'ecg' WHEN 'brain_or_other' THEN 'brain' ELSE 'eog' END AS grp FROM l""")
def _(t):
    probs = F.transform(F.slice("embedding", 1, 4), lambda v: F.abs(v))
    return t.table("embeddings").select("vec_id", op.argmax_label(probs).alias("label")).withColumn("grp", op.label_group(F.col("label")))


@query("reorder_classes", """
SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS brain, round(CAST(embedding[3] AS DOUBLE), 6) AS heart,
 round(CAST(embedding[4] AS DOUBLE), 6) AS blink, round(CAST(embedding[2] AS DOUBLE), 6) AS movement FROM embeddings""")
def _(t):
    p = t.table("embeddings").select("vec_id", op.reorder_classes(F.slice("embedding", 1, 4)).alias("p"))
    return p.select("vec_id", *[r6(F.col("p")[i].cast("double")).alias(n) for i, n in enumerate(("brain", "heart", "blink", "movement"))])


CMP = """, c AS (SELECT component, CASE a_label WHEN 1 THEN 'heart_beat' ELSE 'brain_or_other' END AS a_label,
 CASE b_label WHEN 1 THEN 'heart_beat' ELSE 'brain_or_other' END AS b_label FROM labelings),
x AS (SELECT *, a_label = b_label AS agree, a_label <> 'brain_or_other' AS a_artifact, b_label <> 'brain_or_other' AS b_artifact FROM c) """


def compared(t):
    def side(c):
        return t.labelings().select(F.col("component") % 8, "component", F.when(F.col(c) == 1, "heart_beat").otherwise("brain_or_other").alias("label"))
    return op.compare_labelings(side("a_label"), side("b_label"), [])


@query("compare_labelings", with_views(CMP + "SELECT * FROM x", "labelings"))
def _(t):
    return compared(t)


@query("labeling_agreement", with_views(CMP + """
SELECT 'corpus' AS scope, count(*) AS n_items, count(*) FILTER (agree) AS n_matching, count(*) FILTER (a_artifact AND b_artifact) AS n_intersection,
 count(*) FILTER (a_artifact OR b_artifact) AS n_union, round(count(*) FILTER (agree) / count(*), 6) AS agreement,
 round(count(*) FILTER (a_artifact AND b_artifact) / count(*) FILTER (a_artifact OR b_artifact), 6) AS artifact_jaccard FROM x""", "labelings"))
def _(t):
    out = op.labeling_agreement(compared(t).withColumn("scope", F.lit("corpus")), ["scope"])
    return out.withColumns({c: r6(c) for c in ("agreement", "artifact_jaccard")})


@query("labeling_sets", with_views(CMP + """
SELECT 'disagreement' AS set_name, component FROM x WHERE NOT agree UNION ALL SELECT 'artifact_intersection', component FROM x WHERE a_artifact AND b_artifact
UNION ALL SELECT 'artifact_union', component FROM x WHERE a_artifact OR b_artifact""", "labelings"))
def _(t):
    return op.labeling_sets(compared(t))
