"""Catalogue rules on paths derived from `pages`, and settings, vendors and readers on other tables."""

from pyspark.sql import functions as F

from ..functions.expr import r6, slug
from ..sources import catalogue as op
from ..sources import readers
from ..sources.bindings import with_views
from . import query

# recordings: dataset, subject, session, task (language or empty room), run; every fourth file name lacks the subject
RP = """WITH l AS (SELECT page_id, CASE WHEN regexp_extract(url, '/(fr|en|de|es)/', 1) = '' THEN 'xx' ELSE regexp_extract(url, '/(fr|en|de|es)/', 1) END AS lang FROM pages),
rp AS (SELECT page_id, 'ds' || (page_id % 4) AS dataset, lpad((page_id % 50)::VARCHAR, 3, '0') AS subject, (page_id % 3)::VARCHAR AS session,
 CASE WHEN page_id % 6 = 0 THEN 'emptr' ELSE lang END AS task, page_id::VARCHAR AS run FROM l),
rx AS (SELECT *, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'sub-' || subject || '_ses-' || session || '_' END || 'task-' || task || '_run-' || run || '_meg' AS output_id FROM rp),
rec AS (SELECT *, '/data/' || dataset || '/sub-' || subject || '/ses-' || session || '/meg/' || output_id || '.fif' AS path FROM rx) """


def recordings(t):
    lang = F.regexp_extract("url", "/(fr|en|de|es)/", 1)
    p = t.table("pages").select(
        "page_id", F.concat(F.lit("ds"), F.col("page_id") % 4).alias("dataset"),
        F.lpad((F.col("page_id") % 50).cast("string"), 3, "0").alias("s"), (F.col("page_id") % 3).alias("n"),
        F.when(F.col("page_id") % 6 == 0, "emptr").when(lang == "", "xx").otherwise(lang).alias("k"))
    head = F.when(F.col("page_id") % 4 == 0, "").otherwise(F.concat(F.lit("sub-"), "s", F.lit("_ses-"), "n", F.lit("_")))
    path = F.concat(F.lit("/data/"), "dataset", F.lit("/sub-"), "s", F.lit("/ses-"), "n", F.lit("/meg/"), head, F.lit("task-"), "k",
                    F.lit("_run-"), "page_id", F.lit("_meg.fif"))
    return p.select("page_id", "dataset", path.alias("path"))


def parsed(t):
    return op.parse_recording_entities(recordings(t))


@query("parse_recording_entities", RP + "SELECT page_id, subject, session, task, run, 'meg' AS suffix, output_id || '.fif' AS filename, output_id FROM rec")
def _(t):
    return parsed(t).drop("dataset", "path")


@query("filter_entities", RP + """, d AS (SELECT dataset, subject, dense_rank() OVER (PARTITION BY dataset ORDER BY subject) AS r FROM rec)
SELECT page_id FROM rec WHERE subject = '031' OR (dataset, subject) IN (SELECT (dataset, subject) FROM d WHERE r <= 3)""")
def _(t):
    return op.filter_entities(parsed(t), "subject", ["first:3", "031"]).select("page_id")


@query("filter_paths", RP + """SELECT page_id FROM rec WHERE (contains(output_id, '-fr_') OR contains(output_id, 'emptr')) AND NOT contains(output_id, 'run-1') AND dataset <> 'ds2'""")
def _(t):
    return op.filter_paths(recordings(t), "_MEG.fif", ["-FR_", "emptr"], ["run-1"], ["/data/ds2/"]).select("page_id")


@query("collapse_split_recordings", """
WITH c AS (SELECT conv_id, role, CASE WHEN conv_id % 5 = 0 THEN NULL ELSE turn + 1 END AS split FROM conversations)
SELECT conv_id, role, split FROM c WHERE split IS NULL OR split = 1""")
def _(t):
    c = t.table("conversations").select("conv_id", "role", F.when(F.col("conv_id") % 5 != 0, F.col("turn") + 1).alias("split"))
    return op.collapse_split_recordings(c, ["conv_id"])


@query("auto_dataset_format", """
SELECT r_name AS dataset, CASE WHEN bool_or(n_nationkey % 7 = 3) THEN 'bids' ELSE 'raw' END AS format FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def _(t):
    j = t.table("nation").join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    root = F.concat(F.lit("/data/"), "r_name")
    name = F.when(F.col("n_nationkey") % 7 == 3, "dataset_description.json").otherwise(F.col("n_name"))
    return op.auto_dataset_format(j.select(F.col("r_name").alias("dataset"), root.alias("root"), F.concat(root, F.lit("/"), name).alias("path")))


@query("select_datasets", "SELECT n_name AS dataset FROM nation WHERE n_name IN ('NATION_1', 'NATION_2')")
def _(t):
    d = t.table("nation").select(F.col("n_name").alias("dataset"))
    return op.select_datasets(d, ["nation_1", "Nation 2", "NATION_3"], ["NATION_3", "none"])


@query("select_datasets_exclude", "SELECT n_name AS dataset FROM nation WHERE n_name <> 'NATION_7'")
def _(t):
    return op.select_datasets(t.table("nation").select(F.col("n_name").alias("dataset")), ["*"], ["nation_7"])


BADS = """b AS (SELECT DISTINCT user_id % 20 AS recording_id, event_type || CASE WHEN user_id % 3 = 0 THEN '_x' ELSE '' END AS ch_name FROM events WHERE value > 110)"""


@query("restrict_bads_to_recording", with_views(f", {BADS} SELECT recording_id, ch_name FROM b WHERE (recording_id, ch_name) IN (SELECT (recording_id, ch_name) FROM samples)", "samples"))
def _(t):
    name = F.concat("event_type", F.when(F.col("user_id") % 3 == 0, "_x").otherwise(""))
    bads = t.table("events").where("value > 110").select((F.col("user_id") % 20).alias("recording_id"), name.alias("ch_name")).distinct()
    return op.restrict_bads_to_recording(bads, t.samples().select("recording_id", "ch_name").distinct()).select("recording_id", "ch_name")


@query("replace_annotations", with_views("""
, st AS (SELECT recording_id, onset + 1 AS onset, description FROM annotations WHERE description = 'BAD_amp')
SELECT recording_id, round(onset, 6) AS onset, description FROM annotations WHERE recording_id NOT IN (SELECT recording_id FROM st)
UNION ALL SELECT recording_id, round(onset, 6), description FROM st""", "annotations"))
def _(t):
    a = t.annotations().select("recording_id", "onset", "description")
    stored = a.where("description = 'BAD_amp'").withColumn("onset", F.col("onset") + 1)
    return op.replace_annotations(a, stored).withColumn("onset", r6("onset"))


@query("study_get", RP + "SELECT page_id FROM rec WHERE dataset = 'ds1' AND session = '2'")
def _(t):
    return op.study_get(recordings(t), "/data/{dataset}/sub-{subject}/ses-{session}/meg/{name}.fif", dataset="ds1", session="2").select("page_id")


SETTINGS = RP + """, m AS (SELECT *, task = 'emptr' OR (session = '1' AND contains(output_id, 'run-1')) AS hit FROM rec WHERE task <> 'emptr' OR session <> '1' OR NOT contains(output_id, 'run-1'))
SELECT page_id, CASE WHEN task = 'emptr' THEN 'noise' WHEN session = '1' AND contains(output_id, 'run-1') THEN 'early' ELSE '' END AS profile,
 CASE WHEN task = 'emptr' THEN 'filter=null;ica.enabled=false;ica.method=' || CASE dataset WHEN 'ds1' THEN 'picard' ELSE 'fastica' END
      WHEN session = '1' AND contains(output_id, 'run-1') THEN 'filter.high=40;filter.low=1;ica.enabled=true;ica.method=infomax'
      ELSE 'filter.high=' || CASE dataset WHEN 'ds1' THEN '80' ELSE '100' END || ';filter.low=1;ica.enabled=true;ica.method=' || CASE dataset WHEN 'ds1' THEN 'picard' ELSE 'fastica' END END AS settings FROM m"""


@query("effective_settings", SETTINGS)
def _(t):
    recs = parsed(t)
    early = (F.col("session") == "1") & F.contains("filename", F.lit("run-1"))
    recs = recs.where((F.col("task") != "emptr") | ~early)  # both profiles would match: an error by rule

    def smap(**kv):
        return F.create_map(*[F.lit(x) for k, v in kv.items() for x in (k.replace("__", "."), v)]).cast("map<string,string>")

    defaults = smap(ica__enabled="true", ica__method="fastica", filter__low="1", filter__high="100")
    ds = recs.select("dataset").distinct()
    layer = ds.where("dataset = 'ds1'").select("dataset", smap(ica__method="picard", filter__high="80").alias("settings"))
    spec = "map<string,array<string>>"
    profiles = ds.select("dataset", F.inline(F.array(
        F.struct(F.lit("noise").alias("profile"), F.create_map(F.lit("task"), F.array(F.lit("EMPTR"), F.lit("noise"))).cast(spec).alias("match"),
                 smap(ica__enabled="false", filter=None).alias("settings")),
        F.struct(F.lit("early").alias("profile"), F.create_map(F.lit("session"), F.array(F.lit("1")), F.lit("filename_contains"),
                 F.array(F.lit("RUN-1"))).cast(spec).alias("match"), smap(ica__method="infomax", filter__high="40").alias("settings")))))
    out = op.effective_settings(recs, defaults, layer, profiles, ["page_id"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries("settings")), lambda e: F.concat(
        e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))), ";")
    return out.select("page_id", "profile", text.alias("settings"))


NAMES = ["Elekta", " neuro mag", "BTI", "OPM_QuSpin", "opm", "", "AUTO", "unknown", "Fieldline", "SQUID-X"]


@query("resolve_sensor_vendor", """
SELECT c_custkey, (['Elekta', 'Elekta', '4D', 'QuSpin', 'ALL', 'ALL', 'auto', 'unknown', 'QuanMag', 'SQUID-X'])[c_custkey % 10 + 1] AS device,
 (['elekta', 'elekta', '4D', 'opm', 'opm', '', 'auto', '', 'opm', 'SQUID-X'])[c_custkey % 10 + 1] AS vendor FROM customer""")
def _(t):
    name = F.array(*[F.lit(n) for n in NAMES])[(F.col("c_custkey") % 10).cast("int")]
    return t.table("customer").select("c_custkey", op.resolve_sensor_vendor(name).alias("device"),
                                      op.resolve_sensor_vendor(name, op.PLOT_VENDORS).alias("vendor"))


@query("vendor_by_dataset", RP + "SELECT page_id, CASE WHEN contains(path, '/ds1/sub-0') THEN 'kit' WHEN contains(path, 'ds1') THEN 'ctf' WHEN contains(path, 'ds2') THEN 'elekta' ELSE 'opm' END AS vendor FROM rec")
def _(t):
    table = {"DS1": "ctf", "ds 1/sub-0": "kit", "ds2": "elekta", "default": "opm"}
    return recordings(t).select("page_id", op.vendor_by_dataset(F.col("path"), table).alias("vendor"))


@query("infer_device_family", """
WITH c AS (SELECT label AS recording_id, upper(CASE WHEN label < 3 THEN 'meg ' || lpad(vec_id::VARCHAR, 4, '0') WHEN label < 6 THEN 'ag' || lpad((vec_id % 1000)::VARCHAR, 3, '0')
 WHEN label = 6 THEN 'A' || (vec_id % 1000) WHEN label = 7 THEN 'MLC' || (vec_id % 90 + 10) WHEN label = 8 THEN CASE WHEN vec_id % 2 = 0 THEN 'FL' || (vec_id % 90 + 10) ELSE 'A' || (vec_id % 10) END
 ELSE 'EEG' || vec_id END) AS nm FROM embeddings),
h AS (SELECT recording_id, CASE WHEN regexp_matches(replace(nm, ' ', ''), '^FL[0-9]{2,}') THEN 'opm' WHEN regexp_matches(replace(nm, ' ', ''), '^MEG[0-9]{4}$') THEN 'elekta' WHEN regexp_matches(nm, '^M[LRZ]') THEN 'ctf'
 WHEN regexp_matches(nm, '^AG[0-9]{3}$') THEN 'kit' WHEN regexp_matches(nm, '^A[0-9]{1,3}$') THEN '4d' END AS device FROM c),
g AS (SELECT recording_id, device, count(*) AS hits FROM h WHERE device IS NOT NULL GROUP BY 1, 2),
x AS (SELECT recording_id, max(hits) AS hits FROM g GROUP BY 1)
SELECT x.recording_id, x.hits, CASE WHEN x.hits >= 3 AND count(*) = 1 THEN min(device) END AS device FROM x JOIN g ON g.recording_id = x.recording_id AND g.hits = x.hits GROUP BY 1, 2""")
def _(t):
    v, lab = F.col("vec_id"), F.col("label")
    name = (F.when(lab < 3, F.concat(F.lit("meg "), F.lpad(v.cast("string"), 4, "0")))
            .when(lab < 6, F.concat(F.lit("ag"), F.lpad((v % 1000).cast("string"), 3, "0"))).when(lab == 6, F.concat(F.lit("A"), v % 1000))
            .when(lab == 7, F.concat(F.lit("MLC"), v % 90 + 10))
            .when(lab == 8, F.when(v % 2 == 0, F.concat(F.lit("FL"), v % 90 + 10)).otherwise(F.concat(F.lit("A"), v % 10)))
            .otherwise(F.concat(F.lit("EEG"), v)))
    return op.infer_device_family(t.table("embeddings").select(lab.alias("recording_id"), name.alias("ch_name")))


@query("slug", "SELECT doc_id, source || '_' || lang || '-v.1_' || doc_id AS slug FROM documents")
def _(t):
    raw = F.concat(F.lit(" ._"), "source", F.lit(" (/) "), "lang", F.lit("-v.1 @"), "doc_id", F.lit("...-"))
    return t.table("documents").select("doc_id", slug(raw).alias("slug"))


@query("assert_unique_ids", RP + "SELECT page_id, dataset, output_id FROM rec")
def _(t):
    return op.assert_unique_ids(parsed(t), ["dataset", "output_id"]).select("page_id", "dataset", "output_id")


@query("overlapping_trees", """
WITH d AS (SELECT s_suppkey AS dataset, '/out/' || s_nationkey || CASE WHEN s_acctbal < 5000 THEN '' ELSE '/' || s_suppkey END AS dir FROM supplier)
SELECT a.dataset AS outer_dataset, b.dataset AS inner_dataset, a.dir AS shared FROM d a JOIN d b ON a.dataset <> b.dataset AND (b.dir = a.dir OR starts_with(b.dir, a.dir || '/'))""")
def _(t):
    tail = F.when(F.col("s_acctbal") < 5000, "/").otherwise(F.concat(F.lit("/"), "s_suppkey"))
    d = t.table("supplier").select(F.col("s_suppkey").alias("dataset"), F.concat(F.lit("/out/"), "s_nationkey", tail).alias("output_dir"))
    return op.overlapping_trees(d)


T1 = RP + """, f AS (SELECT dataset, subject, '/data/' || dataset || '/' || CASE page_id % 9 WHEN 7 THEN 'derivatives/' ELSE '' END || 'sub-' || subject || '/anat/sub-' || subject || '_' || page_id ||
 CASE WHEN dataset IN ('ds0', 'ds1') AND page_id % 5 = 0 THEN '_T1w.nii.gz' WHEN page_id % 5 = 1 THEN '_xT1w.nii' WHEN page_id % 5 = 2 THEN '_T1_defaced.nii' WHEN page_id % 5 = 3 THEN '_T2w.nii.gz' ELSE '_T1x.nii.gz' END AS path FROM rec),
k AS (SELECT * FROM f WHERE NOT contains(path, '_33')),
c AS (SELECT * FROM k WHERE dataset IN ('ds0', 'ds1') AND path LIKE '%\\_T1w.nii.gz' ESCAPE '\\' UNION ALL SELECT * FROM k WHERE dataset NOT IN ('ds0', 'ds1') AND path NOT LIKE '%T2w%' AND path NOT LIKE '%derivatives%')
SELECT dataset, 'sub-' || subject AS subject, string_agg(path, ';' ORDER BY path) AS files FROM c GROUP BY 1, 2"""


@query("select_t1_files", T1)
def _(t):
    p = F.col("page_id") % 5
    end = (F.when(F.col("dataset").isin("ds0", "ds1") & (p == 0), "_T1w.nii.gz").when(p == 1, "_xT1w.nii").when(p == 2, "_T1_defaced.nii")
           .when(p == 3, "_T2w.nii.gz").otherwise("_T1x.nii.gz"))
    sub = F.concat(F.lit("sub-"), "subject")
    path = F.concat(F.lit("/data/"), "dataset", F.lit("/"), F.when(F.col("page_id") % 9 == 7, "derivatives/").otherwise(""), sub, F.lit("/anat/"), sub,
                    F.lit("_"), "page_id", end)
    files = parsed(t).select("dataset", path.alias("path"))
    return op.select_t1_files(files, exclude=["_33"]).withColumn("files", F.array_join("files", ";"))


QUALITY = """WITH f AS (SELECT o_custkey % 100 AS recording_id, 'p' || (o_orderkey % 5) AS prefix, o_orderkey % 3 AS k, o_orderdate AS mtime FROM orders),
s AS (SELECT recording_id, prefix, max(mtime) FILTER (k = 0) AS mtime, bool_or(k = 1) AS has_components, bool_or(k = 2) AS has_plot FROM f GROUP BY 1, 2 HAVING bool_or(k = 0))
SELECT recording_id, has_components AND has_plot AS complete, CAST(epoch_us(mtime) // 1000000 AS BIGINT) AS mtime, prefix, has_components, has_plot FROM s
QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY has_components AND has_plot DESC, mtime DESC, prefix DESC) = 1"""


@query("read_quality_outputs", QUALITY)
def _(t):
    k = F.col("o_orderkey") % 3
    end = F.when(k == 0, ".summary.json").when(k == 1, ".component_scores.csv").otherwise(".normative_quality_score.png")
    files = t.table("orders").select((F.col("o_custkey") % 100).alias("recording_id"), F.concat(F.lit("p"), F.col("o_orderkey") % 5, end).alias("name"),
                                     F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("mtime"))
    return readers.pick_quality_outputs(files)


@query("parse_epoch_reject_log", """
SELECT l_orderkey, count(*) AS n_rejected, count(*) * 3 AS remaining, count(*) * 4 AS total, 0.25e0 AS reject_rate FROM lineitem GROUP BY 1""")
def _(t):
    ids = F.array_join(F.array_sort(F.collect_list("l_linenumber")), ", ")
    logs = t.table("lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("["), ids, F.lit("]\n\nnum_epochs: "), F.count("*") * 3, F.lit("\n")).alias("text"))
    parsed_log = readers.parse_epoch_reject_log(F.col("text"))
    return logs.select("l_orderkey", *[parsed_log[c].cast("bigint").alias(c) for c in ("n_rejected", "remaining", "total")],
                       parsed_log["reject_rate"].alias("reject_rate"))


@query("matrix_to_samples", """
SELECT label AS recording_id, 'S' || vec_id AS ch_name, CASE WHEN vec_id % 3 = 0 THEN 'mag' ELSE 'grad' END AS ch_type, i - 1 AS t, round(CAST(embedding[i] AS DOUBLE), 6) + 0e0 AS value FROM embeddings, range(1, 65) r(i)""")
def _(t):
    e = t.table("embeddings")
    sensors = e.select(F.col("label").alias("recording_id"), F.col("vec_id").alias("row"), F.concat(F.lit("S"), "vec_id").alias("ch_name"),
                       F.when(F.col("vec_id") % 3 == 0, "mag").otherwise("grad").alias("ch_type"))
    matrix = e.select(F.col("label").alias("recording_id"), F.col("vec_id").alias("row"), F.col("embedding").alias("values"))
    return readers.matrix_to_samples(matrix, sensors).withColumn("value", r6(F.col("value").cast("double")))


def trigger_rows(t):
    marks = t.triggers().groupBy("recording_id", (F.col("sample") * 3).alias("sample")).agg(F.max("event_id").alias("event_id"))
    return marks, marks.select("recording_id").distinct().withColumn("n_times", F.lit(129_700).cast("bigint"))


MARKS = ", mk AS (SELECT recording_id, sample * 3 AS sample, max(event_id) AS event_id FROM triggers GROUP BY 1, 2) "


@query("events_to_stim", with_views(MARKS + "SELECT recording_id, sample + i AS t, event_id AS value FROM mk, range(0, 2) r(i)", "triggers"))
def _(t):
    return readers.events_to_stim(*trigger_rows(t), 2).where("value > 0")


@query("events_to_stim_clock", with_views(MARKS + """, pu AS (SELECT recording_id, event_id AS value, sample + i AS t FROM mk, range(0, 2) r(i)),
vl AS (SELECT recording_id, value, count(*) AS n, CAST(sum(t) AS BIGINT) AS s FROM pu GROUP BY 1, 2)
SELECT recording_id, value, n AS n_samples, s AS t_sum FROM vl
UNION ALL SELECT recording_id, 0, 129700 - CAST(sum(n) AS BIGINT), CAST(129700::BIGINT * 129699 // 2 - sum(s) AS BIGINT) FROM vl GROUP BY 1""", "triggers"))
def _(t):
    stim = readers.events_to_stim(*trigger_rows(t), 2)
    return stim.groupBy("recording_id", "value").agg(F.count("*").alias("n_samples"), F.sum("t").alias("t_sum"))


@query("triggers_to_stim", with_views(MARKS + """, n AS (SELECT *, coalesce(lead(sample) OVER (PARTITION BY recording_id ORDER BY sample), 129700) - sample AS len FROM mk),
r AS (SELECT recording_id, event_id AS value, sum(len) AS n FROM n GROUP BY 1, 2 UNION ALL SELECT recording_id, 0, min(sample) FROM mk GROUP BY 1)
SELECT recording_id, value, CAST(n AS BIGINT) AS n_samples FROM r WHERE n > 0""", "triggers"))
def _(t):
    marks, recs = trigger_rows(t)
    stim = readers.triggers_to_stim(marks.withColumnRenamed("event_id", "value"), recs)
    return stim.groupBy("recording_id", "value").agg(F.count("*").alias("n_samples"))
