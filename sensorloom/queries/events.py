"""Events and epochs."""

from pyspark.sql import functions as F

from ..functions.expr import r6, r6_off_ties
from ..operators import events as op
from ..operators import intervals
from ..sources.bindings import with_views
from . import query
from .intervals import recordings


@query("infer_category", with_views("""
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'noise' WHEN regexp_matches(lower(path), 'rest|resting|emptyroom|empty-room') THEN 'rest' ELSE 'task' END AS category
FROM paths""", "paths"))
def _(t):
    asked = F.when(F.col("page_id") % 7 == 0, "Noise").otherwise("auto")
    return t.paths().select("page_id", op.infer_category(F.col("path"), asked).alias("category"))


@query("channel_type_from_name", """
SELECT vec_id, CASE WHEN nm[-1] = '1' THEN 'mag' WHEN nm[-1] IN ('2', '3') THEN 'grad' ELSE 'x' END AS ch_type
FROM (SELECT vec_id, 'MEG' || lpad((vec_id * 7)::VARCHAR, 4, '0') AS nm FROM embeddings)""")
def _(t):
    name = F.concat(F.lit("MEG "), F.lpad((F.col("vec_id") * 7).cast("string"), 4, "0"))
    return t.table("embeddings").select("vec_id", op.channel_type_from_name(name).alias("ch_type"))


@query("filter_events_text", with_views("""
SELECT event_id, trial_type FROM event_rows WHERE (contains(trial_type, 'ur') OR contains(trial_type, 'cl') OR contains(trial_type, 'sign'))
AND regexp_matches(trial_type, '^[ps]')""", "event_rows"))
def _(t):
    rule = op.filter_events_text(F.col("trial_type"), ["ur", "cl", "sign"], ["^[ps]"])
    return t.event_rows().where(rule).select("event_id", "trial_type")


@query("filter_events_fields", with_views("""
SELECT event_id FROM event_rows WHERE json_extract_string(props, '$.k') IN ('7', '42', '69')""", "event_rows"))
def _(t):
    return t.event_rows().where(op.filter_events_fields(F.col("props"), {"k": ["7", "42", "69"]})).select("event_id")


@query("map_event_value", with_views(""",
x AS (SELECT event_id, trial_type, CAST(floor(value) AS INTEGER) - 3 AS v FROM event_rows)
SELECT event_id, 'column' AS source, v AS event_value FROM x WHERE v NOT IN (0, -1)
UNION ALL SELECT event_id, 'mapping', CASE trial_type WHEN 'click' THEN 11 ELSE 12 END FROM x WHERE trial_type IN ('click', 'view')
UNION ALL SELECT event_id, 'fixed', 5 FROM x""", "event_rows"))
def _(t):
    rows = t.event_rows()
    text = (F.floor("value").cast("int") - 3).cast("string")

    def part(source, value):
        return rows.select("event_id", F.lit(source).alias("source"), value.alias("event_value")).where("event_value is not null")

    kind = F.col("trial_type")
    return part("column", op.map_event_value(kind, value=text)).unionByName(
        part("mapping", op.map_event_value(kind, {"click": 11, "view": 12}))).unionByName(
        part("fixed", op.map_event_value(kind, fixed=5)))


@query("exclude_event_ids", with_views(
    "SELECT recording_id, source_id, sample, event_id FROM triggers WHERE event_id NOT IN (1, 3)", "triggers"))
def _(t):
    return op.exclude_event_ids(t.triggers(), [1, 3]).select("recording_id", "source_id", "sample", "event_id")


@query("onset_to_sample", with_views(
    "SELECT source_id, CAST(trunc(onset * 250e0) AS BIGINT) + 17 AS sample FROM annotations", "annotations"))
def _(t):
    return t.annotations().select("source_id", op.onset_to_sample(F.col("onset"), 250.0, 17).alias("sample"))


@query("shift_events", with_views("""
SELECT source_id, CAST(sample + CASE recording_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 8 WHEN 2 THEN 2 ELSE -25 END AS BIGINT) AS sample FROM triggers""", "triggers"))
def _(t):
    part = F.col("recording_id") % 4

    def settings(**kv):
        return F.create_map(*[F.lit(x) for pair in kv.items() for x in pair])

    # seconds win over milliseconds; 10 ms at 250 Hz is 2.5 samples and rounds to the even 2
    s = (F.when(part == 1, settings(event_time_shift_ms="900", stimulus_delay_sec="0.034"))
         .when(part == 2, settings(stimulus_delay_ms="10")).when(part == 3, settings(event_time_shift_sec="-0.1"))
         .otherwise(settings(other="1")))
    return op.shift_events(t.triggers(), s, 250.0).select("source_id", "sample")


@query("remap_events_on_resample", with_views(
    "SELECT source_id, CAST(round_even(sample * (250e0 / 600e0), 0) AS BIGINT) AS sample FROM triggers", "triggers"))
def _(t):
    return t.triggers().select("source_id", op.remap_events_on_resample(F.col("sample"), 600.0, 250.0).alias("sample"))


@query("annotation_to_samples", with_views(""",
m AS (SELECT *, CASE WHEN onset >= 86400e0 AND onset - 86400e0 <= 1000000e0 + 1e-6 THEN onset - 86400e0 ELSE onset END AS o FROM annotations),
b AS (SELECT *, greatest(0, least(CAST(round_even(o, 0) AS BIGINT), 1000000)) AS s, greatest(0, least(CAST(round_even(o + duration, 0) AS BIGINT), 1000000)) AS e FROM m)
SELECT source_id, s AS start, CASE WHEN e <= s AND duration > 0 THEN least(1000000, s + 1) ELSE e END AS stop FROM b""", "annotations"))
def _(t):
    recs = recordings(t).withColumn("n_times", F.lit(1_000_000).cast("bigint")).withColumn("first_time", F.lit(86400e0))
    return op.annotation_to_samples(t.annotations(), recs).select("source_id", "start", "stop")


@query("is_bad_annotation", with_views("""
SELECT source_id, contains(lower(description), 'bad') AS mentions, starts_with(upper(description), 'BAD') AS prefixed FROM annotations""", "annotations"))
def _(t):
    d = F.col("description")
    return t.annotations().select("source_id", op.is_bad_annotation(d).alias("mentions"), op.is_bad_annotation(d, "prefix").alias("prefixed"))


@query("threshold_preset", """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'strict' ELSE 'lenient' END AS mode,
  CASE WHEN c_acctbal > 5000 THEN 0.5e0 ELSE CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.85e0 ELSE 0.99e0 END END AS high,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.15e0 ELSE 0.95e0 END AS low,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 10e0 ELSE 0e0 END AS merge_gap,
  CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 0e0 END AS min_duration,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.95e0 ELSE 1e0 END AS short_keep FROM customer""")
def _(t):
    part = F.col("c_custkey") % 3
    settings = t.table("customer").select(
        "c_custkey", F.when(part == 1, " Strict").when(part == 2, "lenient").otherwise("none").alias("mode"),
        F.when(F.col("c_acctbal") > 5000, 0.5).alias("high"))
    return op.threshold_preset(settings)


@query("scale_by_type", with_views("""
SELECT recording_id, ch_name, t, round(value * CASE ch_type WHEN 'mag' THEN 2.5e0 ELSE 0.125e0 END, 6) AS value,
  CASE ch_type WHEN 'mag' THEN 1 ELSE 2 END AS sensor_code FROM samples""", "samples"))
def _(t):
    return op.scale_by_type(t.samples(), {"mag": 2.5, "grad": 0.125}).select(
        "recording_id", "ch_name", "t", r6("value").alias("value"), "sensor_code")


@query("read_bids_events", with_views("""
SELECT event_id, trial_type, CAST(trunc(value * 100e0) AS BIGINT) + 3 AS sample, CAST(json_extract_string(props, '$.k') AS INTEGER) AS event_value
FROM event_rows WHERE (contains(trial_type, 'i')) AND CAST(json_extract_string(props, '$.k') AS INTEGER) NOT IN (0, -1, 13)
AND json_extract_string(props, '$.k') IN ('0', '1', '2', '13', '40', '41')""", "event_rows"))
def _(t):
    rows = t.event_rows().withColumn("onset", F.col("value"))
    out = op.events_from_rows(rows, 100.0, 3, contains=["i"], fields={"k": ["0", "1", "2", "13", "40", "41"]},
                              value=F.get_json_object("props", "$.k"), exclude=[13], field_column="props")
    return out.select("event_id", "trial_type", "sample", "event_value")


@query("events_from_annotations", with_views(""",
nm AS (SELECT recording_id, description, row_number() OVER (PARTITION BY recording_id ORDER BY description) AS i FROM (SELECT DISTINCT recording_id, description FROM annotations))
SELECT recording_id, source_id, CAST(trunc(onset * 10e0) AS BIGINT) AS sample, CAST(i AS INTEGER) AS event_id FROM annotations JOIN nm USING (recording_id, description)""", "annotations"))
def _(t):
    return op.events_from_annotations(t.annotations(), 10.0).select("recording_id", "source_id", "sample", "event_id")


STIM = ", st AS (SELECT recording_id, t, CAST(floor(value / 40) AS BIGINT) AS value FROM samples WHERE ch_name = 'click') "
FOUND = STIM + """, x AS (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS nx FROM st WINDOW w AS (PARTITION BY recording_id ORDER BY t)),
fe AS (SELECT recording_id, t AS sample, value AS event_id FROM x WHERE value > p AND nx = value) """


def stim(t):
    return t.samples().where("ch_name = 'click'").select("recording_id", "t", F.floor(F.col("value") / 40).cast("bigint").alias("value"))


@query("find_events", with_views(FOUND + "SELECT * FROM fe", "samples"))
def _(t):
    return op.find_events(stim(t), 2)


@query("resolve_events", with_views(FOUND + """,
nm AS (SELECT recording_id, description, row_number() OVER (PARTITION BY recording_id ORDER BY description) AS i FROM (SELECT DISTINCT recording_id, description FROM annotations))
SELECT recording_id, sample, CAST(event_id AS INTEGER) AS event_id, 'find_events' AS source FROM fe WHERE recording_id % 4 = 0
UNION ALL SELECT recording_id, CAST(trunc(onset * 10e0) AS BIGINT), CAST(i AS INTEGER), 'annotations' FROM annotations JOIN nm USING (recording_id, description) WHERE recording_id % 4 = 1
UNION ALL SELECT recording_id, sample, CAST(event_id AS INTEGER), 'event_file' FROM triggers WHERE recording_id % 4 = 2
UNION ALL SELECT recording_id, CAST(i * 86400 AS BIGINT), 1, 'resting' FROM (SELECT DISTINCT user_id % 20 AS recording_id FROM events), range(0, 30) r(i) WHERE recording_id % 4 = 3""",
                                     "samples", "annotations", "triggers"))
def _(t):
    recs = recordings(t)
    part = F.col("recording_id") % 4
    routes = recs.select("recording_id", F.when(part == 0, "find_events").when(part == 1, "annotations")
                         .when(part == 2, "event_file").otherwise("resting").alias("source"))
    return op.resolve_events(routes, {
        "find_events": op.find_events(stim(t), 2), "annotations": op.events_from_annotations(t.annotations(), 10.0),
        "event_file": t.triggers(), "resting": intervals.fixed_length_events(recs, DAY_SECONDS)})


DAY_SECONDS = 86_400.0
EP = """, ev AS (SELECT recording_id, source_id AS epoch, event_id, sample // 600 AS sample FROM triggers),
ep AS (SELECT e.recording_id, epoch, event_id, ch_type, ch_name, t - sample AS k, value FROM ev e JOIN samples s
  ON e.recording_id = s.recording_id AND t BETWEEN sample - 4 AND sample + 8),
bl AS (SELECT * EXCLUDE (value), value - avg(value) FILTER (k <= 0) OVER (PARTITION BY recording_id, epoch, ch_name) AS value FROM ep),
pp AS (SELECT recording_id, epoch, event_id, ch_name, max(value) - min(value) > CASE ch_type WHEN 'mag' THEN 165e0 ELSE 170e0 END AS over FROM bl GROUP BY recording_id, epoch, event_id, ch_type, ch_name),
lg AS (SELECT recording_id, epoch, event_id, coalesce(string_agg(CASE WHEN over THEN ch_name END, ',' ORDER BY ch_name), '') AS reason, bool_or(over) AS rejected FROM pp GROUP BY 1, 2, 3) """


def epochs(t):
    ev = t.triggers().select("recording_id", F.col("source_id").alias("epoch"), "event_id",
                             F.floor(F.col("sample") / 600).cast("bigint").alias("sample"))
    return op.cut_epochs(ev, t.samples(), 4, 8)


def corrected(t):
    return op.baseline_correct(epochs(t), None, 0)


LIMITS = {"mag": 165.0, "grad": 170.0}


@query("cut_epochs", with_views(EP + "SELECT recording_id, epoch, event_id, ch_name, k, value FROM ep", "triggers", "samples"))
def _(t):
    return epochs(t).select("recording_id", "epoch", "event_id", "ch_name", "k", "value")


@query("baseline_correct", with_views(EP + "SELECT recording_id, epoch, ch_name, k, round(value, 6) + 0e0 AS value FROM bl", "triggers", "samples"))
def _(t):
    return corrected(t).select("recording_id", "epoch", "ch_name", "k", r6("value").alias("value"))


@query("reject_ptp", with_views(EP + "SELECT * FROM lg", "triggers", "samples"))
def _(t):
    return op.reject_ptp(corrected(t), LIMITS).withColumn("reason", F.array_join("reason", ","))


BADCH = ", bc AS (SELECT recording_id, ch_name FROM samples GROUP BY 1, 2 HAVING max(value) > 190e0) "


@query("drop_bad_channels", with_views(EP + BADCH + """
SELECT recording_id, epoch, ch_name, k FROM ep WHERE NOT EXISTS (SELECT 1 FROM bc WHERE bc.recording_id = ep.recording_id AND bc.ch_name = ep.ch_name)""", "triggers", "samples"))
def _(t):
    bads = t.samples().groupBy("recording_id", "ch_name").agg(F.max("value").alias("m")).where("m > 190")
    return op.drop_bad_channels(epochs(t), bads).select("recording_id", "epoch", "ch_name", "k")


@query("evoked", with_views(EP + """
SELECT recording_id, event_id, ch_name, k, round(avg(value) + 1e-9, 6) AS value, count(*) AS n_epochs FROM bl
WHERE EXISTS (SELECT 1 FROM lg WHERE lg.recording_id = bl.recording_id AND lg.epoch = bl.epoch AND NOT rejected) GROUP BY 1, 2, 3, 4""", "triggers", "samples"))
def _(t):
    e = corrected(t)
    return op.evoked(e, op.reject_ptp(e, LIMITS)).withColumn("value", r6_off_ties("value"))


@query("epoch_reject_histogram", with_views(EP + """,
c AS (SELECT recording_id, count(*) FILTER (rejected) AS n FROM lg GROUP BY 1),
h AS (SELECT n, count(*) AS k FROM c GROUP BY 1)
SELECT i AS n_rejected, coalesce(k, 0) AS n_recordings FROM (SELECT unnest(range(0, (SELECT max(n) FROM c) + 1)) AS i) LEFT JOIN h ON h.n = i""", "triggers", "samples"))
def _(t):
    counts = op.reject_ptp(corrected(t), LIMITS).groupBy("recording_id").agg(F.count_if("rejected").alias("n_rejected"))
    return op.epoch_reject_histogram(counts)
