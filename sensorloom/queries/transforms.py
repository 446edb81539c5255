"""Preprocessing kernels and transform chains."""

from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.expr import r6
from ..operators import statistics
from ..operators import transforms as op
from ..operators.events import scale_by_type
from ..sources.bindings import fir_sql, resample_sql, with_views
from . import query

SFREQ = 600.0


def signal(t):
    return t.samples().select("recording_id", "ch_name", "t", "value")


def fir_twin(taps):
    return with_views(fir_sql(taps) + "SELECT recording_id, ch_name, t, round(y, 6) + 0e0 AS value FROM fx", "samples")


@query("filter_signal", fir_twin(kernels.bandpass_taps(20.0, 100.0, SFREQ, 63)))
def _(t):
    return op.filter_signal(signal(t), SFREQ, 20.0, 100.0, taps=63).withColumn("value", r6("value"))


@query("notch", fir_twin(kernels.notch_taps([50.0], 2.0, SFREQ, 63)))
def _(t):
    return op.notch(signal(t), SFREQ, [50.0], taps=63).withColumn("value", r6("value"))


@query("resample", with_views(resample_sql(5, 12, 8) + "SELECT recording_id, ch_name, t, round(y, 6) + 0e0 AS value FROM rs", "samples"))
def _(t):
    return op.resample(signal(t), SFREQ, 250.0, half=8).withColumn("value", r6("value"))


@query("preprocess", with_views(fir_sql(kernels.bandpass_taps(1.0, 100.0, SFREQ, 63), "bp") + ", b1 AS (SELECT recording_id, ch_name, t, y AS value FROM bp) "
                                + fir_sql(kernels.notch_taps([50.0], 2.0, SFREQ, 63), "nt", "b1") + ", b2 AS (SELECT recording_id, ch_name, t, y AS value FROM nt) "
                                + resample_sql(5, 12, 8, source="b2") + "SELECT recording_id, ch_name, t, round(y, 6) + 0e0 AS value FROM rs", "samples"))
def _(t):
    out, _, _ = op.preprocess(signal(t), SFREQ, taps=63, half=8)
    return out.withColumn("value", r6("value"))


@query("transform_chain", with_views("""
, x AS (SELECT recording_id, ch_name, t, value * CASE ch_type WHEN 'mag' THEN 2e0 ELSE 1e0 END + 1 AS value FROM samples)
SELECT recording_id, ch_name, t, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) + 0e0 AS value FROM x WINDOW w AS (PARTITION BY recording_id, ch_name)""", "samples"))
def _(t):
    def shift(df, by):
        return df.withColumn("value", F.col("value") + by)

    out = op.transform_chain(t.samples(), [
        ("scale_by_type", {"factors": {"mag": 2.0}}), ("shift", {"by": 1}), ("standardize", {}),
        ("select", {"args": ("recording_id", "ch_name", "t", "value")})],
        {"scale_by_type": scale_by_type, "standardize": statistics.standardize}, {"shift": shift})
    return out.withColumn("value", r6("value"))
