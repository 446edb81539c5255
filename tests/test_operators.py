"""Operators against brute force, planted defects, and their error rules."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import kernels
from sensorloom.operators import components, detectors, ensembles, events, intervals, lineage, rollups, scoring, signal, spatial, statistics, transforms
from sensorloom.sources import catalogue, readers

rng = np.random.default_rng(7)


def long(spark, x, rec=1, types=None):
    names = [f"c{i}" for i in range(len(x))]
    types = types or ["mag"] * len(x)
    pdf = pd.DataFrame([(rec, types[i], names[i], j, float(x[i, j])) for i in range(x.shape[0]) for j in range(x.shape[1])],
                       columns=["recording_id", "ch_type", "ch_name", "t", "value"])
    return spark.createDataFrame(pdf)


def raises(df, text):
    with pytest.raises(Exception) as e:
        df.collect()
    assert text in str(e.value)


# ------------------------------------------------------------------------ kernels

def test_student_quantiles():
    p, df = [0.025, 0.05, 0.0005, 0.01, 0.025, 0.005], [10, 1, 5, 2, 1000, 199]
    want = [2.2281388520, 6.3137515147, 6.8688266259, 6.9645567342, 1.9623390808, 2.6007602]
    np.testing.assert_allclose(kernels.student_quantile(p, df), want, rtol=1e-6)
    a, b = kernels._newton_quantile(np.array([1e-5]), np.array([300.0])), kernels.student_quantile([1e-5], [300.0])
    np.testing.assert_allclose(a, b, rtol=1e-8)


def naive_esd(x, alpha, p_out, side):
    n, left, marks = len(x), list(range(len(x))), set()
    for i in range(1, min(math.ceil(n * p_out), n - 2) + 1):
        v = x[left]
        score = {-1: v.mean() - v, 0: np.abs(v - v.mean()), 1: v - v.mean()}[side]
        j = int(np.argmax(score))
        t = kernels.student_quantile([(alpha / 2 if side == 0 else alpha) / (n - i + 1)], [n - i - 1])[0]
        if score[j] / v.std() > (n - i) * t / math.sqrt((n - i - 1 + t * t) * (n - i + 1)):
            marks.add(left[j])
        del left[j]
    return marks


@pytest.mark.parametrize("side", [-1, 0, 1])
def test_esd_equals_repeated_passes(side):
    for seed in range(5):
        x = np.random.default_rng(seed).normal(size=80)
        x[[3, 40]] += 9
        x[11] -= 7
        got = set(np.flatnonzero(kernels.esd_outliers(x, 0.05, 0.1, side)))
        assert got == naive_esd(x, 0.05, 0.1, side)
        if side == 0:
            assert {3, 11, 40} <= got


def test_filters_in_blocks_equal_the_whole(spark):
    x = rng.normal(size=(1, 300)).cumsum(axis=1)
    taps = kernels.bandpass_taps(2, 30, 100, 41)
    want = np.convolve(np.pad(x[0], 20, mode="reflect"), taps, mode="valid")
    got = detectors.filtered(long(spark, x), taps, "y", size=64).toPandas().sort_values("t")
    np.testing.assert_allclose(got["y"], want, atol=1e-10)


def test_notch_and_band(spark):
    t = np.arange(4000) / 500
    x = np.stack([np.sin(2 * np.pi * 10 * t), np.sin(2 * np.pi * 50 * t)])
    out = transforms.notch(long(spark, x), 500, [50], taps=801, size=2000).toPandas()
    rms = {c: np.sqrt((g["value"][500:3500] ** 2).mean()) for c, g in out.sort_values("t").groupby("ch_name")}
    assert rms["c0"] > 0.69 and rms["c1"] < 0.02
    band = transforms.filter_signal(long(spark, x), 500, 20, 100, taps=801, size=2000).toPandas()
    rms = {c: np.sqrt((g["value"][500:3500] ** 2).mean()) for c, g in band.sort_values("t").groupby("ch_name")}
    assert rms["c0"] < 0.02 and rms["c1"] > 0.69


def test_resample_keeps_a_slow_sine(spark):
    t = np.arange(1200) / 600
    x = np.sin(2 * np.pi * 5 * t)[None, :]
    out = transforms.resample(long(spark, x), 600, 250, half=16, size=128).toPandas().sort_values("t")
    assert out["t"].tolist() == list(range(len(out))) and len(out) == 500
    inner = slice(20, 480)
    np.testing.assert_allclose(out["value"][inner], np.sin(2 * np.pi * 5 * out["t"] / 250)[inner], atol=5e-3)


@pytest.mark.parametrize(("old", "new"), [(1000, 250), (600, 250), (250, 300)])
def test_resample_does_not_depend_on_blocks(spark, old, new):
    """At 4 to 1 the filter is four times as long: what the new rate cannot hold is gone, what it can hold is kept."""
    t = np.arange(1500) / old
    x = np.stack([np.sin(2 * np.pi * 40 * t), np.sin(2 * np.pi * 0.45 * old * t), rng.normal(size=1500)])
    key = ["ch_name", "t"]
    whole, small = (transforms.resample(long(spark, x), old, new, half=16, size=size).toPandas().sort_values(key).reset_index(drop=True) for size in (1 << 16, 100))
    assert whole["t"].tolist() == small["t"].tolist() == [*range(1499 * new // old + 1)] * 3
    np.testing.assert_allclose(small["value"], whole["value"], atol=1e-12)
    rms = {c: np.sqrt((g["value"][80:-80] ** 2).mean()) for c, g in whole.groupby("ch_name")}
    assert abs(rms["c0"] - 0.5**0.5) < 0.01 and (rms["c1"] < 0.01) == (new < old)


def test_muscle_spans_do_not_depend_on_blocks(spark):
    m, sfreq = 3000, 500
    x = 0.1 * rng.normal(size=(3, m))
    x[:, 1500:1700] += np.sin(2 * np.pi * 125 * np.arange(200) / sfreq)
    x[:, :90] += np.sin(2 * np.pi * 120 * np.arange(90) / sfreq)
    found = [sorted((r["recording_id"], r["onset"], r["duration"], round(r["peak"], 9)) for r in detectors.muscle_zscore(long(spark, x), sfreq, threshold=1.5, smooth_taps=201, size=size).collect())
             for size in (40, 1000, 1 << 16)]
    assert found[0] == found[1] == found[2] and len(found[0]) >= 2
    pair = kernels.analytic_taps(110, 140, sfreq, 129)
    wave = np.cos(2 * np.pi * 125 * np.arange(2000) / sfreq)
    envelope = np.hypot(np.convolve(wave, pair[0], "valid"), np.convolve(wave, pair[1], "valid"))
    assert np.ptp(envelope) < 0.02 * envelope.mean()


def test_permutation_maxima_equal_numpy_and_shuffle_no_subjects(spark):
    import hashlib

    y = rng.normal(size=(3, 40))
    rows = [(c, f"s{s}", float(y[c, s])) for c in range(3) for s in range(40)]
    df = spark.createDataFrame(rows, "cell int, subject string, cope double").repartition(4)
    sign = np.array([[1] + [1 if hashlib.md5(f"s{s}:{p}:3".encode()).digest()[0] < 128 else -1 for p in range(1, 31)] for s in range(40)])
    z = y[:, :, None] * sign[None]
    t = np.abs(z.mean(axis=1) / np.sqrt(z.var(axis=1, ddof=1) / 40)).max(axis=0)
    for block in (256, 7):
        got = statistics.max_stat_permutation(df, ["cell"], 30, 3, block=block).orderBy("perm").toPandas()
        assert got["perm"].tolist() == list(range(31))
        np.testing.assert_allclose(got["max_stat"], t, rtol=1e-9)
    parts = df.select("cell", F.col("subject").alias("_s"), F.col("cope").alias("_y")).mapInArrow(
        kernels.signed_sums(["cell"], 30, 3, 256), "cell int, block int, sums array<double>, sq double, n bigint")
    assert parts.count() <= 3 * 4 and parts.agg(F.sum("n")).first()[0] == 120
    small = df.select("cell", F.col("subject").alias("_s"), F.col("cope").alias("_y")).mapInArrow(
        kernels.signed_sums(["cell"], 30, 3, 256, held=31), "cell int, block int, sums array<double>, sq double, n bigint")
    assert small.agg(F.sum("n")).first()[0] == 120


def test_preprocess_skip_rules(spark):
    x = rng.normal(size=(1, 200))
    _, rate, log = transforms.preprocess(long(spark, x), 90, [
        {"filter": {"h_freq": 100.0}}, {"notch_filter": {"freqs": [50.0]}}, {"resample": {"sfreq": 90}}], taps=21)
    assert rate == 90 and [e["status"] for e in log] == ["skipped"] * 3
    with pytest.raises(ValueError):
        transforms.preprocess(long(spark, x), 90, [{"resample": {"sfreq": 0}}])


def test_welch_finds_the_peak(spark):
    t = np.arange(1000) / 100
    psd = detectors.welch_psd(long(spark, np.sin(2 * np.pi * 20 * t)[None, :]), 100, 50, size=120).toPandas()
    assert psd.loc[psd["power"].idxmax(), "freq"] == 20 and len(psd) == 26
    whole = detectors.welch_psd(long(spark, np.sin(2 * np.pi * 20 * t)[None, :]), 100, 50, size=5000).toPandas()
    np.testing.assert_allclose(psd.sort_values("freq")["power"], whole.sort_values("freq")["power"], atol=1e-12)


def test_dfa_of_noise_and_walk(spark):
    x = rng.normal(size=(1, 3000))
    noise = signal.segmented_dfa(long(spark, x), 1500).first()["dfa"]
    walk = signal.segmented_dfa(long(spark, x.cumsum(axis=1)), 1500, size=1500).first()["dfa"]
    assert 0.4 < noise < 0.65 and 1.3 < walk < 1.7
    one = kernels.dfa_exponent(x[0][:1501])
    two = kernels.dfa_exponent(x[0][1500:])
    assert noise == pytest.approx((one + two) / 2)


def test_max_abs_diff_and_subsample_in_small_blocks(spark):
    x = rng.normal(size=(2, 101))
    got = {r["ch_name"]: r["max_abs_diff"] for r in signal.channel_max_abs_diff(long(spark, x), size=6).collect()}
    assert got == {f"c{i}": pytest.approx(np.abs(np.diff(x[i])).max()) for i in range(2)}
    kept = signal.uniform_subsample(long(spark, x), 17).where("ch_name = 'c0'").toPandas()["t"]
    assert sorted(kept) == np.linspace(0, 100, 17).astype(int).tolist()


# ---------------------------------------------------------------- planted defects

def noisy(n=6, m=1200):
    base = np.sin(2 * np.pi * 7 * np.arange(m) / 300)
    return base + 0.2 * rng.normal(size=(n, m))


def bad(df):
    return {r["ch_name"] for r in df.where("is_bad").collect()}


def test_planted_channel_defects(spark):
    x = noisy(8)
    x[1] = x[1] * 40
    x[2] += 3 * rng.normal(size=x.shape[1])
    x[3] = 5.0
    s = long(spark, x)
    assert {r["ch_name"] for r in detectors.bad_nan_flat(s).where("is_flat").collect()} == {"c3"}
    assert "c1" in bad(detectors.bad_by_deviation(s))
    live = s.where("ch_name <> 'c3'")
    assert bad(detectors.bad_by_hfnoise(live, 300, taps=61)) == {"c2"}
    cons = detectors.window_consistency(s, 300)
    assert bad(detectors.bad_by_dropout(cons)) == {"c3"}
    assert "c2" not in bad(detectors.bad_by_correlation(cons, 0.1)) and "c3" in bad(detectors.bad_by_correlation(cons, 0.1))
    assert bad(detectors.bad_by_psd(detectors.welch_psd(s, 300, 100), 2.0)) == {"c1"}
    assert "c1" in bad(detectors.bad_channels_gesd(s).withColumnRenamed("is_outlier", "is_bad"))
    assert bad(detectors.bad_channels_lof(live, k=3, threshold=1.5)) >= {"c1"}


def test_ransac_flags_the_independent_channel(spark):
    x = noisy(5, 900)
    x[4] = rng.normal(size=900)
    names = [f"c{i}" for i in range(5)]
    rows = [(j, c, p, 1 / 2) for c in names for j in range(4) for p in [q for q in names[:4] if q != c][j % 3: j % 3 + 2]]
    w = spark.createDataFrame(rows, "subset int, ch_name string, predictor string, weight double")
    assert bad(detectors.bad_by_ransac(long(spark, x), w, 150)) == {"c4"}


def test_bad_segment_intervals_keep_the_onset_rule(spark):
    x = rng.normal(size=(3, 400))
    x[:, 100:120] *= 30
    x[:, 0:20] *= 40
    got = sorted((r["onset"], r["duration"]) for r in detectors.bad_segments_gesd(long(spark, x), 10.0, 20).collect())
    assert got == [(0.0, pytest.approx(1.9)), (pytest.approx(9.9), pytest.approx(2.0))]
    wise = detectors.bad_segments_channelwise(long(spark, x), 10.0, 20, threshold="any").collect()
    assert len(wise) >= 2


def test_muscle_burst(spark):
    m, sfreq = 6000, 500
    x = 0.1 * rng.normal(size=(4, m))
    x[:, 3000:3300] += np.sin(2 * np.pi * 125 * np.arange(300) / sfreq)
    spans = detectors.muscle_zscore(long(spark, x), sfreq, size=1000).collect()
    assert len(spans) == 1 and abs(spans[0]["onset"] - 6.0) < 0.2 and abs(spans[0]["duration"] - 0.6) < 0.3
    whole = detectors.muscle_zscore(long(spark, x), sfreq, size=6000).collect()
    assert abs(whole[0]["onset"] - spans[0]["onset"]) < 0.02


def epochs_with_defects(spark):
    n, c, k = 20, 6, 50
    v = np.sin(np.arange(k) / 5.0) + 0.5 * rng.normal(size=(n, c, k))
    v[0] *= 4
    v[1] += 20
    v[2, :, 0] += 40
    pdf = pd.DataFrame([(1, e, 1, "mag", f"c{i}", j, v[e, i, j]) for e in range(n) for i in range(c) for j in range(k)],
                       columns=["recording_id", "epoch", "event_id", "ch_type", "ch_name", "k", "value"])
    return spark.createDataFrame(pdf)


def test_planted_epoch_defects(spark):
    e = epochs_with_defects(spark)
    out = {}
    for r in detectors.epoch_zscore_outliers(e).where("is_outlier").collect():
        out.setdefault(r["metric"], set()).add(r["epoch"])
    assert out["deviation"] == {1} and 2 in out["amplitude"] and 0 not in out["deviation"]
    marks = {r["epoch"] for r in detectors.bad_epochs_gesd(e, "std").where("is_outlier").collect()}
    assert {0, 2} <= marks


def test_line_noise_channel(spark):
    n, c, k, sfreq = 10, 12, 100, 200.0
    v = rng.normal(size=(n, c, k))
    v[:, 3, :] += 3 * np.sin(2 * np.pi * 50 * np.arange(k) / sfreq)
    pdf = pd.DataFrame([(1, e, f"c{i}", j, v[e, i, j]) for e in range(n) for i in range(c) for j in range(k)],
                       columns=["recording_id", "epoch", "ch_name", "k", "value"])
    out = detectors.channel_zscore_outliers(spark.createDataFrame(pdf), sfreq, 0, k - 1).where("is_outlier").collect()
    assert ("line_noise", "c3") in {(r["metric"], r["ch_name"]) for r in out}


def test_amplitude_spans_and_bad_channels(spark):
    x = np.zeros((2, 100))
    x[0] = rng.normal(size=100)
    x[0, 50] += 100
    spans, chans = detectors.annotate_amplitude(long(spark, x), 10.0, 50.0, 0.0, 5.0, size=16)
    assert [(r["onset"], r["duration"], r["description"]) for r in spans.collect()] == [(4.9, 0.2, "BAD_peak")]
    assert {(r["ch_name"], r["description"]) for r in chans.collect()} == {("c1", "BAD_flat")}


# --------------------------------------------------------------------- intervals

def test_hysteresis_spans_have_their_properties(spark):
    p = np.clip(rng.random(300) * 1.1, 0, 1)
    df = spark.createDataFrame(pd.DataFrame({"r": 1, "win": np.arange(300), "prob": p}))

    def spans(gap, least, keep):
        rows = intervals.hysteresis_intervals(df, ["r"], 0.9, 0.5, 1.0, gap, least, keep).collect()
        return sorted((int(r["onset"]), int(r["end"])) for r in rows)

    plain, merged, long_or_strong = spans(0.0, 0.0, None), spans(2.0, 0.0, None), spans(2.0, 3.0, 0.97)
    strong = set(np.flatnonzero(p >= 0.9))
    assert plain and {i for a, b in plain for i in range(a, b)} >= strong
    for a, b in plain:
        assert (p[a:b] >= 0.5).all() and p[a:b].max() >= 0.9
        assert (a == 0 or p[a - 1] < 0.5) and (b == 300 or p[b] < 0.5)
    assert {a for a, _ in merged} <= {a for a, _ in plain} and {b for _, b in merged} <= {b for _, b in plain}
    assert {i for a, b in plain for i in range(a, b)} <= {i for a, b in merged for i in range(a, b)}
    assert all(c - b > 2 for (_, b), (c, _) in zip(merged, merged[1:]))
    ends = {b: c for (_, b), (c, _) in zip(plain, plain[1:])}
    assert all(ends[b] - b <= 2 for a, z in merged for _, b in plain if a < b < z)
    assert set(long_or_strong) == {(a, b) for a, b in merged if b - a >= 3 or p[a:b].max() >= 0.97}


def test_breaks_with_leads_ignored_spans_and_recording_ends(spark):
    rows = [(1, 30.0, 5.0, "task"), (1, 40.0, 2.0, "BAD_x"), (1, 60.0, 1.0, "task"), (1, 70.0, 1.0, "task"), (1, 95.0, 5.0, None)]
    a = spark.createDataFrame(rows, "recording_id int, onset double, duration double, description string")
    recs = spark.createDataFrame([(1, 0.0, 100.0), (2, 0.0, 50.0)], "recording_id int, start double, stop double")

    def found(**options):
        return sorted((r["recording_id"], r["onset"], r["onset"] + r["duration"]) for r in intervals.annotate_break(a, 15.0, **options).collect())

    assert found() == [(1, 42.0, 60.0), (1, 71.0, 95.0)]
    assert found(lead_in=5.0, lead_out=3.0, ignore=("bad", "edge"), recordings=recs) == [(1, 0.0, 27.0), (1, 40.0, 57.0), (1, 76.0, 92.0), (2, 0.0, 50.0)]
    with pytest.raises(ValueError):
        intervals.annotate_break(a, 5.0, lead_in=4.0, lead_out=2.0)


def test_repeated_components_are_all_looked_up(spark):
    rows = [(1, "dev", "rest", "m", 2.0)] * 3 + [(2, "dev", "rest", "m", None)]
    c = spark.createDataFrame(rows, "recording_id int, device_type string, category string, metric string, value double")
    out = scoring.lookup_reference(c, scoring.build_reference_intervals(c)).collect()
    assert sorted(r["recording_id"] for r in out) == [1, 1, 1, 2] and {r["reference_n"] for r in out} == {3}


@pytest.mark.parametrize("cw,stride,least", [(30, 12, 8), (10, 10, 10), (7, 9, 3), (5, 2, 6)])
def test_chunk_spans(spark, cw, stride, least):
    df = spark.createDataFrame([(n, n) for n in range(0, 70, 3)], "id long, n long")
    rows = intervals.chunk_spans(df, ["id"], cw, stride, least).collect()
    for n in range(0, 70, 3):
        found = sorted((r["start"], r["stop"]) for r in rows if r["id"] == n)
        assert (found == []) if n == 0 else found[-1][1] == n
        assert len(set(found)) == len(found) and all(0 <= a < b <= n and b - a <= max(cw, n if len(found) == 1 else 0) for a, b in found)
        if 0 < n <= cw or least > cw:
            assert n == 0 or found == [(0, n)]
        elif n:
            assert (n - cw, n) in found and all(b - a >= least for a, b in found)
            assert all(a % stride == 0 for a, _ in found if a != n - cw)
            covered = {i for a, b in found for i in range(a, b)}
            assert all(i in covered for i in range(n)) or stride > cw


def test_window_plan_thins_evenly(spark):
    recs = spark.createDataFrame([(1, 1000), (2, 19), (3, 20), (4, 47)], "recording_id int, n_times long")
    plan = intervals.window_plan(recs, 20, 5, 8)
    got = {}
    for r in plan.collect():
        got.setdefault(r["recording_id"], []).append(r["start"])
    full = sorted({*range(0, 981, 15), 980})
    want = [full[int(i)] for i in np.round(np.linspace(0, len(full) - 1, 8))]
    assert sorted(got[1]) == want and 2 not in got and got[3] == [0] and sorted(got[4]) == [0, 15, 27]
    total = intervals.window_vote_weights(plan.where("recording_id = 4"), 20).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(47)


# ------------------------------------------------------------------------ spatial

def test_nearest_against_brute_force(spark):
    pts = np.concatenate([rng.normal(size=(150, 3)), rng.normal(size=(3, 3)) * 50])
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "ident": np.arange(len(pts)), "x": pts[:, 0], "y": pts[:, 1], "z": pts[:, 2]}))
    got = {(r["src"], r["rank"]): r["dst"] for r in spatial.nearest(df, df, ["g"], 4, exclude_self=True).collect()}
    d = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    np.fill_diagonal(d, np.inf)
    for i in range(len(pts)):
        assert [got[(i, r)] for r in range(1, 5)] == np.argsort(d[i], kind="stable")[:4].tolist()
    adj = {(r["src"], r["dst"]) for r in spatial.distance_adjacency(df, ["g"], "ident", 0.7).collect()}
    assert adj == {(i, j) for i in range(len(pts)) for j in range(len(pts)) if i == j or d[i, j] < 0.7}


def test_fewer_targets_than_k(spark):
    p = spark.createDataFrame([(1, i, float(i), 0.0, 0.0) for i in range(3)], "g int, ident int, x double, y double, z double")
    assert spatial.nearest(p, p, ["g"], 5, exclude_self=True).count() == 6


# --------------------------------------------------------------------- statistics

def test_linear_model_matches_lstsq(spark):
    n = 40
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 1 + 2 * a - 0.5 * b + rng.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"cell": 1, "a": a, "b": b, "y": y}))
    x = np.stack([np.ones(n), a, b], axis=1)
    beta, rss, _, _ = np.linalg.lstsq(x, y, rcond=None)
    c = np.array([0, 1, -1.0])
    t = c @ beta / np.sqrt(rss[0] / (n - 3) * (c @ np.linalg.inv(x.T @ x) @ c))
    row = statistics.linear_model(df, ["cell"], "y", [F.lit(1e0), F.col("a"), F.col("b")], {"d": c.tolist()}).first()
    assert (row["cope"], row["t"]) == (pytest.approx(c @ beta), pytest.approx(t))


def test_summed_similarity_equals_pairs(spark):
    covs = [np.cov(rng.normal(size=(4, 30))) for _ in range(6)]
    rows = [(r, i, j, float(c[i, j])) for r, c in enumerate(covs) for i in range(4) for j in range(i, 4)]
    df = spark.createDataFrame(rows, "recording_id int, i int, j int, cov double")
    u = np.triu_indices(4)
    m = np.corrcoef([np.abs(c[u]) for c in covs])
    got = {r["recording_id"]: r["similarity_sum"] for r in statistics.summed_similarity(df).collect()}
    for r in range(6):
        assert got[r] == pytest.approx(m[r].sum() - 1)
    assert statistics.template_subject(df).first()["recording_id"] == np.argsort(m.sum(axis=1))[3]


def test_flips_recover_planted_signs(spark):
    mix = rng.normal(size=(5, 5))
    x = mix @ rng.normal(size=(5, 400))
    cov = np.cov(x)
    s = np.array([1, -1, 1, 1, -1])
    flipped = cov * s[:, None] * s[None, :]

    def table(c, rec):
        return [(rec, f"c{i}", f"c{j}", float(c[i, j])) for i in range(5) for j in range(i, 5)]

    df = spark.createDataFrame(table(flipped, 7), "recording_id int, ci string, cj string, cov double")
    ref = spark.createDataFrame(table(cov, 0), "recording_id int, ci string, cj string, cov double")
    out = {r["ch_name"]: r for r in statistics.find_flips(df, ref, n_init=4, n_iter=200).collect()}
    got = np.array([out[f"c{i}"]["flip"] for i in range(5)])
    assert (got == s).all() or (got == -s).all()
    assert out["c0"]["metric_after"] == pytest.approx(1.0)


def test_parcel_is_the_first_component(spark):
    t = np.arange(200)
    src = np.sin(t / 9)
    x = np.stack([2 * src, src, 0.5 * src]) + 0.01 * rng.normal(size=(3, 200))
    vox = spark.createDataFrame(pd.DataFrame([(1, i, j, x[i, j]) for i in range(3) for j in t], columns=["recording_id", "voxel", "t", "value"]))
    par = spark.createDataFrame([(0, 9), (1, 9), (2, 9)], "voxel long, parcel int")
    out = statistics.parcel_timecourse(vox, par).toPandas().sort_values("t")["value"].to_numpy()
    w = np.array([2, 1, 0.5])
    assert np.corrcoef(out, src)[0, 1] > 0.999 and out.std() == pytest.approx((w / w.sum() * x.std(axis=1)).sum(), rel=1e-2)


def test_time_embed_needs_odd(spark):
    with pytest.raises(ValueError):
        statistics.time_embed(long(spark, np.zeros((1, 5))), 2)


# ------------------------------------------------------------- scoring and labels

def test_reference_fallback_order(spark):
    ref = spark.createDataFrame([
        ("device_category", "A", "rest", "m", 5, 0.0, 1.0, 2.0), ("device", "A", "ALL", "m", 30, 0.0, 2.0, 4.0),
        ("global", "ALL", "ALL", "m", 99, 0.0, 3.0, 6.0), ("device_category", "B", "rest", "m2", 3, 0.0, 1.0, 1.0)],
        "scope string, device_type string, category string, metric string, n int, q05 double, q50 double, q95 double")
    c = spark.createDataFrame([(1, "A", "rest", "m", 1.0), (2, "B", "rest", "m", 3.0), (3, "B", "rest", "m2", 1.0), (4, "C", "task", "x", 1.0)],
                              "recording_id int, device_type string, category string, metric string, value double")
    got = {r["recording_id"]: r["reference_scope"] for r in scoring.lookup_reference(c, ref).collect()}
    assert got == {1: "device", 2: "global", 3: "device_category", 4: None}
    thin = {r["recording_id"]: r["reference_scope"] for r in scoring.lookup_reference(c, ref, min_n=3).collect()}
    assert thin[1] == "device_category"


def test_component_scores_by_mode(spark):
    df = spark.createDataFrame([("lower_is_better", 1.0), ("higher_is_better", 1.0), ("near", 1.0), ("near", 3.5), ("near", 9.0), ("lower_is_better", None)],
                               "mode string, value double").selectExpr("*", "0e0 q05", "2e0 q50", "4e0 q95")
    assert [r[0] for r in df.select(scoring.component_score()).collect()] == [0.75, 0.25, 0.5, 0.25, 0.0, None]
    flat = df.withColumn("q95", F.lit(0e0))
    assert {r[0] for r in flat.select(scoring.component_score()).collect()} == {None}
    assert [r[0] for r in df.select(scoring.component_status()).collect()][-2:] == ["above_q95", "missing"]


def test_constant_topography_does_not_fail(spark):
    c = spark.createDataFrame([("d", 1, [1.0, 1.0, 1.0]), ("d", 2, [1.0, 2.0, 4.0])], "device_type string, component int, topo array<double>")
    t = spark.createDataFrame([("d", "ECG", 0, [1.0, 2.0, 4.0])], "device_type string, kind string, template int, topo array<double>")
    rows = {r["component"]: r for r in components.topo_similarity(c, t).collect()}
    assert rows[2]["pearson"] == pytest.approx(1) and rows[2]["euclidean"] == pytest.approx(1)


def test_template_library_modes(spark, tmp_path):
    lib = spark.createDataFrame([("d", "ECG", 0, [1.0])], "device_type string, kind string, template int, topo array<double>")
    path = str(tmp_path / "lib")
    components.write_template_library(lib, path, "new")
    components.write_template_library(lib, path, "append")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):
        components.write_template_library(lib, path, "new")
    components.write_template_library(lib, path, "overwrite")
    assert spark.read.parquet(path).count() == 1


def test_non_finite_probabilities_raise(spark):
    df = spark.createDataFrame([([0.1, float("nan"), 0.2, 0.3],)], "p array<double>")
    raises(df.select(ensembles.argmax_label(F.col("p"))), "non-finite")


def test_empty_agreement_is_full(spark):
    rows = spark.createDataFrame([("g", 1, "brain_or_other")], "g string, component int, label string")
    out = ensembles.labeling_agreement(ensembles.compare_labelings(rows, rows, ["g"]), ["g"]).first()
    assert (out["agreement"], out["artifact_jaccard"]) == (1.0, 1.0)


def test_single_peak_has_no_rate(spark):
    p = spark.createDataFrame([(1, 10), (2, 0), (2, 50), (2, 100), (3, 7), (3, 7)], "c int, sample long")
    got = {r["c"]: r["bpm"] for r in components.heart_rate(p, ["c"], 50.0).collect()}
    assert got == {1: 0.0, 2: 60.0, 3: 0.0}


def test_silent_spectrum(spark):
    psd = spark.createDataFrame([(1, float(f), 0.0) for f in range(6)], "c int, freq double, power double")
    assert components.low_high_band_ratio(psd, ["c"], 2, 4).first()["low_ratio"] == 0.0


# ------------------------------------------------------------------- error rules

def test_error_rules(spark):
    ev = spark.createDataFrame([(1, 10, 1), (2, 5, 3)], "recording_id int, sample long, event_id int")
    raises(events.exclude_event_ids(ev, [3]), "no events left")
    df = spark.createDataFrame([("meg_all,with_anatomy",)], "steps string")
    raises(rollups.parse_steps(df), "meg_all excludes")
    raises(events.threshold_preset(spark.createDataFrame([("wild",)], "mode string")), "unknown mode")
    raises(events.resolve_events(spark.createDataFrame([(1, "nope")], "recording_id int, source string"), {"file": ev}), "unknown event source")
    parts = spark.createDataFrame([("a", 1), ("a", 1)], "k string, split int")
    raises(catalogue.collapse_split_recordings(parts, ["k"]), "exactly one first split")
    raises(catalogue.assert_unique_ids(parts, ["k"]), "used twice")
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    one = spark.createDataFrame([(1, "x"), (2, "z")], "k int, b string")
    raises(lineage.strict_join(dup, one, ["k"]), "duplicate key")
    raises(lineage.strict_join(one, one.where("k = 1").withColumnRenamed("b", "c"), ["k"]), "unmatched")
    assert lineage.strict_join(one, one.where("k = 1").withColumnRenamed("b", "c"), ["k"], "lenient").count() == 1
    raises(lineage.assert_lineage_equal(spark.createDataFrame([("p", "q")], "a string, b string"), [("a", "b")]), "differ")
    sides = spark.createDataFrame([(1, "c", True)], "recording_id int, ch_name string, is_bad boolean")
    kept, _ = lineage.common_channels(sides.withColumn("is_bad", F.lit(False)), sides, ["recording_id"])
    assert kept.count() == 0
    two = spark.createDataFrame([(1, "a", {"x": "1"}), (1, "b", {"x": "2"})], "id int, profile string, settings map<string,string>")
    raises(catalogue.assert_single_profile(two, ["id"]), "several profiles")


def test_stim_rules(spark):
    recs = spark.createDataFrame([(1, 100)], "recording_id int, n_times long")
    ev = spark.createDataFrame([(1, 10, 2), (1, 13, 1)], "recording_id int, sample long, event_id int")
    assert readers.events_to_stim(ev, recs, 2).where("value > 0").count() == 4
    raises(readers.events_to_stim(ev, recs, 3), "zero sample")
    raises(readers.events_to_stim(ev.withColumn("sample", F.lit(99)), recs, 2), "outside")
    tr = spark.createDataFrame([(1, 10, 5), (1, 40, 0)], "recording_id int, sample long, value int")
    held = readers.triggers_to_stim(tr, recs, bucket=16).where("value = 5").agg(F.min("t"), F.max("t")).first()
    assert tuple(held) == (10, 39)


def test_settings_tree_override(spark):
    base = F.create_map(F.lit("a.b"), F.lit("1"), F.lit("c"), F.lit("2"), F.lit("d.e"), F.lit("3")).cast("map<string,string>")
    over = F.create_map(F.lit("a"), F.lit("x"), F.lit("c.f"), F.lit("4"), F.lit("d.g"), F.lit(None)).cast("map<string,string>")
    got = spark.range(1).select(catalogue._merge(base, over).alias("m")).first()["m"]
    assert got == {"d.e": "3", "a": "x", "c.f": "4", "d.g": None}


def test_a_mean_at_its_limit_is_not_above_it(spark):
    """Means of 0.04 and 0.06 are 5 whatever the order of the sum; one distance more is above."""
    from sensorloom.functions.expr import mean_above

    rows = spark.createDataFrame([("sum", 5.000000000000001), ("less", 4.999999999999993), ("equal", 5.0), ("above", 5.0001), ("none", None)], "name string, m double")
    got = {r["name"]: r["hit"] for r in rows.select("name", mean_above("m", 5.0).alias("hit")).collect()}
    assert got == {"sum": False, "less": False, "equal": False, "above": True, "none": None}
    subjects = rows.select(F.lit(1).alias("dataset"), F.col("name").alias("subject"), F.col("m").alias("coreg_mean"), F.lit(0).alias("bad_channels"), F.lit(0).alias("bad_segments"),
                           F.lit(1.0).alias("coreg_max"), F.lit(1).alias("marked_count"), *[F.lit(True).alias(c) for c in ("has_ecg", "has_eog", "has_coregistration")])
    status = {r["subject"]: r["status"] for r in rollups.viewer_alarms(subjects).collect()}
    assert status == {"sum": "Passed", "less": "Passed", "equal": "Passed", "above": "Failed", "none": "Passed"}
    counted = subjects.select("*", F.lit(80.0).alias("score"), F.lit(0.0).alias("reject_rate"), *[F.lit(True).alias(f"{k}_{x}") for k in ("step", "expected") for x in rollups.STEPS])
    assert rollups.threshold_counts(counted, ["dataset"]).first()["over_coreg_mean"] == 1


def test_tags_are_parsed_once_not_for_each_task(spark):
    """The tasks themselves only meet the tags by a broadcast: nothing is parsed for each of them."""
    import __spark_entry__ as entry

    plan = entry.queries()["match_task_subject"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "rlike" not in plan.lower() and "broadcast" in plan.lower()


def test_affected_fraction_derives_its_scores_once(spark):
    """The plan of the result starts from written bins and medians; spans of a long recording meet the bins of a step, with the rows of brute force."""
    n, width = 40, 50_000.0
    scores = spark.range(n * 2).select((F.col("id") % 2).alias("recording_id"), F.lit("c").alias("ch_name"), F.floor(F.col("id") / 2).alias("bin"),
                                       ((F.floor(F.col("id") / 2) + 0.5) * width).alias("time"), (F.col("id") % 7).cast("double").alias("peak_score"))
    rng = np.random.default_rng(5)
    spans = pd.DataFrame({"recording_id": rng.integers(0, 2, 12), "onset": rng.uniform(-width, n * width, 12), "duration": rng.choice([1.0, width, 3 * width], 12)})
    out = signal.affected_fraction(scores, spark.createDataFrame(spans), 3.0)
    assert "Range (" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["recording_id"], r["bin"]): r["is_bad"] for r in out.collect()}
    low, high, pad = 0.5 * width, (n - 0.5) * width, width / 2
    for rec in range(2):
        own = [(max(o, low), min(o + d, high)) for k, o, d in spans.itertuples(index=False) if k == rec]
        for b in range(n):
            at = (b + 0.5) * width
            assert got[rec, b] == any(e > s and s - pad <= at <= e + pad for s, e in own)
    values = spark.range(100).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    from sensorloom.plans.quantiles import median_and_mad

    plan = median_and_mad(values, ["k"], "v")
    assert tuple(plan.first()) == ("a", 49.5, 25.0)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Range (") <= 4


def test_a_mean_on_a_rounding_tie_does_not_follow_the_order_of_its_rows(spark, tmp_path):
    """The mean distance of supplier 203 is 5.0703125; a sum in other orders ends below it."""
    import os

    import pyarrow.parquet as pq

    from sensorloom.queries import load
    from sensorloom.sources.bindings import Tables

    rows = pq.read_table("/root/testdata/sf0.1/lineitem.parquet", filters=[("l_suppkey", "=", 203)])
    values = rows.column("l_discount").to_numpy()
    orders, seed = [np.arange(len(values))], 0
    while len(orders) < 2:
        order, seed = np.random.default_rng(seed).permutation(len(values)), seed + 1
        if np.cumsum(values[order])[-1] / len(values) * 100 < 5.0703125:
            orders.append(order)
    for name, order in zip("ab", orders):
        (tmp_path / name).mkdir()
        for other in os.listdir("/root/testdata/sf0.1"):
            os.symlink(f"/root/testdata/sf0.1/{other}", tmp_path / name / other) if other != "lineitem.parquet" else pq.write_table(rows.take(order), tmp_path / name / other)
        t = Tables(spark, str(tmp_path / name))
        assert load()["subjects_table"].run(t).where("subject = 203").first()["coreg_mean_mm"] == 5.070313
        assert load()["alarms"].run(t).where("subject = 203 and category = 'Coregistration' and threshold = 5").first()["value"] == 5.070313
