"""Blocked and two-level plans give the same rows as the plain computation."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.plans.blocks import neighbours, rolling
from sensorloom.plans.gram import correlation, covariance, pair_sums
from sensorloom.plans.intervals import islands, merge_overlaps, overlap_filter, range_join
from sensorloom.plans.quantiles import exact_quantiles, median_and_mad
from sensorloom.plans.scans import dense_index, prefix_scan

rng = np.random.default_rng(5)


def frame(spark, n=100, keys=3):
    pdf = pd.DataFrame({"k": np.repeat(np.arange(keys), n), "t": np.tile(np.arange(n), keys), "value": rng.normal(size=n * keys).round(3)})
    return spark.createDataFrame(pdf.sample(frac=1, random_state=1)), pdf


def test_neighbours_cross_block_edges(spark):
    df, pdf = frame(spark)
    got = neighbours(df, ["k"], {"a": ("value", -2), "b": ("value", 3)}, size=7).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    g = pdf.groupby("k")["value"]
    np.testing.assert_array_equal(got["a"], g.shift(2))
    np.testing.assert_array_equal(got["b"], g.shift(-3))


def test_halo_must_fit(spark):
    df, _ = frame(spark)
    with pytest.raises(ValueError):
        neighbours(df, ["k"], {"a": ("value", -9)}, size=4)


def test_rolling(spark):
    df, pdf = frame(spark)
    got = rolling(df, ["k"], "m", F.sum("value"), 3, 2, size=8).toPandas().sort_values(["k", "t"])["m"].to_numpy()
    want = np.concatenate([[x[max(0, i - 3): i + 3].sum() for i in range(len(x))] for _, x in ((k, g.to_numpy()) for k, g in pdf.groupby("k")["value"])])
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_prefix_scan(spark):
    df, pdf = frame(spark)
    df = df.withColumn("sparse", F.when(F.col("value") > 1, F.col("t")))
    out = {"s": ("sum", "value"), "m": ("max", "value"), "l": ("last", "sparse")}
    got = prefix_scan(df, ["k"], F.floor(F.col("t") / 9), ["t"], out).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    g = pdf.groupby("k")["value"]
    np.testing.assert_allclose(got["s"], g.cumsum(), atol=1e-9)
    np.testing.assert_array_equal(got["m"], g.cummax())
    want = pdf.assign(s=np.where(pdf["value"] > 1, pdf["t"], np.nan)).groupby("k")["s"].ffill()
    np.testing.assert_array_equal(got["l"].astype(float), want)
    before = prefix_scan(df, ["k"], F.floor(F.col("t") / 9), ["t"], {"m": ("max", "value")}, inclusive=False).toPandas().sort_values(["k", "t"])
    np.testing.assert_array_equal(before["m"].reset_index(drop=True), g.cummax().groupby(pdf["k"]).shift(1))


def test_dense_index(spark):
    df, pdf = frame(spark)
    got = dense_index(df, ["k"], F.floor(F.col("t") / 10), ["t"], "i").toPandas()
    assert (got["i"] == got["t"]).all()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(-1e6, 1e6, allow_nan=False), st.sampled_from([0.0, 1.0, -1.0])), min_size=1, max_size=40))
def test_exact_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": values}))
    probs = {"a": 0.05, "b": 0.5, "c": 0.95, "d": 0.0, "e": 1.0}
    row = exact_quantiles(df, ["k"], "v", probs).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_quantile_methods_and_missing(spark):
    x = np.array([3.0, 1.0, 2.0, 10.0, np.nan, 7.0])
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "v": x}))
    good = np.sort(x[np.isfinite(x)])
    assert exact_quantiles(df, ["k"], "v", {"q": 0.25}, "midpoint").first()["q"] == pytest.approx(np.percentile(good, 25, method="midpoint"))
    n, q = len(good), 0.75
    pos = (n - 1) * min(1, max(0, (q - 0.5) * n / (n - 1) + 0.5))
    want = good[int(pos)] + (good[min(int(pos) + 1, n - 1)] - good[int(pos)]) * (pos - int(pos))
    assert exact_quantiles(df, ["k"], "v", {"q": q}, "matlab").first()["q"] == pytest.approx(want)
    m = median_and_mad(df, ["k"], "v").first()
    assert (m["center"], m["mad"]) == (np.median(good), np.median(np.abs(good - np.median(good))))


def brute_islands(flags):
    out, start = [], None
    for i, f in enumerate([*flags, 0]):
        if f and start is None:
            start = i
        if not f and start is not None:
            out.append((start, i))
            start = None
    return out


@pytest.mark.parametrize("size", [1, 4, 5, 64])
def test_islands_across_blocks(spark, size):
    flags = (rng.random(200) < 0.7).astype(int)
    flags[20:60] = 1
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "t": np.flatnonzero(flags), "v": np.flatnonzero(flags) * 1.0}))
    got = sorted((r["start"], r["stop"], r["m"]) for r in islands(df, ["k"], extra={"m": "v"}, size=size).collect())
    assert got == [(a, b, float(b - 1)) for a, b in brute_islands(flags)]


@pytest.mark.parametrize("gap", [0, 3])
def test_merge_overlaps(spark, gap):
    starts = rng.integers(0, 500, 60)
    spans = [(int(s), int(s + d)) for s, d in zip(starts, rng.integers(1, 12, 60))]
    spans += [(100, 300), (101, 102)]
    df = spark.createDataFrame([(1, a, b, float(b)) for a, b in spans], "k int, start long, stop long, w double")
    want = []
    for a, b in sorted(spans):
        if want and a <= want[-1][1] + gap:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    got = sorted([r["start"], r["stop"]] for r in merge_overlaps(df, ["k"], 16, gap=gap, extra={"w": "w"}).collect())
    assert got == want


def test_range_joins(spark):
    pts = spark.createDataFrame([(1, float(i)) for i in range(50)], "k int, t double")
    spans = spark.createDataFrame([(1, 3.0, 9.5), (1, 8.0, 8.0), (2, 0.0, 50.0), (1, 30.0, 47.0)], "k int, s double, e double")
    got = sorted(r["t"] for r in range_join(pts, spans, ["k"], F.col("t"), F.col("s"), F.col("e"), 4.0).collect())
    assert got == sorted([t for t in range(50) if 3 <= t < 9.5] + [t for t in range(50) if 30 <= t < 47])
    anti = range_join(pts, spans, ["k"], F.col("t"), F.col("s"), F.col("e"), 4.0, "left_anti", closed=True)
    assert sorted(r["t"] for r in anti.collect()) == [t for t in range(50) if not (3 <= t <= 9.5 or 30 <= t <= 47)]


def test_overlap_filter_keeps_duplicates_out(spark):
    items = spark.createDataFrame([(1, i, i * 10, i * 10 + 5) for i in range(10)], "k int, id int, a int, b int")
    spans = spark.createDataFrame([(1, 12, 40), (1, 14, 16)], "k int, s int, e int")
    args = (items, spans, ["k"], ["k", "id"], (F.col("a"), F.col("b")), (F.col("s"), F.col("e")), 3.0)
    assert sorted(r["id"] for r in overlap_filter(*args, "left_semi").collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in overlap_filter(*args, "left_anti").collect()) == [0, 4, 5, 6, 7, 8, 9]


def test_gram_in_blocks(spark):
    x = rng.normal(size=(4, 90))
    pdf = pd.DataFrame([(1, f"c{i}", j, x[i, j]) for i in range(4) for j in range(90)], columns=["r", "ch_name", "t", "value"])
    sums = pair_sums(spark.createDataFrame(pdf), "r", size=13)
    for r in covariance(sums).collect():
        assert r["cov"] == pytest.approx(np.cov(x[int(r["ci"][1])], x[int(r["cj"][1])])[0, 1])
    for r in correlation(sums).collect():
        assert r["corr"] == pytest.approx(np.corrcoef(x[int(r["ci"][1])], x[int(r["cj"][1])])[0, 1])


@pytest.mark.parametrize("line", [8, 1 << 22])
def test_fourier_of_any_length_equals_numpy(spark, line):
    from sensorloom.plans.fourier import fourier

    gen = np.random.default_rng(1)
    signals = {n: gen.normal(size=n) for n in (1, 7, 35, 37, 48)}
    df = spark.createDataFrame([(n, t, n, float(v)) for n, x in signals.items() for t, v in enumerate(x)], "id long, t long, n long, v double")
    got = {}
    for r in fourier(df, ["id"], "v", line).collect():
        got.setdefault(r["id"], {})[r["k"]] = complex(r["re"], r["im"])
    for n, x in signals.items():
        assert np.allclose([got[n][k] for k in range(n)], np.fft.fft(x)) and len(got[n]) == n


def test_spectral_shape_uses_whole_channels(spark):
    from sensorloom.operators import signal

    gen = np.random.default_rng(2)
    x = gen.normal(size=30_000) + 40 * np.sin(np.arange(30_000) * 0.9)
    df = spark.createDataFrame(pd.DataFrame({"recording_id": 1, "ch_type": "mag", "ch_name": "a", "t": np.arange(30_000), "value": x}))
    y = np.abs(np.fft.fft(x / 30_000))[:15_000]
    y[0] = 0
    d = y - y.mean()
    want = (np.mean(d**3) / np.mean(d**2) ** 1.5, np.mean(d**4) / np.mean(d**2) ** 2)
    for line in (1 << 22, 1000):
        r = signal.spectral_shape(df, line).first()
        assert np.allclose((r["skewness_amplitude"], r["kurtosis_amplitude"]), want)


def test_null_keys_are_groups_like_others(spark):
    from sensorloom.plans.quantiles import exact_quantiles, median_and_mad
    from sensorloom.plans.scans import dense_index

    rows = [(None, i, float(i)) for i in range(6)] + [("a", i, 2.0 * i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    assert {(r["k"], r["m"]) for r in exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()} == {(None, 2.5), ("a", 4.0)}
    assert {(r["k"], r["center"], r["mad"]) for r in median_and_mad(df, ["k"], "v").collect()} == {(None, 2.5, 1.5), ("a", 4.0, 2.0)}
    numbered = dense_index(df, ["k"], F.floor(F.col("i") / 2).cast("bigint"), ["i"]).collect()
    assert all(r["t"] == r["i"] for r in numbered) and numbered[0].asDict().keys() == {"k", "i", "v", "t"}


def test_quantiles_of_values_with_an_offset(spark):
    from sensorloom.plans.quantiles import exact_quantiles

    v = 1e6 + np.random.default_rng(3).normal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": [*v, np.inf, -np.inf]}))
    got = exact_quantiles(df, ["k"], "v", {"lo": 0.0, "a": 0.1, "m": 0.5, "hi": 1.0}).first()
    assert np.allclose(got[1:], [-np.inf, *np.quantile([*v, np.inf, -np.inf], [0.1, 0.5]), np.inf], atol=1e-9)


def test_no_part_of_the_selection_is_crowded(spark):
    """One low value far below the others, which lie close together: the second digit still tells them apart."""
    from sensorloom.plans.quantiles import FIRST, SECOND, exact_quantiles, ordered_bits

    v = np.append(0.0, 1e6 + np.random.default_rng(4).normal(size=20_000))
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": v}))
    parts = df.groupBy(F.shiftright(ordered_bits(F.col("v")), SECOND).alias("p")).count()
    assert parts.agg(F.max("count")).first()[0] < 50
    assert df.groupBy(F.shiftright(ordered_bits(F.col("v")), FIRST).alias("b")).count().count() < 10
    got = exact_quantiles(df, ["k"], "v", {"a": 0.01, "m": 0.5, "z": 0.999}).first()
    assert np.allclose(got[1:], np.quantile(v, [0.01, 0.5, 0.999]), rtol=1e-15)


def test_ordered_bits_are_those_of_the_double(spark):
    from sensorloom.plans.quantiles import ordered_bits

    edge = np.array([2.0**e for e in range(-1074, 1024, 7)])
    v = np.concatenate([edge, np.nextafter(edge, np.inf), np.nextafter(edge, 0), np.random.default_rng(1).normal(size=500) * 1e3, [0.0, np.inf, 1.7976931348623157e308, 2.2250738585072014e-308]])
    v = np.concatenate([v, -v])
    bits = np.abs(v).view(np.int64)
    want = np.where(v < 0, -bits, bits)
    got = spark.createDataFrame(pd.DataFrame({"v": v})).select("v", ordered_bits(F.col("v")).alias("b")).toPandas()
    assert (got["v"].to_numpy() == v).all() and (got["b"].to_numpy() == want).all()


def test_broadcasts_are_decided_by_measured_sizes(spark, tmp_path):
    """Files of repetitive rows are small, their exploded rows are not: no broadcast is planned before sizes are measured."""
    from sensorloom.operators import scoring
    from sensorloom.session import configure

    configure(spark)
    rows = spark.range(50_000).select(F.lit("dev").alias("device_type"), F.lit("rest").alias("category"), F.col("id").alias("recording_id"),
                                      F.lit("m").alias("metric"), (F.col("id") % 100).cast("double").alias("value"))
    rows.write.parquet(str(tmp_path / "m"))
    metrics = spark.read.parquet(str(tmp_path / "m"))
    out = scoring.lookup_reference(metrics, scoring.build_reference_intervals(metrics))
    assert "BroadcastExchange" not in out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert int(spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold").rstrip("b")) == 10 << 20
    assert out.where("reference_scope = 'device_category'").count() == 50_000
