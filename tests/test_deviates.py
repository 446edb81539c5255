"""Extreme-deviate tests over both tails, and channels predicted from others."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import kernels
from sensorloom.operators import detectors, deviates

rng = np.random.default_rng(12)


def groups():
    made = {}
    for r in range(3):
        made[f"normal{r}"] = rng.normal(size=rng.integers(3, 300))
        x = rng.normal(size=250)
        x[: rng.integers(1, 20)] += rng.normal() * 8
        made[f"shifted{r}"] = x
        made[f"wide{r}"] = rng.standard_cauchy(size=rng.integers(20, 400))
        made[f"few values{r}"] = rng.integers(0, 4, size=rng.integers(3, 300)).astype(float)
        made[f"small{r}"] = rng.normal(size=r + 1)
    x = np.full(200, 3.0)
    x[:9], x[20:24] = -1.0, 50.0
    made["one value"] = x
    x = rng.exponential(size=300) ** 2
    x[5], x[7] = np.nan, np.inf
    made["skewed"] = x
    made["far below"] = np.concatenate([rng.normal(size=180), -1000 + rng.normal(size=12), [40, 41]])  # the mean lies below most values
    return made


@pytest.mark.parametrize(("side", "p_out"), [(0, 0.1), (0, 0.5), (1, 0.3), (-1, 0.02)])
def test_tails_equal_the_test_of_whole_groups(spark, side, p_out):
    made = groups()
    rows = [(k, i, float(v)) for k, x in made.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["k", "i", "v"])).union(spark.createDataFrame([(None, i, float(v)) for i, v in enumerate(made["skewed"])], "k string, i long, v double"))
    got = deviates.gesd(df, ["k"], "i", "v", 0.05, p_out, side).toPandas()
    assert len(got) == len(rows) + 300
    for key, x in [*made.items(), (None, made["skewed"])]:
        own = got[got["k"].isna() if key is None else got["k"] == key].sort_values("i")
        assert (own["is_outlier"].to_numpy() == kernels.esd_outliers(x, 0.05, p_out, side)).all(), key


def test_a_task_gets_the_tails_only(spark, monkeypatch):
    """Of 100,000 values of one key, some hundred go through the task that removes them one by one."""
    x = rng.normal(size=100_000)
    x[:40] += 9
    seen = spark.sparkContext.accumulator(0)
    plain = kernels.esd_tails

    def counted(level, side):
        run = plain(level, side)

        def batches(items):
            def watch():
                for b in items:
                    seen.add(b.num_rows)
                    yield b
            return run(watch())
        return batches

    monkeypatch.setattr(kernels, "esd_tails", counted)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "i": np.arange(len(x)), "v": x}))
    got = deviates.gesd(df, ["k"], "i", "v").where("is_outlier").toPandas()["i"]
    assert set(range(40)) <= set(got) == set(np.flatnonzero(kernels.esd_outliers(x, 0.05, 0.1, 0)))
    assert 40 < seen.value < 3000


def test_expanded_and_exact_quantiles_meet():
    p, df = np.full(3, 1e-6), np.array([9_999.0, 10_000.0, 10_001.0])
    t = kernels.student_quantile(p, df)
    assert np.allclose(t, kernels._newton_quantile(p, df), rtol=1e-11) and t[0] > t[1] > t[2]


def long(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["recording_id", "array", "ch_name", "t", "value"]))


def sphere(n):
    i = np.arange(n) + 0.5
    z, a = 1 - i / n, np.pi * (1 + 5**0.5) * i
    return np.stack([np.sqrt(1 - z * z) * np.cos(a), np.sqrt(1 - z * z) * np.sin(a), z], axis=1)


def test_spline_weights_give_back_a_smooth_field(spark):
    xyz = sphere(40)
    places = spark.createDataFrame([("cap", f"c{i:02}", *map(float, 2 * p)) for i, p in enumerate(xyz)] + [("cap", "nowhere", 0.0, 0.0, 0.0), ("one", "alone", 0.0, 1.0, 0.0)],
                                   "array string, ch_name string, x double, y double, z double")
    subsets = detectors.random_subsets(places, 4, 25)
    assert subsets.where("array = 'cap'").groupBy("subset").count().toPandas()["count"].tolist() == [25] * 4
    assert sorted(map(tuple, subsets.collect())) == sorted(map(tuple, detectors.random_subsets(places.repartition(3), 4, 25).collect()))
    w = detectors.interpolation_weights(places, subsets).toPandas()
    assert set(w[w["array"] == "one"]["weight"].round(9)) == {1.0} and "nowhere" not in set(w["ch_name"])
    w = w[w["array"] == "cap"]
    assert np.allclose(w.groupby(["subset", "ch_name"])["weight"].sum(), 1)
    value = dict(zip([f"c{i:02}" for i in range(40)], 1 + xyz[:, 0] - 0.5 * xyz[:, 2]))
    guess = w.assign(v=w["weight"] * w["predictor"].map(value)).groupby(["subset", "ch_name"])["v"].sum()
    assert np.abs(guess - guess.index.get_level_values(1).map(value)).max() < 0.1


def test_spline_weights_in_pieces(spark):
    """No task holds more channels than a piece, and the weights do not depend on it; a missing array is one like others."""
    places = spark.createDataFrame([(a, f"c{i:03}", *map(float, p)) for a in ("cap", None) for i, p in enumerate(sphere(200))] + [("cap", "gone", None, 0.0, 1.0)],
                                   "array string, ch_name string, x double, y double, z double")
    subsets = detectors.random_subsets(places.where("ch_name <> 'gone'"), 2, 9).unionByName(
        spark.createDataFrame([("cap", 0, "gone")], "array string, subset int, predictor string"))
    seen, real = spark.sparkContext.accumulator(0), detectors.kernels.spline_weights

    def counting(array, ridge):
        run = real(array, ridge)

        def counted(rows, chosen):
            seen.add(1)
            assert len(rows) < 100
            return run(rows, chosen)

        return counted

    detectors.kernels.spline_weights = counting
    try:
        cut = detectors.interpolation_weights(places, subsets, piece=20).toPandas()
    finally:
        detectors.kernels.spline_weights = real
    assert seen.value >= 4
    keys = ["array", "subset", "ch_name", "predictor"]
    whole = detectors.interpolation_weights(places, subsets).toPandas()
    a, b = (df.fillna({"array": ""}).sort_values(keys).reset_index(drop=True) for df in (cut, whole))
    assert len(a) == 2 * 2 * 200 * 9 and (a[keys] == b[keys]).all(axis=None) and np.allclose(a["weight"], b["weight"])


def test_late_failure_beside_a_short_channel(spark):
    """A channel that fails in the second half is found though another channel ends early, and the windows of all arrays keep their own weights."""
    n, xyz = 3000, sphere(24)
    base = rng.normal(size=(3, n)).cumsum(axis=1)
    rows, places = [], []
    for array, turn in (("a", 1), ("b", -1)):
        for i, p in enumerate(xyz):
            x = (p * [1, turn, 1]) @ base + 0.3 * rng.normal(size=n)
            if (array, i) == ("a", 3):
                x[900:] = 20 * rng.normal(size=n - 900)
            length = 600 if i == 7 else n
            rows += [(array, array, f"c{i}", t, float(x[t])) for t in range(length)]
            places.append((array, f"c{i}", *map(float, p)))
    positions = spark.createDataFrame(places, "array string, ch_name string, x double, y double, z double").withColumn("y", F.when(F.col("array") == "b", -F.col("y")).otherwise(F.col("y")))
    weights = detectors.interpolation_weights(positions, detectors.random_subsets(positions, 21, 6))
    samples = long(spark, rows)
    found = detectors.bad_by_ransac(samples, weights, 150, array="array", size=900)
    assert {(r.recording_id, r.ch_name) for r in found.where("is_bad").collect()} == {("a", "c3")}
    assert found.count() == 48 and found.where("ch_name = 'c7'").count() == 2
    whole = detectors.bad_by_ransac(samples, weights, 150, array="array", size=100_000)
    key = ["recording_id", "ch_name"]
    assert np.allclose(found.orderBy(key).toPandas()["mean_corr"], whole.orderBy(key).toPandas()["mean_corr"])


def test_missing_predictors_are_made_up_for_and_lone_channels_are_not_judged(spark):
    x = rng.normal(size=200)
    rows = [(1, 0, "a", t, float(x[t])) for t in range(200)] + [(1, 0, "b", t, float(x[t])) for t in range(200)] + [(1, 0, "c", t, float(-x[t])) for t in range(100)]
    rows += [(2, 0, "a", t, float(x[t])) for t in range(200)]
    weights = spark.createDataFrame([(0, "a", "b", 0.6), (0, "a", "c", 0.4)], "subset int, ch_name string, predictor string, weight double")
    found = {(r.recording_id, r.ch_name): r.mean_corr for r in detectors.bad_by_ransac(long(spark, rows).drop("array"), weights, 50).collect()}
    assert found == {(1, "a"): pytest.approx(1.0)}
