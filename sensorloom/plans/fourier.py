"""Discrete Fourier transforms of any length without a whole signal in one task.

A length n = n1 * n2 is done by rows and columns: transforms of length n1 over every n2-th sample, a twist, then transforms of
length n2. A length that does not split so is turned into a convolution with a chirp, whose padded length is a power of two.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels

LINE = 1 << 22
CHUNK = 1 << 16


def _split(n: Column, line: int) -> Column:
    """Smallest n2 that divides n with n / n2 at most `line`; NULL if there is none near."""
    least = F.ceil(n / F.lit(line)).cast("bigint")
    return F.get(F.filter(F.sequence(least, F.least(n, least + 20_000, F.greatest(F.lit(line).cast("bigint"), least))), lambda d: n % d == 0), F.lit(0))


def _pass(rows: DataFrame, keys: list[str], line: str, place: str, size: str, stage: int) -> DataFrame:
    """Transform all lines (constant `line`) over `place` (0 to `size` - 1); several lines make a task call."""
    types = dict(rows.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", n bigint, n1 bigint, n2 bigint, p bigint, q bigint, re double, im double"
    chunk = F.floor(F.col(line) * F.col(size) / F.lit(CHUNK)).cast("bigint")
    return rows.select(*keys, "n", "n1", "n2", F.col(line).alias("p"), F.col(place).alias("q"), "re", "im", chunk.alias("_chunk")).groupBy(
        *keys, "n", "n1", "n2", "_chunk").applyInPandas(kernels.fourier_lines(keys, stage), schema)


def _row_column(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Transform of rows (keys, n, n1, n2, t, re, im); samples that are not there count as zero. Gives (keys, n, k, re, im)."""
    first = _pass(rows.withColumns({"_a": F.floor(F.col("t") / F.col("n2")).cast("bigint"), "_b": F.col("t") % F.col("n2")}), keys, "_b", "_a", "n1", 1)
    second = _pass(first.withColumnsRenamed({"p": "_b", "q": "_k1"}), keys, "_k1", "_b", "n2", 2)
    return second.select(*keys, "n", (F.col("p") + F.col("n1") * F.col("q")).alias("k"), "re", "im")


def _times(a: tuple, b: tuple) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def _chirp(t: Column, n: Column) -> tuple[Column, Column]:
    angle = F.lit(-math.pi) * ((t * t) % (2 * n)) / n
    return F.cos(angle), F.sin(angle)


def fourier(signals: DataFrame, keys: list[str], value: str, line: int = LINE) -> DataFrame:
    """(keys, n, k, re, im) of signals (keys, t, n, value) with a dense clock t from 0 to n - 1; no task holds more than about `line` samples."""
    x = signals.select(*keys, F.col("n").cast("bigint").alias("n"), F.col("t").cast("bigint").alias("t"), F.col(value).cast("double").alias("re"), F.lit(0e0).alias("im"))
    # lengths are few: each is factored once, not in every sample
    sized = x.join(x.select("n").distinct().withColumn("n2", _split(F.col("n"), line)), "n")
    split = sized.where("n2 is not null").withColumn("n1", (F.col("n") / F.col("n2")).cast("bigint"))

    odd = sized.where("n2 is null").drop("n2").withColumn("m", F.pow(F.lit(2e0), F.ceil(F.log2(2e0 * F.col("n") - 1))).cast("bigint"))
    twist = _chirp(F.col("t"), F.col("n"))
    sides = {"n2": F.greatest(F.lit(1), F.pow(F.lit(2e0), F.ceil(F.log2(F.col("n") / F.lit(float(line)))))).cast("bigint")}

    def padded(rows: DataFrame) -> DataFrame:
        return rows.withColumnsRenamed({"n": "_n", "m": "n"}).withColumns(sides).withColumn("n1", (F.col("n") / F.col("n2")).cast("bigint"))

    a = padded(odd.withColumns(dict(zip(("re", "im"), (F.col("re") * twist[0], F.col("re") * twist[1])))))
    lengths = odd.select("n", "m").distinct().withColumn("s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.lit(CHUNK)))))
    b = lengths.select("n", "m", F.explode(F.sequence(F.col("s") * CHUNK, F.least((F.col("s") + 1) * CHUNK, F.col("n")) - 1)).alias("t"))
    b = b.withColumns({"re": twist[0], "im": -twist[1]})
    mirrored = b.unionByName(b.where("t > 0").withColumn("t", F.col("m") - F.col("t")))
    fa = _row_column(a, [*keys, "_n"])
    fb = _row_column(padded(mirrored), ["_n"]).select(F.col("_n").alias("_bn"), F.col("k").alias("_bk"), F.col("re").alias("_bre"), F.col("im").alias("_bim"))
    product = fa.join(fb, (F.col("_n") == F.col("_bn")) & (F.col("k") == F.col("_bk")))
    re, im = _times((F.col("re"), F.col("im")), (F.col("_bre"), F.col("_bim")))
    conjugate = product.select(*keys, "_n", "n", F.col("k").alias("t"), re.alias("re"), (-im).alias("im")).withColumns(sides).withColumn(
        "n1", (F.col("n") / F.col("n2")).cast("bigint"))
    back = _row_column(conjugate, [*keys, "_n"]).where(F.col("k") < F.col("_n"))
    re, im = _times((F.col("re") / F.col("n"), -F.col("im") / F.col("n")), _chirp(F.col("k"), F.col("_n")))
    whole = back.select(*keys, F.col("_n").alias("n"), "k", re.alias("re"), im.alias("im"))
    return _row_column(split, keys).unionByName(whole)
