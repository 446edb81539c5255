"""Numpy kernels for the transforms SQL cannot express (spectra, filters, iterations).

Each kernel sees one bounded group: a sample block, a window, or one value per
channel/segment. The functions return closures for `applyInPandas`; they are pickled by
value, so executors need no installed copy of the package.
"""

import hashlib
import math
from collections import deque
from fractions import Fraction
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa


def matrix(pdf, channel="c", t="t", value="v"):
    """Channels x time matrix with NaN for missing samples, and the channel names."""
    names, rows = np.unique(pdf[channel].to_numpy(), return_inverse=True)
    times, cols = np.unique(pdf[t].to_numpy(), return_inverse=True)
    out = np.full((len(names), len(times)), np.nan)
    out[rows, cols] = pdf[value].to_numpy(dtype=float)
    return names, times, out


def gram_block(key):
    def run(pdf):
        names, _, x = matrix(pdf)
        ok = np.isfinite(x)
        z = np.where(ok, x, 0.0)
        m = ok.astype(float)
        n, sx, sxx, sxy = m @ m.T, z @ m.T, (z * z) @ m.T, z @ z.T
        i, j = np.triu_indices(len(names))
        return pd.DataFrame({
            key: pdf[key].iloc[0], "ci": names[i], "cj": names[j], "n": n[i, j], "sx": sx[i, j], "sy": sx[j, i],
            "sxx": sxx[i, j], "syy": sxx[j, i], "sxy": sxy[i, j],
        })[lambda d: d["n"] > 0]

    return run


# ---------------------------------------------------------------- statistics

def _log_beta(a, b):
    lg = np.vectorize(math.lgamma, otypes=[float])
    return lg(a) + lg(b) - lg(a + b)


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-14):
            break
    return h


def student_upper(t, df):
    """P(T > t) for t >= 0."""
    x = df / (df + t * t)
    a, b = df / 2.0, np.full_like(df, 0.5)
    front = np.exp(a * np.log(x) + b * np.log1p(-x) - _log_beta(a, b))
    swap = x > (a + 1.0) / (a + b + 2.0)
    direct = front * _beta_fraction(a, b, np.where(swap, 0.5, x)) / a
    other = 1.0 - front * _beta_fraction(b, a, np.where(swap, 1.0 - x, 0.5)) / b
    return 0.5 * np.where(t == 0, 1.0, np.where(swap, other, direct))


def _expanded_quantile(p, df):
    """Expansion of the quantile about the normal one in 1 / df."""
    x = -np.array([NormalDist().inv_cdf(v) for v in p])
    terms = ((x**3 + x) / 4, (5 * x**5 + 16 * x**3 + 3 * x) / 96, (3 * x**7 + 19 * x**5 + 17 * x**3 - 15 * x) / 384,
             (79 * x**9 + 776 * x**7 + 1482 * x**5 - 1920 * x**3 - 945 * x) / 92160)
    return x + sum(g / df ** (i + 1) for i, g in enumerate(terms))


def student_quantile(upper, df):
    """t with P(T > t) = upper (< 0.5): Newton steps on log tail against log t, where the tail is nearly linear; beyond 10,000 degrees of freedom the
    expansion alone is as precise."""
    p, df = np.broadcast_arrays(np.atleast_1d(np.asarray(upper, float)), np.atleast_1d(np.asarray(df, float)))
    out = _expanded_quantile(p, df)
    few = df <= 10_000
    if few.any():
        out[few] = _newton_quantile(p[few], df[few], np.where(df[few] > 20, out[few], 2.0))
    return out


def _newton_quantile(p, df, start=2.0):
    log_c = -_log_beta(df / 2.0, np.full_like(df, 0.5)) - 0.5 * np.log(df)
    u = np.full(len(df), np.log(np.maximum(start, 1e-3)))
    for _ in range(40):
        t = np.exp(u)
        tail = np.maximum(student_upper(t, df), 1e-300)
        slope = -np.exp(log_c - (df + 1) / 2.0 * np.log1p(t * t / df)) * t / tail
        step = np.clip((np.log(tail) - np.log(p)) / np.minimum(slope, -1e-12), -2.0, 2.0)
        u = u - step
        if np.all(np.abs(step) < 1e-13):
            break
    return np.exp(u)


def esd_outliers(values, alpha, p_out, side):
    """Marks from the iterative extreme-studentized-deviate test.

    The removed set is always a prefix plus a suffix of the sorted values, so two pointers
    and running sums replace the repeated passes over the data: O(n log n).
    Every removal whose statistic exceeds its own critical value is marked.
    """
    x = np.asarray(values, float)
    finite = np.flatnonzero(np.isfinite(x))
    marks = np.zeros(len(x), bool)
    n = len(finite)
    count = min(int(math.ceil(len(x) * p_out)), n - 2)
    if count < 1:
        return marks
    level = alpha / 2 if side == 0 else alpha
    order = finite[np.argsort(x[finite], kind="stable")]
    z = x[order] - x[order].mean()
    lo, hi, total, square = 0, n - 1, z.sum(), float((z * z).sum())
    stat, removed = np.zeros(count), np.zeros(count, int)
    for j in range(count):
        left = hi - lo + 1
        mean = total / left
        spread = math.sqrt(max(square / left - mean * mean, 0.0))
        low = side == -1 or (side == 0 and mean - z[lo] > z[hi] - mean)
        at = lo if low else hi
        lo, hi = (lo + 1, hi) if low else (lo, hi - 1)
        stat[j] = abs(z[at] - mean) / spread if spread > 0 else 0.0
        removed[j] = order[at]
        total -= z[at]
        square -= z[at] * z[at]
    i = np.arange(1, count + 1)
    t = student_quantile(level / (n - i + 1.0), n - i - 1.0)
    critical = (n - i) * t / np.sqrt((n - i - 1 + t * t) * (n - i + 1.0))
    marks[removed[stat > critical]] = True
    return marks


class CriticalValues:
    """Critical deviations by the number of values left (3 or more), made in blocks."""

    def __init__(self, level, block=512):
        self.level, self.block, self.known = level, block, {}

    def __getitem__(self, left):
        at = left // self.block
        if at not in self.known:
            m = np.maximum(np.arange(at * self.block, (at + 1) * self.block), 3).astype(float)
            t = student_quantile(self.level / m, m - 2)
            self.known[at] = ((m - 1) * t / np.sqrt((m - 2 + t * t) * m)).tolist()
        return self.known[at][left % self.block]


def esd_least(level):
    """Adds to each group the critical value of its last removal, the least of all."""

    def run(batches):
        critical = CriticalValues(level, 64)
        for b in batches:
            least = [critical[n - k + 1] for n, k in zip(b.column("n").to_pylist(), b.column("k").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.float64())], names=[*b.schema.names, "least"])

    return run


class Tails:
    """The removals of one group, from rows that come with the outermost first; `done` when no later one can be marked.

    `limit`: no deviation up to it is ever marked, now or later, and no row that does not come has a larger one. A negative limit says that all rows of
    the group come; they are then ranked at once.
    """

    def __init__(self, n, k, square, limit, side, critical):
        self.left, self.steps, self.total, self.square, self.limit, self.side, self.critical = n, k, 0.0, square, limit, side, critical
        self.low, self.high, self.marked, self.done = deque(), deque(), [], False

    def put(self, z, item, is_low):
        (self.low if is_low or self.limit < 0 else self.high).append((z, item))

    def run(self, unread):
        """Remove as long as it is certain which end is farther: rows still to come lie at most `unread` out (none come if it is None)."""
        if self.limit < 0:
            if unread is not None:
                return
            self.low = self.high = deque(sorted(self.low))
        while not self.done:
            if not self.steps:
                self.done = True
                return
            mean = self.total / self.left
            low = mean - self.low[0][0] if self.low else None
            high = self.high[-1 if self.high is self.low else 0][0] - mean if self.high else None
            hidden = (self.limit, self.limit) if unread is None else (mean + unread, unread - mean)
            if self.side == 0:
                if low is not None and high is not None:
                    from_low = low > high
                elif low is not None and low > hidden[1]:
                    from_low = True
                elif high is not None and high >= hidden[0]:
                    from_low = False
                elif unread is None:
                    self.done = True
                    return
                else:
                    return
            else:
                from_low = self.side < 0
                if (low if from_low else high) is None:
                    self.done = unread is None
                    return
            deviation = low if from_low else high
            if max(d for d in (low if self.side <= 0 else None, high if self.side >= 0 else None) if d is not None) <= self.limit:
                self.done = True
                return
            z, item = self.low.popleft() if from_low else self.high.pop() if self.high is self.low else self.high.popleft()
            spread = math.sqrt(max(self.square / self.left - mean * mean, 0.0))
            if spread > 0 and abs(deviation) / spread > self.critical[self.left]:
                self.marked.append(item)
            self.total -= z
            self.square -= z * z
            self.left -= 1
            self.steps -= 1


def esd_tails(level, side):
    """(key, item) of the marked rows, from rows sorted by key with the outermost first. A group holds the rows between its two ends only."""

    def run(batches):
        critical, key, group = CriticalValues(level), None, None

        def out(b, found):
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], b.schema.field("_key").type), pa.array([i for _, i in found], b.schema.field("_item").type)],
                                              names=["_key", "_item"])

        last = None
        for b in batches:
            found, last = [], b
            columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("_key", "_item", "z", "n", "k", "square", "limit", "is_low")]
            for k, item, z, n, most, square, limit, is_low in zip(*columns):
                if group is None or k != key:
                    if group is not None:
                        group.run(None)
                        found += [(key, i) for i in group.marked]
                    key, group = k, Tails(n, most, square, limit, side, critical)
                if not group.done:
                    group.put(z, item, is_low)
                    group.run(-z if is_low else z)
            if group is not None:
                found += [(key, i) for i in group.marked]
                group.marked = []
            if found:
                yield out(b, found)
        if group is not None:
            group.run(None)
            if group.marked:
                yield out(last, [(key, i) for i in group.marked])

    return run


# ------------------------------------------------------------------ spectra

def spectral_shape(keys):
    """Skewness and kurtosis of the amplitude spectrum (first half, DC removed)."""

    def run(pdf):
        x = pdf.sort_values("t")["value"].to_numpy(float)
        n = len(x)
        skew = kurt = np.nan
        if n >= 4:
            y = np.abs(np.fft.fft(x / n))[: n // 2]
            y[0] = 0.0
            d = y - y.mean()
            s2 = np.mean(d * d)
            if y.sum() <= np.finfo(float).eps or s2 <= 0:
                skew = kurt = 0.0
            else:
                skew, kurt = np.mean(d**3) / s2**1.5, np.mean(d**4) / s2**2
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "skewness": skew, "kurtosis": kurt}])

    return run


def fourier_lines(keys, stage):
    """Transforms of several lines (constant p) over q; the first stage also twists by exp(-2 pi i p k / n)."""

    def run(pdf):
        n, size = int(pdf["n"].iloc[0]), int(pdf["n1" if stage == 1 else "n2"].iloc[0])
        lines, at = np.unique(pdf["p"].to_numpy(np.int64), return_inverse=True)
        x = np.zeros((len(lines), size), complex)
        x[at, pdf["q"].to_numpy(np.int64)] = pdf["re"].to_numpy(float) + 1j * pdf["im"].to_numpy(float)
        y = np.fft.fft(x, axis=1)
        if stage == 1:
            y *= np.exp(-2j * np.pi * ((lines[:, None] * np.arange(size)) % n) / n)
        out = pd.DataFrame({"p": np.repeat(lines, size), "q": np.tile(np.arange(size), len(lines)), "re": y.real.ravel(), "im": y.imag.ravel()})
        for k in ("n2", "n1", "n", *reversed(keys)):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


def dfa_exponent(x):
    """Detrended fluctuation exponent: log-log slope of residual size against window length."""
    n = len(x)
    if n < 12:
        return np.nan
    walk = np.cumsum(x - np.mean(x))
    top = int(0.1 * n)
    sizes = [4]
    while int(sizes[-1] * 1.2) <= top:
        sizes.append(max(int(sizes[-1] * 1.2), sizes[-1] + 1))
    points = []
    for size in sizes:
        m = n // size
        seg = walk[: m * size].reshape(m, size)
        axis = np.arange(size) - (size - 1) / 2.0
        slope = seg @ axis / (axis @ axis)
        rest = seg - seg.mean(axis=1, keepdims=True) - slope[:, None] * axis
        points.append((size, np.mean(np.sqrt(np.mean(rest**2, axis=1)))))
    points = np.array([p for p in points if p[1] > 0])
    if len(points) < 2:
        return np.nan
    return float(np.polyfit(np.log(points[:, 0]), np.log(points[:, 1]), 1)[0])


def dfa_segments(keys, length):
    """DFA of every segment of a chunk; a segment includes the first sample of the next one."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        t, x = pdf["t"].to_numpy(), np.nan_to_num(pdf["value"].to_numpy(float))
        core = pdf["_core"].to_numpy()
        segments = np.unique(t[core] // length)
        lo, hi = np.searchsorted(t, segments * length), np.searchsorted(t, (segments + 1) * length, side="right")
        out = pd.DataFrame({"segment": segments, "dfa": [dfa_exponent(x[i:j]) for i, j in zip(lo, hi)]})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


def _spectra(x, t, size, nperseg, sfreq):
    """Hann-windowed one-sided spectra of all complete half-overlapping windows that start in this block."""
    hop = nperseg // 2
    first = int(-(-t[0] // hop)) * hop
    last = min(int(t[-1]) + 1 - nperseg, (int(t[0]) // size + 1) * size - hop)
    starts = np.arange(first, last + 1, hop)
    if not len(starts):
        return starts, np.empty((0, nperseg // 2 + 1))
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(nperseg) / nperseg)
    z = np.lib.stride_tricks.sliding_window_view(x, nperseg)[starts - int(t[0])]
    p = np.abs(np.fft.rfft((z - z.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2 / (sfreq * (w * w).sum())
    p[:, 1 : (nperseg + 1) // 2] *= 2
    return starts // hop, p


def periodograms(keys, size, nperseg, sfreq):
    """One row per window and frequency."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        wins, p = _spectra(pdf["value"].to_numpy(float), pdf["t"].to_numpy(), size, nperseg, sfreq)
        bins = p.shape[1]
        out = pd.DataFrame({"win": np.repeat(wins, bins), "freq": np.tile(np.arange(bins) * sfreq / nperseg, len(wins)), "power": p.ravel()})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


def welch_sums(keys, size, nperseg, sfreq):
    """Sum of the window spectra of a block, and their number: averaged natively over blocks."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        wins, p = _spectra(pdf["value"].to_numpy(float), pdf["t"].to_numpy(), size, nperseg, sfreq)
        out = pd.DataFrame({"freq": np.arange(p.shape[1]) * sfreq / nperseg, "total": p.sum(axis=0), "n": len(wins)})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


# ------------------------------------------------------------------ filters

def lowpass_taps(cutoff, sfreq, taps):
    """Windowed-sinc low-pass, odd length, unit gain at 0 Hz."""
    k = np.arange(taps) - (taps - 1) / 2.0
    f = min(max(cutoff / sfreq, 0.0), 0.5)
    h = 2 * f * np.sinc(2 * f * k) * (0.54 + 0.46 * np.cos(2 * np.pi * k / (taps - 1)))
    return h / h.sum()


def bandpass_taps(low, high, sfreq, taps):
    h = lowpass_taps(high, sfreq, taps) if high is not None and high < sfreq / 2 else _delta(taps)
    return h - lowpass_taps(low, sfreq, taps) if low else h


def notch_taps(freqs, width, sfreq, taps):
    h = _delta(taps)
    for f in freqs:
        h = h - (lowpass_taps(f + width / 2, sfreq, taps) - lowpass_taps(f - width / 2, sfreq, taps))
    return h


def _delta(taps):
    h = np.zeros(taps)
    h[taps // 2] = 1.0
    return h


def fir_block(keys, taps, name):
    """Zero-phase FIR over one block with halo; samples beyond the recording mirror the edge."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        x = pdf["value"].to_numpy(float)
        half = len(taps) // 2
        pad = min(half, len(x) - 1)
        y = np.pad(np.pad(x, pad, mode="reflect"), half - pad, mode="edge")
        pdf[name] = np.convolve(y, taps, mode="valid")
        return pdf.loc[pdf["_core"], [*keys, "t", "value", name]]

    return run


def hilbert_taps(taps):
    """Quarter-turn filter of odd length: 2 / (pi k) at odd distances, windowed."""
    k = np.arange(taps) - taps // 2
    h = np.where(k % 2 != 0, 2.0 / (np.pi * np.where(k == 0, 1, k)), 0.0)
    return h * (0.54 + 0.46 * np.cos(np.pi * k / (taps // 2 + 1)))


def analytic_taps(low, high, sfreq, taps):
    """Band-pass and the same band turned by a quarter, of equal odd length: the root of their squares is the envelope of the band."""
    band, turn = bandpass_taps(low, high, sfreq, taps), hilbert_taps(taps)
    return np.pad(band, taps // 2), np.convolve(band, turn)


def envelope_block(keys, in_phase, quarter):
    """Amplitude envelope of one block with halo, from a pair of filters; core samples only. Samples beyond the recording mirror the edge."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        x = pdf["value"].to_numpy(float)
        half = len(in_phase) // 2
        pad = min(half, len(x) - 1)
        y = np.pad(np.pad(x, pad, mode="reflect"), half - pad, mode="edge")
        pdf["envelope"] = np.hypot(np.convolve(y, in_phase, mode="valid"), np.convolve(y, quarter, mode="valid"))
        return pdf.loc[pdf["_core"], [*keys, "t", "envelope"]]

    return run


def rate_ratio(old, new):
    """The rates as whole numbers (up, down): output k stands at k * down / up input samples."""
    ratio = Fraction(new).limit_denominator(1000) / Fraction(old).limit_denominator(1000)
    return ratio.numerator, ratio.denominator


def phase_weights(phase, up, down, half):
    """Input weights at the whole distances -reach + 1 to reach of outputs that stand `phase` / `up` samples after an input sample: windowed sinc with `half`
    lobes on each side at the lower of both rates, so its width in input samples grows when the rate falls."""
    cut = min(1.0, up / down)
    reach = math.ceil(half / cut)
    d = (np.asarray(phase)[:, None] / up - np.arange(-reach + 1, reach + 1)[None, :]) * cut
    w = np.sinc(d) * np.where(np.abs(d) < half, np.cos(np.pi * d / (2 * half)) ** 2, 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resample_block(keys, size, up, down, half):
    """Polyphase interpolation at the outputs whose input sample lies in this block; samples beyond the recording repeat its edge."""

    def run(pdf):
        pdf = pdf.sort_values("t")
        t, x, b = pdf["t"].to_numpy(), pdf["value"].to_numpy(float), int(pdf["_block"].iloc[0])
        k = np.arange(-(-b * size * up // down), -(-(b + 1) * size * up // down))
        k = k[(k >= 0) & (k * down <= int(t[-1]) * up)]
        phases, which = np.unique(k * down % up, return_inverse=True)
        w = phase_weights(phases, up, down, half)
        reach = w.shape[1] // 2
        out = np.empty(len(k))
        for part in np.array_split(np.arange(len(k)), max(1, len(k) * 2 * reach // (1 << 22))):
            near = (k[part] * down // up)[:, None] + np.arange(-reach + 1, reach + 1)[None, :]
            out[part] = (x[np.clip(near - t[0], 0, len(t) - 1)] * w[which[part]]).sum(axis=1)
        out = pd.DataFrame({"t": k.astype("int64"), "value": out})
        for key in reversed(keys):
            out.insert(0, key, pdf[key].iloc[0])
        return out

    return run


# ------------------------------------------------------- channel consistency

def matlab_quantile(x, q):
    """Quantile along axis 0 at the sample-population position."""
    s = np.sort(x, axis=0)
    n = s.shape[0]
    if n < 2:
        return s[0]
    pos = (n - 1) * min(1.0, max(0.0, (q - 0.5) * n / (n - 1) + 0.5))
    lo = int(math.floor(pos))
    return s[lo] + (s[min(lo + 1, n - 1)] - s[lo]) * (pos - lo)


def _window_scores(x, q):
    med = np.nanmedian(x, axis=1, keepdims=True)
    live = np.nanmedian(np.abs(x - med), axis=1) > 0
    # a channel that is alone in its window has nothing to be compared with
    score = np.where(live & (len(x) == 1), np.nan, 0.0)
    if live.sum() > 1:
        with np.errstate(all="ignore"):
            corr = np.corrcoef(x[live])
        np.fill_diagonal(corr, 0.0)
        score[live] = matlab_quantile(np.abs(corr), q)
    return score, ~live


def window_correlation(key, length, q=0.98):
    """Per window and channel of a chunk: a high quantile of |correlation| with the other channels, and dropout."""

    def run(pdf):
        names, times, x = matrix(pdf.rename(columns={"ch_name": "c", "value": "v"}))
        parts = []
        for win, here in pdf.groupby("win")["ch_name"]:
            some = np.isin(names, here.unique())
            score, flat = _window_scores(x[np.ix_(some, times // length == win)], q)
            parts.append(pd.DataFrame({key: pdf[key].iloc[0], "win": win, "ch_name": names[some], "max_corr": score, "dropout": flat}))
        return pd.concat(parts)

    return run


def spline_kernel(cosine, stiffness=4, terms=50):
    """Spherical spline: weighted sum of the Legendre polynomials 1 to `terms` of the cosine between two directions."""
    n = np.arange(1, terms + 1, dtype=float)
    factors = (2 * n + 1) / (n * (n + 1)) ** stiffness
    return np.polynomial.legendre.legval(cosine, np.concatenate([[0.0], factors])) / (4 * np.pi)


def spline_weights(array, ridge):
    """Weights that give a piece of the channels of an array from each subset of its predictors: one solve of the spline system of the predictors for each
    subset. They sum to one."""

    def run(places, chosen):
        out = []
        names = places["ch_name"].to_numpy()

        def unit(rows):
            xyz = rows[["x", "y", "z"]].to_numpy(float)
            return xyz / np.linalg.norm(xyz, axis=1)[:, None]

        for subset, some in chosen.groupby("subset"):
            some = some.sort_values("predictor")
            of, k = unit(some), len(some)
            system = np.ones((k + 1, k + 1))
            system[:k, :k] = spline_kernel(np.clip(of @ of.T, -1, 1)) + ridge * np.eye(k)
            system[k, k] = 0
            w = np.linalg.solve(system, np.vstack([spline_kernel(np.clip(of @ unit(places).T, -1, 1)), np.ones((1, len(names)))]))[:k].T
            out.append(pd.DataFrame({"subset": subset, "ch_name": np.repeat(names, k), "predictor": np.tile(some["predictor"].to_numpy(), len(names)), "weight": w.ravel()}))
        out = pd.concat(out) if out else pd.DataFrame(columns=["subset", "ch_name", "predictor", "weight"])
        out.insert(0, array, places["_array"].iloc[0] if len(places) else None)
        return out

    return run


def ransac_windows(key, length, least=0.5):
    """Correlation of each channel with the median of its predictions from channel subsets, per window of a chunk, from the channels that the window has.

    Where predictors of a subset are missing, the weights of the others are scaled up to the same sum; a subset whose weights present make up less than
    `least` of their sum does not count, and a window that no subset predicts gives no row.
    """

    def run(rows, weights):
        names, times, x = matrix(rows.rename(columns={"ch_name": "c", "value": "v"}))
        x = np.nan_to_num(x)
        at = {n: i for i, n in enumerate(names)}
        place = np.array([at.get(p, -1) for p in weights["predictor"]], int)
        value, target = weights["weight"].to_numpy(float), weights["ch_name"].to_numpy()
        subset = np.unique(weights["subset"].to_numpy(), return_inverse=True)[1] if len(weights) else np.zeros(0, int)
        own = {}
        for name in names:
            some = target == name
            if some.any():
                mix, total = np.zeros((subset.max() + 1, len(names))), np.bincount(subset[some], value[some], subset.max() + 1)
                here = some & (place >= 0)
                np.add.at(mix, (subset[here], place[here]), value[here])
                used = np.bincount(subset[some], minlength=len(mix)) > 0
                own[name] = mix[used], total[used]
        alike = {}
        for win, some in rows.groupby("win")["ch_name"]:
            alike.setdefault(tuple(sorted(some.unique())), []).append(win)
        out = []
        for present, wins in alike.items():
            mask, cols = np.isin(names, present), np.isin(times // length, wins)
            z = x[:, cols].reshape(len(names), len(wins), length)
            for name in present:
                if name not in own:
                    continue
                mix, total = own[name]
                have = (mix * mask).sum(axis=1)
                good = (have * np.sign(total) > 0) & (np.abs(have) >= least * np.abs(total))
                if not good.any():
                    continue
                guess = np.median(np.tensordot((mix * mask)[good] * (total[good] / have[good])[:, None], z, axes=1), axis=0)
                a, b = z[at[name]], guess
                a, b = a - a.mean(axis=1, keepdims=True), b - b.mean(axis=1, keepdims=True)
                size = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
                corr = np.divide((a * b).sum(axis=1), size, out=np.zeros(len(wins)), where=size > 0)
                out.append(pd.DataFrame({"win": wins, "ch_name": name, "corr": corr}))
        out = pd.concat(out) if out else pd.DataFrame(columns=["win", "ch_name", "corr"])
        out.insert(0, key, rows[key].iloc[0] if len(rows) else None)
        return out

    return run


# ----------------------------------------------------------- small matrices

def pair_matrix(pdf, a="ci", b="cj", value="cov"):
    names = np.unique(np.concatenate([pdf[a].to_numpy(), pdf[b].to_numpy()]))
    i, j = np.searchsorted(names, pdf[a].to_numpy()), np.searchsorted(names, pdf[b].to_numpy())
    out = np.zeros((len(names), len(names)))
    out[i, j] = out[j, i] = pdf[value].to_numpy(float)
    return names, out


def flip_search(key, n_init, n_iter, max_flips, seed):
    """Channel signs that best match a template covariance.

    Each of `n_init` rounds draws `n_iter` sign changes of up to `max_flips` channels of the best signs so far, scores all by one product, and
    takes the best; then single channels are turned as long as one of them helps.
    """

    def run(pdf):
        names, cov = pair_matrix(pdf)
        _, ref = pair_matrix(pdf, value="template_cov")
        i, j = np.triu_indices(len(names), k=1)
        a, b = cov[i, j], ref[i, j] - ref[i, j].mean() if len(i) else ref[i, j]

        def scores(signs):
            v = a * signs[:, i] * signs[:, j]
            v = v - v.mean(axis=1, keepdims=True)
            size = np.sqrt((v * v).sum(axis=1) * (b @ b))
            return np.divide(v @ b, size, out=np.zeros(len(v)), where=size > 1e-300)

        def better(signs, proposals):
            got = scores(signs * proposals)
            top = int(got.argmax())
            return (signs * proposals[top], got[top]) if got[top] > scores(signs[None])[0] + 1e-15 else None

        best, rng = np.ones(len(names)), np.random.default_rng([seed, len(names)])
        start = float(scores(best[None])[0]) if len(i) else 0.0
        single = 1 - 2 * np.eye(len(names))
        for _ in range(n_init if len(i) else 0):
            order = rng.random((n_iter, len(names))).argsort(axis=1)
            proposals = np.where(order < rng.integers(1, min(max_flips, len(names)) + 1, (n_iter, 1)), -1.0, 1.0)
            found = better(best, proposals)
            while found:
                best = found[0]
                found = better(best, single)
        after = float(scores(best[None])[0]) if len(i) else 0.0
        return pd.DataFrame({key: pdf[key].iloc[0], "ch_name": names, "flip": best.astype(int), "metric_before": start,
                             "metric_after": max(after, start)})

    return run


def first_component(keys):
    """Leading eigenvector of a parcel's voxel cross-product matrix, with its eigenvalue."""

    def run(pdf):
        names, g = pair_matrix(pdf, value="cross")
        values, vectors = np.linalg.eigh(g)
        u = vectors[:, -1]
        u = u if u[np.argmax(np.abs(u))] >= 0 else -u
        out = pd.DataFrame({"voxel": names, "loading": u, "eigenvalue": values[-1]})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return run


# -------------------------------------------------------------- topographies

def topography_forms(vectors: pd.Series) -> pd.DataFrame:
    """Unit, centred-unit, centred-rank-unit (ties averaged) and min-max forms of short vectors."""
    rows = []
    for v in vectors:
        x = np.asarray(v, float)
        _, place, count = np.unique(x, return_inverse=True, return_counts=True)
        ranks = (np.cumsum(count) - (count - 1) / 2.0)[place]
        c, r = x - x.mean(), ranks - ranks.mean()
        with np.errstate(all="ignore"):
            rows.append((x / np.sqrt(x @ x), c / np.sqrt(c @ c), r / np.sqrt(r @ r), (x - x.min()) / (x.max() - x.min() + 1e-10)))
    return pd.DataFrame(rows, columns=["unit", "centred", "ranked", "scaled"])


# ------------------------------------------------------------- permutations

class Signs:
    """Signs of subjects under permutations 0 to `n_perms` (0 turns none), from the first bit of an md5 over subject, permutation and seed. Those of the
    subjects seen last are kept, as bytes."""

    def __init__(self, n_perms, seed, room=1 << 26):
        self.ends = [f":{p}:{seed}".encode() for p in range(1, n_perms + 1)]
        self.most, self.known = max(1, room // (n_perms + 1)), {}

    def of(self, subjects):
        if len(self.known) + len(subjects) > self.most:
            self.known.clear()
        for s in subjects:
            if s not in self.known:
                start = hashlib.md5(s.encode())
                row = np.ones(len(self.ends) + 1, np.int8)
                for i, end in enumerate(self.ends):
                    digest = start.copy()
                    digest.update(end)
                    if digest.digest()[0] >= 128:
                        row[i + 1] = -1
                self.known[s] = row
        return np.stack([self.known[s] for s in subjects])


def signed_sums(cell, n_perms, seed, block, held=1 << 22):
    """Sums of signed values by cell and permutation, one row for each cell and block of permutations, with the sum of squares and the number of rows. A task
    sums what it reads before it gives it out, as far as `held` sums go."""

    def run(batches):
        signs, place, sums, other, last = Signs(n_perms, seed), {}, [], [], None

        def out():
            keys = list(place)
            starts = range(0, n_perms + 1, block)
            for at in range(0, len(keys), max(1, 1 + (1 << 20) // (n_perms + 1))):
                some = range(at, min(len(keys), at + max(1, 1 + (1 << 20) // (n_perms + 1))))
                columns = [pa.array([keys[i][c] for i in some for _ in starts], last.schema.field(name).type) for c, name in enumerate(cell)]
                yield pa.RecordBatch.from_arrays([
                    *columns, pa.array([b for _ in some for b in range(len(starts))], pa.int32()), pa.array([sums[i][a : a + block] for i in some for a in starts], pa.list_(pa.float64())),
                    pa.array([other[i][0] for i in some for _ in starts], pa.float64()), pa.array([other[i][1] for i in some for _ in starts], pa.int64())],
                    names=[*cell, "block", "sums", "sq", "n"])

        for b in batches:
            last = b
            keys = list(zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in cell])) if cell else [()] * b.num_rows
            names, subject = np.unique(np.array(b.column(b.schema.get_field_index("_s")).to_pylist(), object), return_inverse=True)
            y = b.column(b.schema.get_field_index("_y")).fill_null(0.0).to_numpy(zero_copy_only=False)
            if not len(y):
                continue
            table = signs.of(names.tolist())
            new = [k for k in dict.fromkeys(keys) if k not in place]
            if place and (len(place) + len(new)) * (n_perms + 1) > held:
                yield from out()
                place, sums, other = {}, [], []
                new = list(dict.fromkeys(keys))
            for k in new:
                place[k] = len(place)
                sums.append(np.zeros(n_perms + 1))
                other.append([0.0, 0])
            which = np.fromiter(map(place.__getitem__, keys), np.int64, len(keys))
            order = np.argsort(which, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(which[order]) != 0))
            rows = which[order][first].tolist()
            for a in range(0, n_perms + 1, block):
                part = np.add.reduceat(table[subject[order], a : a + block] * y[order, None], first, axis=0)
                for i, r in enumerate(rows):
                    sums[r][a : a + block] += part[i]
            squares, count = np.add.reduceat((y * y)[order], first), np.diff(np.append(first, len(order)))
            for i, r in enumerate(rows):
                other[r][0] += float(squares[i])
                other[r][1] += int(count[i])
        if place:
            yield from out()

    return run
