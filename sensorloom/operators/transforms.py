"""Signal preprocessing and ordered transform chains."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..plans.blocks import BLOCK, with_blocks
from .detectors import CHANNEL, _schema, filtered

# Default reference preprocessing.
DEFAULT_STEPS = [{"filter": {"l_freq": 1.0, "h_freq": 100.0}}, {"notch_filter": {"freqs": [50.0]}}, {"resample": {"sfreq": 250.0}}]


def filter_signal(samples: DataFrame, sfreq: float, low: float | None, high: float | None, taps: int = 1025, size: int = BLOCK,
                  keys: list[str] | None = None) -> DataFrame:
    """Band-pass by a linear-phase FIR in blocks with halo; `keys` name a channel (by default recording and channel)."""
    keys = keys or CHANNEL
    return filtered(samples, kernels.bandpass_taps(low, high, sfreq, taps), "_y", size, keys).select(*keys, "t", F.col("_y").alias("value"))


def notch(samples: DataFrame, sfreq: float, freqs: list[float], width: float = 2.0, taps: int = 1025, size: int = BLOCK, keys: list[str] | None = None) -> DataFrame:
    keys = keys or CHANNEL
    return filtered(samples, kernels.notch_taps(freqs, width, sfreq, taps), "_y", size, keys).select(*keys, "t", F.col("_y").alias("value"))


def resample(samples: DataFrame, old: float, new: float, half: int = 32, size: int = BLOCK, keys: list[str] | None = None) -> DataFrame:
    """Band-limited interpolation at the new rate by a filter bank, in blocks with halo; `half` lobes of the lower rate on each side."""
    keys = keys or CHANNEL
    up, down = kernels.rate_ratio(old, new)
    reach = math.ceil(half * max(1.0, down / up)) + 2
    cols = samples.select(*keys, "t", F.col("value").cast("double").alias("value"))
    blocked = with_blocks(cols, size=size, before=reach, after=reach, wide=True).where("_block >= 0")
    return blocked.groupBy(*keys, "_block").applyInPandas(
        kernels.resample_block(keys, size, up, down, half), _schema(samples, keys, "t bigint, value double"))


def preprocess(samples: DataFrame, sfreq: float, steps: list[dict] | None = None, taps: int = 1025,
               size: int = BLOCK, half: int = 32, keys: list[str] | None = None) -> tuple[DataFrame, float, list[dict]]:
    """Configured steps with their skip rules; returns the signal, its rate and the log of applied steps."""
    log: list[dict] = []
    for step in DEFAULT_STEPS if steps is None else steps:
        (name, cfg), = step.items()
        if name == "filter":
            low, high = cfg.get("l_freq"), cfg.get("h_freq")
            high = None if high is not None and high >= sfreq / 2 else high
            if low is None and high is None:
                log.append({"step": name, "status": "skipped", "reason": "no usable band"})
                continue
            samples = filter_signal(samples, sfreq, low, high, taps, size, keys)
            log.append({"step": name, "status": "applied", "l_freq": low, "h_freq": high})
        elif name in ("notch", "notch_filter"):
            freqs = [f for f in cfg.get("freqs", []) if f < sfreq / 2]
            if not freqs:
                log.append({"step": "notch_filter", "status": "skipped", "reason": "no frequency below Nyquist"})
                continue
            samples = notch(samples, sfreq, freqs, taps=taps, size=size, keys=keys)
            log.append({"step": "notch_filter", "status": "applied", "freqs": freqs})
        elif name == "resample":
            new = float(cfg["sfreq"])
            if new <= 0:
                raise ValueError("resample rate must be positive")
            if abs(new - sfreq) <= 1e-9:
                log.append({"step": name, "status": "skipped", "reason": "already at the target rate"})
                continue
            samples = resample(samples, sfreq, new, half, size, keys)
            log.append({"step": name, "status": "applied", "from": sfreq, "to": new})
            sfreq = new
        else:
            raise ValueError(f"unknown step {name!r}")
    return samples, sfreq, log


def transform_chain(df: DataFrame, steps: list[tuple[str, dict]], builtin: dict[str, Callable[..., DataFrame]],
                    extra: dict[str, Callable[..., DataFrame]] | None = None) -> DataFrame:
    """Apply named steps in order: user function first, then a built-in, then a DataFrame method."""
    for name, options in steps:
        fn = (extra or {}).get(name) or builtin.get(name)
        if fn is not None:
            df = df.transform(fn, **options)
        elif callable(getattr(DataFrame, name, None)):
            df = getattr(df, name)(*options.get("args", ()), **{k: v for k, v in options.items() if k != "args"})
        else:
            raise ValueError(f"unknown step {name!r}")
    return df
