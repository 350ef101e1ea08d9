"""Indicators that are recurrences: exponential averages and what is built on them.

A series is one instrument's daily history, bounded by the calendar, so a
grouped map holds one bounded series at a time; the recurrence itself runs in
pandas' compiled exponential average.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from barloom.functions.indicators import null_for_nan


def ema(values: np.ndarray, n: int) -> np.ndarray:
    """The mean of the first n valid values, then e + 2 / (n + 1) * (x - e); leading NaN are skipped."""
    out = np.full(len(values), np.nan)
    valid = np.flatnonzero(~np.isnan(values))
    if len(valid) and len(values) - valid[0] >= n:
        at = valid[0] + n - 1
        x = values[at:].astype(float).copy()
        x[0] = np.mean(values[valid[0] : at + 1])
        out[at:] = pd.Series(x).ewm(alpha=2.0 / (n + 1), adjust=False).mean().to_numpy()
    return out


def with_ema(df: DataFrame, periods: tuple[int, ...], value: str = "close", code: str = "code", order: str = "day") -> DataFrame:
    """code, order, value and ema_n for every n."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(code, order, value).schema) + "".join(f", ema_{n} double" for n in periods)

    def fold(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order)
        return p.assign(**{f"ema_{n}": ema(p[value].to_numpy(float), n) for n in periods})

    return null_for_nan(df.select(code, order, value).groupBy(code).applyInPandas(fold, schema), [f"ema_{n}" for n in periods])


def with_macd(df: DataFrame, fast: int = 12, slow: int = 26, smooth: int = 9, value: str = "close", code: str = "code", order: str = "day") -> DataFrame:
    """The frame with dif (fast less slow), dea (smoothed dif) and macd = 2 (dif - dea)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", dif double, dea double, macd double"

    def fold(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order)
        x = p[value].to_numpy(float)
        dif = ema(x, fast) - ema(x, slow)
        dea = ema(dif, smooth)
        return p.assign(dif=dif, dea=dea, macd=2 * (dif - dea))

    return null_for_nan(df.groupBy(code).applyInPandas(fold, schema), ["dif", "dea", "macd"])

