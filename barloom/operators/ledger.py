"""Replay of trades through a cash and position ledger.

The ledger is the one true recurrence of a back-test.  It moves only at
trades: between them a holding is a running product of returns, so a series is
processed trade by trade with whole stretches filled at once.

Rule sets are data, not code: each says at which price a quantity is sized in
each of the four transitions, how a holding is closed and what a repeated
trade does.  The series of an instrument (and parameter pair) is bounded by
the calendar; instruments and parameter pairs are the parallelism.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from barloom.functions.indicators import null_for_nan


@dataclass(frozen=True)
class Settings:
    """Account and broker: opening cash, commission share, lot, slippage per unit; a fixed number of units
    instead of all that is affordable, if given; the share of the cash that one position may take."""

    cash: float = 100_000.0
    commission: float = 0.002
    lot: int = 100
    slippage: float = 0.01
    units: float | None = None
    position_limit: float = 1.0


@dataclass(frozen=True)
class Rules:
    """Sizing prices: own (the slipped price of the order), raw (no slippage), far (the slipped price of the
    other side), unit (the price itself is taken for the quantity).  close: mark (the last market value
    comes back as cash) or deal (units at the slipped price, less commission).  repeat: hold, or lost
    (the rest of the series is unknown).  signed: fixed units of a short are negative."""

    name: str
    flat_long: str = "own"
    flat_short: str = "own"
    short_long: str = "own"
    long_short: str = "own"
    close: str = "mark"
    repeat: str = "hold"
    signed: bool = True


RULES = {
    "a": Rules("a", flat_short="raw", short_long="raw", repeat="lost"),
    "b": Rules("b", repeat="lost"),
    "c": Rules("c", flat_short="unit", long_short="far", close="deal", signed=False),
    "d": Rules("d"),
}
LEDGER_COLUMNS = "position double, market_value double, cash double, total_asset double"


@functools.lru_cache(64)
def striker(s: Settings, r: Rules) -> Callable[[int, float, float, float, float], tuple[float, float, float]]:
    """The function (trade, price, units held, their market value, cash) -> (units, market value, cash)
    of a trade on the opposite or an empty side."""
    slip, fee, lot, fixed, share = s.slippage, s.commission, s.lot, s.units, s.position_limit
    after_fee, at_mark, signed = 1 - fee, r.close == "mark", r.signed
    sizing = {(1, False): r.flat_long, (-1, False): r.flat_short, (1, True): r.short_long, (-1, True): r.long_short}

    def strike(trade: int, price: float, held: float, worth: float, cash: float) -> tuple[float, float, float]:
        own = price + slip if trade > 0 else price - slip
        if held:
            if at_mark:
                cash = cash + worth
            else:
                back = (price + slip if held > 0 else price - slip) * abs(held)
                cash = cash + back - back * fee
        how = sizing[trade, held != 0]
        if fixed is not None:
            units = fixed if trade > 0 or not signed else -fixed
        elif how == "unit":
            units = own * trade
        else:
            at = own if how == "own" else price if how == "raw" else price - slip if trade > 0 else price + slip
            # whole lots that the cash buys; none at a price that slippage has brought to nothing
            units = trade * (cash * share * after_fee / at // lot * lot) if at > 0 else 0.0
        value = abs(units) * own
        cash = cash - value
        return units, value, cash - value * fee

    return strike


def replay(price: np.ndarray, change: np.ndarray, trade: np.ndarray, s: Settings, r: Rules) -> np.ndarray:
    """Rows of (position, market value, cash, total asset); the first row never trades.  NaN: lost."""
    n = len(price)
    out = np.full((n, 4), np.nan)
    if not n:
        return out
    strike = striker(s, r)
    units, worth, cash, total = 0.0, 0.0, float(s.cash), float(s.cash)
    out[0] = units, worth, cash, total
    last = 0

    def stay(to: int) -> None:
        """Rows after ``last`` up to ``to``, holding what there is."""
        nonlocal worth, total, last
        if to <= last:
            return
        rows = slice(last + 1, to + 1)
        if units:
            values = np.cumprod(np.r_[worth, 1 + np.sign(units) * change[rows]])[1:]
            out[rows, 1], out[rows, 3] = values, values + cash
            worth, total = float(values[-1]), float(values[-1]) + cash
        else:
            out[rows, 1], out[rows, 3] = 0.0, total
            worth = 0.0
        out[rows, 0], out[rows, 2] = units, cash
        last = to

    for k in np.flatnonzero(trade[1:]) + 1:
        stay(k - 1)
        if trade[k] * units > 0:
            if r.repeat == "lost":
                return out
            stay(k)
            continue
        units, worth, cash = strike(int(trade[k]), float(price[k]), units, worth, cash)
        total = worth + cash
        out[k], last = (units, worth, cash, total), k
    stay(n - 1)
    return out


def final_asset(price: list[float], up: list[float], down: list[float], places: list[int], sides: list[int], s: Settings, r: Rules) -> float:
    """The last total asset only, visiting nothing but the trades.  up and down are the running products
    of one plus and one less the change; both must be nonzero throughout."""
    strike, lost = striker(s, r), r.repeat == "lost"
    units, worth, cash, at = 0.0, 0.0, float(s.cash), 0
    total = cash
    for k, side in zip(places, sides, strict=True):
        if side * units > 0:
            if lost:
                return float("nan")
            continue
        if units:
            run = up if units > 0 else down
            worth = worth * (run[k - 1] / run[at])  # the mark of the row before
        units, worth, cash = strike(side, price[k], units, worth, cash)
        total, at = worth + cash, k
    if units:
        run = up if units > 0 else down
        total = worth * (run[-1] / run[at]) + cash
    return total


def with_ledger(df: DataFrame, rules: str | Rules = "d", settings: Settings | None = None, keys: tuple[str, ...] = ("code",), order: str = "day") -> DataFrame:
    """The frame (keys, order, open, open_pct_change, trade) with position, market_value, cash, total_asset.

    NULL marks rows of which the rules know nothing."""
    r = RULES[rules] if isinstance(rules, str) else rules
    s = settings or Settings()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", " + LEDGER_COLUMNS

    def fold(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order, ignore_index=True)
        rows = replay(p["open"].to_numpy(float), p["open_pct_change"].to_numpy(float), p["trade"].to_numpy(np.int64), s, r)
        rows[:, 0] += 0.0  # no negative zero
        return pd.concat([p, pd.DataFrame(rows, columns=["position", "market_value", "cash", "total_asset"])], axis=1)

    return null_for_nan(df.groupBy(*keys).applyInPandas(fold, schema), ["position", "market_value", "cash", "total_asset"])
