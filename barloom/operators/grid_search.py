"""Search of a parameter grid of double-average back-tests.

Each distinct average is computed once per instrument from prefix sums of whole
prices, then all pairs of the instrument are replayed trade by trade.  The
parallelism is instrument times slow period: the pairs of one slow period of
one instrument are a task's unit of work.

Scale: an instrument's history is bounded by the calendar; it is sent once to
each of its groups of slow periods, not once per pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.ledger import RULES, Settings, final_asset, replay

FAST, SLOW = tuple(range(5, 200, 5)), tuple(range(10, 205, 5))
RETURNS_SCHEMA = "code string, period_fast int, period_slow int, total_returns double"


def pairs(spark: SparkSession, fast: tuple[int, ...] = FAST, slow: tuple[int, ...] = SLOW) -> DataFrame:
    """period_fast, period_slow of all pairs with fast below slow: for each slow period the fast ones under it."""
    s = spark.createDataFrame([(x,) for x in slow], "period_slow int")
    f = F.array(*(F.lit(x) for x in fast))
    return s.select(F.explode(F.filter(f, lambda x: x < F.col("period_slow"))).alias("period_fast"), "period_slow")


def _averages(close: np.ndarray, n: int) -> np.ndarray:
    """Sums of the last n whole prices over n; NaN before the first."""
    out = np.full(len(close), np.nan)
    if len(close) >= n:
        total = np.cumsum(close)
        out[n - 1 :] = (total[n - 1 :] - np.r_[0, total[:-n]]) / n
    return out


def pair_returns(open_: np.ndarray, averages: dict[int, np.ndarray], fasts: list[int], slow: int, s: Settings, rules) -> list[float]:
    """Final less opening assets of each fast period against one slow one, on whole-number prices.

    averages: by period.  The crosses of all fast periods are found at once."""
    n = len(open_)
    if n <= slow or not fasts:
        return []
    price = open_[slow:] / 1000.0
    change = open_[slow:] / open_[slow - 1 : -1] - 1
    up, down = np.cumprod(1 + change), np.cumprod(1 - change)
    exact = bool((up > 0).all() and (np.abs(1 - change) > 1e-9).all())
    side = np.sign(np.stack([averages[f][slow - 1 :] for f in fasts]) - averages[slow][slow - 1 :])
    before, now = side[:, :-1], side[:, 1:]
    # a signal is traded on the row after it; the first kept row never trades
    trade = np.zeros(now.shape, np.int8)
    trade[:, 1:] = ((before <= 0) & (now > 0))[:, :-1].astype(np.int8) - ((before >= 0) & (now < 0))[:, :-1]
    which, places = np.nonzero(trade)
    ends = np.searchsorted(which, np.arange(len(fasts) + 1)).tolist()
    places, sides = places.tolist(), trade[which, places].tolist()
    prices, ups, downs = price.tolist(), up.tolist(), down.tolist()
    out = []
    for k in range(len(fasts)):
        if exact:
            mine = slice(ends[k], ends[k + 1])
            total = final_asset(prices, ups, downs, places[mine], sides[mine], s, rules)
        else:
            total = replay(price, change, trade[k], s, rules)[-1, 3]
        out.append(round(round(total, 4) - s.cash, 4))  # half to even, twice
    return out


def grid_returns(bars: DataFrame, fast: tuple[int, ...] = FAST, slow: tuple[int, ...] = SLOW, rules: str = "d", settings: Settings | None = None, slow_per_group: int = 10) -> DataFrame:
    """code, period_fast, period_slow, total_returns of all pairs.  bars: code, day, whole thousandths o, c."""
    s, r = settings or Settings(), RULES[rules]
    ordered = sorted(slow)
    groups = [ordered[k : k + slow_per_group] for k in range(0, len(ordered), slow_per_group)]

    def run(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("day")
        o, c = p["o"].to_numpy(np.int64), p["c"].to_numpy(np.int64)
        rows = []
        averages = {n: _averages(c, n) for n in {*fast, *groups[key[1]]}}
        for sl in groups[key[1]]:
            under = [f for f in fast if f < sl]
            rows += [(key[0], f, sl, x) for f, x in zip(under, pair_returns(o, averages, under, sl, s, r), strict=False)]
        return pd.DataFrame(rows, columns=["code", "period_fast", "period_slow", "total_returns"])

    spread = bars.select("code", "day", "o", "c", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))).alias("part"))
    found = spread.groupBy("code", "part").applyInPandas(run, RETURNS_SCHEMA)
    return found.where("total_returns is not null and not isnan(total_returns)")


def best_pairs(returns: DataFrame) -> DataFrame:
    """The best pair of each instrument; of equal ones that with the smaller fast, then slow period."""
    first = F.max_by(F.struct("period_fast", "period_slow", "total_returns"), F.struct("total_returns", -F.col("period_fast"), -F.col("period_slow")))
    return returns.groupBy("code").agg(first.alias("x")).select("code", "x.*")


def summary_lines(returns: DataFrame, cash: float = Settings.cash) -> DataFrame:
    """code, pair ("5-20") and a line of text for each tested pair."""
    pair = F.concat_ws("-", "period_fast", "period_slow")
    line = F.format_string("%s: final asset %.4f, total returns %.4f", pair, F.col("total_returns") + F.lit(cash), "total_returns")
    return returns.select("code", pair.alias("pair"), line.alias("line"))
