"""Strategies and the facade that runs them.

    Backtest().add_data(bars).set_account(cash=1e6).set_broker(commission=0.003, lot=200).add_strategy(AverageCross(5, 20)).run()

Everything is lazy: run() returns a ledger DataFrame, and nothing is computed
before an action asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import DataFrame

from barloom.operators import evaluation, ledger, signals
from barloom.sources.bars import read_bars_folder, union_bars


class Strategy(Protocol):
    """trades(bars) returns code, day, open, open_pct_change, trade; bars: code, day, whole thousandths o, h, l, c."""

    def trades(self, bars: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class AverageCross:
    fast: int = 5
    slow: int = 20

    def trades(self, bars: DataFrame) -> DataFrame:
        return signals.average_cross(bars, self.fast, self.slow)


@dataclass(frozen=True)
class MacdCross:
    fast: int = 12
    slow: int = 26
    smooth: int = 9

    def trades(self, bars: DataFrame) -> DataFrame:
        return signals.macd_cross(bars, self.fast, self.slow, self.smooth)


class Backtest:
    """Collects data, account, broker, rules and a strategy; setters return the object."""

    def __init__(self) -> None:
        self.settings, self.rules = ledger.Settings(), "d"
        self.bars: DataFrame | None = None
        self.strategy: Strategy | None = None

    def add_data(self, *frames: DataFrame) -> Backtest:
        self.bars = union_bars(*([self.bars] if self.bars is not None else []), *frames)
        return self

    def add_data_folder(self, spark, folder: str, **options) -> Backtest:
        return self.add_data(read_bars_folder(spark, folder, **options))

    def set_account(self, cash: float) -> Backtest:
        self.settings = replace(self.settings, cash=float(cash))
        return self

    def set_broker(self, commission: float | None = None, lot: int | None = None, slippage: float | None = None, position_limit: float | None = None, units: float | None = None) -> Backtest:
        given = {k: v for k, v in {"commission": commission, "lot": lot, "slippage": slippage, "position_limit": position_limit, "units": units}.items() if v is not None}
        self.settings = replace(self.settings, **given)
        return self

    def set_rules(self, rules: str) -> Backtest:
        self.rules = rules
        return self

    def add_strategy(self, strategy: Strategy) -> Backtest:
        self.strategy = strategy
        return self

    def run(self) -> DataFrame:
        """The ledger of every instrument."""
        if self.bars is None or self.strategy is None:
            raise ValueError("a back-test needs data and a strategy")
        trades = self.strategy.trades(self.bars).select("code", "day", "open", "open_pct_change", "trade")
        return ledger.with_ledger(trades, self.rules, self.settings)

    def evaluate(self, benchmark: DataFrame) -> DataFrame:
        """The figures of the run against a benchmark (day, close)."""
        return evaluation.report(evaluation.strategy_returns(self.run()), evaluation.benchmark_returns(benchmark))
