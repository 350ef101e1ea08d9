"""Queries of the indicators, the ledger, the parameter grid and the views, over the clean daily bars."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import indicators as I
from barloom.operators import books, evaluation, grid_search, recursive, signals
from barloom.operators.ledger import Settings, with_ledger
from barloom.sources import bars as feeds
from barloom.sources.bars import benchmark, daily_bars
from barloom.sources.tables import table
from barloom.session import discard_at_end, shared_folder
from barloom.strategy import AverageCross, Backtest, MacdCross
from barloom.streaming.online import replay_online

SMALL_FAST, SMALL_SLOW = (5, 10), (20, 30)


def _day():
    return F.date_format("day", "yyyy-MM-dd").alias("day")


def _w():
    return I.series()


def _r(c, places: int = 6):
    return F.round(c, places) + F.lit(0.0)


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    third = lambda c, name: (F.col(c) / F.lit(1000.0)).alias(name)
    return daily_bars(spark, folder).select("code", "day", third("o", "open"), third("h", "high"), third("l", "low"), third("c", "close"))


def bars_daily(spark, folder):
    return _priced(spark, folder).select("code", _day(), "open", "high", "low", "close")


def pct_change_open(spark, folder):
    return daily_bars(spark, folder).select("code", _day(), _r(I.pct_change(F.col("o").cast("double"), _w())).alias("open_pct_change"))


def sma(spark, folder):
    b, w = daily_bars(spark, folder), _w()
    return b.select("code", _day(), *(_r(I.sma("c", n, w) / 1000.0).alias(f"sma_{n}") for n in (5, 20)))


def sma_warmup_drop(spark, folder):
    return signals.drop_incomplete(sma(spark, folder))


def llv(spark, folder):
    return _priced(spark, folder).select("code", _day(), I.lowest("low", 9, _w()).alias("llv_9"))


def hhv(spark, folder):
    return _priced(spark, folder).select("code", _day(), I.highest("high", 9, _w()).alias("hhv_9"))


def rsv(spark, folder):
    return daily_bars(spark, folder).select("code", _day(), _r(I.rsv("c", "h", "l", 9, _w())).alias("rsv_9"))


def kdj(spark, folder):
    k = I.with_kdj(daily_bars(spark, folder), _w(), 9, 3, 3, "c", "h", "l")
    return k.select("code", _day(), *(_r(F.col(c)).alias(c) for c in ("k", "d", "j")))


def crossup_sma(spark, folder):
    b, w = daily_bars(spark, folder), _w()
    ma = b.withColumns({"f": I.sma("c", 5, w), "s": I.sma("c", 20, w)})
    return ma.select("code", _day(), I.crossed("f", "s", w).alias("signal"))


def trade_delay(spark, folder):
    return signals.average_cross(daily_bars(spark, folder), 5, 20).select("code", _day(), "signal", "trade")


def ema(spark, folder):
    e = recursive.with_ema(_priced(spark, folder), (12, 26))
    return e.select("code", _day(), *(_r(F.col(f"ema_{n}")).alias(f"ema_{n}") for n in (12, 26)))


def macd(spark, folder):
    m = recursive.with_macd(_priced(spark, folder).select("code", "day", "close"))
    return m.select("code", _day(), *(_r(F.col(c)).alias(c) for c in ("dif", "dea", "macd")))


def macd_signal(spark, folder):
    return signals.macd_cross(daily_bars(spark, folder)).select("code", _day(), "signal", "trade")


def max_pos(spark, folder):
    units = I.most_affordable(F.col("close"), F.lit(100000.0), 0.002, 100)
    return _priced(spark, folder).select("code", _day(), units.alias("position"))


def _ledger(spark, folder, rules="d", settings=None) -> DataFrame:
    t = signals.average_cross(daily_bars(spark, folder), 5, 20)
    return with_ledger(t.select("code", "day", "open", "open_pct_change", "trade"), rules, settings)


def _fed(spark, folder, by_code: bool = False) -> str:
    """The daily bars as CSV files in the shared folder until the application ends."""
    path = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    discard_at_end(spark, path)
    rows = _priced(spark, folder).select(F.col("day").cast("timestamp_ntz").alias("date"), "code", "open", "close")
    return feeds.write_csv_bars(rows.repartition("code") if by_code else rows, path, by_code)


def feed_csv(spark, folder):
    """The daily bars through CSV files, dates parsed."""
    rows = feeds.read_csv_bars(spark, _fed(spark, folder))
    return rows.select("code", F.date_format("date", "yyyy-MM-dd").alias("day"), "open", "close")


def feed_csv_text(spark, folder):
    """The same, dates as written."""
    return feeds.read_csv_bars(spark, _fed(spark, folder), parse_dates=False).select("code", "date", "close")


def feed_folder(spark, folder):
    """The daily bars through a folder of files for each instrument."""
    rows = feeds.read_bars_folder(spark, _fed(spark, folder, by_code=True), header=("date", "open", "close", "code"))
    return rows.select("code", F.date_format("date", "yyyy-MM-dd").alias("day"), "open", "close")


def feed_united(spark, folder):
    """Two feeds as one: the benchmark beside the bars, under a code of its own."""
    mark = benchmark(spark, folder).select(F.lit("benchmark").alias("code"), "day", "close")
    return feeds.union_bars(_priced(spark, folder).select("code", "day", "open", "close"), mark).select("code", _day(), "open", "close")


OTHER = Settings(cash=1_000_000.0, commission=0.003, lot=200, slippage=0.02, position_limit=0.5)


def ledger_settings(spark, folder):
    """Another account and broker, and half of the cash at most in a position."""
    return _shown(_ledger(spark, folder, "d", OTHER))


def facade_macd(spark, folder):
    """backtest_macd by way of the facade."""
    x = evaluation.final_assets(Backtest().add_data(daily_bars(spark, folder)).add_strategy(MacdCross()).set_rules("c").run())
    return x.select("code", _day(), _r(F.col("total_asset"), 3).alias("total_asset"))


def facade_report(spark, folder):
    """report_metrics by way of the facade."""
    m = Backtest().add_data(daily_bars(spark, folder)).add_strategy(AverageCross(5, 20)).evaluate(benchmark(spark, folder))
    return m.select("code", F.col("days").cast("long").alias("days"), *(_r(F.col(c), 5).alias(c) for c in m.columns[2:]))


def param_lines(spark, folder):
    """Label and summary line of each tested pair."""
    return grid_search.summary_lines(param_returns(spark, folder))


def monthly_returns(spark, folder):
    m = evaluation.monthly_returns(evaluation.strategy_returns(_ledger(spark, folder)))
    return m.select("code", F.date_format("month", "yyyy-MM").alias("month"), _r(F.col("monthly_return")).alias("monthly_return"), "days")


def drawdowns(spark, folder):
    d = evaluation.drawdowns(_ledger(spark, folder))
    return d.select("code", F.date_format("peak_day", "yyyy-MM-dd").alias("peak_day"), F.date_format("last_day", "yyyy-MM-dd").alias("last_day"), "days", _r(F.col("depth")).alias("depth"))


def _shown(ledger: DataFrame, places: int = 4) -> DataFrame:
    return ledger.select("code", _day(), "trade", *(_r(F.col(c), places).alias(c) for c in ("position", "market_value", "cash", "total_asset")))


def ledger_a(spark, folder):
    return _shown(_ledger(spark, folder, "a"))


def ledger_b(spark, folder):
    return _shown(_ledger(spark, folder, "b"))


def ledger_c(spark, folder):
    return _shown(_ledger(spark, folder, "c"), 3)


def ledger_d(spark, folder):
    return _shown(_ledger(spark, folder, "d"))


def ledger_c_fixed_volume(spark, folder):
    return _shown(_ledger(spark, folder, "c", Settings(units=1.0)), 6)


def online_sma(spark, folder):
    """ledger_d, bar by bar on a stream."""
    rows = replay_online(daily_bars(spark, folder)).where(F.col("status").isin("held", "traded"))
    return _shown(rows)


def final_asset(spark, folder):
    return evaluation.final_assets(_ledger(spark, folder)).select("code", _day(), _r(F.col("total_asset"), 4).alias("total_asset"))


def backtest_sma(spark, folder):
    """Average cross of 30 and 100 days under rules d, all rows, up to the final asset."""
    t = signals.average_cross(daily_bars(spark, folder), 30, 100)
    x = evaluation.final_assets(with_ledger(t.select("code", "day", "open", "open_pct_change", "trade"), "d"))
    return x.select("code", _day(), _r(F.col("total_asset"), 4).alias("total_asset"))


def backtest_macd(spark, folder):
    t = signals.macd_cross(daily_bars(spark, folder))
    x = evaluation.final_assets(with_ledger(t.select("code", "day", "open", "open_pct_change", "trade"), "c"))
    return x.select("code", _day(), _r(F.col("total_asset"), 3).alias("total_asset"))


def param_grid(spark, folder):
    return grid_search.pairs(spark)


def param_returns(spark, folder):
    return grid_search.grid_returns(daily_bars(spark, folder), SMALL_FAST, SMALL_SLOW).withColumn("total_returns", _r(F.col("total_returns"), 4))


def param_best(spark, folder):
    best = grid_search.best_pairs(param_returns(spark, folder))
    return best.select("code", "period_fast", "period_slow", "total_returns")


def param_returns_full(spark, folder):
    """All 780 pairs of every instrument."""
    return grid_search.grid_returns(daily_bars(spark, folder))


def param_best_full(spark, folder):
    return grid_search.best_pairs(param_returns_full(spark, folder))


def strategy_returns(spark, folder):
    return evaluation.strategy_returns(_ledger(spark, folder)).select("code", _day(), _r(F.col("stra_pct_returns"), 8).alias("stra_pct_returns"))


def benchmark_returns(spark, folder):
    return evaluation.benchmark_returns(benchmark(spark, folder)).select(_day(), _r(F.col("bench_pct_returns"), 8).alias("bench_pct_returns"))


def report_metrics(spark, folder):
    m = evaluation.report(evaluation.strategy_returns(_ledger(spark, folder)), evaluation.benchmark_returns(benchmark(spark, folder)))
    return m.select("code", F.col("days").cast("long").alias("days"), *(_r(F.col(c), 5).alias(c) for c in m.columns[2:]))


def account_view(spark, folder):
    a = evaluation.account_view(_ledger(spark, folder))
    return a.select("code", _day(), *(_r(F.col(c), 4).alias(c) for c in a.columns[2:]))


def position_view(spark, folder):
    p = evaluation.position_view(_ledger(spark, folder))
    return p.select("code", *(_r(F.col(c), 5).alias(c) for c in ("market_value", "hold_vol", "cost", "price", "daily_profit_loss", "position_ratio")), F.col("hold_days").cast("long").alias("hold_days"))


def account_history(spark, folder):
    h = books.account_history(table(spark, folder, "qt_account"))
    return h.select("account_id", "broker_id", F.date_format("date", "yyyy-MM-dd").alias("day"), *(_r(F.col(c), 4).alias(c) for c in books.MONEY))


def account_latest(spark, folder):
    x = books.latest_accounts(books.account_history(table(spark, folder, "qt_account")), table(spark, folder, "qt_broker"))
    return x.select("account_id", "broker_id", F.date_format("date", "yyyy-MM-dd").alias("day"), "total_asset", "cash", "commission", F.col("min_size").cast("long").alias("min_size"), "pct_limit")


def position_book(spark, folder):
    p = books.position_book(table(spark, folder, "qt_position"))
    return p.select("account_id", "code", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "name", "market_value", "hold_vol", "cost", _r(F.col("price")).alias("price"), _r(F.col("share")).alias("share"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        bars_daily, pct_change_open, sma, sma_warmup_drop, llv, hhv, rsv, kdj, crossup_sma, trade_delay, ema, macd, macd_signal, max_pos, ledger_a, ledger_b, ledger_c, ledger_d, ledger_c_fixed_volume, online_sma,
        final_asset, backtest_sma, backtest_macd, param_grid, param_returns, param_best, param_returns_full, param_best_full, strategy_returns, benchmark_returns, report_metrics, account_view, position_view,
        account_history, account_latest, position_book, feed_csv, feed_csv_text, feed_folder, feed_united, ledger_settings, facade_macd, facade_report, param_lines, monthly_returns, drawdowns,
    )
}
