"""Views and figures of a finished ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import indicators as I

YEAR = 252.0


def final_assets(ledger: DataFrame, keys: tuple[str, ...] = ("code",), order: str = "day") -> DataFrame:
    """keys, day and total_asset of the last row."""
    return ledger.groupBy(*keys).agg(F.max(order).alias(order), F.max_by("total_asset", order).alias("total_asset"))


def strategy_returns(ledger: DataFrame) -> DataFrame:
    """code, day, stra_pct_returns; 0 on the first row."""
    w = I.series()
    ratio = F.try_divide("total_asset", F.lag("total_asset").over(w)) - 1
    return ledger.select("code", "day", F.coalesce(ratio, F.lit(0.0)).alias("stra_pct_returns"))


def benchmark_returns(benchmark: DataFrame) -> DataFrame:
    """day, bench_pct_returns.  The benchmark is one series of a few thousand days, fixed in size."""
    w = Window.partitionBy(F.lit(1)).orderBy("day")
    ratio = F.try_divide("close", F.lag("close").over(w)) - 1
    return benchmark.select("day", F.coalesce(ratio, F.lit(0.0)).alias("bench_pct_returns"))


def report(returns: DataFrame, bench: DataFrame) -> DataFrame:
    """Per instrument: days, cumulative return, growth a year, volatility, Sharpe, Sortino, largest
    drawdown, win rate, beta and alpha to the benchmark.  The benchmark (fixed size) is broadcast."""
    w = I.series()
    wealth = F.exp(F.sum(F.log(F.greatest(1 + F.col("stra_pct_returns"), F.lit(1e-12)))).over(w))
    r = returns.withColumn("wealth", wealth)
    r = r.withColumn("drawdown", F.col("wealth") / F.greatest(F.max("wealth").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1.0)) - 1)
    r = r.join(F.broadcast(bench), "day", "left").withColumn("b", F.coalesce("bench_pct_returns", F.lit(0.0)))
    x = F.col("stra_pct_returns")
    a = r.groupBy("code").agg(
        F.count(F.lit(1)).alias("days"), F.max_by("wealth", "day").alias("wealth"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.sqrt(F.avg(F.pow(F.least(x, F.lit(0.0)), 2))).alias("down"),
        F.min("drawdown").alias("max_drawdown"), F.avg((x > 0).cast("double")).alias("win_rate"), F.covar_samp(x, "b").alias("cov"), F.var_samp("b").alias("var"), F.avg("b").alias("bench_mean"))
    beta = F.try_divide("cov", "var")
    return a.select(
        "code", "days", (F.col("wealth") - 1).alias("cumulative_return"), (F.pow("wealth", F.lit(YEAR) / F.col("days")) - 1).alias("yearly_growth"), (F.col("sd") * F.sqrt(F.lit(YEAR))).alias("volatility"),
        (F.try_divide("mean", "sd") * F.sqrt(F.lit(YEAR))).alias("sharpe"), (F.try_divide("mean", "down") * F.sqrt(F.lit(YEAR))).alias("sortino"), "max_drawdown", "win_rate", beta.alias("beta"), ((F.col("mean") - beta * F.col("bench_mean")) * YEAR).alias("alpha"))


def account_view(ledger: DataFrame) -> DataFrame:
    """The account by day: total asset, market value, floating and daily profit or loss, cash.

    The floating figure is the market value less that of the day the holding was opened."""
    w = I.series()
    opened = F.last(F.when(F.col("position") != F.coalesce(F.lag("position").over(w), F.lit(0.0)), F.col("market_value")), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    daily = F.coalesce(F.col("total_asset") - F.lag("total_asset").over(w), F.lit(0.0))
    floating = F.when(F.col("position") != 0, F.col("market_value") - opened).otherwise(0.0)
    return ledger.select("code", "day", "total_asset", "market_value", floating.alias("float_profit_loss"), daily.alias("daily_profit_loss"), "cash")


def position_view(ledger: DataFrame) -> DataFrame:
    """The last holding of each instrument: units, cost and price, share of the assets, days held."""
    w = I.series()
    changed = F.col("position") != F.coalesce(F.lag("position").over(w), F.lit(0.0))
    x = ledger.withColumns({"turn": F.when(changed, F.col("day")), "entry": F.when(changed, F.col("open"))})
    last = lambda c: F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumns({"since": last("turn"), "cost": last("entry"), "daily": F.coalesce(F.col("total_asset") - F.lag("total_asset").over(w), F.lit(0.0))})
    x = x.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("code", "since").orderBy("day")))
    final = x.groupBy("code").agg(F.max_by(F.struct("position", "market_value", "total_asset", "cost", F.col("open").alias("price"), "daily", "held"), "day").alias("x")).select("code", "x.*")
    holds = F.col("position") != 0
    return final.select("code", "market_value", F.col("position").alias("hold_vol"), F.when(holds, F.col("cost")).alias("cost"), "price", F.col("daily").alias("daily_profit_loss"), F.try_divide("market_value", "total_asset").alias("position_ratio"), F.when(holds, F.col("held")).otherwise(0).alias("hold_days"))


def monthly_returns(returns: DataFrame) -> DataFrame:
    """code, month (first day), monthly_return, days: the days' returns of each month, compounded."""
    months = returns.groupBy("code", F.trunc("day", "month").alias("month"))
    return months.agg((F.product(1 + F.col("stra_pct_returns")) - 1).alias("monthly_return"), F.count(F.lit(1)).alias("days"))


def drawdowns(ledger: DataFrame) -> DataFrame:
    """code, peak_day, last_day, days, depth: each stretch below the highest asset so far, from the day of
    that peak.  The windows and the aggregate share one exchange."""
    w = I.series().rowsBetween(Window.unboundedPreceding, 0)
    under = ledger.select("code", "day", "total_asset").withColumn("peak", F.max("total_asset").over(w))
    under = under.withColumn("peak_day", F.max(F.when(F.col("total_asset") >= F.col("peak"), F.col("day"))).over(w)).where("total_asset < peak")
    return under.groupBy("code", "peak_day").agg(F.max("day").alias("last_day"), F.count(F.lit(1)).alias("days"), F.min(F.col("total_asset") / F.col("peak") - 1).alias("depth"))
