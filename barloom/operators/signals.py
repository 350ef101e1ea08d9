"""From indicators to trades: crosses at the close, executed at the next open."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import indicators as I


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with a NULL in any (or any of the given) columns leave."""
    return df.na.drop("any", subset=columns)


def with_signal(df: DataFrame, fast: str, slow: str, code: str = "code", order: str = "day") -> DataFrame:
    """signal: 1 or -1 where fast crosses slow, else NULL."""
    return df.withColumn("signal", I.crossed(fast, slow, I.series(code, order)))


def with_trade(df: DataFrame, code: str = "code", order: str = "day") -> DataFrame:
    """trade: the signal of the kept row before, 0 where there is none.  Apply after incomplete rows have left."""
    return df.withColumn("trade", F.coalesce(F.lag("signal").over(I.series(code, order)), F.lit(0)))


def average_cross(bars: DataFrame, fast: int, slow: int) -> DataFrame:
    """code, day, open, close, open_pct_change, ma_fast, ma_slow, signal, trade of rows whose slow average
    has a value on the row before too.

    bars: code, day and whole thousandths o, c.  Every window has one partitioning: a single exchange."""
    w = I.series()
    ma = bars.withColumns({"open_pct_change": I.pct_change(F.col("o").cast("double"), w), "ma_fast": I.sma("c", fast, w), "ma_slow": I.sma("c", slow, w)})
    ma = with_signal(ma, "ma_fast", "ma_slow").withColumn("past_slow", F.lag("ma_slow").over(w))
    kept = with_trade(ma.where("past_slow is not null"))
    third = lambda c: F.col(c) / F.lit(1000.0)
    return kept.select("code", "day", third("o").alias("open"), third("c").alias("close"), "open_pct_change", third("ma_fast").alias("ma_fast"), third("ma_slow").alias("ma_slow"), "signal", "trade")


def macd_cross(bars: DataFrame, fast: int = 12, slow: int = 26, smooth: int = 9) -> DataFrame:
    """As average_cross, with dif crossing dea; rows whose dea has a value on the row before too."""
    from barloom.operators.recursive import with_macd

    w = I.series()
    prices = bars.select("code", "day", (F.col("o") / F.lit(1000.0)).alias("open"), (F.col("c") / F.lit(1000.0)).alias("close"), I.pct_change(F.col("o").cast("double"), w).alias("open_pct_change"))
    m = with_signal(with_macd(prices, fast, slow, smooth), "dif", "dea").withColumn("past", F.lag("dea").over(w))
    return with_trade(m.where("past is not null").drop("past"))
