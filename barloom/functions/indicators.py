"""Technical indicators as window expressions.

All take columns and a series window (partitioned by instrument, ordered by
date), keep the number of rows, and are NULL until their frame is full or
where the frame holds a NULL.  Windows of one query share one exchange and sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series(code: str = "code", order: str = "day") -> WindowSpec:
    return Window.partitionBy(code).orderBy(order)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _over_full_frame(x: Column | str, n: int, w: WindowSpec, how) -> Column:
    if n < 1:
        raise ValueError("a period is at least 1")
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(_col(x)).over(frame) == n, how(_col(x)).over(frame))


def sma(x: Column | str, n: int, w: WindowSpec) -> Column:
    """Simple mean of the last n rows."""
    return _over_full_frame(x, n, w, F.avg)


def lowest(x: Column | str, n: int, w: WindowSpec) -> Column:
    return _over_full_frame(x, n, w, F.min)


def highest(x: Column | str, n: int, w: WindowSpec) -> Column:
    return _over_full_frame(x, n, w, F.max)


def rsv(close: Column | str, high: Column | str, low: Column | str, n: int, w: WindowSpec) -> Column:
    """Place of the close within the range of the last n rows, in percent; NULL for an empty range."""
    floor = lowest(low, n, w)
    return F.try_divide(_col(close) - floor, highest(high, n, w) - floor) * 100


def with_kdj(df: DataFrame, w: WindowSpec, n: int, m1: int, m2: int, close: str = "close", high: str = "high", low: str = "low") -> DataFrame:
    """Adds rsv, k (mean of m1 rsv), d (mean of m2 k) and j = 3k - 2d."""
    df = df.withColumn("rsv", rsv(close, high, low, n, w))
    df = df.withColumn("k", sma("rsv", m1, w))
    df = df.withColumn("d", sma("k", m2, w))
    return df.withColumn("j", 3 * F.col("k") - 2 * F.col("d"))


def crossed(x: Column | str, y: Column | str, w: WindowSpec) -> Column:
    """1 where x rises through y, -1 where it falls through, else NULL; a touch counts as the side before."""
    gap = F.signum(_col(x) - _col(y))
    before = F.lag(gap).over(w)
    return F.when((before <= 0) & (gap > 0), F.lit(1)).when((before >= 0) & (gap < 0), F.lit(-1))


def pct_change(x: Column | str, w: WindowSpec) -> Column:
    """Relative change to the row before; 0 for the first row.  NULLs are bridged by the last value."""
    padded = F.last(_col(x), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(_col(x), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.try_divide(padded, before) - 1, F.lit(0.0))


def lot_floor(value: Column, lot: Column | int) -> Column:
    """The largest multiple of lot that is at most value."""
    return value - F.pmod(value, lot if isinstance(lot, Column) else F.lit(float(lot)))


def most_affordable(price: Column, cash: Column, commission: Column | float, lot: Column | int) -> Column:
    """Units that the cash buys after commission, in whole lots."""
    return lot_floor(cash * (F.lit(1.0) - commission) / price, lot)


def null_for_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """What grouped Python gives back as NaN is NULL."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})
