"""Rolling totals over trailing calendar periods, by binary doubling.

Sums and counts of blocks of 1, 2, 4, 8 and 16 days, and further doubles as far
as the longest period asks, are built one from the other (a block of 2k days is
the block of k days that ends here plus the one that ended k days before); any
trailing period is then a combination of shifted blocks: 7 = 4 + 2 + 1, 30 = 16
+ 8 + 4 + 2.

Scale: readings are sent once, by source and day, and reduced to one row for
each, so a source is bounded by the length of its history; the dense grid of
days makes every shift a plain lag.  All levels are windows on the same
partitioning and order: one exchange and one sort for the whole operator.

Defined results: days without activity are rows with n = 0, total 0 and a null
average if the period is empty; null values are no activity; of bars
delivered again for the same time the last with a value counts once; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.readings import latest


def shifted_blocks(period: int) -> list[tuple[int, int]]:
    """(block, shift) pairs that cover the trailing ``period`` days once each."""
    if period < 1:
        raise ValueError("a period has at least one day")
    parts, shift = [], 0
    for power in reversed(range(period.bit_length())):
        if period >> power & 1:
            parts.append((1 << power, shift))
            shift += 1 << power
    return parts


def rolling_totals(readings: DataFrame, value: str = "close", periods: tuple[int, ...] = (7, 30)) -> DataFrame:
    """code, day, and total_p, avg_p, n_p for every period p, for each calendar day from the
    first to the last reading with a value.

    readings: bar_id, code, date, day, value (null where not usable)."""
    rows = latest(readings.where(F.col(value).isNotNull()), value)
    daily = rows.groupBy("code", "day").agg(F.sum(value).alias("s1"), F.count(value).cast("int").alias("n1"))
    # the gaps become rows: each day with activity opens the days up to the next one
    w = Window.partitionBy("code").orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(w), 1), F.col("day"))
    dense = daily.withColumn("until", until).select("code", "s1", "n1", F.col("day").alias("from_day"), F.explode(F.sequence("day", "until")).alias("day"))
    first = F.col("day") == F.col("from_day")
    level = dense.select("code", "day", F.when(first, F.col("s1")).otherwise(0.0).alias("s1"), F.when(first, F.col("n1")).otherwise(0).alias("n1"))
    for k in (1 << power for power in range(max(periods).bit_length() - 1)):
        level = level.withColumns({f"{c}{2 * k}": F.col(f"{c}{k}") + F.lag(f"{c}{k}", k, 0).over(w) for c in "sn"})

    def combined(c: str, period: int) -> Column:
        total = None
        for block, shift in shifted_blocks(period):
            part = F.lag(f"{c}{block}", shift, 0).over(w) if shift else F.col(f"{c}{block}")
            total = part if total is None else total + part
        return total

    out = level.withColumns({f"{'total' if c == 's' else 'n'}_{p}": combined(c, p) for c in "sn" for p in periods})
    cols = [x for p in periods for x in (F.col(f"total_{p}"), F.when(F.col(f"n_{p}") > 0, F.col(f"total_{p}") / F.col(f"n_{p}")).alias(f"avg_{p}"), F.col(f"n_{p}"))]
    return out.select("code", F.date_format("day", "yyyy-MM-dd").alias("day"), *cols)


def idle_days(totals: DataFrame, period: int = 7) -> DataFrame:
    """The days whose trailing period holds no activity."""
    return totals.where(F.col(f"n_{period}") == 0).select("code", "day")
