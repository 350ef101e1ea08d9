"""Irregular readings onto a regular grid.

For each source one entry per open day, at a fixed time of day, from its first
to its last reading: an as-of merge of the sorted grid with the sorted
readings, taking the neighbours on both sides; a day without a reading gets
the time-weighted linear interpolation of the two, unless the gap is longer
than the limit, in which case it is marked and left empty.

Scale: the readings of a (source, day) are reduced first, map-side, to those
that an as-of merge can pick: the last one up to the grid time, the first one
from it, and the first and last of the day.  A source is then bounded by the
days of the calendar, and both sides of the merge are windows over one
exchange.

Defined results: a reading without a usable value still makes its day
observed (status "observed_without_value", its value interpolated where the
gap allows); ties at one time are settled by the latest delivery with a usable value; a source
with one reading has one entry; a side without any value is a gap without a
length; an empty table gives an empty grid; values
that are not positive are not used as neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.readings import moment, open_days


def regular_series(readings: DataFrame, calendar: DataFrame, value: str = "open", at_hour: int = 15, gap_limit_days: int = 5) -> DataFrame:
    """code, day, value, status (observed, observed_without_value, filled, gap), gap_days.

    readings: bar_id, code, date, day, value (null where not usable)."""
    days = open_days(calendar)
    grid_time = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(at_hour))
    use = F.col(value) > 0
    rows = readings.select("code", "day", "date", value, F.when(use, moment(F.col("date"), F.col("bar_id"))).alias("late"), F.when(use, moment(F.col("date"), -F.col("bar_id"))).alias("early"))
    pre, post = F.col("date") <= grid_time, F.col("date") >= grid_time

    def pick(first: bool, when=F.lit(True)):
        k = F.when(when, F.col("early" if first else "late"))
        t = F.when(when & use, F.col("date"))
        return (F.min if first else F.max)(t), (F.min_by if first else F.max_by)(value, k)

    (bt, bv), (at, av), (ft, fv), (lt, lv) = pick(False, pre), pick(True, post), pick(True), pick(False)
    daily = rows.groupBy("code", "day").agg(bt.alias("bt"), bv.alias("bv"), at.alias("at"), av.alias("av"), ft.alias("ft"), fv.alias("fv"), lt.alias("lt"), lv.alias("lv"))
    daily = daily.join(F.broadcast(days), "day")
    # the grid: each day with a reading opens the open days up to the next one
    until = F.coalesce(F.lead("day_no").over(Window.partitionBy("code").orderBy("day_no")) - 1, F.col("day_no"))
    merged = daily.drop("day").withColumn("until", until).withColumnRenamed("day_no", "from_no").withColumn("day_no", F.explode(F.sequence("from_no", "until")))
    has = F.col("day_no") == F.col("from_no")
    merged = merged.select("code", "day_no", has.alias("has"), *(F.when(has, F.col(c)).alias(c) for c in ("bt", "bv", "at", "av", "ft", "fv", "lt", "lv")))
    forward = Window.partitionBy("code").orderBy("day_no").rowsBetween(Window.unboundedPreceding, -1)
    backward = Window.partitionBy("code").orderBy(F.desc("day_no")).rowsBetween(Window.unboundedPreceding, -1)
    # the two sides, as of the grid time: from other days, both as running aggregates, then from the day itself
    merged = merged.withColumn("valued", F.when(F.col("ft").isNotNull(), F.col("day_no")))
    sided = merged.withColumns({"pt": F.last("lt", True).over(forward), "pv": F.last("lv", True).over(forward), "pn": F.last("valued", True).over(forward)})
    sided = sided.withColumns({"nt": F.last("ft", True).over(backward), "nv": F.last("fv", True).over(backward), "nn": F.last("valued", True).over(backward)})
    sided = sided.join(F.broadcast(days), "day_no")
    own = lambda t, mine, other: F.when(F.col(t).isNotNull(), F.col(mine)).otherwise(F.col(other))
    sided = sided.select("code", "day", "has", "ft", "bv", "av", own("bt", "bt", "pt").alias("pt"), own("bt", "bv", "pv").alias("pv"), own("bt", "day_no", "pn").alias("pn"), own("at", "at", "nt").alias("nt"), own("at", "av", "nv").alias("nv"), own("at", "day_no", "nn").alias("nn"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    here, left, right = micros(grid_time), micros(F.col("pt")), micros(F.col("nt"))
    line = F.when(F.col("pt") == F.col("nt"), F.col("pv")).when(right > left, F.col("pv") + (F.col("nv") - F.col("pv")) * (here - left) / (right - left))
    gap = F.when(F.col("nn").isNotNull() & F.col("pn").isNotNull(), F.greatest(F.col("nn") - F.col("pn") - 1, F.lit(0)))  # days without a value between the two neighbours
    near = gap <= gap_limit_days
    seen = F.col("has")
    status = F.when(seen & F.col("ft").isNotNull(), "observed").when(seen, "observed_without_value").when(near, "filled").otherwise("gap")
    value_at = F.when(near, line)
    return sided.select("code", F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce(value_at, F.when(F.col("ft").isNotNull(), F.coalesce("bv", "av"))).alias("value"), status.alias("status"), gap.alias("gap_days"))


def missing_days(series: DataFrame) -> DataFrame:
    """The days of the grid on which the source has no reading."""
    return series.where(F.col("status").isin("filled", "gap")).select("code", "day")
